"""Slow, plain counterparts used as checks on small tables."""

from __future__ import annotations

from shelfmark.operators import repos as rp


def chosen_files(files: list[str], subpath: str | None, k: int) -> list[str]:
    folder = (subpath or "").lower()
    inside = lambda p: bool(folder) and p.lower().startswith(folder + "/")

    def wanted(p: str) -> bool:
        low, name = p.lower(), p.lower().split("/")[-1]
        if folder and not inside(p) and low != folder and "/" in p:
            return False
        if low.endswith(rp.EXCLUDED_EXTENSIONS) or any(x in low for x in rp.EXCLUDED_FOLDERS):
            return False
        return any(n.lower() in name for n in rp.KEY_FILES) or any(x in low for x in rp.KEY_PATTERNS)

    kept = [p for p in files if wanted(p)]
    return sorted(kept, key=lambda p: (not inside(p), p.count("/"), p))[:k]
