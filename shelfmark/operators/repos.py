"""Choice of a tree and of the most telling files of each repository.

Landed tables: trees `(keys, branch, path, type)`, one row per entry; status
`(keys, status_code, default_branch)`; contents `(keys, ref, path, content)`.
`keys` name the repository, by default owner and repo.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.answers import decoded_payload, strictly_decoded
from shelfmark.functions.text import any_of, cut, strip
from shelfmark.operators.keysets import key_bitmap, maybe_among, maybe_among_first

KEYS = ("owner", "repo")

# File names, path parts, extensions and folders that decide what is fetched.
KEY_FILES = (
    "README.md", "readme.md", "README", "docker-compose.yml", "docker-compose.yaml",
    "requirements.txt", "pyproject.toml", "Dockerfile", "Makefile", "setup.py",
)
KEY_PATTERNS = (
    ".tf", "dags/", "terraform/", "airflow/", "kafka", "flink", "kestra", "prefect", "mage",
)
EXCLUDED_EXTENSIONS = (
    ".png", ".jpg", ".jpeg", ".gif", ".svg", ".ico", ".webp", ".pdf", ".zip", ".gz", ".tar",
    ".rar", ".csv", ".parquet", ".pkl", ".h5", ".bin", ".exe", ".dll", ".so", ".lock", ".log",
    ".mp3", ".mp4", ".wav", ".avi",
)
EXCLUDED_FOLDERS = ("/node_modules/", "/__pycache__/", "/.git/", "/venv/", "/.venv/")
BRANCHES = ("main", "master")
MAX_FILES = 10
# Bits of the bitmap of files, 32 megabytes: of 15 million, one other file in eighteen passes.
BITS = 1 << 28


def depth_of(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def in_folder(path: Column, folder: Column) -> Column:
    """Whether the path lies below the folder, case ignored; no folder counts as no."""
    below = F.lower(path).startswith(F.concat(F.lower(folder), F.lit("/")))
    return F.coalesce((folder != "") & below, F.lit(False))


# The lists above as three patterns on the lower-cased path.
_NAMES, _PARTS = [n.lower() for n in KEY_FILES], list(KEY_PATTERNS)
_STARTS = re.escape("".join(sorted({t[0] for t in _NAMES + _PARTS})))
TELLING = rf"(?s)(?=[{_STARTS}])(?:{any_of(_NAMES)}[^/]*\z|{any_of(_PARTS)})"
BINARY = rf"{any_of(EXCLUDED_EXTENSIONS)}\z"
COPIED = any_of(EXCLUDED_FOLDERS)
KEY_FILE = rf"(?s)\A(?!.*(?:{BINARY}|{COPIED})).*?{TELLING.removeprefix('(?s)')}"


def is_key_file(path: Column) -> Column:
    """Whether a file helps to describe any project: by name or place, not binary, not a copy.

    As a filter this moves down to the scan and repeats whatever `path` is made
    of, so one pattern looks at the path once.
    """
    return F.lower(path).rlike(KEY_FILE)


def should_fetch(path: Column, subpath: Column) -> Column:
    """A key file below `subpath` or at the root; without a subpath, any key file."""
    anywhere = F.coalesce(subpath, F.lit("")) == ""
    itself = F.coalesce(F.lower(path) == F.lower(subpath), F.lit(False))
    return (anywhere | in_folder(path, subpath) | itself | ~path.contains("/")) & is_key_file(path)


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key of a landed table: the latest by `landed_at` where there is one, then by all columns.

    Repeated landings of a key are cut to one row per map task before the shuffle.
    """
    latest = [F.desc("landed_at")] if "landed_at" in df.columns else []
    rest = [F.asc_nulls_last(c) for c in df.columns if c not in (*keys, "landed_at")]
    order = Window.partitionBy(*keys).orderBy(*(latest + rest or [F.asc(keys[0])]))
    return df.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def choose_tree(
    projects: DataFrame,
    trees: DataFrame,
    status: DataFrame | None = None,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Add `tree_branch`, `default_branch` and `not_found` to projects `(keys, branch, ...)`.

    The first branch with a landed tree counts, in the order: branch of the URL,
    main, master, default branch of the repository. Without any, the repository
    is not found if its landed status is 404. `branch` is the URL's, or null.

    Both sides are reduced to distinct branches before they meet, so neither a
    huge tree nor a repository submitted very often makes a big group. A status
    landed several times counts once.
    """
    keys = list(keys)
    if status is not None:
        known = [c for c in (*keys, "status_code", "default_branch", "landed_at") if c in status.columns]
        once = one_per_key(status.select(*known), keys)
        base = projects.join(once.select(*keys, "status_code", "default_branch"), keys, "left")
    else:
        base = projects.withColumns(
            {"status_code": F.lit(None).cast("int"), "default_branch": F.lit(None).cast("string")}
        )
    order = F.array(
        F.nullif("branch", F.lit("")), *[F.lit(b) for b in BRANCHES], F.col("default_branch")
    )
    asked = base.select(*keys, "branch", "default_branch").distinct()
    candidates = asked.select(*keys, "branch", F.posexplode(order).alias("_rank", "_candidate"))
    landed = trees.select(*keys, F.col("branch").alias("_candidate")).distinct()
    first = (
        candidates.join(landed, [*keys, "_candidate"], "left_semi")
        .groupBy(*[F.col(c).alias(f"_{c}") for c in keys], F.col("branch").alias("_branch"))
        .agg(F.min("_rank").alias("_first"))
    )
    same = F.col("branch").eqNullSafe(F.col("_branch"))
    for c in keys:
        same = same & (F.col(c) == F.col(f"_{c}"))
    chosen = base.join(first, same, "left").withColumn("tree_branch", F.get(order, F.col("_first")))
    missing = F.col("tree_branch").isNull() & F.col("status_code").eqNullSafe(404)
    return chosen.withColumn("not_found", missing).drop(
        "_first", "_branch", *[f"_{c}" for c in keys], "status_code"
    )


def folders_above(path: Column) -> Column:
    """Every folder a path lies in, lower case, from '' for the root down to the path itself."""
    # One split per path: the parts are the variable of an outer one-element transform.
    prefixes = lambda parts: F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"),
    )
    return F.get(F.transform(F.array(F.split(F.lower(path), "/")), prefixes), 0)


def ranked_files(
    projects: DataFrame, trees: DataFrame, k: int = MAX_FILES, keys: Sequence[str] = KEYS
) -> DataFrame:
    """The k most telling files per project: inside its folder first, then flat, then by path.

    `projects` carry tree_branch and subpath. Projects and files are never
    paired before the choice: one repository may hold the projects of a whole
    course, each in a folder of its own, and pairs would grow with the square.
    Instead every key file is listed under each folder above it that some project
    asks for, and cut to k per folder, which happens per map task before the
    shuffle. A project then takes the k of its folder and the root files among
    the k of the whole tree. Bitmaps of the chosen trees and of the asked folders
    leave out other files and folders before anything moves; what they let pass by
    chance finds no project.
    """
    keys = [*keys, "tree_branch"]
    files = trees.where((F.col("type") == "blob") & is_key_file(F.col("path"))).select(
        *keys[:-1], F.col("branch").alias("tree_branch"), "path"
    )
    files = maybe_among(files, key_bitmap(projects.select(*keys), keys, BITS), keys, BITS)
    files = files.withColumn("_depth", depth_of(F.col("path")))
    listed = files.select("*", F.explode_outer(folders_above(F.col("path"))).alias("_folder"))
    listed = listed.withColumn(
        "_inside", (F.col("_folder") != "") & (F.col("_folder") != F.lower("path"))
    )
    asked = projects.withColumn("_asked", F.lower(F.coalesce("subpath", F.lit(""))))
    # A folder is looked up under its own name and under the root; one look at the trees serves both.
    names = F.when(F.col("_asked") == "", F.array(F.lit(""))).otherwise(F.array("_asked", F.lit("")))
    lookups = asked.select(*keys, "_asked").distinct()
    lookups = lookups.select(*keys, "_asked", F.explode_outer(names).alias("_folder"))
    by_folder = [*keys, "_folder"]
    listed = maybe_among(listed, key_bitmap(lookups.select(*by_folder), by_folder, BITS), by_folder, BITS)
    best = [F.desc("_inside"), F.asc("_depth"), F.asc("path")]
    in_order = Window.partitionBy(*by_folder).orderBy(*best)
    top = listed.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= k)

    # A root file whose own path is the asked folder is already listed under it.
    from_root = (F.col("_depth") == 0) & (F.lower("path") != F.col("_asked"))
    found = top.drop("rank").join(lookups, by_folder)
    found = found.where((F.col("_folder") == F.col("_asked")) | from_root)
    per_folder = Window.partitionBy(*keys, "_asked").orderBy(*best)
    ranked = found.withColumn("rank", F.row_number().over(per_folder)).where(F.col("rank") <= k)
    return asked.join(ranked.select(*keys, "_asked", "path", "rank"), [*keys, "_asked"]).drop("_asked")


def _moved(per_file: int | None, text: Column | None) -> Column:
    """What of a content is moved."""
    if text is not None:
        return text
    return F.col("content") if per_file is None else F.substring("content", 1, per_file)


def wanted_texts(
    files: DataFrame, contents: DataFrame, keys: Sequence[str] = KEYS, per_file: int | None = None, text: Column | None = None
) -> DataFrame:
    """`(keys, path, _ref, content)` of the files `(keys, path, _ref)`: the latest landing of each, '' as ref where it had none.

    A bitmap of the refs asked for goes to the scan of the contents, so that other texts are not moved at all, nor other
    branches of the same file. Texts are cut to `per_file` characters there, or become `text`, an expression of
    `content`. The few that the bitmap lets pass go after that one shuffle. Empty texts are left out.
    """
    text = _moved(per_file, text)
    on = [*keys, "path", "_ref"]
    landed = ["landed_at"] if "landed_at" in contents.columns else []
    held = contents.where(F.length("content") > 0).withColumn("_ref", F.coalesce("ref", F.lit("")))
    near = maybe_among(held.select(*on, "content", *landed), key_bitmap(files, on, BITS), on, BITS)
    once = one_per_key(near.select(*on, text.alias("content"), *landed), on).drop("landed_at")
    return once.join(files.select(*on), on, "left_semi")


def gathered_texts(
    files: DataFrame, contents: DataFrame, keys: Sequence[str] = KEYS, per_file: int | None = None, text: Column | None = None
) -> DataFrame:
    """Those of the files `(keys, path, _ref, ...)` that have a text, with `content`; all of a repository in one place.

    Files and texts are dealt out by `keys` alone and meet in order of path and ref, so a text moves once, also for a
    caller who groups by `keys` next. `_plain` tells whether the path was landed without a ref. A bitmap of the refs
    asked for leaves out other texts where the contents are read, before they are put together. Texts are cut there,
    but landings of one file are told apart only where they meet. Keys and paths of files are not null.
    """
    on = [*keys, "path", "_ref"]
    landed = F.col("landed_at") if "landed_at" in contents.columns else F.lit(0)
    held = contents.where(F.length("content") > 0).dropna(subset=list(keys)).withColumn("_ref", F.coalesce("ref", F.lit("")))
    near = maybe_among_first(held, key_bitmap(files, on, BITS, len(keys)), on, BITS, len(keys))
    texts = near.select(*on, _moved(per_file, text).alias("content"), landed.alias("_landed"), F.lit(True).alias("_text"))
    both = files.withColumn("_text", F.lit(False)).unionByName(texts, allowMissingColumns=True).repartition(*keys)
    # Texts of a ref come before the files that ask for it, the latest first.
    order = [F.desc("_text"), F.desc("_landed"), F.asc_nulls_last("content")]
    best = Window.partitionBy(*on).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = F.max(F.col("_text") & (F.col("_ref") == "")).over(Window.partitionBy(*on[:-1]))
    found = {"content": F.first("content").over(best), "_found": F.first("_text").over(best)}
    met = both.withColumns(found).withColumn("_plain", plain).where(~F.col("_text") & F.col("_found"))
    return met.select(*files.columns, "content", "_plain")


def with_contents(
    files: DataFrame, contents: DataFrame, keys: Sequence[str] = KEYS, per_file: int | None = None
) -> DataFrame:
    """Selected files with their text, requested at `ref`, where null means without a ref.

    Empty texts are left out, a text landed several times counts once, and texts
    are cut to `per_file` characters before they are shuffled.
    """
    asked = files.withColumn("_ref", F.coalesce("ref", F.lit("")))
    return asked.join(wanted_texts(asked, contents, keys, per_file), [*keys, "_ref", "path"]).drop("_ref")


def key_files(
    projects: DataFrame,
    trees: DataFrame,
    contents: DataFrame,
    k: int = MAX_FILES,
    keys: Sequence[str] = KEYS,
    per_file: int | None = None,
    text: Column | None = None,
    gathered: bool = False,
) -> DataFrame:
    """The k files per project with their texts, cut to `per_file` characters where given.

    Texts come from the branch of the URL, or else the default branch, even
    where the tree was found on a fallback branch. Where neither is known, they
    come from what was landed without a ref, or else from the branch of the tree.
    The contents are read once: whether a path was landed without a ref is seen beside its texts.
    Only texts of these refs move. A caller who wants no texts but what `text` makes of `content`, such as a
    digest, has only that moved. A caller who groups by `keys` next asks for them `gathered`: all texts of a
    repository then go to one task, in one move. Otherwise they stay spread over its paths.
    """
    keys = list(keys)
    on = [*keys, "path"]
    ranked = ranked_files(projects, trees, k, keys)
    known = F.coalesce(F.nullif("branch", F.lit("")), "default_branch")
    refs = F.when(known.isNotNull(), F.array(known)).otherwise(F.array(F.lit(""), F.coalesce("tree_branch", F.lit(""))))
    if gathered:
        asked = ranked.withColumn("_sure", known.isNotNull()).select("*", F.explode_outer(F.array_distinct(refs)).alias("_ref"))
        met = gathered_texts(asked, contents, keys, per_file, text)
        met = met.where(F.col("_sure") | ((F.col("_ref") == "") == F.col("_plain")))
        met = met.withColumn("ref", F.when(F.col("_sure") | ~F.col("_plain"), F.col("_ref")))
        return met.drop("_ref", "_sure", "_plain")
    texts = wanted_texts(ranked.select(*on, F.explode_outer(refs).alias("_ref")), contents, keys, per_file, text)
    plain = F.max(F.col("_ref") == "").over(Window.partitionBy(*on))
    texts = texts.withColumn("_plain", plain)
    unnamed = F.when(F.col("_plain"), F.lit(None).cast("string")).otherwise(F.col("tree_branch"))
    found = ranked.join(texts, on).withColumn("ref", F.when(known.isNotNull(), known).otherwise(unnamed))
    return found.where(F.coalesce("ref", F.lit("")) == F.col("_ref")).drop("_ref", "_plain")


def best_readme(files: DataFrame, n: int = 700, by: Sequence[str] = KEYS) -> DataFrame:
    """The README nearest to the root, per project, with its beginning on one line."""
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    order = Window.partitionBy(*by).orderBy(depth_of(F.col("path")), "rank")
    flat = F.replace(F.substring("content", 1, n), F.lit("\n"), F.lit(" "))
    return (
        files.where(name.isin("readme.md", "readme"))
        .withColumn("_first", F.row_number().over(order))
        .where("_first = 1")
        .select(*by, F.col("path").alias("readme_path"), strip(flat).alias("readme_preview"))
    )


# How the files of a project are laid out in one text, per purpose:
# text before and after a path, text after a content, limits, mark of a cut.
LAYOUTS = {
    "title": ("\n=== ", " ===\n", "", 2000, 6000, ""),
    "classification": ("\n--- ", " ---\n", "\n", 3000, 12000, "\n[truncated...]"),
    "general": ("\n--- ", " ---\n", "\n", 4000, 15000, "\n[truncated...]"),
}


def longest_cut(layouts: Sequence[str]) -> int:
    """The most characters of a file that any of the layouts takes."""
    return max(LAYOUTS[layout][3] for layout in layouts)


def contexts(
    files: DataFrame, layouts: Sequence[str], by: Sequence[str] = KEYS
) -> DataFrame:
    """The files of a project `(by, rank, path, content)` as one text per layout, in rank order.

    All layouts are gathered in one shuffle, as columns `<layout>_context`.
    Texts are cut before they are gathered, and files whose rank alone puts them
    behind the total limit are left out, which bounds each gathered group.
    """
    gathered, texts = [], []
    for layout in layouts:
        before, after, tail, per_file, total, mark = LAYOUTS[layout]
        text = F.substring("content", 1, per_file)
        block = F.concat(F.lit(before), F.col("path"), F.lit(after), text, F.lit(tail))
        within = F.col("rank") <= total // len(before + after + tail) + 1
        kept = F.when(within, F.struct("rank", block.alias("block")))
        gathered.append(F.sort_array(F.collect_list(kept)).alias(f"_{layout}"))
        joined = F.array_join(f"_{layout}.block", "")
        texts.append(joined.alias(f"_{layout}"))
    grouped = files.groupBy(*by).agg(*gathered).select(*by, *texts)
    cuts = [
        cut(F.col(f"_{layout}"), LAYOUTS[layout][4], LAYOUTS[layout][5]).alias(f"{layout}_context")
        for layout in layouts
    ]
    return grouped.select(*by, *cuts)


def context(files: DataFrame, layout: str = "general", by: Sequence[str] = KEYS) -> DataFrame:
    """One layout alone, as column `context`."""
    return contexts(files, [layout], by).withColumnRenamed(f"{layout}_context", "context")


def decode_payload(df: DataFrame, strict: bool = False, n: int = 8000) -> DataFrame:
    """Replace `content_b64` by `content`: lenient and cut to n, or strict and whole."""
    raw = F.col("content_b64")
    kind = F.col("type") if "type" in df.columns else None
    text = strictly_decoded(raw) if strict else decoded_payload(raw, kind, n)
    return df.withColumn("content", text).drop("content_b64")


def readme_of(
    projects: DataFrame, entries: DataFrame, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Add `readme_name`, the README of the folder a project names, as it is really spelled.

    `projects` are `(keys, folder, ...)`; `entries` list folders as `(keys,
    folder, position, name, type)`. A path that is itself a file is landed as an
    entry with its own path as folder. The first of several spellings counts.
    """
    on = [*keys, "folder"]
    order = Window.partitionBy(*on).orderBy("position")
    first = (
        entries.where((F.col("type") == "file") & (F.lower("name") == "readme.md"))
        .withColumn("_rank", F.row_number().over(order))
        .where("_rank = 1")
        .select(*on, F.col("name").alias("readme_name"))
    )
    return projects.join(first, on, "left")
