"""Words of letters, digits and whatever is not ASCII, with A-Z in lower case, on bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What a byte becomes: itself within a word (in lower case), a blank between words.
#: A word is a maximal match of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z were lower-cased.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def plain_words(raw: bytes) -> list[bytes]:
    """The words of a text in UTF-8."""
    return raw.translate(TABLE).split()


def byte_parts(batch: pa.RecordBatch, column: str = "text", limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch whose texts hold about `limit` bytes each, one row at least, and their texts; null is empty."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for lo, hi in zip(edges, edges[1:]):
        if hi > lo:
            rows = batch.slice(lo, hi - lo)
            yield rows, [b or b"" for b in rows.column(column).cast(pa.binary()).to_pylist()]
