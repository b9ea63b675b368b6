"""Fill-in-the-middle: a text is cut at two of its units, and its parts are marked and put in another order.

A unit is a run of ASCII letters or any other single code point. A text is looked at in
blocks of fixed size. A Fenwick tree over them holds two counts of each block, units and
code points that begin in it. Where a cut lies, a descent through the tree by halving
steps finds the block and the code points before it; only that block is looked at again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.plain_words import byte_parts

BLOCK = 4096
#: Blocks that are counted at once, which bounds the memory for a long text.
AT_ONCE = 256
#: Marks of the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")


def starts(raw: bytes, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether a unit, and whether a code point, begins at each byte of raw[lo:hi]."""
    data = np.frombuffer(raw, np.uint8, hi - max(lo - 1, 0), max(lo - 1, 0))
    letter = ((data | 32) - np.uint8(97)) < 26
    point = (data & 0xC0) != 0x80
    if lo:
        return point[1:] & ~(letter[1:] & letter[:-1]), point[1:]
    unit = point.copy()
    unit[1:] &= ~(letter[1:] & letter[:-1])
    return unit, point


class BlockTree:
    """Counts of units and code points of a text, in a Fenwick tree over its blocks."""

    def __init__(self, raw: bytes, block: int = BLOCK):
        self.raw, self.block = raw, block
        self.blocks = -(-len(raw) // block)
        counts = np.zeros((2, self.blocks + 1), np.int64)
        for lo in range(0, len(raw), block * AT_ONCE):
            hi = min(len(raw), lo + block * AT_ONCE)
            edges = np.arange(0, hi - lo, block)
            for row, mask in zip(counts, starts(raw, lo, hi)):
                row[lo // block + 1 : lo // block + 1 + len(edges)] = np.add.reduceat(mask, edges, dtype=np.int64)
        upto = np.cumsum(counts, axis=1)
        node = np.arange(self.blocks + 1)
        self.tree = upto - upto[:, node - (node & -node)]
        self.units, self.points = upto[:, -1].tolist()

    def cut(self, units: int) -> tuple[int, int]:
        """Where so many units end: the byte, and the code points before it."""
        if units >= self.units:
            return len(self.raw), self.points
        at, points = 0, 0
        for step in (1 << k for k in reversed(range(self.blocks.bit_length()))):
            if at + step <= self.blocks and self.tree[0, at + step] <= units:
                at += step
                units -= int(self.tree[0, at])
                points += int(self.tree[1, at])
        lo = at * self.block
        unit, point = starts(self.raw, lo, min(len(self.raw), lo + self.block))
        place = int(np.flatnonzero(unit)[units])
        return lo + place, points + int(np.count_nonzero(point[:place]))


def draws(key: str) -> list[int]:
    """Four unsigned numbers that follow from a key."""
    digest = hashlib.sha256(key.encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def checked(marks: Sequence[str]) -> tuple[str, str, str]:
    """The marks, if an output can be read back: none may hold, or run into, another or itself."""
    for a in marks:
        for b in marks:
            if not a or (a != b and a in b) or any(a.endswith(b[:k]) for k in range(1, len(b))):
                raise ValueError(f"marks overlap: {a!r}, {b!r}")
    if len(set(marks)) != 3:
        raise ValueError("three different marks are needed")
    return tuple(marks)


def fill_in_middle(
    docs: DataFrame,
    seed: str = "1",
    fim_percent: int = 90,
    spm_percent: int = 20,
    marks: Sequence[str] = MARKS,
    block: int = BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output): every text, cut and put in another order.

    `n` counts units. The numbers of the key `seed:id` decide where the cuts are and which
    form a text takes. Form `psm` is mark 1, prefix, mark 2, suffix, mark 3, middle; `spm` is
    mark 2, suffix, mark 1, prefix, mark 3, middle; `plain` is the text as it is: for one
    in 100 - `fim_percent`, for empty texts, and for those that hold a mark. `restored` gives the
    text back.

    A null text is empty; a null id draws by the key `seed:` and stays null; rows of one id draw alike;
    a text of any length is one row, looked at in blocks; other columns are dropped, an empty table gives an empty one.
    """
    p, s, m = (x.encode() for x in checked(marks))
    kind = docs.schema[id_col].dataType
    lean = docs.select(
        docs[id_col].alias("id"), F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("key"), docs[text_col].alias("text")
    )

    def one(key: str, raw: bytes) -> tuple:
        tree = BlockTree(raw, block)
        h = draws(f"{seed}:{key}")
        if not raw or p in raw or s in raw or m in raw or h[2] % 100 >= fim_percent:
            return tree.units, "plain", None, None, raw
        cuts = sorted(x % (tree.units + 1) for x in h[:2])
        (i, before), (j, upto) = map(tree.cut, cuts)
        prefix, middle, suffix = raw[:i], raw[i:j], raw[j:]
        if h[3] % 100 < spm_percent:
            return tree.units, "spm", before, upto - before, s + suffix + p + prefix + m + middle
        return tree.units, "psm", before, upto - before, p + prefix + s + suffix + m + middle

    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in byte_parts(batch):
                made = list(zip(*map(one, rows.column("key").to_pylist(), texts)))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
                columns = [pa.array(c, k) for c, k in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays([rows.column("id"), *columns[:-1], columns[-1].cast(pa.string())], names)

    out = lean.mapInArrow(run, f"id {kind.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("id", id_col)


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that an output was made of. Each mark stands in it once."""
    p, s, m = checked(marks)
    order = F.substring_index(output, m, 1)
    middle = F.substring_index(output, m, -1)

    def halves(first: str, second: str) -> tuple[Column, Column]:
        head = F.substring_index(order, second, 1)
        return head.substr(F.lit(len(first) + 1), F.char_length(head)), F.substring_index(order, second, -1)

    psm, spm = halves(p, s), halves(s, p)
    return (
        F.when(form == "psm", F.concat(psm[0], middle, psm[1]))
        .when(form == "spm", F.concat(spm[1], middle, spm[0]))
        .otherwise(output)
    )
