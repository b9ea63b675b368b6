"""All members of a bucket against each other, in blocks that no large bucket makes larger."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def paired_blocks(members: DataFrame, keys: list[str], node: str, size: int) -> DataFrame:
    """`members` with lo, hi and cut: a bucket (equal integer `keys`) of k members is cut at random into k / `size` parts.

    Each two parts lo <= hi of a bucket are a block, and each member is in as many blocks as
    its bucket has parts. Buckets of one member are left out.
    """
    counts = members.groupBy(*keys).agg(F.count("*").alias("_k")).where("_k > 1")
    met = members.join(counts, keys).withColumn("_cuts", F.ceil(F.col("_k") / size).cast("int"))
    met = met.withColumn("cut", F.pmod(F.xxhash64(node), F.col("_cuts")).cast("int"))
    pair = F.transform(
        F.sequence(F.lit(0), F.col("_cuts") - 1),
        lambda c: F.struct(F.least(c, F.col("cut")).alias("lo"), F.greatest(c, F.col("cut")).alias("hi")),
    )
    return met.withColumn("_pair", F.explode(pair)).select(*members.columns, "cut", "_pair.lo", "_pair.hi")


def sides(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The places of the members of both parts of a block; the same places where it is one part."""
    cut = block.column("cut").to_numpy()
    return np.flatnonzero(cut == block.column("lo")[0].as_py()), np.flatnonzero(cut == block.column("hi")[0].as_py())


def over_blocks(blocks: DataFrame, keys: list[str], solve: Callable[[pa.RecordBatch], list[tuple]], schema: str, kinds: list[tuple[str, pa.DataType]]) -> DataFrame:
    """The rows that `solve` makes of each block; blocks stream past in order of their keys."""
    names = [*keys, "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        done: list[tuple] = []

        def settle(final: bool) -> None:
            block = pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
            values = np.stack([block.column(k).to_numpy() for k in names])
            turns = (np.flatnonzero((values[:, 1:] != values[:, :-1]).any(0)) + 1).tolist()
            ends = [*turns, block.num_rows] if final else turns
            for begin, end in zip([0, *ends], ends):
                if end - begin > 1:
                    done.extend(solve(block.slice(begin, end - begin)))
            rest[:] = [] if final else [block.slice(ends[-1] if ends else 0)]

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, (_, k) in enumerate(kinds)], [n for n, _ in kinds])
            done.clear()
            return made

        for batch in batches:
            if batch.num_rows:
                rest.append(batch)
                settle(False)
                if len(done) > 10_000:
                    yield out()
        if rest:
            settle(True)
        if done:
            yield out()

    return blocks.repartition(*names).sortWithinPartitions(*names).mapInArrow(run, schema)
