"""Near-duplicate vectors by randomised-rotation binary codes.

A unit vector is turned by random rotations and kept as signs. With the inner product
of the vector and its own sign vector as a stored correction factor, the signs give
an unbiased estimate of the inner product with any other vector, and a bound on its
error. Bits of the codes, taken in bands, are bucket keys: vectors as near as asked
agree in some band with a probability set beforehand. Inside a bucket the estimates and
their bounds decide which pairs are computed exactly, in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.blocks import over_blocks, paired_blocks, sides
from shelfmark.llm.common import stored
from shelfmark.llm.graph import components

#: Standard deviations of the estimate's error that a bound leaves room for.
SIGMAS = 4.0
#: Vectors of a bucket that are compared at once; larger buckets are cut, and the cuts meet in pairs.
BLOCK = 512


def banding(vectors: int, cosine: float, recall: float) -> tuple[int, int]:
    """(bits of a band, bands) so that buckets stay small and a pair of exactly `cosine` meets with `recall`."""
    bits = max(8, ceil(log2(max(2, vectors))) - 2)
    agree = (1 - acos(cosine) / pi) ** bits
    return bits, max(1, ceil(log(1 - recall) / log(1 - agree)))


@lru_cache(maxsize=4)
def rotations(dim: int, bits: int) -> np.ndarray:
    """dim x (a multiple of dim, `bits` at least): random rotations side by side, scaled to keep lengths."""
    rng = np.random.default_rng(20_24)
    count = -(-bits // dim)
    return np.concatenate([np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(count)], axis=1) / np.sqrt(count)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square overflows."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def codes(vectors: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(signs as 0 and 1, correction factors) of unit vectors."""
    turned = vectors @ rotations(vectors.shape[1], bits)
    return (turned > 0).astype(np.uint8), np.abs(turned).sum(1) / np.sqrt(turned.shape[1])


def estimates(signs: np.ndarray, factors: np.ndarray, others: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of coded vectors (rows) with unit vectors (columns), and the bounds on their errors."""
    turn = rotations(others.shape[1], bits)
    dim, width = turn.shape
    raw = (signs.astype(np.float32) * 2 - 1) @ (others @ turn).T.astype(np.float32) / np.float32(np.sqrt(width))
    spread = np.sqrt(np.maximum(0, 1 - factors**2)) / factors / np.sqrt(width / dim * max(1, dim - 1))
    return raw / factors[:, None], SIGMAS * spread + 1e-6


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec): vectors as bytes of double numbers; null where one cannot be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column("v"):
                ok = v.is_valid and len(v.values) and not v.values.null_count
                x = np.asarray(v.values.to_numpy(zero_copy_only=False), "<f8") if ok else None
                out.append(x.tobytes() if ok and np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], ["id", "vec"])

    lean = vectors.select(vectors[id_col].alias("id"), vectors[vector_col].alias("v"))
    return lean.mapInArrow(run, f"id {lean.schema['id'].dataType.simpleString()}, vec binary")


def banded(nodes: DataFrame, bits: int, bands: int) -> DataFrame:
    """(node, copies, vec, signs, factor, bands): the code of every vector, made once, and its bucket numbers, one for each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            raw = batch.column("vec").to_pylist()
            out: list[tuple | None] = [None] * len(raw)
            for size in {len(r) for r in raw}:
                at = [i for i, r in enumerate(raw) if len(r) == size]
                signs, factors = codes(unit(np.frombuffer(b"".join(raw[i] for i in at), "<f8").reshape(len(at), -1)), bits * bands)
                numbers = signs[:, : bits * bands].reshape(len(at), bands, bits).astype(np.int64) @ power
                for i, code, factor, row in zip(at, np.packbits(signs, axis=1), factors, numbers):
                    out[i] = (code.tobytes(), factor, row)
            kinds = (pa.binary(), pa.float64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("copies"), batch.column("vec"), *[pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)]],
                ["node", "copies", "vec", "signs", "factor", "bands"],
            )

    return nodes.select("node", "copies", "vec").mapInArrow(
        run, f"node {nodes.schema['node'].dataType.simpleString()}, copies long, vec binary, signs binary, factor double, bands array<bigint>"
    )


def block_links(
    x: np.ndarray, signs: np.ndarray, factors: np.ndarray, bands: np.ndarray, band: int, left: np.ndarray, right: np.ndarray, cosine: float, bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (i in left, j in right, i < j where both are) that meet in no earlier band."""
    guess, error = estimates(signs[left], factors[left], x[right], bits)
    i, j = np.nonzero(guess + error[:, None] >= cosine)
    i, j = left[i], right[j]
    new = i != j
    if len(left) == len(right) and (left == right).all():
        new &= i < j
    for earlier in range(band):
        new &= bands[i, earlier] != bands[j, earlier]
    i, j = i[new], j[new]
    near = np.concatenate([np.einsum("ij,ij->i", x[i[a : a + 65_536]], x[j[a : a + 65_536]]) for a in range(0, len(i), 65_536)] or [np.zeros(0)])
    return i[near >= cosine], j[near >= cosine]


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place that each of n places reaches by links."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def links(rows: DataFrame, cosine: float, bits: int, bands: int) -> DataFrame:
    """(node, n, root): from each block, the copies linked with a node, and the least node it reaches there."""
    node = rows.schema["node"].dataType.simpleString()
    spread = rows.select("node", "copies", "vec", "signs", "factor", "bands", F.octet_length("vec").alias("dim"), F.posexplode("bands").alias("band", "bucket"))
    keys = ["dim", "band", "bucket"]
    blocks = paired_blocks(spread, keys, "node", BLOCK)

    def solve(block: pa.RecordBatch) -> list[tuple[object, int, object]]:
        ids, copies = block.column("node").to_pylist(), block.column("copies").to_numpy()
        x = unit(np.frombuffer(b"".join(block.column("vec").to_pylist()), "<f8").reshape(len(ids), -1))
        named = np.stack(block.column("bands").to_numpy(zero_copy_only=False))
        left, right = sides(block)
        packed = np.frombuffer(b"".join(block.column("signs").to_pylist()), np.uint8).reshape(len(ids), -1)
        signs = np.unpackbits(packed, axis=1, count=rotations(x.shape[1], bits * bands).shape[1])
        i, j = block_links(x, signs, block.column("factor").to_numpy(), named, block.column("band")[0].as_py(), left, right, cosine, bits * bands)
        n = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        order = np.argsort(np.array(ids, object), kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        root = local_roots(len(ids), place[i], place[j])
        return [(ids[k], int(n[k]), ids[order[root[place[k]]]]) for k in np.flatnonzero(n)]

    kind = {"bigint": pa.int64(), "int": pa.int32()}.get(node, pa.string())
    return over_blocks(blocks, keys, solve, f"node {node}, n long, root {node}", [("node", kind), ("n", pa.int64()), ("root", kind)])


def near_vectors(vectors: DataFrame, cosine: float = 0.95, recall: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) of every vector.

    Two vectors link when their cosine is `cosine` or more; none below links, and a pair at
    exactly `cosine` is found with probability `recall`, nearer ones with more. Equal
    vectors are one node and always link. A vector that is null, empty, zero or holds null or
    non-finite numbers links with nothing, nor does a row with a null id; vectors
    of different lengths are never compared. Repeated rows each return and count as others.
    Other columns are dropped; an empty table gives an empty one.
    """
    rows = stored(usable(vectors, id_col, vector_col))
    valid = rows.where("id is not null and vec is not null")
    nodes = stored(valid.groupBy("vec").agg(F.min("id").alias("node"), F.count("*").alias("copies")))
    # A repeated id may carry different vectors: nodes are then told apart by their bytes, links by the id.
    bits, bands = banding(nodes.count(), cosine, recall)
    found = stored(links(banded(nodes, bits, bands), cosine, bits, bands))
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "_n")
    named = nodes.join(counts, "node", "left").join(roots, F.col("node") == F.col("_n"), "left")
    named = named.select(
        F.col("vec").alias("_vec"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    out = valid.join(named, F.col("vec") == F.col("_vec")).select("id", "n_links", "component_id")
    alone = rows.where("id is null or vec is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = out.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
