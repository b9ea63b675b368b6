"""Which keys do two or more owners have? Keys travel packed, many in a row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfmark.llm.common import U64, slices

#: Keys (unsigned) and their owners (signed) of a part of a batch; a pair may come repeatedly.
MakeKeys = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]


def repeated(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order of key, whether each is the first of its key, whether its key has others."""
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    keys, owners = keys[new], owners[new]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    often = ~first
    often[:-1] |= ~first[1:]
    return keys, owners, first, often


def shared_keys(texts: DataFrame, make: MakeKeys) -> DataFrame:
    """(key, owner): all keys that two or more owners have, with all owners; rows may repeat.

    `texts` has a column text. Of the owners in one part of a batch that share a key only
    one travels to the task that looks for the key; the others are known to share it. So
    a key that very many have brings that task one entry for each part.
    """
    count = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = 8 * count

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            for part in slices(batch, "text"):
                keys, owners, first, often = repeated(*make(part))
                if not len(keys):
                    continue
                turn += 1
                rows = []
                if often.any():
                    rows.append(((int(keys[0] % U64(buckets)) + turn) % buckets, True, keys[often].tobytes(), owners[often].tobytes()))
                keys, owners = keys[first], owners[first]
                bucket = (keys % U64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                keys, owners = keys[order], owners[order]
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                rows += [(i, False, keys[lo:hi].tobytes(), owners[lo:hi].tobytes()) for i, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi > lo]
                kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["bucket", "known", "keys", "owners"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]

        def out(k: np.ndarray, o: np.ndarray) -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(k), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(k[lo : lo + 100_000].view(np.int64)), pa.array(o[lo : lo + 100_000])], ["key", "owner"])

        for batch in batches:
            for known, k, o in zip(batch.column("known").to_pylist(), batch.column("keys"), batch.column("owners")):
                k, o = np.frombuffer(k.as_buffer(), np.uint64), np.frombuffer(o.as_buffer(), np.int64)
                if known:
                    yield from out(k, o)
                else:
                    keys.append(k.copy())
                    owners.append(o.copy())
        k, o, _, often = repeated(np.concatenate(keys), np.concatenate(owners))
        yield from out(k[often], o[often])

    packed = texts.mapInArrow(pack, "bucket int, known boolean, keys binary, owners binary")
    return packed.repartition(count, "bucket").mapInArrow(meet, "key long, owner long")
