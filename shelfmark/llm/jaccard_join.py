"""Links between texts with similar sets of word shingles, by parity sketches.

Each shingle toggles one bit of a sketch, so two sketches differ in at most as many bits as
the sets differ in shingles. Sets of a size band that are similar enough differ in at
most d shingles; cut into d + 1 + spare parts, their sketches agree in more than `spare`
whole parts. Parts are therefore join keys: no similar pair is lost. Parts without a
set bit would be shared by many; a sketch with at most `spare` of them need not use them.
A large set has many parts, and similar ones agree in a good share of them; some hundred groups of parts are keys
then, so many that a similar pair agrees in none with a probability below exp(-48).
The parts of this sketch have a bit for each hash, hardly any of them set, and are named by the exclusive or
of the hashes whose bits are set: what agrees are shingles, not a few bits by chance, however many sets there are.

Sets that agree in a part are not paired with each other one by one. The hub of a part is the set
that meets the most others, of a large class of near copies one of the least changed; each set is compared with one hub,
that of the most parts. After links have joined them into components, only sets of
different components still meet, first at another hub, then each with each. Every
candidate passes the bound on a whole sketch, and then the exact sets decide.
Equal sets are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from math import ceil, exp, sqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.blocks import over_blocks, paired_blocks, sides
from shelfmark.llm.common import U64, discard, joined_bytes, mix, slices, stored, tidy
from shelfmark.llm.graph import components
from shelfmark.llm.keys import shared_keys
from shelfmark.llm.shingles import shingle_sets

#: Sketches that travel to the parts have a bit for each shingle, as a power of two within these bounds.
SMALL_BITS = (512, 1024)
#: Width of a size band, largest size against smallest; 1 / t where that is more, so that partners are a band apart at most.
BAND = Fraction(13, 10)
#: Rows of a side that may be broadcast; a larger side is shuffled instead.
BROADCAST_ROWS = 200_000
HUB_ROUNDS = 2
#: Sets of a part that are compared at once.
BLOCK = 512
#: Parts with one lead are compared as one, if that makes at most so many times the pairs.
MORE = 4
#: Parts of up to so many sets are compared many at a time, larger ones in blocks.
FEW = 12


class Band(NamedTuple):
    """How sets of a size band are cut: into `parts`, of which more than `spare` agree; keys are `count` groups of `size` parts, or all parts."""

    parts: int
    spare: int
    size: int
    count: int


def grouped(parts: int, low: int, d: int) -> tuple[int, int]:
    """(size, count) of the groups of parts that are keys, 0 where all parts are needed.

    A set of many parts needs not use them all. The d shingles in which a pair may differ fall into parts by their
    hashes, so a group of parts is spared with probability (1 - size / parts) ** d at least, and all
    `count` groups are hit with a probability below exp(-48), less than that of two shingles having one hash.
    Groups of two parts are chosen where there are enough, since chance rarely makes two parts agree; groups of
    fewer than `size` shingles are left out, which the count allows for.
    """
    for size in (2, 1):
        mean = size * low / parts
        strong = 1 - sum(exp(-mean) * mean**k for k in range(size))
        spared = (1 - size / parts) ** d * strong if parts > size else 0
        if spared and size * (count := ceil(48 / spared)) < parts:
            return size, count
    return 1, 0


def spares(low: int, d: int) -> int:
    """How many parts to spare, so that sets of `low` shingles hardly ever have more parts without a shingle.

    A set that has more must use them, and they are like those of any other such set. The number of empty parts
    is kept five deviations away; where d leaves no room for that, twice its mean has to do.
    """
    least = spare = ceil(1 + 2.2 * d * exp(-low / d))
    while spare <= least + low:
        parts = d + 1 + spare
        empty = exp(-low / parts)
        if spare >= parts * empty + 5 * sqrt(parts * empty * max(0, 1 - (1 + low / parts) * empty)):
            return spare
        spare += max(1, spare // 16)
    return least


@lru_cache(maxsize=8)
def bands(t: Fraction, largest: int = 1 << 40) -> tuple[np.ndarray, list[Band]]:
    """Upper sizes of the bands, and how sets of each are cut.

    A pair belongs to the band of its smaller set, whose partner has at most size / t; sets
    so small that similar ones are equal have no parts.
    """
    tops, cuts = [], []
    top = 1
    while top < largest:
        d = int((top + int(top / t)) * (1 - t) / (1 + t))
        low = tops[-1] + 1 if tops else 1
        spare = spares(low, d) if d else 0
        parts = d + 1 + spare if d else 0
        tops.append(top)
        cuts.append(Band(parts, spare, *grouped(parts, low, d)) if d else Band(0, 0, 1, 0))
        top = max(top + 1, int(top * max(BAND, 1 / t)))
    return np.array(tops), cuts


def part_keys(shingles: np.ndarray, t: Fraction) -> np.ndarray:
    """The join keys of a set: its parts in the band of its size and, as a larger partner, in the band below.

    A part that holds other shingles in another set has another key there, but for equal hashes of 64 bits.
    """
    tops, cuts = bands(t)
    band = int(np.searchsorted(tops, len(shingles)))
    out = []
    for i in (band, band - 1):
        if i < 0 or (i < band and len(shingles) > int(int(tops[i]) / t)) or not cuts[i].parts:
            continue
        n, spare, size, count = cuts[i]
        place = (((shingles & U64(0xFFFFFFFF)) * U64(n)) >> U64(32)).astype(np.int64)
        words, held = np.zeros(n, np.uint64), np.bincount(place, minlength=n)
        np.bitwise_xor.at(words, place, shingles)
        if count:
            groups = words[: size * count].reshape(count, size)
            used = np.flatnonzero(held[: size * count].reshape(count, size).sum(axis=1) >= size)
            words = groups[:, 0].copy()
            for k in range(1, size):
                words = mix(words) + groups[:, k]
        else:
            used = np.arange(n) if (held == 0).sum() > spare else np.flatnonzero(held)
        out.append(mix(words[used] ^ mix(used.astype(np.uint64) + U64(i + 1) * U64(1 << 40))))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def sketch(shingles: np.ndarray, small: bool = False) -> bytes:
    """The parity sketch of a whole set: two bits for each shingle; a small one has about one, within SMALL_BITS.

    Similar sets of n shingles differ in a quarter of n bits or less, others in half of them.
    """
    low, high = (x.bit_length() - 1 for x in SMALL_BITS)
    k = round(np.log2(max(1, len(shingles)))) if small else (2 * len(shingles)).bit_length()
    k = min(high if small else 20, max(low, k))
    counts = np.bincount((shingles >> U64(64 - k)).astype(np.int64), minlength=1 << k)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def signature(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set: sums of two scramblings of its hashes."""
    a, b = mix(shingles ^ U64(0x5851F42D4C957F2D)).sum(dtype=np.uint64), mix(shingles + U64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def set_digests(docs: DataFrame, size: int) -> DataFrame:
    """(id, n_shingles, a, b) of docs (id, text): the size and the signature of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*joined_bytes(part.column("text")), size)
                names = [signature(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([n[0] for n in names], pa.int64()),
                     pa.array([n[1] for n in names], pa.int64())],
                    ["id", "n_shingles", "a", "b"],
                )

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, n_shingles long, a long, b long")


def shared_parts(docs: DataFrame, size: int, t: Fraction) -> DataFrame:
    """(key, a): the parts that two or more different sets have, with the signatures of these sets."""

    def make(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        found = {}
        for s in shingle_sets(*joined_bytes(part.column("text")), size):
            if len(s) and (a := signature(s)[0]) not in found:
                found[a] = part_keys(s, t)
        keys = np.concatenate([*found.values(), np.zeros(0, np.uint64)])
        return keys, np.repeat(np.array(list(found), np.int64), [len(k) for k in found.values()])

    return shared_keys(docs.select("text"), make).withColumnRenamed("owner", "a")


class Sketches:
    """Sketches of many sets, of different sizes, compared in rows of 64-bit words; the larger one of a pair is folded."""

    def __init__(self, raw: list[bytes], n: np.ndarray, t: Fraction):
        self.raw, self.n, self.t = raw, n, t
        self.size = np.array([8 * len(s) for s in raw], np.int64)
        self.rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def at(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """All sketches of so many bits, or more as far as sets of such sizes may be similar, and where each one's row is."""
        if bits not in self.rows:
            place = np.zeros(len(self.raw), np.int64)
            parts, done = [], 0
            most = 2 * bits / self.t
            for size in np.unique(self.size[(self.size >= bits) & (self.size <= most)]).tolist():
                own = np.flatnonzero(self.size == size)
                place[own] = np.arange(done, done + len(own))
                done += len(own)
                data = np.frombuffer(b"".join([self.raw[i] for i in own.tolist()]), np.uint8)
                if size > bits:
                    data = np.packbits(np.bitwise_xor.reduce(np.unpackbits(data).reshape(-1, size // bits), axis=1))
                parts.append(data)
            self.rows[bits] = np.concatenate(parts).view(np.uint64).reshape(done, bits // 64), place
        return self.rows[bits]

    def close(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the sets at places i and j may be similar, by their sizes and the bits that both sketches have.

        |A and B| >= t / (1 + t) * (n + m), so sets differ in at most (1 - t) / (1 + t) * (n + m) shingles.
        """
        p, q, n = self.t.numerator, self.t.denominator, self.n
        ok = np.minimum(n[i], n[j]) * q >= p * np.maximum(n[i], n[j])
        both = np.minimum(self.size[i], self.size[j])
        for bits in np.unique(both[ok]).tolist():
            pairs = np.flatnonzero(ok & (both == bits))
            rows, place = self.at(bits)
            for some in np.array_split(pairs, -(-len(pairs) // (1 << 16))):
                a, b = i[some], j[some]
                apart = np.bitwise_count(rows[place[a]] ^ rows[place[b]]).sum(axis=1, dtype=np.int64)
                ok[some] = apart * (q + p) <= (q - p) * (n[a] + n[b])
        return ok


def merged(members: DataFrame) -> DataFrame:
    """(key, node, component) of members with k, the size of their part: one key for the parts with one lead, where that pays.

    A pair meets in every part that both sets have, near copies in dozens. The lead of a part is the smallest hash of its
    nodes; parts of a class have few leads between them, and whoever shares a part shares its lead. Parts with one
    lead stay apart where they have so little in common that their union has over MORE times as many pairs.
    """
    leads = members.groupBy("key").agg(F.min(F.xxhash64("node")).alias("lead"), F.first("k").alias("k"))
    costs = leads.groupBy("lead").agg(F.sum(F.col("k").cast("double") * F.col("k")).alias("apart"))
    unions = members.drop("k").join(leads, "key").groupBy("lead").agg(F.countDistinct("node").cast("double").alias("size"))
    pays = costs.join(unions, "lead").where(F.col("size") * F.col("size") <= MORE * F.col("apart")).select("lead", F.lit(True).alias("pays"))
    # A part, not each of its rows, looks up its lead: a class of very many sets has few leads.
    names = leads.join(pays, "lead", "left").select("key", F.when(F.col("pays"), F.col("lead")).otherwise(F.col("key")).alias("name"))
    return members.join(names, "key").select(F.col("name").alias("key"), "node", "component").distinct()


def reaching(members: DataFrame) -> DataFrame:
    """(key, node, reach) of members (key, node): how many sets a node meets in all its parts, each as often as they meet."""
    sizes = members.groupBy("key").agg(F.count("*").alias("k"))
    reach = members.join(sizes, "key").groupBy("node").agg((F.sum("k") - F.count("*")).alias("reach"))
    return members.join(reach, "node").select("key", "node", "reach")


def crossing(members: DataFrame, sets: DataFrame, t: Fraction) -> DataFrame:
    """(x, y): members (key, node, component, k: of the part) of one part, but of different components, that may be similar.

    Small sketches travel to the parts, never pairs: of a part of few sets all pairs are compared where its rows lie,
    many parts at a time; of a larger one blocks. Only close pairs leave.
    """
    node = members.schema["node"].dataType.simpleString()
    met = lambda rows: rows.join(sets.select("node", "n", "small"), "node")

    def solve(block: pa.RecordBatch) -> list[tuple]:
        left, right = sides(block)
        n, component = block.column("n").to_numpy(), codes(block.column("component"))
        i, j = np.nonzero(component[left][:, None] != component[right][None, :])
        near = Sketches(block.column("small").to_pylist(), n, t).close(left[i], right[j])
        return ordered(block.column("node").to_pylist(), left[i[near]], right[j[near]])

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []

        def pairs(block: pa.RecordBatch) -> pa.RecordBatch:
            key, n, component = block.column("key").to_numpy(), block.column("n").to_numpy(), codes(block.column("component"))
            sketches, ids, found = Sketches(block.column("small").to_pylist(), n, t), block.column("node").to_pylist(), []
            for step in range(1, min(FEW, len(key))):
                i = np.flatnonzero((key[step:] == key[:-step]) & (component[step:] != component[:-step]))
                near = i[sketches.close(i, i + step)]
                found += ordered(ids, near, near + step)
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind) for k in (0, 1)], ["x", "y"])

        for batch in batches:
            if batch.num_rows:
                rest.append(batch)
                block = pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
                key = block.column("key").to_numpy()
                whole = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
                rest = [block.slice(whole)]
                if whole:
                    yield pairs(block.slice(0, whole))
        if rest:
            yield pairs(rest[0])

    kind = {"bigint": pa.int64(), "int": pa.int32()}.get(node, pa.string())
    small = met(members.where(F.col("k") <= FEW).drop("k", "reach")).repartition("key").sortWithinPartitions("key")
    blocks = paired_blocks(met(merged(members.where(F.col("k") > FEW))), ["key"], "node", BLOCK)
    made = over_blocks(blocks, ["key"], solve, f"x {node}, y {node}", [("x", kind), ("y", kind)])
    return small.mapInArrow(few, f"x {node}, y {node}").unionByName(made)


def codes(column: pa.Array) -> np.ndarray:
    """Numbers in place of values: equal ones for equal values."""
    return column.dictionary_encode().indices.to_numpy()


def ordered(ids: list, left: np.ndarray, right: np.ndarray) -> list[tuple]:
    """Pairs of ids at these places, the smaller id first."""
    return [(min(ids[a], ids[b]), max(ids[a], ids[b])) for a, b in zip(left.tolist(), right.tolist())]


def by_size(side: DataFrame) -> DataFrame:
    """A narrow side of a join: counted, broadcast up to BROADCAST_ROWS rows, and shuffled beyond."""
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def among(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The documents whose id is in `nodes`."""
    return docs.join(by_size(nodes.select(F.col("node").alias("_node")).distinct()), F.col("id") == F.col("_node"), "left_semi")


def keyed_sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, n, small, sketch) of the documents whose id is in `nodes`; no sketch where the small one says as much."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*joined_bytes(part.column("text")), size)
                small, bits = [sketch(s, True) for s in sets], [sketch(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(small, pa.binary()),
                     pa.array([b if len(b) > len(a) else None for a, b in zip(small, bits)], pa.binary())],
                    ["node", "n", "small", "sketch"],
                )

    return among(docs, nodes).mapInArrow(run, f"node {docs.schema['id'].dataType.simpleString()}, n long, small binary, sketch binary")


def whole_sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, shingles): the sets themselves, out of the texts again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*joined_bytes(part.column("text")), size)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])

    return among(docs, nodes).mapInArrow(run, f"node {docs.schema['id'].dataType.simpleString()}, shingles binary")


def linked(pairs: DataFrame, docs: DataFrame, sets: DataFrame, size: int, t: Fraction) -> DataFrame:
    """The pairs (x, y) whose sets are similar: by the bound on their sketches first, then by the sets, which only likely pairs need."""

    def side(table: DataFrame, name: str) -> DataFrame:
        return table.select(*[F.col(c).alias(f"{c}_{name}") for c in table.columns])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.concatenate([batch.column(f"n_{s}").to_numpy() for s in "xy"])
            left = np.arange(batch.num_rows)
            bits = [b for s in "xy" for b in batch.column(f"small_{s}").to_pylist()]
            for kind in ("small", "sketch"):  # then once more, with all the bits that both have
                more = [b for s in "xy" for b in batch.column(f"{kind}_{s}").to_pylist()]
                left = left[Sketches([b or c for b, c in zip(more, bits)], n, t).close(left, left + batch.num_rows)]
            yield batch.select(["x", "y"]).take(pa.array(left))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for a, b in zip(batch.column("shingles_x"), batch.column("shingles_y")):
                a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (a, b))
                common = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(common * t.denominator >= t.numerator * (len(a) + len(b) - common))
            yield batch.select(["x", "y"]).filter(pa.array(ok, pa.bool_()))

    kind = f"x {pairs.schema['x'].dataType.simpleString()}, y {pairs.schema['y'].dataType.simpleString()}"
    pairs = stored(pairs.distinct())
    met = side(sets, "x").join(by_size(pairs), F.col("x") == F.col("node_x")).join(side(sets, "y"), F.col("y") == F.col("node_y"))
    likely = stored(met.select("x", "y", "n_x", "n_y", "small_x", "small_y", "sketch_x", "sketch_y").mapInArrow(near, kind).distinct())
    discard(pairs)
    whole = stored(whole_sets(docs, likely.select(F.col("x").alias("node")).union(likely.select("y")), size))
    hubs = by_size(likely.select(F.col("x").alias("_x")).distinct())
    left = side(whole, "x").join(hubs, F.col("node_x") == F.col("_x"), "left_semi")
    met = side(whole, "y").join(by_size(likely), F.col("y") == F.col("node_y")).join(left, F.col("x") == F.col("node_x"))
    links = stored(met.select("x", "y", "shingles_x", "shingles_y").mapInArrow(exact, kind))
    discard(likely, whole)
    return links


def joined_by(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components (node, component) after more links (x, y): only what `found` has not yet joined is looked at."""
    if found is None:
        return stored(components(links.toDF("a", "b")))
    of = lambda side: found.select(F.col("node").alias(f"_{side}"), F.col("component").alias(f"c_{side}"))
    ends = links.join(of("x"), F.col("x") == F.col("_x"), "left").join(of("y"), F.col("y") == F.col("_y"), "left")
    more = stored(components(ends.select(F.coalesce("c_x", "x").alias("a"), F.coalesce("c_y", "y").alias("b"))))
    renamed = more.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    old = found.join(renamed, F.col("component") == F.col("_n"), "left").select("node", F.coalesce("_c", "component").alias("component"))
    now = stored(old.unionByName(more.join(found, "node", "left_anti")))
    discard(more, found)
    return now


def similar_sets(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id): classes of documents linked by 100 * |A and B| >= percent * |A or B|.

    Shingles are runs of `size` words, A-Z in lower case; a text of fewer words is one shingle,
    a text without words and a null text have none and link with nothing. component_id is
    the smallest id reachable by links. Sets are compared by 64-bit hashes of shingles and
    named by 128-bit signatures. Repeated rows each return; rows of one id are one document,
    with all its texts; a row with a null id links with
    nothing and has a null component. Other columns are dropped; an empty table gives an empty one.
    """
    with tidy(docs.sparkSession):
        return _similar_sets(docs, size, Fraction(percent, 100), id_col, text_col)


def _similar_sets(docs: DataFrame, size: int, t: Fraction, id_col: str, text_col: str) -> DataFrame:
    lean = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    digests = stored(set_digests(lean, size))
    named = digests.where((F.col("n_shingles") > 0) & F.col("id").isNotNull())
    nodes = named.groupBy("a", "b").agg(F.min("id").alias("node"))
    shared = stored(shared_parts(lean, size, t))
    members = stored(shared.distinct().join(nodes, "a").select("key", "node"))
    discard(shared)
    bare, members = members, stored(reaching(members))
    discard(bare)
    sets = stored(keyed_sets(lean, members, size))
    found = None
    for turn in range(HUB_ROUNDS + 1):
        if not members.head(1):
            break
        if turn < HUB_ROUNDS:  # each with one hub, the one it shares most parts with: the likeliest to join it
            fields = F.struct(*[c for c in members.columns if c != "key"])
            chance = 1 + F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1000)) if turn else F.lit(1)  # later another than before
            rank = F.struct(F.col("reach") * chance, F.xxhash64("node", F.lit(turn)))
            pairs = members.join(members.groupBy("key").agg(F.max_by(fields, rank).alias("hub")), "key").where("node != hub.node")
            if turn:
                pairs = pairs.where(F.col("component") != F.col("hub.component"))
            votes = pairs.groupBy("node", F.col("hub.node").alias("hub")).agg(F.count("*").alias("n"))
            best = F.max_by("hub", F.struct("n", F.xxhash64("hub")))
            pairs = votes.groupBy(F.col("node").alias("y")).agg(best.alias("x")).select("x", "y")
        else:  # each with each, but not within a component
            pairs = crossing(members, sets, t)
        links = linked(pairs, lean, sets, size, t)
        if found is None or links.head(1):
            found = joined_by(found, links)
        discard(links)
        if turn < HUB_ROUNDS:
            marked = members.select("key", "node", "reach").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
            mixed = marked.groupBy("key").agg(F.count("*").alias("k"), F.min("component").alias("lo"), F.max("component").alias("hi"))
            before, members = members, stored(marked.join(mixed.where("lo != hi").select("key", "k"), "key"))
            discard(before)
    discard(members, sets)
    joined = nodes.select("node", F.col("node").alias("component")).limit(0) if found is None else found
    roots = nodes.join(joined, "node", "left").select("a", "b", F.coalesce("component", "node").alias("component_id"))
    out = named.join(roots, ["a", "b"]).select("id", "n_shingles", "component_id")
    alone = digests.where((F.col("n_shingles") == 0) | F.col("id").isNull()).select("id", "n_shingles", F.col("id").alias("component_id"))
    return out.unionByName(alone).withColumnRenamed("id", id_col)
