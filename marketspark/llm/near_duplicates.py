"""Near duplicates by b-bit MinHash: bands give candidates, packed low bits an estimate, full sets the proof.

1. Each text becomes its set of word shingles (64-bit hashes). Rows of one set are one node from then on, so
   exact copies, however many, cost one row a task.
2. Bands of minima put nodes into buckets. A bucket's hub is its smallest id; nodes that share a bucket share
   that bucket's hub, so the pairs to look at lie inside the hub's group.
3. Every member is held against its hub: equal bits of the packed signatures are counted, corrected for chance,
   and a link is proved on the full sets where the estimate allows one. A group of any size moves once for this.
4. Links are contracted to their smallest id, round by round, in tables of the shared folder.
5. Members that are still not connected with their hub are held against the rest of the group, in tasks of one or
   two bounded blocks that leave out rows connected already. Their links contract what step 4 gave.
"""

from __future__ import annotations

import functools
import hashlib
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import mixed, picked, stored, text_slices

ROWS_PER_BAND = 5
KEPT_BITS = 2
MISS = 1e-7
DEVIATIONS = 5.5
BROADCAST_IDS = 1_000_000
# A block holds about so many rows of a group and so many shingles of them, or one row with more.
BLOCK_ROWS, BLOCK_SHINGLES = 8_192, 1 << 21
SEED = 20_240_607


def bands_for(percent: int) -> int:
    """Bands of ``ROWS_PER_BAND`` minima that lose a pair at the threshold less often than ``MISS``."""
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS_PER_BAND))


@functools.lru_cache(maxsize=8)
def multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    odd = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, rng.integers(0, 1 << 63, count, dtype=np.uint64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word; each spelling is hashed once."""
    coded = pa.array(words, pa.binary()).dictionary_encode()
    digests = [struct.unpack("<Q", hashlib.blake2b(w, digest_size=8).digest())[0] for w in coded.dictionary.to_pylist()]
    return np.array(digests, np.uint64)[coded.indices.to_numpy()]


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words is one shingle, an empty one none."""
    docs = [text.encode().lower().split() if text else [] for text in texts]
    flat = [w for words in docs for w in words]
    if not flat:
        return [np.empty(0, np.uint64)] * len(docs)
    hashes = word_hashes(flat)
    joined = np.zeros(len(flat), np.uint64)
    for k in range(size):
        later = hashes[k:]
        joined[:len(later)] = mixed(joined[:len(later)] * np.uint64(3) + later)
    sets, at = [], 0
    for words in docs:
        n = len(words)
        if n >= size:
            sets.append(np.unique(joined[at:at + n - size + 1]))
        elif n:
            own = np.array([n], np.uint64)
            for h in hashes[at:at + n]:
                own = mixed(own * np.uint64(5) + h)
            sets.append(own)
        else:
            sets.append(np.empty(0, np.uint64))
        at += n
    return sets


def digest_of(packed: bytes) -> bytes:
    return hashlib.sha256(packed).digest()[:16]


def signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """``count`` minima for each set, none of them empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    factors, offsets = multipliers(count)
    out = np.empty((len(sets), count), np.uint64)
    scratch = np.empty(len(flat), np.uint64)
    for k in range(count):
        np.multiply(flat, factors[k], out=scratch)
        np.add(scratch, offsets[k], out=scratch)
        out[:, k] = np.minimum.reduceat(scratch, starts)
    return out


def packed_bits(minima: np.ndarray) -> list[bytes]:
    """``KEPT_BITS`` bits of each minimum, above its 40 lowest, packed into bytes."""
    low = (minima >> np.uint64(40)) & np.uint64((1 << KEPT_BITS) - 1)
    bits = np.stack([(low >> np.uint64(b)) & np.uint64(1) for b in range(KEPT_BITS)], axis=-1).astype(np.uint8)
    return [row.tobytes() for row in np.packbits(bits.reshape(len(minima), -1), axis=1)]


def band_keys(minima: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(minima), minima.shape[1] // ROWS_PER_BAND), np.uint64)
    for band in range(keys.shape[1]):
        for k in range(ROWS_PER_BAND):
            keys[:, band] = mixed(keys[:, band] * np.uint64(3) + minima[:, band * ROWS_PER_BAND + k])
    return keys.view(np.int64)


def least_estimate(percent: int, count: int) -> float:
    """The estimate below which a pair at the threshold falls less often than once in ten million pairs."""
    j, chance = percent / 100, 2.0 ** -KEPT_BITS
    p = chance + (1 - chance) * j
    return j - DEVIATIONS * math.sqrt(p * (1 - p) / count) / (1 - chance)


def estimates(one: np.ndarray, others: np.ndarray, count: int) -> np.ndarray:
    """Similarity by equal minima of packed signatures, less the equal low bits that chance gives."""
    differ = np.bitwise_xor(others, one)
    lanes = differ | (differ >> 1)  # a minimum differs if either of its two bits does
    equal = count - np.bitwise_count(lanes & 0x55).sum(axis=1, dtype=np.int64)
    chance = 2.0 ** -KEPT_BITS
    return (equal / count - chance) / (1 - chance)


class Members:
    """Rows of a group with their packed signatures and sets."""

    def __init__(self, table: pa.Table, percent: int, count: int):
        self.ids = np.array(table.column("node").to_pylist(), np.int64)
        self.sets = [np.frombuffer(b, np.uint64) for b in table.column("shingles").to_pylist()]
        self.bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint8).reshape(len(self.ids), -1)
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.flat, self.starts = np.concatenate(self.sets), np.cumsum(self.sizes) - self.sizes
        self.percent, self.count, self.least = percent, count, least_estimate(percent, count)

    def likely(self, x: int) -> np.ndarray:
        """Rows whose size and estimate allow a link with row ``x``, likeliest first, without ``x``."""
        found = estimates(self.bits[x], self.bits, self.count)
        fits = (found >= self.least) & (100 * np.minimum(self.sizes, self.sizes[x]) >= self.percent * np.maximum(self.sizes, self.sizes[x]))
        fits[x] = False
        others = np.flatnonzero(fits)
        return others[np.argsort(-found[others], kind="stable")]

    def proved(self, x: int, some: np.ndarray) -> np.ndarray:
        """Those of ``some`` rows that the full sets link with row ``x``."""
        lengths = self.sizes[some]
        places = np.repeat(self.starts[some] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        values, own = self.flat[places], self.sets[x]
        spots = np.searchsorted(own, values)
        spots[spots == len(own)] = 0
        shared = np.add.reduceat((own[spots] == values).astype(np.int64), np.cumsum(lengths) - lengths)
        return some[100 * shared >= self.percent * (lengths + len(own) - shared)]


def links_within(members: Members, labels: list[int], sides: list[int]) -> list[tuple[int, int]]:
    """Pairs of labels that connect all that is linked among these rows; with two sides, only across them."""
    names, label = np.unique(np.array(labels, np.int64), return_inverse=True)
    first, side, links = label.copy(), np.array(sides), []
    across = len(set(sides)) > 1
    for x in np.argsort(members.ids, kind="stable"):
        if across and side[x] != side.min():
            continue
        others = members.likely(x)
        if across:
            others = others[side[others] != side[x]]
        at, width = 0, 8
        while at < len(others):
            some = others[at:at + width]
            some = some[label[some] != label[x]]
            at, width = at + width, min(2 * width, 512)
            for y in members.proved(x, some) if len(some) else ():
                if label[y] != label[x]:
                    links.append((int(names[first[x]]), int(names[first[y]])))
                    label[label == label[y]] = label[x]
    return links


def links_with(members: Members, hub: int) -> list[int]:
    """Ids of the rows that are linked with the row ``hub``."""
    [x] = np.flatnonzero(members.ids == hub)
    others, found = members.likely(x), []
    for at in range(0, len(others), 512):
        found += members.ids[members.proved(x, others[at:at + 512])].tolist()
    return found


def with_sets(docs: DataFrame, size: int) -> DataFrame:
    """The shingle set of each text that has one, sorted and packed as 64-bit numbers, and its digest."""

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            packed = [s.tobytes() for s in shingle_sets(batch.column("text").to_pylist(), size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(digest_of, packed), pa.binary()), pa.array(packed, pa.binary())],
                ["node", "digest", "shingles"])

    return docs.mapInArrow(shingle, "node long, digest binary, shingles binary").filter(F.octet_length("shingles") > 0)


def signed(docs: DataFrame, size: int, count: int) -> DataFrame:
    """For each row the size and digest of its set, the band keys and the packed signature."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sets = shingle_sets(batch.column("text").to_pylist(), size)
            filled = [s for s in sets if len(s)]
            minima = signatures(filled, count) if filled else np.empty((0, count), np.uint64)
            keys, bits = iter(band_keys(minima).tolist()), iter(packed_bits(minima))
            rows = [(digest_of(s.tobytes()), next(keys), next(bits)) if len(s) else (None, None, None) for s in sets]
            digests, bands, packed = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(packed, pa.binary())],
                ["doc_id", "n_shingles", "digest", "bands", "bits"],
            )

    return docs.mapInArrow(sign, "doc_id long, n_shingles long, digest binary, bands array<long>, bits binary")


def stars(nodes: DataFrame) -> DataFrame:
    """Each node with the hubs (smallest ids) of the buckets it shares with another; hubs are in their own groups."""
    placed = nodes.select("node", "n_shingles", F.posexplode("bands").alias("band", "key"))
    hubs = placed.groupBy("band", "key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n"))
    shared = hubs.filter("n > 1").select("band", "key", "hub")
    return placed.join(shared, ["band", "key"]).groupBy("hub", "node").agg(F.max("n_shingles").alias("n_shingles"))


def blocks_of(which: Column) -> Column:
    """How many blocks the rows of a group take for which ``which`` holds, as an aggregate."""
    rows, shingles = F.count(F.when(which, 1)), F.sum(F.when(which, F.col("n_shingles")).otherwise(0))
    return F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def beside_hubs(groups: DataFrame) -> DataFrame:
    """Rows of each hub's group dealt to parts, each once; the hub alone is in every part of its group."""
    # Stored, here and below, so that the join has plain tables on both sides and a hub of many rows can be split.
    sizes = stored(groups.groupBy("hub").agg(blocks_of(F.lit(True)).alias("parts")), "hub-parts")
    own = F.array(F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    return groups.join(sizes, "hub").select("hub", "node", F.explode(F.when(F.col("hub") == F.col("node"), every).otherwise(own)).alias("part"))


def hub_links(groups: DataFrame, sets: DataFrame, percent: int, count: int) -> DataFrame:
    """Links of members with the hub of their group."""

    def prove(key: tuple, members: pa.Table) -> pa.Table:
        hub = key[0].as_py()
        found = links_with(Members(members, percent, count), hub)
        return pa.table({"a": pa.array([hub] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return beside_hubs(groups).join(sets, "node").groupBy("hub", "part").applyInArrow(prove, "a long, b long")


def connected(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """``groups`` with each node's component so far and whether it is ``loose``, that is not connected with its hub."""
    of_hubs = labels.select(F.col("node").alias("hub"), F.col("component").alias("at_hub"))
    label = F.coalesce("component", "node")
    return groups.join(labels, "node", "left").join(of_hubs, "hub", "left").select(
        "hub", "node", "n_shingles", label.alias("label"), (label != F.coalesce("at_hub", "hub")).alias("loose"))


def blocks(groups: DataFrame) -> DataFrame:
    """Loose rows meet one another and the rest of their group in pairs of blocks; groups without any are left out.

    Blocks of loose rows come first, then those of the rest, of which no two meet. So a row of the rest moves once
    for each block of loose rows, and a loose row once for each block of its group.
    """
    loose = F.col("loose")
    sizes = groups.groupBy("hub").agg(blocks_of(loose).alias("of_loose"), blocks_of(~loose).alias("of_rest"))
    sizes = stored(sizes.filter("of_loose > 0"), "hub-blocks")
    place = F.xxhash64("node")
    side = F.when(loose, F.pmod(place, F.col("of_loose"))).otherwise(F.col("of_loose") + F.pmod(place, F.col("of_rest")))
    last = F.when(loose, F.col("of_loose") + F.col("of_rest")).otherwise(F.col("of_loose")) - 1
    dealt = groups.join(sizes, "hub").withColumn("side", side.cast("int"))
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), last.cast("int")))).select(
        "hub", "node", "label", "side", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"))


def block_links(groups: DataFrame, sets: DataFrame, percent: int, count: int) -> DataFrame:
    """Links of loose rows with others of their group, as pairs of components, enough to connect all that is linked."""

    def prove(key: tuple, members: pa.Table) -> pa.Table:
        labels, sides = members.column("label").to_pylist(), members.column("side").to_pylist()
        found = links_within(Members(members, percent, count), labels, sides)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return blocks(groups).join(sets, "node").groupBy("hub", "low", "high").applyInArrow(prove, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest id that links reach, by contracting every node into its smallest neighbour."""
    edges = stored(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = stored(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("component", F.col("node")), "labels")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("at", "near")
        # Stored, so that the join below has plain tables on both sides and a hub of many nodes can be split.
        nearest = stored(both.groupBy("at").agg(F.min("near").alias("near")).select("at", F.least("at", "near").alias("to")), "nearest")
        up = nearest.select(F.col("at").alias("to"), F.col("to").alias("further"))
        jumps = stored(nearest.join(up, "to", "left").select("at", F.coalesce("further", "to").alias("to")), "jumps")
        ends = jumps.toDF("a", "to_a"), jumps.toDF("b", "to_b")
        moved = edges.join(ends[0], "a").join(ends[1], "b").filter("to_a <> to_b")
        edges = stored(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "links")
        labels = stored(
            labels.join(jumps.toDF("component", "to"), "component", "left").select("node", F.coalesce("to", "component").alias("component")),
            "labels")
    return labels


def near_duplicates(
    docs: DataFrame, shingle_words: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, kept (doc_id = component_id).

    Texts are linked at ``percent`` of similarity of their sets of ``shingle_words`` words, A-Z lowered. A
    null text, or one without words, has no shingle and is linked with nothing. A row without id has no
    component and is kept. Repeated rows of an id get the same component. Extra columns are left out; an
    empty table gives an empty result. A pair at the threshold is missed with a chance below one in ten
    million by the bands, and as rarely by the estimate; all other steps are exact.

    Texts are read for signatures, for candidates, and once more for groups whose members are not all connected with
    their hub. They are not shuffled while the rows wanted are at most ``BROADCAST_IDS``, whose number is counted
    first; beyond that they are joined by id.
    """
    texts = picked(docs, id_column, text_column)
    count = ROWS_PER_BAND * bands_for(percent)
    rows = stored(signed(texts, shingle_words, count), "signatures")
    nodes = rows.filter("doc_id is not null and digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("bits").alias("bits"), F.first("n_shingles").alias("n_shingles"))
    nodes = stored(nodes, "signature-nodes")
    groups = stored(stars(nodes), "stars")

    def sets_of(members: DataFrame) -> DataFrame:
        wanted = members.select(F.col("node").alias("doc_id")).distinct()
        few = wanted.count() <= BROADCAST_IDS
        chosen = texts.join(F.broadcast(wanted) if few else wanted, "doc_id", "left_semi")
        sets = with_sets(chosen, shingle_words).groupBy("node", "digest").agg(F.first("shingles").alias("shingles"))
        return sets.join(nodes.select("node", "digest", "bits"), ["node", "digest"]).drop("digest")

    labels = components(stored(hub_links(groups, sets_of(groups), percent, count), "hub-links"))
    named = nodes.select("digest", "node").join(labels, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    judged = stored(connected(groups, labels), "connected-stars")
    open_hubs = stored(judged.filter("loose").select("hub").distinct(), "open-hubs")
    unsettled = stored(judged.join(open_hubs, "hub", "left_semi"), "unsettled-stars")
    if not unsettled.isEmpty():
        further = components(stored(block_links(unsettled, sets_of(unsettled), percent, count), "block-links"))
        joined = further.toDF("component_id", "smallest")
        named = named.join(joined, "component_id", "left").select("digest", F.coalesce("smallest", "component_id").alias("component_id"))
    found = rows.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
