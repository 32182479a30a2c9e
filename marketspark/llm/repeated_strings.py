"""Repeated strings by a depth-limited radix sort of suffixes, distributed by most significant digit.

Suffixes are ordered only as deep as ``threshold`` bytes. The first digit of a suffix is its first ``K`` bytes.
Ordering every suffix would move some twenty bytes for each byte of text, so only suffixes at anchors take
part: the least digit (by a hash) of every run of ``threshold`` bytes. Equal strings of ``threshold`` bytes
have their anchor at the same place, so no repeat is lost, and a string is what stands around its anchor.

Pass 1 deals the first digits to buckets by hash; digits of one chunk of documents alone leave the sort.
Pass 2 orders equal first digits by all that a string around the anchor can hold. Equal groups are repeats.
Surroundings are dealt by their own hash, so that those of one digit spread over all buckets; the digit's
bucket learns from each chunk only how many it holds, and one of them.
Pass 3 orders what is left, anchors with several surroundings, string by string, and compares their bytes.
The strings of a hot digit, one of very many surroundings, are dealt by two hashes of the string itself,
each once a chunk, so that no bucket meets all of them.

A chunk sends each distinct digit or surrounding once, packed, and gets its answers back in the same order.
The documents are shuffled once; all passes read that shuffle.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import broadcast_if_small, mixed, picked, shuffle_width, stored

CHUNK_BYTES = 4 << 20
DIGIT_BYTES = 5
ONE, SEVERAL, HOT = 0, 1, 2
HOT_KINDS = 1 << 14
COPIES = 1_000_000
FACTORS = [np.uint64(2 * x + 1) for x in (
    0x3C6EF372FE94F82A, 0x510E527FADE682D1, 0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x2545F4914F6CDD1D)]


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over each run of ``width`` values, by doubling."""
    done = 1
    while 2 * done <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return pick(values[:-rest], values[rest:]) if rest else values


def first_groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts by ``keys``, first key first, and in it where a new first-but-last key begins."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys[:-1]])
    return order, new


def parts(bucket: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Each bucket that occurs, with the places of its items in order."""
    order = np.argsort(bucket, kind="stable")
    values, starts = np.unique(bucket[order], return_index=True)
    return list(zip(values.tolist(), np.split(order, starts[1:]), strict=True)) if len(order) else []


def hashed(strings: np.ndarray, factor: np.uint64) -> np.ndarray:
    """A hash of each row of bytes; all rows have the same length, of 8 or more."""
    out = np.zeros(len(strings), np.uint64)
    last = strings.shape[1] - 8
    for k in [*range(0, last, 8), last]:
        out = mixed(out * factor + np.ascontiguousarray(strings[:, k:k + 8]).view("<u8").reshape(-1))
    return out


class Shape:
    """Sizes that follow from the threshold, and the arithmetic on one document."""

    def __init__(self, threshold: int, buckets: int):
        self.threshold, self.buckets = threshold, buckets
        # Half the string, or more where its offsets around a digit would be over the 64 that a mask holds.
        self.digit = max(threshold // 2, threshold - 56) // 8 * 8
        self.windows = threshold - self.digit + 1
        self.bits = np.uint32 if self.windows <= 32 else np.uint64
        self.side = threshold - self.digit
        self.around = self.digit + 2 * self.side
        self.row = -(-(self.around + 8) // 8) * 8
        self.mask = np.uint64((1 << (8 * DIGIT_BYTES + int(math.log2(buckets)))) - 1)

    def anchors(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Places of the anchors of a text of ``threshold`` bytes or more, and their digits."""
        words = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))
        n = len(raw) - self.digit + 1
        half = ((words * FACTORS[0]) >> np.uint64(32)).astype(np.uint32)
        order = half[:n].copy()
        for k in range(8, self.digit, 8):
            order = order * np.uint32(0x9E3779B1) + half[k:k + n]
        order = order * np.uint32(0x85EBCA6B)
        order ^= order >> np.uint32(15)
        order |= np.uint32(1)  # above the padding below
        least = sliding(order, self.windows, np.minimum)
        padded = np.zeros(n + self.windows - 1, np.uint32)
        padded[self.windows - 1:self.windows - 1 + len(least)] = least
        reach = sliding(padded, self.windows, np.maximum)
        at = np.flatnonzero(reach == order)
        digit = np.zeros(len(at), np.uint64)
        for k in range(0, self.digit, 8):
            digit = mixed(digit * FACTORS[1] + words[at + k])
        return at, digit & self.mask


class Chunk:
    """The documents of one chunk with their anchors, independent of the order in which rows arrive."""

    def __init__(self, docs: pa.Table, shape: Shape):
        self.shape = shape
        self.ids = docs.column("doc_id").to_pylist()
        self.raw = [(t or "").encode() for t in docs.column("text").to_pylist()]
        doc, at, digit = [], [], []
        for i, raw in enumerate(self.raw):
            if self.ids[i] is not None and len(raw) >= shape.threshold:
                places, digits = shape.anchors(raw)
                at.append(places)
                digit.append(digits)
                doc.append(np.full(len(places), i, np.int64))
        empty = np.empty(0, np.int64)
        self.doc = np.concatenate(doc) if doc else empty
        self.at = np.concatenate(at) if at else empty
        digits = np.concatenate(digit) if digit else empty.astype(np.uint64)
        self.bucket = (digits % np.uint64(shape.buckets)).astype(np.int64)
        self.digit = digits // np.uint64(shape.buckets)
        self.owner = np.array([-1 if i is None else i for i in self.ids], np.int64)[self.doc]

    def distinct_digits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct (bucket, digit), for each anchor its rank there, and which digits several documents hold."""
        order, new = first_groups(self.bucket, self.digit, self.owner)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        owners = self.owner[order]
        several = np.minimum.reduceat(owners, heads) != np.maximum.reduceat(owners, heads) if len(heads) else np.empty(0, bool)
        return self.bucket[order][heads], self.digit[order][heads], rank, several

    def keep_shared(self, seen_elsewhere: dict[int, bytes]) -> None:
        """Only anchors whose digit another document holds; ``seen_elsewhere`` is a bit for each distinct digit."""
        buckets, digits, rank, shared = self.distinct_digits()
        edges = np.searchsorted(buckets, np.arange(self.shape.buckets + 1))
        for bucket, bits in seen_elsewhere.items():
            low, high = edges[bucket], edges[bucket + 1]
            shared[low:high] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=high - low).astype(bool)
        keep = shared[rank] if len(rank) else np.empty(0, bool)
        self.doc, self.at, self.bucket, self.digit, self.owner = (
            x[keep] for x in (self.doc, self.at, self.bucket, self.digit, self.owner))
        self._surroundings()

    def _surroundings(self) -> None:
        """Around each anchor all bytes of strings that hold it, how far they go to either side, and groups of equals.

        Sets ``rank`` for each anchor, and for the groups ``heads`` (an anchor of the least id), sorted by
        bucket, digit and hash; ``spot`` is the bucket of a group's hash, ``firsts`` the first group of each
        digit, and ``digit_rank`` the place of each group's digit.
        """
        shape, side = self.shape, self.shape.side
        sizes = np.array([len(r) for r in self.raw], np.int64)
        starts = np.cumsum(sizes + side) - sizes
        buffer = np.frombuffer(b"".join(b"\0" * side + r for r in self.raw) + b"\0" * shape.row, np.uint8)
        left = np.minimum(self.at, side)
        right = np.minimum(sizes[self.doc] - self.at - shape.digit, side)
        rows = np.zeros((len(self.at), shape.row), np.uint8)
        rows[:, :shape.around] = buffer[(starts[self.doc] + self.at - side)[:, None] + np.arange(shape.around)]
        spread = np.arange(shape.around)
        rows[:, :shape.around][(spread < (side - left)[:, None]) | (spread >= (side + shape.digit + right)[:, None])] = 0
        rows[:, shape.around], rows[:, shape.around + 1] = left, right
        self.rows, self.left, self.right = rows, left, right
        self.hash = np.zeros(len(rows), np.uint64)
        for word in rows.view("<u8").reshape(len(rows), -1).T:
            self.hash = mixed(self.hash * FACTORS[2] + word)
        order, new = first_groups(self.bucket, self.digit, self.hash, self.owner)
        if len(order):
            new[1:] |= (rows[order[1:]] != rows[order[:-1]]).any(axis=1)
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.cumsum(new) - 1
        self.heads = order[new]

        own = self.bucket[self.heads], self.digit[self.heads]
        begins = np.ones(len(self.heads), bool)
        begins[1:] = (own[0][1:] != own[0][:-1]) | (own[1][1:] != own[1][:-1])
        self.firsts, self.digit_rank = np.flatnonzero(begins), np.cumsum(begins) - 1
        self.spot = (self.hash[self.heads] % np.uint64(shape.buckets)).astype(np.int64)

    def verdicts(self, flags: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each group how many surroundings its digit has, and whether a smaller id holds the whole of it elsewhere."""
        kinds, whole = np.zeros(len(self.firsts), np.uint8), np.zeros(len(self.heads), bool)
        for bucket, at in parts(self.bucket[self.heads[self.firsts]]):
            kinds[at] = np.frombuffer(flags[bucket], np.uint8)
        for bucket, at in parts(self.spot):
            whole[at] = np.frombuffer(flags[self.shape.buckets + bucket], np.uint8) > 0
        return kinds[self.digit_rank], whole

    def strings(self, chosen: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """The strings of the ``chosen`` groups by offset: groups that reach it, the rank of their string there, and
        for each distinct string two hashes and the least id."""
        heads = self.heads[chosen]
        for offset in range(self.shape.windows):
            reach = (offset >= self.shape.side - self.left[heads]) & (offset <= self.right[heads])
            at, owners = heads[reach], self.owner[heads[reach]]
            rows = self.rows[at, offset:offset + self.shape.threshold]
            first, second = hashed(rows, FACTORS[3]), hashed(rows, FACTORS[4])
            order, new = first_groups(first, second, owners)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.cumsum(new) - 1
            lead = order[new]
            yield offset, chosen[reach], rank, first[lead], second[lead], owners[lead]

    def removed(self, elsewhere: np.ndarray, masks: np.ndarray) -> list[np.ndarray]:
        """For each document which bytes a repeated string covers."""
        shape = self.shape
        offsets = np.arange(shape.windows)
        valid = (offsets >= (shape.side - self.left)[:, None]) & (offsets <= self.right[:, None])
        whole = (self.owner > self.owner[self.heads][self.rank]) | elsewhere[self.rank]
        bits = (masks[self.rank][:, None] >> offsets.astype(shape.bits)) & shape.bits(1) > 0
        anchor, offset = np.nonzero(valid & (whole[:, None] | bits))
        sizes = np.array([len(r) for r in self.raw], np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        begin = starts[self.doc[anchor]] + self.at[anchor] - shape.side + offset
        total = int(sizes.sum()) + len(sizes)
        edges = np.bincount(begin, minlength=total + 1)[:total + 1] - np.bincount(begin + shape.threshold, minlength=total + 1)[:total + 1]
        covered = np.cumsum(edges) > 0
        return [covered[s:s + n] for s, n in zip(starts, sizes, strict=True)]


def packed(digits: np.ndarray) -> bytes:
    return digits.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :DIGIT_BYTES].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // DIGIT_BYTES, 8), np.uint8)
    out[:, :DIGIT_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, DIGIT_BYTES)
    return out.view("<u8").reshape(-1)


MESSAGE = "chunk int, bucket int, digits binary, hashes binary, kinds binary, owners binary, rows binary, shared binary, flags binary, masks binary"
FIELDS = [f.split()[0] for f in MESSAGE.split(", ")]
BYTES = FIELDS[2:]


def messages(rows: list[dict]) -> pa.Table:
    kinds = {name: pa.binary() if name in BYTES else pa.int32() for name in FIELDS}
    return pa.table({name: pa.array([r.get(name) for r in rows], kind) for name, kind in kinds.items()})


def answers(table: pa.Table, field: str) -> dict[int, bytes]:
    pairs = zip(table.column("bucket").to_pylist(), table.column(field).to_pylist(), strict=True)
    return {bucket: value for bucket, value in pairs if value is not None}


def joined(table: pa.Table, field: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(field).to_pylist()), kind)


def least_elsewhere(owners: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """For each entry 1 if one of equal keys has a smaller owner."""
    order, new = first_groups(*keys, owners)
    out = np.zeros(len(owners), np.uint8)
    if len(order):
        out[order] = owners[order] > owners[order][new][np.cumsum(new) - 1]
    return out


def once(texts: DataFrame) -> tuple[DataFrame, bool]:
    """Rows that repeat an id and a text as one row with their number as ``copies``, and whether there are any."""
    version = F.xxhash64("text")
    repeated = stored(
        texts.groupBy(F.col("doc_id").alias("same_id"), version.alias("version")).agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "repeated-rows")
    if repeated.isEmpty():
        return texts.withColumn("copies", F.lit(1).cast("long")), False
    same = F.col("doc_id").eqNullSafe(F.col("same_id")) & (version == F.col("version"))
    small = broadcast_if_small(repeated)
    grouped = texts.join(small, same, "left_semi").groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
    return texts.join(small, same, "left_anti").withColumn("copies", F.lit(1).cast("long")).unionByName(grouped), True


def every_copy(df: DataFrame) -> DataFrame:
    """Each row as often as its ``copies`` say, in blocks, so that no array holds all of them."""
    blocks = df.withColumn("block", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES}L)")))
    rows = blocks.withColumn("copy", F.explode(F.expr(f"sequence(1L, least({COPIES}L, copies - block * {COPIES}L))")))
    return rows.select(*[c for c in df.columns if c != "copies"])


def repeated_strings(
    docs: DataFrame, threshold: int = 50, id_column: str = "doc_id", text_column: str = "text", with_kept: bool = False, hot_kinds: int = HOT_KINDS,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked, ``kept``.

    A byte goes if a string of ``threshold`` bytes over it also starts in a document of a smaller id; ``kept``
    is what stays, as bytes; ``threshold`` is 16 or any larger number. A null text is empty. A row without id removes nothing elsewhere and keeps all.
    Repeated rows of an id are one document to the others and lose nothing to each other. Extra columns are
    left out; an empty table gives an empty result.

    Chunks hold about ``CHUNK_BYTES`` of text, or one longer text, at any size of the corpus; rows that repeat an
    id and a text are one row there. Equal digits of a chunk travel once, so a string in every document is one
    entry a chunk; a digit that meets over ``hot_kinds`` surroundings has its strings spread by themselves.
    """
    if threshold < 16:
        raise ValueError("a threshold of 16 bytes or more is needed")
    spark = docs.sparkSession
    texts = picked(docs, id_column, text_column)
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = shuffle_width(spark)
    chunks, buckets = max(2 * width, -(-total // CHUNK_BYTES)), max(width, -(-total // (4 * CHUNK_BYTES)))
    shape = Shape(threshold, buckets)
    single, repeats = once(texts)
    dealt = single.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))

    def send_digits(key: tuple, table: pa.Table) -> pa.Table:
        bucket, digit, _, _ = Chunk(table, shape).distinct_digits()
        edges = np.searchsorted(bucket, np.arange(buckets + 1))
        return messages([
            {"chunk": key[0].as_py(), "bucket": b, "digits": packed(digit[edges[b]:edges[b + 1]])}
            for b in np.flatnonzero(np.diff(edges)).tolist()])

    def find_shared(key: tuple, table: pa.Table) -> pa.Table:
        parts = [unpacked(x) for x in table.column("digits").to_pylist()]
        _, inverse, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        shared = count[inverse] > 1
        ends = np.cumsum([len(p) for p in parts])
        return messages([
            {"chunk": c, "bucket": key[0].as_py(), "shared": np.packbits(shared[end - len(p):end]).tobytes()}
            for c, p, end in zip(table.column("chunk").to_pylist(), parts, ends, strict=True)])

    def state(table: pa.Table, replies: pa.Table) -> tuple[Chunk, dict[int, bytes]]:
        shared = answers(replies, "shared")
        chunk = Chunk(table, shape)
        chunk.keep_shared(shared)
        return chunk, shared

    # Buckets below ``buckets`` are those of digits, then follow those of surroundings and of strings of hot digits.

    def send_surroundings(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        chunk, shared = state(table, replies)
        number, heads = key[0].as_py(), chunk.heads
        firsts, kinds = heads[chunk.firsts], np.diff(np.append(chunk.firsts, len(heads))).astype("<u4")
        by_bucket = dict(parts(chunk.bucket[firsts]))
        rows = []
        for b, bits in shared.items():
            at = by_bucket.get(b, np.empty(0, np.int64))
            rows.append({"chunk": number, "bucket": b, "shared": bits, "digits": packed(chunk.digit[firsts[at]]),
                         "hashes": chunk.hash[firsts[at]].tobytes(), "kinds": kinds[at].tobytes()})
        for b, at in parts(chunk.spot):
            own = heads[at]
            rows.append({"chunk": number, "bucket": buckets + b, "digits": packed(chunk.digit[own]),
                         "hashes": chunk.hash[own].tobytes(), "owners": chunk.owner[own].tobytes()})
        return messages(rows)

    def order_surroundings(key: tuple, table: pa.Table) -> pa.Table:
        digit = np.concatenate([unpacked(x) for x in table.column("digits").to_pylist()])
        hashes = joined(table, "hashes", "<u8")
        if key[0].as_py() >= buckets:
            flags = least_elsewhere(joined(table, "owners", "<i8"), digit, hashes)
        else:
            kinds = joined(table, "kinds", "<u4").astype(np.int64)
            order, new = first_groups(digit, hashes)
            flags = np.zeros(len(digit), np.uint8)
            if len(order):
                begin, group = np.flatnonzero(new), np.cumsum(new) - 1
                several = (hashes[order][begin] != np.maximum.reduceat(hashes[order], begin)) | (np.maximum.reduceat(kinds[order], begin) > 1)
                hot = np.add.reduceat(kinds[order], begin) > hot_kinds
                flags[order] = np.where(several, np.where(hot, HOT, SEVERAL), ONE).astype(np.uint8)[group]
        sizes = [len(x) // 8 for x in table.column("hashes").to_pylist()]
        ends = np.cumsum(sizes)
        return messages([
            {"chunk": c, "bucket": key[0].as_py(), "shared": shared, "flags": flags[end - n:end].tobytes()}
            for c, shared, n, end in zip(table.column("chunk").to_pylist(), table.column("shared").to_pylist(), sizes, ends, strict=True)])

    def send_strings(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        chunk, shared = state(table, replies)
        number, flags = key[0].as_py(), answers(replies, "flags")
        kinds, elsewhere = chunk.verdicts(flags)
        asked = chunk.heads[(kinds == SEVERAL) & ~elsewhere]
        by_bucket = dict(parts(chunk.bucket[asked]))
        rows = [{"chunk": number, "bucket": b, "flags": x} for b, x in flags.items() if b >= buckets]
        for b, bits in shared.items():
            own = asked[by_bucket.get(b, np.empty(0, np.int64))]
            rows.append({"chunk": number, "bucket": b, "shared": bits, "flags": flags[b],
                         "rows": chunk.rows[own].tobytes(), "owners": chunk.owner[own].tobytes()})
        hot = np.flatnonzero((kinds == HOT) & ~elsewhere)
        if len(hot):
            first, second, owners = (np.concatenate(x) for x in list(zip(*chunk.strings(hot), strict=True))[3:])
            for b, at in parts((first % np.uint64(buckets)).astype(np.int64)):
                rows.append({"chunk": number, "bucket": 2 * buckets + b, "digits": second[at].tobytes(),
                             "hashes": first[at].tobytes(), "owners": owners[at].tobytes()})
        return messages(rows)

    def order_strings(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        if buckets <= bucket < 2 * buckets:
            return table
        owners = joined(table, "owners", "<i8")
        sizes = [len(x) // 8 for x in table.column("owners").to_pylist()]
        ends = np.cumsum(sizes)
        if bucket >= 2 * buckets:
            flags = least_elsewhere(owners, joined(table, "hashes", "<u8"), joined(table, "digits", "<u8"))
            return messages([
                {"chunk": c, "bucket": bucket, "flags": flags[end - n:end].tobytes()}
                for c, n, end in zip(table.column("chunk").to_pylist(), sizes, ends, strict=True)])
        rows = joined(table, "rows", "u1").reshape(-1, shape.row)
        left, right = (rows[:, shape.around + k].astype(np.int64) for k in (0, 1))
        masks = np.zeros(len(rows), shape.bits)
        for offset in range(shape.windows):
            own = np.flatnonzero((offset >= shape.side - left) & (offset <= right))
            if not len(own):
                continue
            strings = np.ascontiguousarray(rows[own, offset:offset + threshold])
            order, new = first_groups(hashed(strings, FACTORS[3]), owners[own])
            new[1:] |= (strings[order[1:]] != strings[order[:-1]]).any(axis=1)
            least = owners[own][order][new][np.cumsum(new) - 1]
            masks[own[order[owners[own][order] > least]]] |= shape.bits(1 << offset)
        columns = [table.column(c).to_pylist() for c in ("chunk", "shared", "flags")]
        return messages([
            {"chunk": c, "bucket": bucket, "shared": s, "flags": f, "masks": masks[end - n:end].tobytes()}
            for c, s, f, n, end in zip(*columns, sizes, ends, strict=True)])

    def remove(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        chunk, _ = state(table, replies)
        flags, found = answers(replies, "flags"), answers(replies, "masks")
        kinds, elsewhere = chunk.verdicts(flags)
        masks = np.zeros(len(chunk.heads), shape.bits)
        asked = np.flatnonzero((kinds == SEVERAL) & ~elsewhere)
        for b, at in parts(chunk.bucket[chunk.heads[asked]]):
            masks[asked[at]] = np.frombuffer(found[b], shape.bits)
        hot = np.flatnonzero((kinds == HOT) & ~elsewhere)
        if len(hot):
            by_offset = list(chunk.strings(hot))
            first = np.concatenate([x[3] for x in by_offset])
            smaller = np.zeros(len(first), bool)
            for b, at in parts((first % np.uint64(buckets)).astype(np.int64)):
                smaller[at] = np.frombuffer(flags[2 * buckets + b], np.uint8) > 0
            start = 0
            for offset, own, rank, lead, _, least in by_offset:
                gone = (chunk.owner[chunk.heads[own]] > least[rank]) | smaller[start:start + len(lead)][rank]
                masks[own[gone]] |= shape.bits(1 << offset)
                start += len(lead)
        covered = chunk.removed(elsewhere, masks)
        kept, removed, spans = [], [], []
        for raw, gone in zip(chunk.raw, covered, strict=True):
            n = int(gone.sum())
            removed.append(n)
            spans.append(int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(n > 0 and gone[0]))
            kept.append(np.frombuffer(raw, np.uint8)[~gone].tobytes() if n else raw)
        columns = {
            "doc_id": pa.array(chunk.ids, pa.int64()), "n_bytes": pa.array([len(r) for r in chunk.raw], pa.int64()),
            "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), "copies": table.column("copies")}
        return pa.table(columns | ({"kept": pa.array(kept, pa.binary())} if with_kept else {}))

    by_chunk = dealt.groupBy("chunk")
    shared = by_chunk.applyInArrow(send_digits, MESSAGE).groupBy("bucket").applyInArrow(find_shared, MESSAGE)
    flagged = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(send_surroundings, MESSAGE).groupBy("bucket").applyInArrow(
        order_surroundings, MESSAGE)
    masked = by_chunk.cogroup(flagged.groupBy("chunk")).applyInArrow(send_strings, MESSAGE).groupBy("bucket").applyInArrow(
        order_strings, MESSAGE)
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, copies long" + (", kept binary" if with_kept else "")
    judged = by_chunk.cogroup(masked.groupBy("chunk")).applyInArrow(remove, result)
    return every_copy(judged) if repeats else judged.drop("copies")
