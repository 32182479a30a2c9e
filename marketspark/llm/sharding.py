"""Sharding by best-fit-decreasing bin packing of indivisible groups of equal texts.

Groups in order of size each enter the shard with the least room that still holds them, found in a balanced
tree of the shards' room. The least capacity for which this needs no more than the wanted shards is sought
by halving, so that shards come out near equal.

Groups of one size are alike to the packing, which therefore runs over distinct sizes and the number of groups of
each: the shard with the tightest room stays the tightest until it is full, so a run of equal groups enters it at
once. Every group is sorted and packed, however small, while the driver holds one row for each distinct size. The
groups of a size are numbered, and each shard takes a range of those numbers.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketspark.llm.common import broadcast_if_small, picked, stored

ROWS_PER_BLOCK = 50_000


class Room:
    """An AA tree (balanced by levels) of keys; nodes are [key, level, left, right]."""

    def __init__(self):
        self.root: list | None = None

    @staticmethod
    def _skew(t: list) -> list:
        left = t[2]
        if left and left[1] == t[1]:
            t[2], left[3] = left[3], t
            return left
        return t

    @staticmethod
    def _split(t: list) -> list:
        right = t[3]
        if right and right[3] and right[3][1] == t[1]:
            t[3], right[2] = right[2], t
            right[1] += 1
            return right
        return t

    def add(self, key: tuple) -> None:
        def put(t: list | None) -> list:
            if t is None:
                return [key, 1, None, None]
            side = 2 if key < t[0] else 3
            t[side] = put(t[side])
            return self._split(self._skew(t))

        self.root = put(self.root)

    def remove(self, key: tuple) -> None:
        def cut(t: list | None, key: tuple) -> list | None:
            if t is None:
                return None
            if key != t[0]:
                side = 2 if key < t[0] else 3
                t[side] = cut(t[side], key)
            elif t[2] is None:
                return t[3]
            else:
                before = t[2]
                while before[3]:
                    before = before[3]
                t[0] = before[0]
                t[2] = cut(t[2], before[0])
            level = 1 + min(t[2][1] if t[2] else 0, t[3][1] if t[3] else 0)
            if level < t[1]:
                t[1] = level
                if t[3] and t[3][1] > level:
                    t[3][1] = level
            t = self._skew(t)
            if t[3]:
                t[3] = self._skew(t[3])
                if t[3][3]:
                    t[3][3] = self._skew(t[3][3])
            t = self._split(t)
            if t[3]:
                t[3] = self._split(t[3])
            return t

        self.root = cut(self.root, key)

    def at_least(self, key: tuple) -> tuple | None:
        """The least key that is not below ``key``."""
        t, best = self.root, None
        while t:
            if t[0] >= key:
                t, best = t[2], t[0]
            else:
                t = t[3]
        return best


Range = tuple[int, int, int]  # size, first number, shard


def best_fit(runs: Iterable[tuple[int, int]], capacity: int, most: int | None = None) -> list[Range] | None:
    """Where runs of equal groups (size, count), in falling order of size, begin in each bin that takes some of them.

    A new bin is opened only where no open one has the room; None if that needs more than ``most`` bins.
    """
    room, ranges, opened = Room(), [], 0
    for size, count in runs:
        at = 0
        while at < count:
            found = room.at_least((size, -1))
            if found is None:
                if opened == most:
                    return None
                found = (capacity, opened)
                opened += 1
            else:
                room.remove(found)
            taken = min(count - at, found[0] // size)
            room.add((found[0] - taken * size, found[1]))
            ranges.append((size, at, found[1]))
            at += taken
    return ranges


def balanced(runs: list[tuple[int, int]], shards: int) -> list[Range]:
    """Ranges of groups for each shard, by best fit at the least capacity found that needs no more than ``shards``.

    A group larger than an equal share of what is left has a shard of its own. The capacity is sought upward from
    an equal share in doubled steps, then by halving.
    """
    rest = [list(run) for run in sorted(runs, reverse=True)]
    total, own, first = sum(size * count for size, count in rest), [], 0
    taken = 0
    while rest and first < shards - 1 and rest[0][0] * (shards - first) >= total:
        size = rest[0][0]
        own.append((size, taken, first))
        total -= size
        first, taken, rest[0][1] = first + 1, taken + 1, rest[0][1] - 1
        if not rest[0][1]:
            del rest[0]
            taken = 0
    if not rest:
        return own
    left, offset = shards - first, (rest[0][0], taken)
    low = max(rest[0][0], -(-total // left))
    step, high = 1, low
    while (packed := best_fit(rest, high, left)) is None:
        low, high, step = high + 1, high + step, step * 2
    while low < high:
        middle = (low + high) // 2
        if (tried := best_fit(rest, middle, left)) is not None:
            high, packed = middle, tried
        else:
            low = middle + 1
    return own + [(size, at + (offset[1] if size == offset[0] else 0), first + bin_) for size, at, bin_ in packed]


def numbered(rows: DataFrame, within: str, order: str, n_rows: int) -> DataFrame:
    """``rows`` with ``number``, gapless from 0 within each value of ``within``, in blocks of bounded rows.

    A block is a hash of ``order``, which no two rows share, so a value that most rows have is spread over many tasks.
    """
    blocks = max(1, -(-n_rows // ROWS_PER_BLOCK))
    placed = rows.withColumn("block", F.pmod(F.xxhash64(order), F.lit(blocks)))
    before = Window.partitionBy(within).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(within, "block").agg(F.count(F.lit(1)).alias("n")).select(
        within, "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    nth = F.row_number().over(Window.partitionBy(within, "block").orderBy(order))
    return placed.withColumn("nth", nth).join(offsets, [within, "block"]).withColumn("number", F.col("start") + F.col("nth") - 1).drop(
        "block", "nth", "start")


def shard(docs: DataFrame, shards: int = 16, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The size is the text's bytes and 1; a null text has size 1 and is a group with other nulls. Equal texts
    share a shard, so a group larger than an equal share makes its shard the larger. Groups of one size are alike:
    which of them enter which shard is by their texts' hashes. Slots count from 0 in each shard without gaps. Texts
    of any length are hashed whole and not moved. Rows without id and repeated rows are placed like others. Extra
    columns are left out; an empty table gives an empty result. ``grown_shard`` is null under this law.

    The driver holds the distinct sizes of groups with their counts. N of them need texts of at least N * N / 2
    bytes together, so 100 TB cannot have more than 15 million; texts below a megabyte have at most a million.
    """
    spark = docs.sparkSession
    texts = picked(docs, id_column, text_column)
    key = F.coalesce(F.unhex(F.sha2("text", 256)), F.lit(b""))
    rows = stored(
        texts.select(
            "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), key.alias("key"))
        .withColumn("row", F.monotonically_increasing_id()),
        "shard-rows")
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-groups")
    runs = [(r.bytes, r.groups, r.rows) for r in groups.groupBy("bytes").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("n").alias("rows")).toLocalIterator()]
    n_groups, n_rows = sum(r[1] for r in runs), sum(r[2] for r in runs)
    ranges = balanced([run[:2] for run in runs], shards)
    del runs
    by_size = stored(
        spark.createDataFrame(ranges, "bytes long, first long, shard int").groupBy("bytes").agg(
            F.array_sort(F.collect_list(F.struct("first", "shard"))).alias("ranges")), "shard-ranges")
    ranked = numbered(groups.select("key", "bytes"), "bytes", "key", n_groups).join(broadcast_if_small(by_size), "bytes")
    homes = ranked.select("key", F.element_at(F.filter("ranges", lambda r: r["first"] <= F.col("number")), -1)["shard"].alias("shard"))
    # Stored, so that the join has plain tables on both sides and a text that very many rows hold can be split.
    placed = stored(rows.join(stored(homes, "group-shards"), "key").drop("key"), "placed-rows")
    return numbered(placed, "shard", "row", n_rows).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("number").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
