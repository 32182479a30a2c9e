from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from marketspark.llm import sharding


def check(found, texts, shards):
    assert len(found) == len(texts)
    groups, slots, sizes = {}, defaultdict(list), defaultdict(int)
    for r in found:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        assert 0 <= r.shard < shards and groups.setdefault(texts[r.doc_id], r.shard) == r.shard
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def plain_best_fit(sizes, capacity):
    """Item by item over a list of bins: the tightest that holds it, the first of equals, or a new one."""
    room, places = [], []
    for size in sizes:
        fits = [(r, b) for b, r in enumerate(room) if r >= size]
        if not fits:
            room.append(capacity)
            fits = [(capacity, len(room) - 1)]
        bin_ = min(fits)[1]
        room[bin_] -= size
        places.append(bin_)
    return places


def plain_shards(sizes, shards):
    """The sizes of the groups of each shard, by plain best fit at the capacity that the operator's search ends at."""
    rest, out, total = sorted(sizes, reverse=True), [], sum(sizes)
    while rest and len(out) < shards - 1 and rest[0] * (shards - len(out)) >= total:
        total -= rest[0]
        out.append([rest.pop(0)])
    if rest:
        left = shards - len(out)
        low = max(rest[0], -(-total // left))
        step, high = 1, low
        while max(plain_best_fit(rest, high)) >= left:
            low, high, step = high + 1, high + step, step * 2
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if max(plain_best_fit(rest, middle)) < left else (middle + 1, high)
        bins = [[] for _ in range(left)]
        for size, bin_ in zip(rest, plain_best_fit(rest, high), strict=True):
            bins[bin_].append(size)
        out += bins
    return [sorted(own) for own in out if own]


def group_sizes(rows):
    groups = defaultdict(int)
    for r in rows:
        groups[r.key, r.shard] += r.size
    by_shard = defaultdict(list)
    for (_, shard), size in groups.items():
        by_shard[shard].append(size)
    return [sorted(by_shard[k]) for k in sorted(by_shard)]


@pytest.mark.parametrize(("table", "shards"), [("sf0.001", 16), ("sf0.01", 16), ("sf0.01", 3)])
def test_shards_equal_plain_best_fit_over_all_groups(spark, table, shards):
    docs = spark.read.parquet(f"/root/testdata/{table}/documents.parquet")
    keys = docs.select("doc_id", F.sha2("text", 256).alias("key"))
    found = sharding.shard(docs, shards).join(keys, "doc_id").collect()
    sizes = docs.groupBy("text").agg(F.sum(F.octet_length("text") + 1).alias("size")).collect()
    assert group_sizes(found) == plain_shards([r["size"] for r in sizes], shards)


def test_runs_equal_single_groups():
    rng = random.Random(2)
    for _ in range(60):
        sizes = sorted((rng.choice([1, 2, 3, 7, 20, rng.randint(1, 50)]) for _ in range(rng.randint(1, 80))), reverse=True)
        capacity = max(sizes) + rng.randint(0, 60)
        runs = sorted(Counter(sizes).items(), reverse=True)
        bins = {}
        for (size, first, bin_) in sharding.best_fit(runs, capacity):
            bins[size, first] = bin_
        places, seen, own = [], Counter(), None
        for size in sizes:
            own = bins.get((size, seen[size]), own)
            seen[size] += 1
            places.append(own)
        assert places == plain_best_fit(sizes, capacity)


def test_one_size_is_spread_over_blocks(documents, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BLOCK", 20)
    texts = [f"{i:05d}" for i in range(700)] + [None] * 90 + ["x" * 9000]
    sizes = check(sharding.shard(documents(*texts), shards=5).collect(), texts, 5)
    assert sorted(sizes.values())[-1] == 9001 and max(sorted(sizes.values())[:4]) - min(sizes.values()) <= 90


def test_near_equal_shards_of_whole_groups(documents, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BLOCK", 50)
    rng = random.Random(1)
    texts = [None, None, "", ""] + ["é" * rng.randint(1, 400) + str(i) for i in range(400)]
    texts += [texts[10]] * 5 + [texts[11]] * 3
    sizes = check(sharding.shard(documents(*texts), shards=8).collect(), texts, 8)
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and max(sizes.values()) < 1.02 * mean


def test_hot_group_has_a_shard_of_its_own(documents):
    texts = ["hot text " * 9] * 60 + [f"other text {i} " * 5 for i in range(90)]
    sizes = sorted(check(sharding.shard(documents(*texts), shards=4).collect(), texts, 4).values())
    assert sizes[-1] == 60 * 82 and sizes[2] - sizes[0] <= 90


def test_edges(documents):
    docs = documents("a", "a", None, ids=[1, None, 1]).withColumn("shard", F.lit("x")).withColumn("key", F.lit(1))
    assert sorted(r["size"] for r in sharding.shard(docs).collect()) == [1, 2, 2]
    assert sharding.shard(docs.limit(0)).count() == 0


def test_tree_against_a_sorted_list():
    rng, room, keys = random.Random(6), sharding.Room(), []
    for i in range(3000):
        if keys and rng.random() < 0.45:
            key = rng.choice(keys)
            keys.remove(key)
            room.remove(key)
        else:
            key = (rng.randint(0, 300), i)
            keys.append(key)
            room.add(key)
        probe = (rng.randint(0, 310), -1)
        assert room.at_least(probe) == min((k for k in keys if k >= probe), default=None)

    def depth(t):
        return 0 if t is None else 1 + max(depth(t[2]), depth(t[3]))

    assert depth(room.root) <= 2 * (len(keys) + 1).bit_length()


def test_best_fit_takes_the_tightest_bin():
    assert sharding.best_fit([(7, 1), (6, 1), (3, 1), (2, 2)], 10) == [(7, 0, 0), (6, 0, 1), (3, 0, 0), (2, 0, 1)]
    assert sharding.best_fit([], 10) == [] and sharding.best_fit([(6, 3)], 10, most=2) is None


def test_long_texts(documents):
    texts = ["long text " * 300_000, "long text " * 300_000, "a", "b"]
    assert sorted(check(sharding.shard(documents(*texts), shards=3).collect(), texts, 3).values())[-1] == 6_000_002
