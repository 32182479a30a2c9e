from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketspark.llm import near_duplicates as nd


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} - {()}


def brute(texts, size, percent, ids):
    sets = [shingles(t, size) for t in texts]
    best = dict(zip(range(len(texts)), ids, strict=True))
    changed = True
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in pairs:
            low = min(best[i], best[j])
            changed |= best[i] != low or best[j] != low
            best[i] = best[j] = low
    return {ids[i]: (len(sets[i]), best[i], best[i] == ids[i]) for i in range(len(texts))}


def corpus(seed, groups=6, copies=30, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Été", "É"]
    texts = [None, "", " \n", "one", "One", "two words", "two  WORDS", "É", "é", "a b c", "a b c d", "A B C", "a b c a b c"]
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                del own[rng.randrange(len(own))]
            texts.append(" ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in own))
    texts += texts[-5:] * 3
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("size", "percent", "small"), [(3, 85, 64), (5, 80, 8)])
def test_components_equal_brute_force(documents, monkeypatch, size, percent, small):
    monkeypatch.setattr(nd, "BLOCK_ROWS", small)
    texts = corpus(size)
    ids = list(range(100, 100 + len(texts)))
    found = nd.near_duplicates(documents(*texts, ids=ids), size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(texts, size, percent, ids)
    assert len(found) == len(texts)


def test_chain_and_join_by_id(documents, monkeypatch):
    monkeypatch.setattr(nd, "BROADCAST_IDS", 0)
    words = [f"x{i}" for i in range(200)]
    texts = [" ".join(words[5 * k:5 * k + 100]) for k in range(15)]
    found = nd.near_duplicates(documents(*texts), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: c for i, (_, c, _) in brute(texts, 3, 85, list(range(15))).items()}
    assert {r.component_id for r in found} == {0}


def test_ids_missing_repeated_and_empty_table(documents):
    text = "some text of several words here"
    docs = documents(text, text, text, text, ids=[7, None, 7, 9]).withColumn("node", F.lit(1)).withColumn("bands", F.lit("x"))
    found = nd.near_duplicates(docs, 3, 85).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in found) == [(-1, -1, True), (7, 7, True), (7, 7, True), (9, 7, False)]
    assert nd.near_duplicates(docs.limit(0)).count() == 0


def test_estimates_are_corrected_for_chance():
    rng = np.random.default_rng(1)
    one = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    two = np.where(np.arange(1000) < 600, one, rng.integers(0, 1 << 63, 1000, dtype=np.uint64)).astype(np.uint64)
    bits = np.frombuffer(b"".join(nd.packed_bits(np.stack([one, two]))), np.uint8).reshape(2, -1)
    low, high = nd.estimates(bits[0], bits[1:], 1000)[0], nd.estimates(bits[0], bits[:1], 1000)[0]
    assert abs(low - 0.6) < 0.07 and high == 1


def test_long_text(documents):
    text = " ".join(f"w{i % 7919}x{i}" for i in range(200_000))
    found = nd.near_duplicates(documents(text, text + " tail"), 5, 80).collect()
    assert {r.component_id for r in found} == {0}


def test_rows_moved_follow_the_loose_rows(spark):
    """A group moves once to its hub; only blocks of loose rows multiply what moves after that."""
    n, loose = 200_000, 50_000
    group = spark.range(n).select(F.lit(0).cast("long").alias("hub"), F.col("id").alias("node"), F.lit(20).cast("long").alias("n_shingles"))
    beside = nd.beside_hubs(group).groupBy("node").count()
    assert beside.filter("node > 0 and count <> 1").isEmpty()
    assert beside.filter("node = 0").first()["count"] == -(-n // nd.BLOCK_ROWS)
    judged = group.withColumn("label", F.when(F.col("node") < n - loose, 0).otherwise(F.col("node"))).withColumn("loose", F.col("label") > 0)
    moved = nd.blocks(judged)
    of_loose, of_rest = -(-loose // nd.BLOCK_ROWS), -(-(n - loose) // nd.BLOCK_ROWS)
    assert moved.count() == loose * (of_loose + of_rest) + (n - loose) * of_loose
    assert moved.groupBy("hub", "low", "high").count().agg(F.max("count")).first()[0] < 2.2 * nd.BLOCK_ROWS
    assert nd.blocks(judged.filter("not loose")).isEmpty()


def test_blocks_let_every_pair_with_a_loose_row_meet(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_ROWS", 5)
    rows = [(0, i, 3, i if i % 3 == 1 else 0, i % 3 == 1) for i in range(40)]
    tasks = {}
    for r in nd.blocks(spark.createDataFrame(rows, "hub long, node long, n_shingles long, label long, loose boolean")).collect():
        tasks.setdefault((r.low, r.high), []).append((r.node, r.side))
    met = set()
    for members in tasks.values():
        across = len({side for _, side in members}) > 1
        met |= {(a, b) for a, x in members for b, y in members if a < b and (not across or x != y)}
    assert met == {(a, b) for a in range(40) for b in range(a + 1, 40) if rows[a][4] or rows[b][4]}


def test_hub_linked_with_nothing(documents):
    """The least id shares most of its bands by chance of its words with rows that are linked with one another alone."""
    base = [f"v{i}" for i in range(120)]
    texts = [" ".join(base[:60] + [f"h{i}" for i in range(12)])]
    for k in range(40):
        texts.append(" ".join(base[:60] + [f"t{i}" for i in range(30)] + [f"own{k}"]))
    found = {r.doc_id: r.component_id for r in nd.near_duplicates(documents(*texts), 3, 85).collect()}
    assert found == {i: c for i, (_, c, _) in brute(texts, 3, 85, list(range(len(texts)))).items()}
    assert set(found.values()) == {0, 1}
