from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(texts, items, window):
    out = {}
    for i, text in enumerate(texts):
        own, hit, found = words(text), set(), set()
        for item, t in items:
            w = words(t)
            for s in range(max(1, len(w) - window + 1)) if w else ():
                phrase = w[s:s + window]
                for p in range(len(own) - len(phrase) + 1):
                    if own[p:p + len(phrase)] == phrase:
                        hit |= set(range(p, p + len(phrase)))
                        found.add(str(item))
        out[i] = (len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def benchmark(spark, items):
    return spark.createDataFrame(items, T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())]))


def test_equals_brute_force(spark, documents):
    rng = random.Random(2)
    vocabulary = ["the", "of", "Rare1", "É", "é", "x9", "日本", "und", "a", "b"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--", "\x7f"]) for _ in range(n))

    items = [(i, text(rng.choice([1, 2, 4, 5, 9, 20]))) for i in range(14)] + [(100, ""), (101, None), (102, "..."), (10, "the of")]
    texts = [None, "", " .. ", "The", "É é", "the the the the"]
    for _ in range(60):
        parts = [text(rng.randint(0, 20))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(items)[1] or "", " ", text(rng.randint(0, 10))]
        texts.append("".join(parts).upper() if rng.random() < 0.2 else "".join(parts))
    found = dc.decontaminate(documents(*texts), benchmark(spark, items), window=4).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found} == brute(texts, items, 4)
    assert len(found) == len(texts)


def test_near_matches(spark, documents):
    items = [(1, "alpha beta gamma delta epsilon")]
    texts = ["so beta alpha the gamma epsilon delta then", "alpha beta gamma", "Alpha-beta gamma. DELTA (epsilon)", "alpha beta gamma delta other"]
    found = {r.doc_id: (r.n_hit, r.n_near_items) for r in dc.decontaminate(documents(*texts), benchmark(spark, items), 5).collect()}
    assert found == {0: (0, 1), 1: (0, 0), 2: (5, 0), 3: (0, 0)}


def test_without_broadcast_and_edges(spark, documents, monkeypatch):
    monkeypatch.setattr(dc, "broadcast_if_small", lambda df: df)
    item = "one two three four five six seven eight nine ten eleven"
    docs = documents(item, item, None, "x " + item, ids=[4, 4, None, None]).withColumn("term", F.lit("x")).withColumn("words", F.lit(1))
    found = dc.decontaminate(docs, benchmark(spark, [(3, item), (20, item)])).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_hit, r.item_ids) for r in found) == [
        (0, 0, 0, []), (0, 12, 11, ["20", "3"]), (4, 11, 11, ["20", "3"]), (4, 11, 11, ["20", "3"])]
    assert dc.decontaminate(docs.limit(0), benchmark(spark, [(3, item)])).count() == 0
    assert {r.n_hit for r in dc.decontaminate(docs, benchmark(spark, [])).collect()} == {0}
    long = documents("filler " * 200_000 + item)
    assert dc.decontaminate(long, benchmark(spark, [(3, item)])).first().n_hit == 11


def test_near_items_equal_brute_force(spark, documents):
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(12)]
    items = [(i, " ".join(rng.sample(vocabulary, rng.choice([2, 3, 4, 6])))) for i in range(12)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 25))) for _ in range(50)]
    counts = {v: sum(words(t).count(v) for t in texts) for v in vocabulary}
    wanted = {}
    for i, text in enumerate(texts):
        own, exact, near = words(text), set(), set()
        for item, t in items:
            w = words(t)
            for phrase in [w[s:s + 4] for s in range(max(1, len(w) - 3))]:
                rarest = min(phrase, key=lambda v: (counts[v], v))
                for p in [p for p, v in enumerate(own) if v == rarest]:
                    begin = p - phrase.index(rarest)
                    if begin >= 0 and own[begin:begin + len(phrase)] == phrase:
                        exact.add(str(item))
                    elif set(phrase) <= set(own[max(0, p - 3):p + 4]):
                        near.add(str(item))
        wanted[i] = sorted(near - exact)
    found = {r.doc_id: r for r in dc.decontaminate(documents(*texts), benchmark(spark, items), window=4).collect()}
    assert {i: r.near_item_ids for i, r in found.items()} == wanted and any(wanted.values())
    assert all(r.n_near_items == len(r.near_item_ids) for r in found.values())


def test_a_long_text_full_of_hits(spark, documents, monkeypatch):
    """Rows hold a block of a text, never the whole of it: a million words of which a fifth are hits."""
    texts = ["the cat sat on mats " * 200_000, "nothing", " the" * 600]
    found = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in dc.decontaminate(documents(*texts), benchmark(spark, [(7, "The")])).collect()}
    assert found == {0: (1_000_000, 200_000, ["7"]), 1: (1, 0, []), 2: (600, 600, ["7"])}


def test_no_row_of_the_index_holds_a_text(spark, documents, capsys, monkeypatch):
    plans = []
    stored = dc.stored
    monkeypatch.setattr(dc, "stored", lambda df, name, *rest: (plans.append((name, df)), stored(df, name, *rest))[1])
    for keep in (dc.broadcast_if_small, lambda df: df):
        monkeypatch.setattr(dc, "broadcast_if_small", keep)
        dc.decontaminate(documents("one two three"), benchmark(spark, [(1, "two")])).collect()
    checked = 0
    for name, df in plans:
        if name in ("postings", "term-places", "term-counts"):
            df.explain("simple")
            for line in capsys.readouterr().out.splitlines():
                if "Generate " in line or "Exchange " in line:
                    kept = line.split("], ", 1)[0] if "Exchange" in line else line.split(", [", 1)[1].split("]")[0]
                    assert not any(part.strip().startswith("words#") for part in kept.split(","))
                    checked += 1
    assert checked > 4


def test_blocks_meet_at_their_borders(spark, documents, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK", 3)
    rng = random.Random(9)
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.choice([1, 3, 6, 12])))) for i in range(8)]
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40))) for _ in range(40)]
    for keep in (dc.broadcast_if_small, lambda df: df):
        monkeypatch.setattr(dc, "broadcast_if_small", keep)
        found = dc.decontaminate(documents(*texts), benchmark(spark, items), window=5).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found} == brute(texts, items, 5)
