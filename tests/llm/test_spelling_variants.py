from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from marketspark.llm import spelling_variants as sv


def neighbours(word):
    """What is left of a word without one of its code points, with the place."""
    return [(word[:i], word[i + 1:]) for i in range(len(word))]


def brute(texts, ids, least_length=7, garble=None, factor=10):
    counts = Counter()
    for doc, text in zip(ids, texts, strict=True):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if garble and h % garble == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 2 and len(w) >= least_length}
    replaced = defaultdict(set)
    for word in words:
        for mark in neighbours(word):
            replaced[mark].add(word)
    near = defaultdict(set)
    for word in words:
        for head, tail in neighbours(word):
            near[word] |= replaced[head, tail] - {word}
            if head + tail in words:
                near[word].add(head + tail)
                near[head + tail].add(word)
    form = {}
    for word, others in near.items():
        if others:
            best = min(others, key=lambda w: (-words[w], w))
            if words[best] >= factor * words[word]:
                form[word] = best

    def root(word):
        while word in form:
            word = form[word]
        return word

    return sorted((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items())


def found(df):
    return sorted(tuple(row) for row in df.collect())


def corpus(seed, n=300):
    rng = random.Random(seed)
    bases = ["".join(rng.choice("abÉé") for _ in range(rng.randint(6, 12))) for _ in range(40)]
    texts = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 60)):
            word = rng.choice(bases[: rng.choice([2, 5, 40])])
            if rng.random() < 0.3:
                k = rng.randrange(len(word))
                word = rng.choice([word[:k] + word[k + 1:], word[:k] + rng.choice("abÉ") + word[k:], word[:k] + rng.choice("abé") + word[k + 1:]])
            words.append(word.upper() if rng.random() < 0.1 and word.isascii() else word)
        texts.append(rng.choice([" ", ", ", "1", "日"]).join(words))
    return texts


@pytest.mark.parametrize(("seed", "garble", "pairs"), [(1, 31, 32), (2, 3, 0), (3, None, 1)])
def test_words_equal_brute_force(documents, monkeypatch, seed, garble, pairs):
    monkeypatch.setattr(sv, "PAIRS_A_ROW", pairs)
    texts = corpus(seed)
    assert found(sv.group_variants(documents(*texts), garble=garble)) == brute(texts, range(len(texts)), garble=garble)


def test_short_words(documents):
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(40)) for _ in range(30)]
    found_rows = found(sv.group_variants(documents(*texts), least_length=1, factor=2))
    assert found_rows == brute(texts, range(len(texts)), least_length=1, factor=2)


def test_chains_of_forms(documents):
    steps = {"abcdefgh": 4000, "abcdefgx": 400, "abcdefyx": 40, "abcdezyx": 4, "abcdezy": 3}
    texts = [f"{word} " * n for word, n in steps.items()]
    rows = {r[0]: r for r in found(sv.group_variants(documents(*texts)))}
    assert {rows[w][2] for w in list(steps)[:4]} == {"abcdefgh"} and rows["abcdezy"][1:3] == (None, "abcdezy")
    assert sorted(rows.values()) == brute(texts, range(len(texts)))


def test_a_hot_bucket_is_split(documents, monkeypatch):
    """All words share a half, and most of them are not near: what is verified must not grow with the square."""
    rng = random.Random(6)
    words = sorted({"internation" + "".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(4000)})
    words += ["internation" + "x" + w[12:] for w in words[:50]]
    texts = [" ".join(words[i::7]) for i in range(7)] * 2
    tried = []
    verified = sv.verified

    def watched(rows):
        longer = rows.filter("shift = 0").groupBy("key").agg(F.count(F.lit(1)).alias("x"))
        tried.append(longer.join(rows, "key").agg(F.sum("x")).first()[0] or 0)
        return verified(rows)

    monkeypatch.setattr(sv, "verified", watched)
    assert found(sv.group_variants(documents(*texts))) == brute(texts, range(len(texts)))
    assert len(tried) > 1 and sum(tried) < 200 * len(words)


def test_long_words_and_texts(documents, monkeypatch):
    monkeypatch.setattr(sv, "HELD_WORDS", 3)
    long = "ab" * 20_000
    texts = [long, f"{long} {long[:-1]}", long[:-1], f"{long[:9999]}é{long[10000:]} " * 2, "cdefghij " * 50_000, "cdefghi cdefghi"]
    assert found(sv.group_variants(documents(*texts))) == brute(texts, range(len(texts)))


def test_edges(documents):
    texts = [None, "", "   ", "Straße STRASSE straße", "ÀÉÈÊËÌÍ ÀÉÈÊËÌÍ àÉÈÊËÌÍ àÉÈÊËÌÍ", "abcdefg1abcdefg", "straße", "x×÷xxxx x×÷xxxx"]
    ids = [1, 2, None, None, 5, 5, 5, 9]
    docs = documents(*texts, ids=ids).withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    assert found(sv.group_variants(docs, least_length=6, garble=2)) == brute(texts, ids, least_length=6, garble=2)
    assert found(sv.group_variants(docs.union(docs))) == brute(texts * 2, ids * 2)
    assert sv.group_variants(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        sv.group_variants(docs, factor=1)


def test_query_on_the_smallest_tables(spark):
    from marketspark.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = brute([r.text for r in rows], [r.doc_id for r in rows], garble=31)
    result = QUERIES["op12_asymmetric_chunks"](spark, folder).select("word", "form", "root", "n", "n_near", "form_n")
    assert found(result) == expected and any(r[1] for r in expected)
