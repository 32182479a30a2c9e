from __future__ import annotations

import random
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from marketspark.llm import quality_rules

CLEAN = "The river runs past the old mill, and people walk there in the evening.\nNobody knows when it was built. " * 3


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    hit = {i + k for i, w in enumerate(windows) if w in often for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(hit), failed)


def test_counts_equal_brute_force(documents):
    rng = random.Random(1)
    texts = [None, "", " ", "\n\n", "a", "x\x1cy z", "a " * 9, "a " * 40, " lead\n lead\nlead", "é|ü <b> é", "\r\n a\r\n a"]
    for _ in range(200):
        words = [rng.choice(["a", "b", "é", "c#", "|"]) for _ in range(rng.randint(0, 60))]
        texts.append("".join(w + rng.choice([" ", " ", "\n", "\t", "　"]) for w in words))
    found = quality_rules.judge_documents(documents(*texts)).select("doc_id", "verdict.*").collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_lines_that_fail_are_removed(documents):
    body = "\n".join(f"Sentence {i} says thing{i} of its own, and then{i} it ends." for i in range(9))
    menu, shout = "Home | News | About | Contact", "BUY!! NOW!! CHEAP!! STUFF!!"
    junk, stock = "w### x*** y&&& z%%% v$$$ u###", "Read our privacy policy."
    text = "\n".join([menu, body, shout, junk, stock, "word " * 12])
    [row] = quality_rules.judge_documents(documents(text)).collect()
    assert row.verdict.cleaned == body and row.verdict.n_lines_removed == 5 and row.verdict.kept
    assert row.text == text and row.source == "src0"


def test_documents_that_lose_too_much_go(documents):
    menu = "\n".join(f"one{i} | two{i} | three{i} | four{i} | five{i}" for i in range(9))
    kept = {r.doc_id: r.verdict.kept for r in quality_rules.judge_documents(documents(menu, CLEAN[:140], None, "")).collect()}
    assert kept == {0: False, 1: True, 2: False, 3: False}


def test_planted_styles(documents):
    texts = ["".join(f"Word{i} goes with others{i * 7 % 11} here. " for i in range(30)), "no marks at all " + " ".join(f"w{i}" for i in range(20))]
    assert [r.verdict.kept for r in quality_rules.judge_documents(documents(*texts)).orderBy("doc_id").collect()] == [True, True]


def test_clashing_and_empty(documents):
    docs = documents(CLEAN, CLEAN, ids=[4, None]).withColumn("verdict", F.lit(1)).withColumn("kept", F.lit("x"))
    found = quality_rules.judge_documents(docs)
    assert sorted(found.columns) == sorted(docs.columns) and found.count() == 2
    assert quality_rules.judge_documents(docs.limit(0)).count() == 0


def test_very_long_text(documents):
    text = "\n".join(f"This is line{i} of a very{i} long text." for i in range(60_000))
    [row] = quality_rules.judge_documents(documents(text)).collect()
    assert row.verdict.n_words == 8 * 60_000 and row.verdict.n_repeat_words == 0 and row.verdict.cleaned == text


def test_sentences_that_hold_a_stock_phrase_stay(documents):
    clean = ["The catalog in the hall is old.", "Her blog in spring was read.", "They turned the dialog into a play.",
             "Butter is spread more thinly here.", "He read more than his brother.", "We share this view.", "I log in.",
             "They log in at nine.", "The privacy policy was debated in parliament.", "He has all rights reserved by law."]
    stock = ["All rights reserved.", "© 2019 Example Media Group Ltd. All rights reserved.", "READ MORE »", "Log in", "Read our privacy policy.",
             "Privacy Policy | Terms of Use", "Click here to continue", "Share this:", "Lorem ipsum", "Back to top", "Please enable JavaScript to view this page."]
    [row] = quality_rules.judge_documents(documents("\n".join(x for pair in zip(clean, stock) for x in pair) + "\n" + stock[-1])).collect()
    assert row.verdict.cleaned == "\n".join(clean) and row.verdict.n_lines_removed == len(stock)
    [row] = quality_rules.judge_documents(documents("\n".join(clean))).collect()
    assert row.verdict.kept and row.verdict.cleaned == row.text


def sketch(text):
    words, hashes = re.split(r"[ \t\n\x0b\f\r]+", text), []
    for i in range(len(words)):
        h = 42
        for word in words[i:i + 3]:
            h = xxhash.xxh64_intdigest(word.encode(), h)
        hashes.append(h - (1 << 64) if h >> 63 else h)
    return min(hashes)


def shared_by_brute_force(rows):
    places, times, sources = {}, Counter(), {}
    for text, source in rows:
        for line in (text or "").split("\n"):
            key = line.strip(" \t\r")
            if 3 <= len(key.split()) <= 20:
                places.setdefault(key, set()).add(sketch(text))
                times[key] += 1
                sources.setdefault(key, set()).add(source)
    least = max(quality_rules.LEAST_PLACES, len(rows) / quality_rules.SHARED_BY_ONE_IN)
    return {k for k, p in places.items() if len(p) >= least and 3 * len(p) >= 2 * times[k] and len(sources[k]) > 1}


def test_lines_shared_by_documents_of_several_sources(spark):
    rng = random.Random(3)

    def sentence():
        return " ".join(f"w{rng.randrange(5000)}" for _ in range(9)) + "."

    stock = ["Alle Angaben ohne Gewähr.", "Tous droits réservés par la rédaction.", "Síguenos en las redes sociales", "Subscribe to hear from us first."]
    near_copy = [sentence() for _ in range(12)]
    rows = [(None, "a"), ("", "b"), ("\n\n", None)]
    for k in range(120):
        body = [sentence() for _ in range(8)]
        body.insert(rng.randrange(9), "  " + stock[k % 2] + "\r" if k % 5 == 0 else stock[k % 2])
        body.insert(rng.randrange(9), stock[2] if k < 60 else sentence())
        rows.append(("\n".join([*body, "Only here now and then." if k < 40 else sentence()]), f"site{k % 7}"))
        own = list(near_copy)
        own[rng.randrange(12)] = sentence()
        rows.append(("\n".join(own), f"site{k % 7}"))
        rows.append(("\n".join([sentence(), "One site alone says this.", sentence()] * 3), "site1"))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i if i % 9 else None, *r) for i, r in enumerate(rows)], "doc_id long, text string, source string").repartition(3)
    found = quality_rules.shared_lines(docs)
    assert found == {quality_rules.line_key(x) for x in shared_by_brute_force(rows)} == {quality_rules.line_key(x) for x in stock[:3]}
    for r in quality_rules.judge_documents(docs).collect():
        lines = (r.text or "").split("\n")
        kept = [x for x in lines if not (x.strip() and quality_rules.line_key(x) in found)]
        assert (r.verdict.cleaned or "") == "\n".join(kept)
    assert quality_rules.shared_lines(docs.limit(0)) == frozenset()
