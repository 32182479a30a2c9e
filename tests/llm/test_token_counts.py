from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from marketspark.llm import token_counts
from marketspark.llm.queries import vocabulary

sentencepiece = pytest.importorskip("sentencepiece")

ODD = [
    None, "", " ", "  ", "\n", "\n\n", " \n ", "a", "a ", " a", "a  b", "a\nb", "a\n b", "a \nb", "a\tb", "▁x", "a▁b", "▁",
    "a▁ b", "<s>", "</s> <unk>", "<0x0A>", "é", "é", "　x", "x\x00y", "日本語 テスト", "🙂🙂 x", "12345 678", "\r\n",
    "ﬁ ½ Å", "word" * 5000, "a " * 3000, "\n" * 500, " " * 700, "don't stop",
]


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))


def rows(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect())


def test_counts_equal_the_library(spark, documents, model):
    rng = random.Random(3)
    alphabet = "ab tion\n  ▁.é,'9<>日\t"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    found = token_counts.count_tokens(documents(*texts), vocabulary("piece_bpe_32k.model"), limit=40)
    expected = [(i, len((t or "").encode()), n := len(model.encode(t or "")), n > 40) for i, t in enumerate(texts)]
    assert rows(found) == expected


def test_memo_may_run_over(monkeypatch, model):
    monkeypatch.setattr(token_counts, "MEMO_ENTRIES", 10)
    counter = token_counts.PieceCounter(vocabulary("piece_bpe_32k.model"))
    for texts in (["alpha betagamma zzqx", "qqqx wwwy"], ["zzqx alpha\nzzqx qqqx"]):
        assert [n for n, _ in counter.counts(texts)] == [len(x) for x in model.encode(texts)]


def test_empty_repeated_and_clashing(spark, documents):
    docs = documents("same text", "same text", None, ids=[5, 5, None]).withColumn("n_tokens", F.lit("x"))
    found = token_counts.count_tokens(docs, vocabulary("piece_bpe_32k.model"))
    assert rows(found) == [(-1, 0, 0, False), (5, 9, 2, False), (5, 9, 2, False)]
    assert token_counts.count_tokens(docs.limit(0), vocabulary("piece_bpe_32k.model")).count() == 0
