from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketspark.llm import packing
from marketspark.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")

ODD = [
    None, "", " \n", "Don't STOP, it's 12 o'clock!!", "Éa èB. ÑÓ x", "é İstanbul ΑΣ", "a\x1cb \x1f", "日本 🙂 x²",
    "<|endoftext|> a<|startoftext|>b", "can'tll 's 'T", "word" * 900, "x " * 5000, "ß×÷ª µº ¹½x 3² ÀÝ \x85\xa0y\x1c\x1dz \xad", "it's 'RE O'Dell", "x<|y", "áb c‍",
]


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(vocabulary("word_bpe_49k.json"))


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def check(pieces, wanted, length):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(bytes(p.ids)) and p.length * 4 == len(p.ids) and p.length > 0
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert by_doc.keys() == wanted.keys()
    for doc, own in by_doc.items():
        own.sort(key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in own) == np.array(wanted[doc], "<u4").tobytes()
        assert [p.start for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        assert [p.continues for p in own] == [True] * (len(own) - 1) + [False]
        assert {p.doc_tokens for p in own} == {len(wanted[doc])}
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for sequence, own in by_sequence.items():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        full = sum(p.length for p in own)
        assert full == length or sequence == len(by_sequence) - 1 and full < length


@pytest.mark.parametrize("length", [7, 64, 4096])
def test_pieces_rebuild_every_document(documents, tokenizer, length):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("abé' \n.,9ÉT!") for _ in range(rng.randint(0, 80))) for _ in range(150)]
    pieces = packing.pack(documents(*texts), vocabulary("word_bpe_49k.json"), length=length).collect()
    check(pieces, {i: ids_of(tokenizer, t) for i, t in enumerate(texts)}, length)


def test_memo_may_run_over(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "MEMO_ENTRIES", 6)
    words = packing.PartIds(vocabulary("word_bpe_49k.json"))
    for texts in (["alpha, beta gamma! delta"], ["epsilon alpha zeta beta", "日本 alpha"]):
        assert words.ids(texts) == [np.array(ids_of(tokenizer, t)[:-1], "<u4").tobytes() for t in texts]


def test_empty_null_and_clashing(documents):
    docs = documents("a b", None, None, ids=[1, 2, None]).withColumn("length", F.lit("x")).withColumn("block", F.lit(9))
    found = packing.pack(docs, vocabulary("word_bpe_49k.json")).collect()
    assert sorted((p.doc_id or 0, p.doc_tokens) for p in found) == [(0, 1), (1, 3), (2, 1)]
    assert packing.pack(docs.limit(0), vocabulary("word_bpe_49k.json")).count() == 0
