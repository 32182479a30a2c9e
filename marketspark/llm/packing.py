"""Packing by concatenation: every token has a global place, and windows of fixed length cut the row of tokens.

Pass one tokenises each text once and stores the ids with their place in the task's block. The totals of the
blocks, one row for each task, give the blocks' global offsets. Pass two adds the two and cuts each document
at the window borders; a document that crosses one leaves a piece on either side.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketspark.llm.common import picked, stored, text_slices

MEMO_ENTRIES = 600_000
# The tokenizer's own cuts, written for lower-cased Latin-1: contractions, runs of letters, single digits, the
# rest. Each Latin-1 character composes and lowers by itself, so a lowered text can be cut before encoding.
CUTS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    r"|[^\t-\r \x85\xa0a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")
WORDS = re.compile(r"[^\x20\x09-\x0d]+")
SPECIAL_MARK = "<|"  # a text that may hold the spelling of a special token is left to the tokenizer's own cuts


def parts_of(text: str) -> list[str]:
    """Parts that the tokenizer encodes one by one: its own pre-tokens in Latin-1 texts, else words."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return WORDS.findall(text)
    return WORDS.findall(text) if SPECIAL_MARK in text else CUTS.findall(text.lower())


class PartIds:
    """Token ids of a text from those of its parts. Each spelling is encoded once while a bounded memo holds it.

    The tokenizer drops white space and cuts at it before any merge, so words are encoded alone; a pre-token
    encoded alone is one pre-token again.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[str, bytes] = {}

    def ids(self, texts: list[str | None]) -> list[bytes]:
        split = [parts_of(text) if text else [] for text in texts]
        if len(self.memo) > MEMO_ENTRIES:
            self.memo = {}
        memo = self.memo
        if missing := list({part for parts in split for part in parts if part not in memo}):
            for part, found in zip(missing, self.tokenizer.encode_batch_fast(missing, add_special_tokens=False), strict=True):
                memo[part] = array("I", found.ids).tobytes()
        return [b"".join([memo[part] for part in parts]) for parts in split]


@functools.lru_cache(maxsize=4)
def part_ids(path: str) -> PartIds:
    return PartIds(path)


def tokenised(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Pass one: each text's ids (unsigned 32-bit, little-endian) and end id, with its place in the task's block."""
    end = np.uint32(end_id).astype("<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, block, at = part_ids(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in text_slices(batches):
            ids = [x + end for x in encoder.ids(batch.column("text").to_pylist())]
            n = np.array([len(x) // 4 for x in ids], np.int64)
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(ids), block, np.int64)), pa.array(starts),
                 pa.array(n), pa.array(ids, pa.binary())],
                ["doc_id", "block", "block_start", "doc_tokens", "ids"],
            )

    return docs.mapInArrow(encode, "doc_id long, block long, block_start long, doc_tokens long, ids binary")


def pack(
    docs: DataFrame, tokenizer_path: str, length: int = 4096, end_id: int = 2,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row for each piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids, continues.

    A null or empty text is the end id alone. Rows without id and repeated rows are packed like others.
    Only the last sequence may be short of ``length``. Extra columns are left out; an empty table packs to
    nothing. ``continues`` marks a piece whose document goes on in the next sequence. The broadcast holds
    one row of 16 bytes for each task of the first pass, whatever the number of documents.
    """
    tokens = stored(tokenised(picked(docs, id_column, text_column), tokenizer_path, end_id), "packing-tokens")
    totals = tokens.groupBy("block").agg(F.sum("doc_tokens").alias("tokens"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("block", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("block_offset"))
    placed = tokens.join(F.broadcast(offsets), "block").select(
        "doc_id", (F.col("block_offset") + F.col("block_start")).alias("place"), "doc_tokens", "ids")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "ids"):
            rows = []
            for doc, place, n, ids in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                at = 0
                while at < n:
                    sequence, offset = divmod(place + at, length)
                    size = min(n - at, length - offset)
                    piece = ids[4 * at:4 * (at + size)]
                    rows.append((doc, at, size, zlib.crc32(piece), n, sequence, offset, piece, at + size < n))
                    at += size
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), PIECE.types, strict=True)]
                if rows else [pa.array([], kind) for kind in PIECE.types],
                schema=PIECE,
            )

    return placed.mapInArrow(
        cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
             "offset long, ids binary, continues boolean")


PIECE = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
    ("continues", pa.bool_()),
])
