"""Token counts by the whole-token shortcut.

The model's normaliser keeps the text as it is, puts one space before it and writes spaces as U+2581. No
piece holds that mark behind another character, and none holds a line feed. So no merge crosses the place
before a run of spaces or either side of a line feed, and a text's count is the sum over these pre-tokens.

Which pre-tokens are one token is proved once for each worker by encoding every vocabulary string alone.
Those count 1 without a merge; only the rest are encoded, each spelling once while a bounded memo holds it.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import picked, text_slices

MARK = "▁"
RUNS = re.compile(" +[^ ]*")
MEMO_ENTRIES = 400_000


class PieceCounter:
    """Counts tokens of one sentencepiece model, pre-token by pre-token."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.spaced, self.bare = self._whole_tokens()
        self.memo: dict[str, int] = dict(self.spaced)

    def _whole_tokens(self) -> tuple[dict[str, int], dict[str, int]]:
        """Vocabulary strings that alone are one token: behind a space (left out of the key), and without one."""
        model = self.model
        pieces = [
            (i, model.id_to_piece(i)) for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))
        ]
        if any(MARK in piece.lstrip(MARK) or "\n" in piece for _, piece in pieces):
            raise ValueError("pieces of this model cross the places where texts are cut")
        if model.encode("\n")[:1] != model.encode("\nx")[:1] or len(model.encode("\n")) != 2:
            raise ValueError("this model does not keep a line feed apart")
        spaced = [(i, piece[1:].replace(MARK, " ")) for i, piece in pieces if piece[0] == MARK and piece != MARK]
        bare = [(i, piece) for i, piece in pieces if piece[0] != MARK]
        one = {key: 1 for (i, key), ids in zip(spaced, model.encode([k for _, k in spaced]), strict=True) if ids == [i]}
        alone = model.encode(["\n" + key for _, key in bare])
        return one | {"": 1}, {key: 1 for (i, key), ids in zip(bare, alone, strict=True) if ids[2:] == [i]}

    def pre_tokens(self, text: str) -> list[str]:
        """Runs of spaces with what follows them, less their first space."""
        if not text:
            return []
        if MARK in text:
            text = text.replace(MARK, " ")
        if text[0] == " " or text[-1] == " " or "  " in text:
            return [run[1:] for run in RUNS.findall(" " + text)]
        return text.split(" ")

    def learn(self, keys: set[str]) -> None:
        """Counts for pre-tokens the memo lacks: the parts between line feeds, merged where no proof holds."""
        parts = {key: key.split("\n") for key in keys}
        heads = list({p[0] for p in parts.values()} - self.spaced.keys())
        tails = list({x for p in parts.values() for x in p[1:] if x} - self.bare.keys())
        head = dict(zip(heads, map(len, self.model.encode(heads, num_threads=1)), strict=True)) if heads else {}
        tail = {}
        if tails:
            tail = {t: len(ids) - 2 for t, ids in zip(tails, self.model.encode(["\n" + t for t in tails], num_threads=1), strict=True)}
        for key, (first, *rest) in parts.items():
            count = head.get(first) or self.spaced[first]
            self.memo[key] = count + sum(1 + (self.bare.get(x) or tail[x] if x else 0) for x in rest)

    def counts(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """For each text its tokens, and how many of them the shortcut settled."""
        split = [self.pre_tokens(text or "") for text in texts]
        if len(self.memo) > MEMO_ENTRIES:
            self.memo = dict(self.spaced)
        if missing := {key for keys in split for key in keys if key not in self.memo}:
            self.learn(missing)
        memo, whole = self.memo, self.spaced
        return [(sum(map(memo.__getitem__, keys)), sum(map(whole.__contains__, keys))) for keys in split]


@functools.lru_cache(maxsize=4)
def counter(model_path: str) -> PieceCounter:
    return PieceCounter(model_path)


def count_tokens(
    docs: DataFrame, model_path: str, limit: int = 4096, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: n_bytes, n_tokens, over_limit, n_whole (settled without a merge).

    A null or empty text has no bytes and no tokens. A null id stays null; repeated rows each give a row.
    Extra columns are left out. An empty table gives an empty result. The work is one pass without a
    shuffle: a task holds about a megabyte of text at a time, or one text where that is longer.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = counter(model_path)
        for batch in text_slices(batches):
            found = pieces.counts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("n_bytes"),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([n > limit for n, _ in found], pa.bool_()),
                    pa.array([w for _, w in found], pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "n_whole"],
            )

    sized = picked(docs, id_column, text_column).withColumn(
        "n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    return sized.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_whole long")
