"""Spelling variants: words one edit apart, by asymmetric q-chunks.

Of two words one edit apart the longer (of equals, either) gives its two disjoint halves as chunks. The edit lies
in one of them, and the other stands unchanged in the other word, at the same place or one to the left. So the
other word gives its positional grams: of all those of a chunk's length the ones that lie within a shift of one of
a chunk's place, for a word as long as itself and for one longer by one. A join on chunk, place and length finds
every pair, and the edit distance verifies it.

Where many words share a chunk, the pairs of a bucket would grow with its square. Such a bucket is split by the
same rule: its words agree outside an interval, one of the two halves of that interval is unchanged too, and joins
the key. Each level halves what is left to differ, down to one code point, so no bucket needs a limit.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import picked, stored, text_slices

LETTERS = "A-Za-zÀ-ÿ"
HELD_WORDS = 200_000
HELD_CHARS = 1 << 24
# A bucket is split where each of its rows would meet more longer words than this.
PAIRS_A_ROW = 32


def word_counts(texts: DataFrame, least_length: int, garble: int | None) -> DataFrame:
    """(word, n): the maximal runs of letters of at least ``least_length`` code points, with their occurrences.

    A task adds up what it has met, and passes it on when it holds ``HELD_WORDS`` spellings. With ``garble`` a run
    loses a code point where that number divides its CRC.
    """
    runs = re.compile(f"[{LETTERS}]{{{least_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        chars = 0
        for batch in text_slices(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = Counter(runs.findall(text.encode().lower().decode())) if text else {}
                begun = zlib.crc32(b":" if doc is None else b"%d:" % doc)
                for run, n in found.items():
                    if garble and not (h := zlib.crc32(run.encode(), begun)) % garble:
                        run = run[:h % len(run)] + run[h % len(run) + 1:]
                        if len(run) < least_length:
                            continue
                    if run not in held:
                        chars += len(run)
                    held[run] += n
                if len(held) >= HELD_WORDS or chars >= HELD_CHARS:
                    yield counted(held)
                    held, chars = Counter(), 0
        yield counted(held)

    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def counted(held: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])


def halves(rows: DataFrame) -> DataFrame:
    """Each row twice, once for each half of the open interval [low, high) of the longer word that may be unchanged.

    ``shift`` is how many code points the row's own word is shorter by; what stands behind the edit lies that
    much further left in it.
    """
    word, low, high, shift, key = (F.col(c) for c in ("word", "low", "high", "shift", "key"))
    middle = low + F.floor((high - low) / 2).cast("int")

    def unchanged(side: int, start: Column, length: Column, left_low: Column, left_high: Column) -> Column:
        piece = F.substr(word, start + 1, length)
        return F.struct(F.xxhash64(key, F.lit(side), piece).alias("key"), left_low.alias("low"), left_high.alias("high"))

    both = F.array(
        unchanged(0, low, middle - low, middle, high),
        unchanged(1, middle - shift, high - middle, low, middle))
    return rows.select("word", "n", "shift", F.explode(both).alias("half")).select("word", "n", "shift", "half.*")


def roots_of_search(words: DataFrame) -> DataFrame:
    """Every word as the longer one or an equal (shift 0) and as the shorter one (shift 1), with nothing known unchanged."""
    length = F.char_length("word")
    shift = F.explode(F.array(F.lit(0), F.lit(1))).alias("shift")
    rows = words.select("word", "n", length.alias("length"), shift)
    longer = F.col("length") + F.col("shift")
    return rows.select("word", "n", "shift", F.lit(0).alias("low"), longer.alias("high"), F.xxhash64(longer).alias("key"))


def near_words(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): each pair of words one edit apart, once."""
    found = []
    rows = roots_of_search(words)
    while True:
        rows = stored(halves(rows), "word-chunks")
        longer = F.sum(1 - F.col("shift"))
        sizes = rows.groupBy("key").agg(longer.alias("longer"), F.count(F.lit(1)).alias("n_rows")).filter("longer > 0 and n_rows > 1")
        # Stored, so that the join has plain tables on both sides and a bucket of many words can be split.
        few = stored(sizes.select("key", (F.col("longer") <= PAIRS_A_ROW).alias("few")), "bucket-sizes")
        met = rows.join(few, "key").withColumn("last", F.col("few") | (F.col("high") - F.col("low") <= 1)).drop("few")
        met = stored(met, "word-buckets")
        found.append(stored(verified(met.filter("last").drop("last", "low", "high")), "near-words"))
        rows = met.filter("not last").drop("last")
        if rows.isEmpty():
            return functools.reduce(DataFrame.union, found).distinct()


def verified(rows: DataFrame) -> DataFrame:
    """Pairs of a bucket that are one edit apart."""
    longer = rows.filter("shift = 0").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    other = rows.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), "shift")
    pairs = longer.join(other, "key").filter((F.col("shift") == 1) | (F.col("a") < F.col("b")))
    return pairs.filter(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b")


def with_roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the end of the chain of forms, which doubles its steps each round.

    A form is more frequent than its word, so chains end, and ten-fold counts leave them a few steps.
    """
    chains = stored(forms.select("word", F.col("form").alias("root")), "chains")
    while True:
        onward = chains.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = stored(chains.join(onward, "root", "left"), "longer-chains")
        chains = joined.select("word", F.coalesce("further", "root").alias("root"))
        if joined.filter("further is not null").isEmpty():
            return chains


def group_variants(
    docs: DataFrame, least_length: int = 7, least_count: int = 2, factor: int = 10, garble: int | None = None,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row for each word: word, form, root, n, n_near, form_n.

    Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z lowered, of at least ``least_length``
    code points and ``least_count`` occurrences (n). Two are near if one code point is inserted, deleted or
    replaced. A word's form is its most frequent near word, of equals the first in code-point order, if that is
    at least ``factor`` times as frequent; its root is the end of the chain of forms. With ``garble`` a run loses
    a code point where that number divides the CRC of ``doc_id:run``. Null and empty texts have no words, a row
    without id counts with an empty id, and repeated rows count each. Texts and words may be of any length. Extra
    columns are left out; an empty table gives an empty result.
    """
    if factor < 2:
        raise ValueError("factor must be 2 at least, or chains of forms could turn back")
    counts = word_counts(picked(docs, id_column, text_column), least_length, garble)
    words = stored(counts.filter(F.col("n") >= least_count), "words")
    pairs = stored(near_words(words), "near-pairs")
    ways = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("near"))).alias("best")
    near = ways.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    frequent = -F.col("best.rank") >= factor * F.col("n")
    judged = stored(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.rank")).alias("form_n")),
        "word-forms")
    roots = with_roots(judged.filter("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
