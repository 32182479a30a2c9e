"""Line-first cleaning: judge every line, remove the lines that fail, reject documents that lose too much text."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.llm.common import text_slices

WHITE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30
# A line is shared if so many unlike documents hold it at least, and one of so many.
SHARED_BY_ONE_IN = 1_000
LEAST_PLACES = 50
SKETCH_WORDS = 3
LINE_WORDS = 3, 20
MARGIN = " \t\r"
HASH_SEED = 42  # of Spark's xxhash64

# Stock phrases that only stand in page furniture.
STOCK_PHRASES = (
    "all rights reserved", "accept cookies", "cookie policy", "privacy policy", "terms of use", "terms of service",
    "enable javascript", "javascript is disabled", "sign up for our newsletter", "click here", "read more",
    "log in", "lorem ipsum", "back to top", "skip to content", "share this",
)
STOCK = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, STOCK_PHRASES)) + r")(?!\w)")
# The words that furniture puts around a stock phrase. Any other word makes the line a sentence.
FURNITURE = frozenset(
    "a an and by continue cookie cookies copyright for here in javascript more must now of on or our page please policy "
    "privacy read register see service services sign site terms the this to top up use view website you your".split())
PLAIN_WORDS = re.compile(r"[^\W\d_]+")
NOTICE = re.compile(r"^\W*(?:copyright\b|©|\(c\)).*\ball rights reserved\W*$")
SENTENCE_MARKS = re.compile(r"[.!?…。！？:;,]")
MENU_SEPARATORS = frozenset("| » › > → · • / -".split())


def punctuation_ok(line: str, words: list[str]) -> bool:
    """No more than one symbol for five words, no shouting marks behind half of them, and marks in a long line."""
    raw = line.encode()
    if 5 * (len(raw) - len(raw.translate(None, SYMBOLS))) > max(5, len(words)):
        return False
    if 2 * sum(w.endswith(("!!", "??")) for w in words) > len(words):
        return False
    return len(words) < 30 or SENTENCE_MARKS.search(line) is not None


def navigation_ok(words: list[str]) -> bool:
    """Not a menu: fewer than three lone separators, or fewer than one for four words."""
    separators = sum(w in MENU_SEPARATORS for w in words)
    return separators < 3 or 4 * separators < len(words)


def is_stock(line: str) -> bool:
    """Whether a line is stock phrases, whole words of furniture and nothing else, or a copyright notice."""
    low = line.lower()
    rest, found = STOCK.subn(" ", low)
    return found > 0 and (FURNITURE.issuperset(PLAIN_WORDS.findall(rest)) or NOTICE.match(low) is not None)


def boilerplate_ok(line: str, words: list[str]) -> bool:
    """No stock line of up to 20 words, and no word that fills half of a line of ten or more."""
    if len(words) <= 20 and is_stock(line):
        return False
    return len(words) < 10 or 2 * max(Counter(words).values()) < len(words)


def line_key(line: str) -> int:
    """Spark's ``xxhash64`` of the line without white margins."""
    unsigned = xxhash.xxh64_intdigest(line.strip(MARGIN).encode(), HASH_SEED)
    return unsigned - (1 << 64) if unsigned >> 63 else unsigned


def shared_lines(docs: DataFrame, text_column: str = "text", source_column: str = "source") -> frozenset[int]:
    """Keys of the lines of 3 to 20 words that unlike documents of different sources share as boilerplate.

    A document is told by the least hash of its runs of ``SKETCH_WORDS`` words, which near copies mostly have in
    common. A line is shared if ``LEAST_PLACES`` documents so told hold it, and one of ``SHARED_BY_ONE_IN`` documents,
    and if they are two thirds of its occurrences at least: lines that copies repeat, exact or near, stay. At most
    ``SHARED_BY_ONE_IN`` times the mean number of lines in a document can be shared, at any size of the corpus, so the
    driver may hold them. Null and empty texts have no lines, and an empty table shares none.
    """
    least = max(LEAST_PLACES, docs.count() / SHARED_BY_ONE_IN)
    text = F.col(f"`{text_column}`")
    split = docs.select(
        F.split(text, "\n").alias("lines"), F.split(text, r"\s+").alias("words"), F.xxhash64(f"`{source_column}`").alias("source"))
    told = split.select("lines", "source", F.array_min(F.transform(
        "words", lambda word, i: F.xxhash64(word, *[F.get("words", i + k) for k in range(1, SKETCH_WORDS)]))).alias("place"))
    lines = told.select("source", "place", F.explode("lines").alias("line")).select("source", "place", F.btrim("line", F.lit(MARGIN)).alias("line"))
    words = F.size(F.split("line", r"\s+"))
    places = lines.filter(words.between(*LINE_WORDS)).groupBy(F.xxhash64("line").alias("key"), "place").agg(
        F.count(F.lit(1)).alias("n"), F.min("source").alias("least"), F.max("source").alias("most"))
    found = places.groupBy("key").agg(
        F.count(F.lit(1)).alias("places"), F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
    shared = (F.col("places") >= least) & (3 * F.col("places") >= 2 * F.col("n")) & F.expr("least <> most")
    return frozenset(r.key for r in found.filter(shared).select("key").collect())


def line_ok(line: str) -> bool:
    words = line.split()
    return not words or punctuation_ok(line, words) and navigation_ok(words) and boilerplate_ok(line, words)


def repeated_words(docs: list[list[bytes]]) -> list[int]:
    """For each document its words inside windows of ``WINDOW`` words that stand in it twice or more.

    Windows get ranks by doubling: a rank of 2, 4, then 8 words names the pair of its halves' ranks.
    """
    sizes = np.array([len(words) for words in docs], np.int64)
    flat = [w for words in docs for w in words]
    if len(flat) < WINDOW:
        return [0] * len(docs)
    ranks = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    width = 1
    while width < WINDOW:
        pairs = ranks[:-width] * (ranks.max() + 1) + ranks[width:]
        ranks = np.unique(pairs, return_inverse=True)[1]
        width *= 2
    doc = np.repeat(np.arange(len(docs)), sizes)
    inside = doc[:len(ranks)] == doc[WINDOW - 1:WINDOW - 1 + len(ranks)]
    starts = np.flatnonzero(inside)
    _, group, count = np.unique(doc[starts] * (ranks.max() + 1) + ranks[starts], return_inverse=True, return_counts=True)
    starts = starts[count[group] > 1]
    edges = np.zeros(len(flat) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    covered = np.cumsum(edges[:-1]) > 0
    return np.bincount(doc, covered, minlength=len(docs)).astype(np.int64).tolist()


def judged(text: str | None, max_lost: float, shared: frozenset[int] = frozenset()) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_lines_removed, lost_chars, cleaned text, and the words."""
    if not text:
        return 0, 0, 0, 0, 0, 0, text, []
    raw = text.encode()
    words = raw.split()
    chars = len(text) - (len(raw) - len(raw.translate(None, WHITE)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen, kept, repeated, removed, lost = set(), [], 0, 0, 0
    for line in text.split("\n"):
        if bare := line.encode().translate(None, WHITE):
            repeated += line in seen
            seen.add(line)
            if not line_ok(line) or shared and line_key(line) in shared:
                removed += 1
                lost += len(bare.decode())
                continue
        kept.append(line)
    return len(words), chars, symbols, repeated, removed, lost, text if not removed else "\n".join(kept), words


VERDICT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()), T.StructField("n_lines_removed", T.LongType()),
    T.StructField("lost_chars", T.LongType()), T.StructField("cleaned", T.StringType()),
])


def judge_documents(
    docs: DataFrame, text_column: str = "text", max_lost: float = 0.5, source_column: str | None = "source",
) -> DataFrame:
    """``docs`` with one more column ``verdict``, a struct: counts, ``kept``, and ``cleaned``, the text left over.

    A document is kept if it has 20 words or more, at most 30 % of them in repeated windows of 8 words, and
    loses at most ``max_lost`` of its characters to failed lines. A null or empty text has no words and is
    rejected; its cleaned text is what it was. Repeated rows are judged alike. All columns of ``docs`` stay;
    one named ``verdict`` is replaced. Lines that documents of different values of ``source_column`` share fail too;
    they are counted first, over all documents, unless it is None. Then one pass without a shuffle, by about a
    megabyte of text at a time.
    """
    shared = shared_lines(docs, text_column, source_column) if source_column else frozenset()
    fields = T.StructType([f for f in docs.schema.fields if f.name != "verdict"])
    plain = docs.select(*[F.col(f"`{f.name}`") for f in fields])
    types = pa.struct([(f.name, pa.string() if f.dataType == T.StringType() else pa.bool_() if f.dataType == T.BooleanType()
                        else pa.int64()) for f in VERDICT])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_column):
            found = [judged(text, max_lost, shared) for text in batch.column(text_column).to_pylist()]
            rows = []
            for (n, chars, symbols, dups, removed, lost, cleaned, _), repeats in zip(
                found, repeated_words([f[-1] for f in found]), strict=True,
            ):
                failed = n < MIN_WORDS or 100 * repeats > MAX_REPEATED * n
                rows.append(dict(zip(VERDICT.names, (
                    n, chars, symbols, dups, repeats, failed, not failed and lost <= max_lost * chars, removed, lost, cleaned,
                ), strict=True)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, types)], [*batch.schema.names, "verdict"])

    return plain.mapInArrow(judge, T.StructType([*fields, T.StructField("verdict", VERDICT)]))
