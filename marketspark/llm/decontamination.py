"""Benchmark decontamination with a positional inverted index, in DataFrame operations alone.

1. Items are cut into phrases of ``window`` words. The corpus frequency of every word that phrases use is
   counted, and each phrase is looked up by its rarest word.
2. Texts are cut into blocks of words that overlap by the reach of a phrase, so that no row holds a whole long
   text beside one of its words. The index stores postings of the rarest words: document, position, and the words
   around it as far as a phrase can reach. The words around are what the lists of all other words hold at that
   place, adjusted by offset.
3. A phrase meets the postings of its rarest word. It stands there exactly if the words around, shifted by
   the word's offset in the phrase, are the phrase; it is near if they hold all its words in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketspark.llm.common import broadcast_if_small, picked, stored

# Everything of ASCII but digits and letters parts words; only A-Z are lowered.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK = 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text, letters as they stand; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def lowered(word: Column) -> Column:
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def phrases_of(items: DataFrame, window: int) -> DataFrame:
    """(phrase_id, phrase, item_id): each phrase of each item; a short item is one phrase. Equal phrases share an id."""
    words = items.select("item_id", F.transform(words_of(F.col("text")), lowered).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (window - 1)))
    cut = words.select("item_id", "words", F.explode(starts).alias("start"))
    phrase = F.slice("words", F.col("start"), window)
    return cut.select(F.sha2(F.array_join(phrase, " "), 256).alias("phrase_id"), phrase.alias("phrase"), "item_id").distinct()


def tokens_of(docs: DataFrame) -> DataFrame:
    """The words of all documents, as ``term``."""
    # The outer form: for the inner one the optimizer adds a test of the array below, which splits texts twice.
    return docs.select(F.explode_outer(words_of(F.col("text"))).alias("word")).select(lowered(F.col("word")).alias("term"))


def blocks_of(docs: DataFrame, reach: int) -> DataFrame:
    """(doc_id, version, number, own, block): ``BLOCK`` words of a text with up to ``reach`` words on either side.

    ``version`` tells apart texts that share an id, ``own`` is how many words stand before the block's own.
    """
    words = docs.select("doc_id", F.xxhash64("text").alias("version"), words_of(F.col("text")).alias("words"))

    def cut(number: Column) -> Column:
        own = F.least(number * BLOCK, F.lit(reach))
        return F.struct(
            number.alias("number"), own.alias("own"),
            F.slice("words", number * BLOCK - own + 1, own + BLOCK + reach).alias("block"))

    numbers = F.sequence(F.lit(0), F.floor((F.size("words") - 1) / BLOCK).cast("int"))
    blocks = F.when(F.size("words") > 0, F.transform(numbers, cut))
    return words.select("doc_id", "version", F.explode_outer(blocks).alias("b")).select("doc_id", "version", "b.*")


def rarest_terms(phrases: DataFrame, docs: DataFrame) -> DataFrame:
    """(phrase_id, phrase, term, offset): phrases that can occur at all, with their rarest word over the corpus."""
    used = phrases.select("phrase_id", F.posexplode("phrase").alias("offset", "term"))
    terms = broadcast_if_small(stored(used.select("term").distinct(), "benchmark-terms"))
    counted = stored(tokens_of(docs).join(terms, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term-counts")
    ranked = used.join(counted, "term", "left").groupBy("phrase_id").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "offset")).alias("rarest"))
    return phrases.join(ranked.filter("rarest.n > 0"), "phrase_id").select("*", "rarest.term", "rarest.offset").drop("rarest")


def index(docs: DataFrame, terms: DataFrame, reach: int) -> DataFrame:
    """The stored postings of ``terms``: term, doc_id, version, position, words around, and the term's place there.

    Few terms are broadcast to the blocks. Many are joined with tokens alone, and the blocks of hits come back to them.
    """
    blocks = blocks_of(docs, reach)
    token = F.posexplode_outer(F.slice("block", F.col("own") + 1, BLOCK)).alias("nth", "word")
    small = broadcast_if_small(terms)
    if small is not terms:
        hits = blocks.select("*", token).withColumn("term", lowered(F.col("word"))).join(small, "term")
    else:
        tokens = blocks.select("doc_id", "version", "number", token).withColumn("term", lowered(F.col("word")))
        places = stored(tokens.drop("word").join(terms, "term").distinct(), "term-places")
        home = blocks.dropDuplicates(["doc_id", "version", "number"]).toDF("block_id", "block_version", "block_number", "own", "block")
        same = (F.col("doc_id").eqNullSafe(F.col("block_id")) & (F.col("version") == F.col("block_version"))
                & (F.col("number") == F.col("block_number")))
        hits = places.join(home, same)
    at = F.col("own") + F.col("nth")
    first = F.greatest(F.lit(0), at - reach)
    around = F.slice("block", first + 1, at - first + 1 + reach)
    return stored(
        hits.select(
            "term", "doc_id", "version", (F.col("number").cast("long") * BLOCK + F.col("nth")).alias("position"),
            F.transform(around, lowered).alias("around"), (at - first).alias("place")),
        "postings")


def matches(postings: DataFrame, phrases: DataFrame) -> DataFrame:
    """Where phrases stand: doc_id, version, phrase_id, start, length, exact; near ones are not exact."""
    met = postings.join(broadcast_if_small(phrases), "term")
    length = F.size("phrase")
    begin = F.col("place") - F.col("offset")
    exact = (begin >= 0) & (F.slice("around", F.greatest(begin, F.lit(0)) + 1, length) == F.col("phrase"))
    near = F.size(F.array_except("phrase", "around")) == 0
    return met.select(
        "doc_id", "version", "phrase_id", (F.col("position") - F.col("offset")).alias("start"), length.alias("length"),
        F.when(exact, True).when(near, False).alias("exact")).filter(F.col("exact").isNotNull())


def hits_of(found: DataFrame, phrase_items: DataFrame) -> DataFrame:
    """(hit_id, hit_version, n_hit, item_ids, near_item_ids) of each text with a match.

    Hit words are counted along the spans of a text in order of start, each adding what reaches past those before.
    """
    spans = found.filter("exact").select("doc_id", "version", "start", (F.col("start") + F.col("length")).alias("end")).distinct()
    before = Window.partitionBy("doc_id", "version").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    past = F.greatest("start", F.coalesce(F.max("end").over(before), F.col("start")))
    grown = spans.select("doc_id", "version", F.greatest(F.lit(0), F.col("end") - past).alias("n"), F.lit(None).cast("string").alias("item_id"),
                         F.lit(None).cast("boolean").alias("exact"))
    items = found.join(broadcast_if_small(phrase_items), "phrase_id").groupBy("doc_id", "version", "item_id").agg(F.max("exact").alias("exact"))
    both = grown.unionByName(items.withColumn("n", F.lit(0)))
    return both.groupBy(F.col("doc_id").alias("hit_id"), F.col("version").alias("hit_version")).agg(
        F.sum("n").alias("n_hit"), F.array_sort(F.collect_list(F.when(F.col("exact"), F.col("item_id")))).alias("item_ids"),
        F.array_sort(F.collect_list(F.when(~F.col("exact"), F.col("item_id")))).alias("near_item_ids"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: n_words, n_hit, n_items, items_sha256, contaminated, n_near_items,
    version, item_ids, near_item_ids; ``version`` (xxhash64 of the text) tells apart texts that share an id.

    A word is hit if it lies in an exact occurrence of a phrase of ``window`` words of an item (of all its
    words, if it has fewer). ``near_item_ids``, counted in ``n_near_items``, are the items of which only the words of
    a phrase stand close together. A null text has no words; items without id, text or words match nothing. Repeated rows give
    equal rows. Extra columns are left out; an empty table on either side gives no hit. A text may be of any
    length: what is joined are blocks of ``BLOCK`` words. Ties of rarest words go to the first in code-point order.

    Documents are read three times and not shuffled; what is shuffled are counts of benchmark words and hits.
    Tables that come from the benchmark are broadcast if their counted rows and bytes are few, else joined. A
    passage in very many documents adds one row of hits to each and no row of many.
    """
    texts = picked(docs, id_column, text_column)
    items = benchmark.select(F.col(item_column).cast("string").alias("item_id"), F.col(item_text_column).cast("string").alias("text"))
    every = stored(phrases_of(items.filter("item_id is not null"), window), "phrases")
    phrases = stored(rarest_terms(every.select("phrase_id", "phrase").distinct(), texts), "placed-phrases")
    postings = index(texts, stored(phrases.select("term").distinct(), "rare-terms"), window - 1)
    found = stored(matches(postings, phrases), "phrase-matches")
    hits = hits_of(found, stored(every.select("phrase_id", "item_id"), "phrase-items"))
    base = texts.select("doc_id", F.xxhash64("text").alias("version"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("version") == F.col("hit_version"))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    near_ids = F.coalesce("near_item_ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return base.join(hits, same, "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.size(near_ids).cast("long").alias("n_near_items"), "version", ids.alias("item_ids"), near_ids.alias("near_item_ids"))
