"""From documents to training sequences: five stages, each a table that the next one reads.

Every stage works on all rows its predecessor kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark.llm.common import broadcast_if_small, stored, table, with_package
from marketspark.llm.decontamination import decontaminate
from marketspark.llm.near_duplicates import near_duplicates
from marketspark.llm.packing import pack
from marketspark.llm.quality_rules import judge_documents
from marketspark.llm.queries import FEW_OWNERS, vocabulary
from marketspark.llm.secrets import redact, scan_secrets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# What tasks hand to Python at once. Ten thousand rows, the default, are tens of megabytes of texts a task outside the heap.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1_000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def stage(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``function`` with this package on the executors and small batches to Python; smaller ones of the session stay."""
    with_tasks = with_package(function)

    @functools.wraps(function)
    def call(spark: SparkSession, *arguments: object) -> DataFrame:
        for name, most in BATCHES.items():
            given = spark.conf.get(name, None)
            size = int(given) if given and given.lstrip("-").isdigit() else -1
            if not 0 < size <= most:
                spark.conf.set(name, most)
        return with_tasks(spark, *arguments)

    return call


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go from every text, and documents that the rules reject go altogether.

    A null, empty or short text is rejected; texts of any length are judged whole. Rows without id and repeated rows
    are judged like others. An empty table gives an empty result.
    """
    judged = judge_documents(docs.select(*COLUMNS)).filter("verdict.kept")
    text = F.col("verdict.cleaned")
    return judged.select("doc_id", text.alias("text"), "lang", "source", F.char_length(text).cast("long").alias("n_chars"))


@stage
def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near duplicates stays; of rows that repeat an id and text, one.

    A row without id stays, and so do texts without words, null and empty ones among them, which are like no other.
    Texts of any length are compared by their whole sets. An empty table gives an empty result.
    """
    found = stored(near_duplicates(docs).select("doc_id", "kept"), "near-duplicates")
    kept = docs.select(*COLUMNS).join(broadcast_if_small(stored(found.filter(~F.col("kept")).select("doc_id").distinct(), "copies")), "doc_id", "left_anti")
    repeated = stored(found.filter("kept and doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated-ids")
    if repeated.isEmpty():
        return kept
    repeated = broadcast_if_small(repeated)
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, "doc_id", "left_anti").unionByName(once)


@stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go; near matches alone leave a document in.

    Rows without id and repeated rows are told by their texts. Null and empty texts hold no passage, and texts of
    any length are searched whole. An empty table on either side lets everything stay.
    """
    found = decontaminate(docs, table(spark, sf_dir, "benchmark")).filter("contaminated")
    leaks = stored(found.select(F.col("doc_id").alias("leak_id"), F.col("version").alias("leak_version")).distinct(), "leaks")
    same = F.col("doc_id").eqNullSafe(F.col("leak_id")) & (F.xxhash64("text") == F.col("leak_version"))
    return docs.select(*COLUMNS).join(broadcast_if_small(leaks), same, "left_anti")


@stage
def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are taken out of texts: every named format, and opaque strings that look live.

    Ownership is judged as in op6. Null and empty texts stay, rows without id and repeated rows are treated like
    others, texts of any length are rewritten whole, and an empty table gives an empty result.
    """
    docs = docs.select(*COLUMNS)
    found = scan_secrets(docs, max_owners=FEW_OWNERS, by_text=True)
    return redact(docs, found).withColumn("n_chars", F.char_length("text").cast("long"))


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens, with their ids.

    A null or empty text is an end id alone, a text of any length is cut over as many sequences as it needs, and
    rows without id and repeated rows are packed like others. An empty table packs to nothing.
    """
    return pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicate_groups),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("packing", packing),
]

# Packing counts tokens of a vocabulary, which SQL cannot; the tests hold the rows against brute force.
ORACLE_SQL = None


@with_package
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
