"""The registered queries of this subpackage, each over its whole table, with SQL where SQL can state it."""

from __future__ import annotations

import json
from collections.abc import Callable
from secrets import token_hex

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark.llm import (
    archives, centroid_clusters, chat_formats, decontamination, near_duplicates, oracles, packing, quality_rules, repeated_strings, secrets, sharding,
    spelling_variants, surrogates, token_counts,
)
from marketspark.llm.common import table, with_package

Query = Callable[[SparkSession, str], DataFrame]

# A value is a copied example if more owners than this hold it in texts that are no copies of one another.
FEW_OWNERS = 4
# The setting that holds the key of surrogates. Without it each run has a random key, which nobody can go back by.
SURROGATE_KEY = "spark.marketspark.surrogateKey"

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = with_package(function)
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


@query("op1_line_first_cleaning")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_documents(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return judged.select("doc_id", "verdict.*").drop("cleaned")


@query("op2_radix_suffix_dedup", oracles.REPEATED_STRINGS)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_strings.repeated_strings(table(spark, sf_dir, "documents"), threshold=50)


@query("op3_concatenate_and_cut")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return pieces.drop("ids")


@query("op4_positional_index", oracles.DECONTAMINATION)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("near_items", F.array_join("near_item_ids", ",")).drop("item_ids", "near_item_ids", "version")


@query("op5_bbit_minhash", oracles.NEAR_DUPLICATES)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, percent=85)


@query("op6_secret_ownership")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"), max_owners=FEW_OWNERS, by_text=True)


@query("op7_keyed_surrogates")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(SURROGATE_KEY, None) or token_hex(32)
    return surrogates.replace_personal_data(table(spark, sf_dir, "documents"), key=key)


@query("op8_best_fit_shards")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=16)


@query("op9_gzip_normaliser", oracles.ARCHIVES)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.archive_pages(table(spark, sf_dir, "pages"))


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op11_schema_fingerprints", oracles.CONVERSATIONS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"}).alias("record"))
    messages = {"messages": [{"role": role, "content": oracles.MARKS_IN_TEXT} for role in ("user", "assistant")]}
    planted = spark.createDataFrame([(-7, json.dumps(messages))], "conv_id long, record string")
    turns = chat_formats.canonical_turns(rows.unionByName(planted))
    return chat_formats.read_back(chat_formats.format_conversations(turns), in_order=True)


@query("op12_asymmetric_chunks")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"), garble=31)


@query("op13_walsh_hadamard_clusters", oracles.clusters(clusters=16, rounds=3))
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.cluster_vectors(table(spark, sf_dir, "embeddings")).drop("centroid")
