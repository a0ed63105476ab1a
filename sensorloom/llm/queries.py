"""The operators applied to the whole given tables, as queries with fixed results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import clusters, exact, langid, licenses, mixing, ngrams, packing, repeats, rules, spelling, tokens, toxicity, voting
from sensorloom.llm.common import documents, hashed_share, written
from sensorloom.session import configure, scratch_dir

LABELS = "doc_id long, quality int, toxic int"
QUALITY_BOUND = 0.7
VECTORS = "vec_id long, embedding array<float>"
CLUSTERS, CLUSTER_ROUNDS = 8, 10
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
CAPACITY = 2048
TOKEN_LIMIT = 512


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(configure(spark), sf_dir)
    pieces = packing.cut(docs, TOKENIZER, capacity=CAPACITY)
    # The digest instead of the ids: only it is needed from here on.
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place(written(pieces, "pieces"), capacity=CAPACITY)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(configure(spark), sf_dir)
    return langid.identify(docs, held_out=hashed_share(F.col("doc_id"), 4) == 2)


#: How much the query lifts rare levels of each margin, and the share of tokens that it draws.
POWERS = {"source": 0.7, "lang": 0.8, "topic": 0.9}
BUDGET, ROUNDS, SEED = 0.5, 12, "mix"


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(configure(spark), sf_dir)
    mixed = mixing.mix(docs, POWERS, budget=BUDGET, rounds=ROUNDS, seed=SEED)
    return mixed.withColumn("probability", F.round("probability", 6))


def op4_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(configure(spark), sf_dir)
    index = exact.DigestIndex(spark, scratch_dir(spark, "digests"))
    return exact.dedup(docs, index).drop("known", "text_hash")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(documents(configure(spark), sf_dir))
    return found.select(
        "doc_id",
        F.array_join("sentence_ids", " ").alias("sentence_ids"),
        F.array_join("line_ids", " ").alias("line_ids"),
        F.array_join("licences", ",").alias("licences"),
        F.size("licences").cast("long").alias("n_licences"),
    )


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngrams.join(documents(configure(spark), sf_dir), n=5, threshold=0.8)
    return found.drop("stays", "text_hash")


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.ledger(documents(configure(spark), sf_dir))
    base = rules.mask(rules.BASE)
    return rows.select(
        "*",
        (F.col("failures").bitwiseAND(F.lit(base).cast("long")) != 0).alias("base_failed"),
        rules.verdict(F.col("failures")).alias("kept"),
    )


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(configure(spark), sf_dir)
    counts = tokens.count_tokens(docs, TOKENIZER, scratch_dir(spark, "token-counts"))
    return counts.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = repeats.remove(documents(configure(spark), sf_dir), length=100)
    return made.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(configure(spark), sf_dir)
    labels = spark.read.schema(LABELS).parquet(f"{sf_dir}/labels.parquet")
    made = toxicity.classify(docs, labels, held_out=hashed_share(F.col("doc_id"), 5) == 0)
    return made.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(configure(spark), sf_dir)
    labels = spark.read.schema(LABELS).parquet(f"{sf_dir}/labels.parquet")
    made = voting.rate(docs, labels, held_out=hashed_share(F.col("doc_id"), 4) == 2)
    return made.withColumn("predicted", (F.col("score") >= QUALITY_BOUND).cast("int"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = configure(spark).read.schema(VECTORS).parquet(f"{sf_dir}/embeddings.parquet")
    return clusters.cluster(vectors, count=CLUSTERS, rounds=CLUSTER_ROUNDS, dimension=64, scale=1024, seed="3")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(configure(spark), sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_language": op2_language,
    "op3_mixing": op3_mixing,
    "op4_exact": op4_exact,
    "op5_licenses": op5_licenses,
    "op6_ngram_join": op6_ngram_join,
    "op7_rules": op7_rules,
    "op8_tokens": op8_tokens,
    "op9_repeats": op9_repeats,
    "op10_toxicity": op10_toxicity,
    "op11_quality": op11_quality,
    "op12_clusters": op12_clusters,
    "op13_spelling": op13_spelling,
}
