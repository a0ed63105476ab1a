"""From raw documents to packed training sequences: five stages, each on what the last one kept.

Every stage is a function of (spark, docs, sf_dir) that returns a DataFrame; ``run`` writes it as
Parquet and reads it again as the next one's documents. All but the last return the columns of
documents. Rows with the same key and the same text count as one document once texts are compared.
Null text reads as empty, a null key is a key like others, texts are read whole however long they
are, other columns are left out, and empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import exact, mixing, ngrams, packing, queries, rules
from sensorloom.llm.common import content, documents, written
from sensorloom.session import configure, scratch_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A mild lift of rare sources, languages and topics; nine tenths of the tokens are drawn.
POWERS = {"source": 0.9, "lang": 0.9, "topic": 0.95}
BUDGET = 0.9
#: Stands for a null key in joins.
NO_KEY = -(1 << 63)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy of quality rules."""
    return rules.passing(docs.select(*COLUMNS))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space.

    The one with the most code points, then the smallest key; of rows of one key that differ in
    white space only and are as long, the one with the smallest hash.
    """
    index = exact.DigestIndex(spark, scratch_dir(spark, "digests"))
    found = exact.dedup(docs, index).where("kept").groupBy(_key().alias("_key"), "text_sha256")
    return _kept(_marked(docs), found.agg(F.min("text_hash").alias("_hash")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: word 5-grams, similarity 0.8 or more."""
    found = ngrams.join(docs, n=5, threshold=0.8).where("stays")
    return _kept(_marked(docs), found.select(_key().alias("_key"), F.col("text_hash").alias("_hash")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics come in their target weights."""
    return mixing.drawn(docs.select(*COLUMNS), POWERS, budget=BUDGET)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids, placed in sequences of 2,048 tokens."""
    return packing.pack(docs, queries.TOKENIZER, capacity=queries.CAPACITY)


def _key():
    return F.coalesce("doc_id", F.lit(NO_KEY))


def _marked(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS, _key().alias("_key"), F.xxhash64(content()).alias("_hash"))


def _kept(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The documents that stay, once each: by their key and a hash of their text.

    Both steps are on the same columns, so the texts are shuffled once.
    """
    both = ["_key", "_hash"]
    return docs.join(kept.select(*both).distinct(), both).dropDuplicates(both).select(*COLUMNS)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pack", pack),
]

#: SQL can express neither MinHash banding nor the tokenizer; tests hold the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = documents(configure(spark), sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
