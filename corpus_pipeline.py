"""A corpus from raw documents to packed training sequences, as stages over whole tables.

1. language: documents without a language go: those without text or letter, and those whose trigrams even chance explains far
   better than any mixture of the learned languages (languages.EVIDENCE). Where no row has a label, nothing is learned and every document with a letter stays.
2. near_dedup: of each group of near-duplicates (0.8, shingles of five words) one row stays, that with the smallest id (nulls last) and of those the
   smallest hash of the text.
3. decontamination: documents with a hit in at least a twentieth of their words go.
4. packing: the token ids of what is left, in sequences of 4096.

Each stage reads what the one before it wrote. Null ids are documents like others; an empty table passes through; further columns pass through unchanged,
whatever their names."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import decontaminate, languages, near_dedup, packing
from llm.common import small, stored, table, vocabulary
from tidemart.session import tune


def free(docs: DataFrame, name: str) -> str:
    """A column name that no input column has, whatever its case."""
    have = {c.lower() for c in docs.columns}
    while name.lower() in have:
        name += "_"
    return name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return languages.accepted(docs, *languages.fit(docs))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    # null ids, and rows that repeat an id, can all be the smallest of their group: the smallest text hash decides between them
    kept = near_dedup.near_duplicates(docs.select("doc_id", "text"), similarity=80).filter("kept").withColumn("id", F.coalesce("doc_id", F.lit(near_dedup.NO_ID)))
    alone = F.col("component").isNull()
    one = kept.groupBy("component", F.when(alone, F.col("id")), F.when(alone, F.col("text_key"))).agg(F.min("id").alias("id"), F.min("text_key").alias("key")).select("id", "key")
    i, k = free(docs, "pipeline_id"), free(docs, "pipeline_key")
    keyed = docs.withColumns({i: F.coalesce("doc_id", F.lit(near_dedup.NO_ID)), k: F.xxhash64("text")})
    return keyed.join(one.toDF(i, k), [i, k], "left_semi").dropDuplicates([i, k]).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    found = decontaminate.contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    k = free(docs, "pipeline_key")
    bad = stored(found.filter("contaminated").select(F.col("key").alias(k)).distinct(), "contaminated")
    return docs.join(small(bad, "16"), decontaminate.document_key(F.col("doc_id"), F.col("text")) == F.col(k), "left_anti")


#: Pieces of text that a worker remembers while packing; it shares its executor's memory with what the stages before have left there.
KEPT = 200_000


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), end_id=2, kept=KEPT)


STAGES = [("language", language), ("near_dedup", dedup), ("decontamination", decontamination), ("packing", pack)]

#: The tokenizer, the language model and MinHash are beyond SQL; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
