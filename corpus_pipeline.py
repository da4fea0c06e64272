"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

1. quality: the ordinal classifier is trained on the rated documents of this
   input; documents whose probability of grade 1 or better is under a half go.
2. near_duplicates: of every group (five-word shingles, similarity 0.8 or more,
   transitively) the document of least id stays.
3. decontamination: documents that hold a benchmark item go.
4. surrogates: personal data is replaced in the texts.
5. packing: the remaining texts as sequences of at most 2048 tokens.

Null texts, empty tables, repeated rows and extra columns: as the operators'
docstrings say. A row without doc_id is kept by the second stage; of rows
that repeat a doc_id and its text one stays there, and those of other texts stay
unless they are near duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunefold.llm import decontam, neardup, packing, quality, surrogates
from tunefold.llm.common import fresh, table, written
from tunefold.llm.queries import tokenizer_path


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier selects."""
    rated = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic").withColumn("rating", quality.rating())
    return quality.select(docs, quality.train(docs, rated))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    judged = written(neardup.judged(docs, k=5, percent=80), "stage-near")
    row = [fresh("id"), fresh("hash")]
    of = judged.where("doc_id is not null").select(F.col("doc_id").alias(row[0]), F.col("text_hash").alias(row[1]), "stays")
    rows = docs.withColumns({row[0]: F.col("doc_id").cast("long"), row[1]: neardup.text_hash()})
    out = rows.join(of.where("not stays").select(*row).distinct(), row, "left_anti")
    if of.where("stays").groupBy(*row).count().where("count > 1").isEmpty():
        return out.drop(*row)
    once = out.where(F.col(row[0]).isNotNull()).dropDuplicates(row)
    return once.unionByName(out.where(F.col(row[0]).isNull())).drop(*row)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data."""
    return surrogates.replaced(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, one row per piece."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality", good),
    ("near_duplicates", distinct),
    ("decontamination", uncontaminated),
    ("surrogates", private),
    ("packing", packed),
]

#: No SQL: a trained model, MinHash, a tokenizer. tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
