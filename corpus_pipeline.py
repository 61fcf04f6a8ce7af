"""Corpus preparation: toxic documents go, boilerplate lines go, near copies go, documents with benchmark passages go, the rest is packed.

Every stage takes all that its predecessor kept, from a written table. All but the last keep the
columns of ``documents``; where lines were dropped, ``n_chars`` is counted again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm import decontaminate, linededup, minhash, packing, toxicity
from pulse.llm.arrow import table
from pulse.llm.queries import vocabulary
from pulse.settle import settle


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose expected severity reaches the limit; the model is fitted to the labels of these documents."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With the lines dropped that a tenth of a source's documents share."""
    done = linededup.drop_lines(docs, F.col("source"))
    made = {"text": F.col("text"), "n_chars": F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("page.n_chars"))}
    return done.select([made[c].alias(c) if c in made else F.col("page").getField(c).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by a similarity of 0.8 over five words."""
    return minhash.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold ten consecutive words of a benchmark item."""
    return decontaminate.keep_unseen(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 4096 ids."""
    return packing.pack(docs, *vocabulary())


STAGES = [
    ("toxicity", toxic_documents),
    ("line_dedup", boilerplate_lines),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_passages),
    ("packing", packed),
]

#: The model, the buckets and the vocabulary have no SQL; the tests follow the stages one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in a folder; each stage's result is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
