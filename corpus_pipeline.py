"""The corpus pipeline: five stages over documents, each one operator of ``concordat.llm``.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the
columns of documents; the last one returns the ids of the pieces. ``run`` writes each stage's rows
as Parquet under the session's checkpoint folder and reads them again for the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.llm.common import checkpoint_folder, cut, free_name, remove_folder
from concordat.llm.decontaminate import decontaminated
from concordat.llm.fuzzy_lines import dedup_lines
from concordat.llm.ngram_join import ngram_components
from concordat.llm.pieces import encode_decode
from concordat.llm.queries import tokenizer_file
from concordat.llm.toxicity import held_out, score_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the others go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = {c: f"__kept{n}" for n, c in enumerate(docs.columns)}  # columns of any name, "score" too
    rows = docs.select("doc_id", "text", *[docs[c].alias(k) for c, k in kept.items()])
    scored = score_toxicity(rows, labels, ~held_out(F.col("doc_id")), keep=tuple(kept.values()))
    return scored.where("score < 0.5").select(*[F.col(k).alias(c) for c, k in kept.items()])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with one line of each connected group; n_chars follows the text."""
    out = dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group: shingles of five words, Jaccard 0.8 or more.

    Each row without a doc_id is a document of its own, after all others: it stays unless its group
    has a document with an id, or an earlier one without.
    """
    row = free_name(docs, "__row")
    number = (F.lit(1 << 62) + F.monotonically_increasing_id()).alias(row)
    nameless = cut(docs.where("doc_id is null").select("*", number))  # numbered once
    rows = docs.where("doc_id is not null").select("*", F.col("doc_id").cast("long").alias(row)).unionAll(nameless)
    groups = ngram_components(rows, doc_id=row, n=5, num=80, den=100)
    kept = groups.where("doc_id = component_id").select(F.col("doc_id").alias(row)).distinct()
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no item of the benchmark."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, number of ids and the ids of each text."""
    return encode_decode(docs, tokenizer_file(spark), keep=("doc_id", "source", "lang")).drop("decoded")


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pieces", pieces),
]

#: SQL can't express the learned scorer, the encoder and the similarity joins.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again. What a stage has read goes when
    its own rows are written; the last ones stay, for the result is read from them."""
    folder, was = f"{checkpoint_folder(spark)}/corpus-{uuid.uuid4().hex}", None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (name, stage) in enumerate(STAGES):
        here = f"{folder}/{n}-{name}"
        stage(spark, docs, sf_dir).write.parquet(here)
        docs = spark.read.parquet(here)
        if was:
            remove_folder(spark, was)
        was = here
    return docs
