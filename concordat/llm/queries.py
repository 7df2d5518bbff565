"""One thin query for each operator: production parameters, whole tables, digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tokenizer_file(spark: SparkSession, name: str = "piece_bpe_32k.model") -> str:
    """Path of a public vocabulary file; ``concordat.tokenizers`` in the session names a folder."""
    folder = spark.conf.get("concordat.tokenizers", None)
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fuzzy_lines import line_groups

    return line_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), num=80, den=100)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import ngram_components

    return ngram_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=4, num=85, den=100)


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pieces import encode_decode

    return encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_file(spark), with_ids=False)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import held_out, score_toxicity

    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = score_toxicity(docs, labels, ~held_out(F.col("doc_id")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op5_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .private_data import scan_private

    return scan_private(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import scan_secrets

    return scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op7_sentence_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document that loses sentences: how many spans, and the spans themselves."""
    from .sentence_runs import repeated_spans

    found = repeated_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    text = F.array_join(F.zip_with("starts", "ends", lambda a, b: F.concat(a.cast("string"), F.lit(":"), b.cast("string"))), ",")
    return found.select("doc_id", F.size("starts").cast("long").alias("n_spans"), text.alias("spans"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .nearest import nearest

    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.vec_id % 100 == 0, k=10)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and item of the benchmark that it holds."""
    from .decontaminate import leaks

    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return leaks(docs, items)


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licences import scan_licences

    return scan_licences(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fuzzy_lines": op1_fuzzy_lines,
    "op2_ngram_join": op2_ngram_join,
    "op3_pieces": op3_pieces,
    "op4_toxicity": op4_toxicity,
    "op5_private_data": op5_private_data,
    "op6_secrets": op6_secrets,
    "op7_sentence_runs": op7_sentence_runs,
    "op8_nearest": op8_nearest,
    "op9_decontaminate": op9_decontaminate,
    "op10_licences": op10_licences,
}

ORACLE_SQL: dict[str, str] = {
    "op8_nearest": """
        WITH v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), d AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   list_distance(q.e, c.e) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
        ), r AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank, vec_id, score FROM d
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
