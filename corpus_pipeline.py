"""A corpus pipeline of five stages, each over all that the one before it kept.

``quality`` drops documents that the quality classifier rejects; ``lines`` cuts lines
that are boilerplate of their source; ``near_duplicates`` keeps one document of each
group; ``benchmark`` drops documents with a benchmark item in them; ``packing`` cuts
and packs the rest into training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaseries.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from metaseries.llm.shared import private, stash


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.7 or more; learnt from labels outside the held-out fold.

    Each row is judged by its own text; a null or empty one is scored like any other, and
    repeated ids and null ids need no care. An empty table stays empty.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), train=quality.TRAIN)


def cut_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their source's boilerplate lines; ``n_chars`` follows. All documents stay.

    Null texts stay null, texts of nothing but boilerplate become empty; rows without
    source form a source of their own.
    """
    count = private("cut")
    cut = line_dedup.dedup_lines(docs, count_col=count)
    n_chars = F.when(F.col(count) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).drop(count)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group linked at 0.8 on five-word shingles.

    Null and empty texts link with nothing and stay, as do rows without id; of rows that
    repeat a kept id with the same text one stays.
    """
    return jaccard_join.keep_one(docs, width=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found.

    Each row is judged by its own text, also where ids repeat or are null; null and
    empty texts hold no item.
    """
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens.

    A null or empty text is an end id alone; repeated rows are packed each.
    """
    return packing.pack(stash(packing.token_pieces(docs)))


STAGES = [
    ("quality", drop_low_quality),
    ("lines", cut_boilerplate),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_benchmark),
    ("packing", pack_sequences),
]

#: SQL can't express the fitted classifier, the template windows and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one returns is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stash(docs)
    return docs
