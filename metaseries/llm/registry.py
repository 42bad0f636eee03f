"""The corpus operators' queries and SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, exact_dedup, fill_middle, hyper_minhash, jaccard_join, language_id, line_dedup, lm_score, packing, quality, token_files, turn_repair, url_rules


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_rules.RULES, url_rules.RULE_SCHEMA)
    return url_rules.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": language_id.query,
        "op2_packing": packing.query,
        "op3_exact_dedup": op3,
        "op4_token_counts": token_files.query,
        "op5_jaccard_join": jaccard_join.query,
        "op6_line_dedup": line_dedup.query,
        "op7_decontamination": decontaminate.query,
        "op8_quality": quality.query,
        "op9_lm_scores": lm_score.query,
        "op10_url_filters": op10,
        "op11_fill_in_middle": fill_middle.query,
        "op12_turn_repair": turn_repair.query,
        "op13_hyper_minhash": hyper_minhash.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": exact_dedup.SQL, "op6_line_dedup": line_dedup.SQL, "op10_url_filters": url_rules.SQL, "op11_fill_in_middle": fill_middle.SQL}
