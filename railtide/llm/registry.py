"""The registered queries of this folder, each with equivalent SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from railtide.llm import (
    align, decontaminate, infill, linkgraph, lmscore, mixing, packing, quality, repeats, shards, simhash, spotsigs, tokens,
)
from railtide.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, build, *tables: str, sql: str | None = None) -> None:
    """``build`` takes the tables in order and returns the result."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return build(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables))

    QUERIES[name] = run
    if sql is not None:
        SQL[name] = sql


register("op1_spotsigs", spotsigs.op1, "documents", sql=spotsigs.OP1_SQL)
register("op2_decontaminate", decontaminate.op2, "documents", "benchmark", sql=decontaminate.OP2_SQL)
register("op3_suffix_dedup", repeats.op3, "documents")
register("op4_shards", shards.op4, "documents")
register("op5_quality", quality.op5, "documents", "labels")
register("op6_lm_score", lmscore.op6, "documents", "labels")
register("op7_mixing", mixing.op7, "documents", sql=mixing.OP7_SQL)
register("op8_url_filter", linkgraph.op8, "pages", sql=linkgraph.OP8_SQL)
register("op9_token_counts", tokens.op9, "documents")
register("op10_simhash", simhash.op10, "documents")
register("op11_fill_in_middle", infill.op11, "documents", sql=infill.OP11_SQL)
register("op12_align", align.op12, "documents")
register("op13_packing", packing.op13, "documents")
QUERIES["pipeline"] = corpus_pipeline.run
