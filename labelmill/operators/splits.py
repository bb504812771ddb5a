"""Deterministic splits with held-out templates and block kinds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions import text as tx

# Fixed value: every tenth seed goes to test.
TEST_EVERY = 10


def split_name(
    template: Column, seed: Column, blocks: Column, holdout_templates: Iterable[str], holdout_blocks: Iterable[str]
) -> Column:
    """Held-out template or block first, then every tenth seed, else train."""
    held = tx.one_of(template, holdout_templates) | tx.overlaps(blocks, holdout_blocks)
    return F.when(held, "evaluation").when(seed % TEST_EVERY == 0, "test").otherwise("train")


def assign(
    rows: DataFrame, holdout_templates: Iterable[str] = (), holdout_blocks: Iterable[str] = ()
) -> DataFrame:
    """Add ``split``; a projection, no shuffle."""
    return rows.withColumn(
        "split", split_name(F.col("template_id"), F.col("seed"), F.col("blocks"), holdout_templates, holdout_blocks)
    )


def counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def counts_wide(rows: DataFrame) -> DataFrame:
    """One row: train_rows, test_rows, evaluation_rows."""
    return rows.agg(
        *[F.count_if(F.col("split") == s).alias(f"{s}_rows") for s in ("train", "test", "evaluation")]
    )


def template_counts(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """Rows per template, zero for a template nobody used. ``templates(template_id)`` is the registry."""
    used = rows.groupBy("template_id").agg(F.count(F.lit(1)).alias("n"))
    return templates.join(used, "template_id", "left").select(
        "template_id", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")
    )
