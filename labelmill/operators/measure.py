"""Token and length cost of the text forms."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMS = ("xml", "fbd", "sgd")


def whitespace_tokens(text: Column) -> Column:
    """The default token count: runs of anything but blanks and line breaks."""
    return F.regexp_count(text, F.lit(r"[^ \t\r\n]+")).cast("bigint")


def tokenizer_udf(load: Callable[[], Callable[[list[str]], list[int]]]) -> Callable[[Column], Column]:
    """Token counts from a tokenizer, Arrow-batched.

    ``load`` runs once per task and returns a function from texts to counts.
    """

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = load()
        for texts in batches:
            yield pd.Series(counter(texts.tolist()))

    return count


def token_stats(texts: DataFrame, column: str = "text", tokens: Callable[[Column], Column] = whitespace_tokens) -> DataFrame:
    """mean (1 decimal), interpolated median, max and total."""
    counted = texts.select(tokens(F.col(column)).alias("t"))
    return counted.agg(
        F.round(F.avg("t"), 1).alias("mean"),
        F.percentile("t", F.lit(0.5)).alias("p50"),
        F.max("t").alias("max"),
        F.sum("t").alias("total"),
    )


def unpivot_forms(rows: DataFrame, forms: tuple[str, ...] = FORMS) -> DataFrame:
    """One row per (row, text form)."""
    return rows.select(F.inline(F.array(*[F.struct(F.lit(f).alias("form"), F.col(f).alias("text")) for f in forms])))


def form_stats(
    rows: DataFrame, forms: tuple[str, ...] = FORMS, tokens: Callable[[Column], Column] = whitespace_tokens
) -> DataFrame:
    """Per form: rows, token mean, median, max, mean of characters. Texts become two numbers before the shuffle."""
    sized = unpivot_forms(rows, forms).select(
        "form", tokens(F.col("text")).alias("t"), F.length("text").cast("bigint").alias("chars")
    )
    return sized.groupBy("form").agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg("t"), 1).alias("tokens_mean"),
        F.percentile("t", F.lit(0.5)).alias("tokens_p50"),
        F.max("t").alias("tokens_max"),
        F.round(F.avg("chars"), 1).alias("chars_mean"),
    )


def form_ratio(stats: DataFrame, over: str = "xml", under: str = "fbd") -> DataFrame:
    """Ratio of two forms' mean tokens, 2 decimals."""

    def mean(form: str) -> Column:
        return F.max(F.when(F.col("form") == form, F.col("tokens_mean")))

    return stats.agg(F.round(mean(over) / mean(under), 2).alias("ratio"))


def form_table(candidates: DataFrame, forms: DataFrame) -> DataFrame:
    """rank1 candidates with their text forms; forms(row_key, xml, fbd, sgd, error)."""
    rank1 = candidates.filter(F.col("candidate") == "rank1").select("row_key")
    return rank1.join(forms, "row_key")


def split_round_trips(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ok rows, failures(row_key, error))."""
    return table.filter("error is null"), table.filter("error is not null").select("row_key", "error")


def round_trip_counts(table: DataFrame) -> DataFrame:
    return table.agg(
        F.count(F.lit(1)).alias("rank1_rows"), F.count_if(F.col("error").isNull()).alias("round_trip_ok")
    )


def first_failures(table: DataFrame, shown: int = 20) -> DataFrame:
    return table.filter("error is not null").select("row_key", "error").orderBy("row_key").limit(shown)
