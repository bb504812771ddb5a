"""Label controls: what the three candidates of a row must show."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.operators import relations


def verdicts(scores: DataFrame) -> DataFrame:
    """One row per row_key with the flags the controls read; three map-side slots each."""

    def flag(name: str, column: str):
        return F.bool_and(F.when(F.col("candidate") == name, F.col(column)))

    def either(name: str, column: str):
        return F.bool_or(F.when(F.col("candidate") == name, F.col(column)))

    identity = F.bool_and(
        F.when(F.col("candidate") == "rank1", F.col("compiles") & F.col("runs") & F.col("effect_matches"))
    )
    return scores.groupBy("row_key").agg(
        identity.alias("identity"),
        flag("rank3", "compiles").alias("rank3_compiles"),
        either("rank3", "effect_matches").alias("rank3_matches"),
        either("rank5", "compiles").alias("rank5_compiles"),
    )


def assert_controls(scores: DataFrame) -> DataFrame:
    """Rows that break a control, the first control they break: (row_key, control).

    A missing candidate breaks the control that reads it.
    """
    control = (
        F.when(~F.coalesce("identity", F.lit(False)), "identity")
        .when(~F.coalesce("rank3_compiles", F.lit(False)) | F.coalesce("rank3_matches", F.lit(True)), "effect")
        .when(F.coalesce("rank5_compiles", F.lit(True)), "negative")
    )
    return verdicts(scores).select("row_key", control.alias("control")).filter("control is not null")


def control_problems(scores: DataFrame) -> DataFrame:
    """The broken controls as gate problems."""
    return assert_controls(scores).select(
        F.col("row_key").alias("subject"),
        F.concat(F.col("control"), F.lit(" control failed on "), F.col("row_key")).alias("problem"),
    )


def planted_negative(scores: DataFrame) -> DataFrame:
    """Hand the refused candidate's verdict to rank1; the controls must refuse every row."""
    planted = {
        name: F.when(F.col("candidate") == "rank1", F.lit(False)).otherwise(F.col(name))
        for name in ("parses", "compiles", "runs", "effect_matches")
    }
    return scores.withColumns(planted)


def wanted_scores(rows: DataFrame) -> DataFrame:
    """The score relation that the controls want of in-flight rows: rank1 right, rank3 running but wrong, rank5 refused."""
    yes, no, zero = F.lit(True), F.lit(False), F.lit(0).cast("bigint")

    def verdict(name: str, compiles: Column, effect: Column, refusal: str) -> Column:
        return F.struct(
            F.lit(name).alias("candidate"), compiles.alias("parses"), compiles.alias("compiles"), compiles.alias("runs"), effect.alias("effect_matches"),
            zero.alias("steps"), zero.alias("wall_ms"), F.lit(refusal).alias("refusal"),
        )

    entries = F.array(verdict("rank1", yes, yes, ""), verdict("rank3", yes, no, ""), verdict("rank5", no, no, "refused"))
    return relations.score_rows(rows.withColumn("scores", entries))
