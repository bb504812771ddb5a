"""Gates: a DataFrame of problems, raised once, with all kinds counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBLEM_COLUMNS = ("subject", "problem")


class Refused(Exception):
    """A gate found problems; ``problems`` holds the first of them."""

    def __init__(self, message: str, problems: list[str]):
        super().__init__(message)
        self.problems = problems


def require_none(problems: DataFrame, what: str, shown: int = 20) -> None:
    """Raise when ``problems(subject, problem)`` has any row.

    The driver receives a count and at most ``shown`` lines.
    """
    first = [r["problem"] for r in problems.orderBy("subject", "problem").limit(shown).collect()]
    if first:
        total = problems.count()
        raise Refused(f"REFUSED: {what}: {total} problem(s): {'; '.join(first)}", first)


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, one scan: (position, col, nulls)."""
    totals = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    per_column = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("col"), F.col(f"n{i}").alias("nulls"))
        for i, c in enumerate(df.columns)
    ]
    return totals.select(F.inline(F.array(*per_column)))


def null_problem(relation: str) -> Column:
    return F.concat(
        F.lit(f"FAIL: {relation}."), F.col("col"), F.lit(" carries "), F.col("nulls").cast("string"),
        F.lit(" null(s); the normal form forbids them"),
    )


def null_gate(df: DataFrame, relation: str) -> DataFrame:
    """The first column, in schema order, that carries nulls: (subject, problem)."""
    return (
        null_counts(df)
        .filter("nulls > 0")
        .orderBy("position")
        .limit(1)
        .select(F.lit(relation).alias("subject"), null_problem(relation).alias("problem"))
    )


def minimum_rows(rows: DataFrame, floor: int) -> DataFrame:
    """A problem when the train split holds fewer than ``floor`` rows."""
    counted = rows.agg(F.count_if(F.col("split") == "train").alias("n"))
    return counted.filter(F.col("n") < floor).select(
        F.lit("train").alias("subject"),
        F.concat(F.col("n").cast("string"), F.lit(f" train rows, below the floor of {floor}")).alias("problem"),
    )
