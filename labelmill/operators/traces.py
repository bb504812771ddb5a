"""Comparing time-series outputs and computing what a trace must show.

A trace is (row_key, trace, tick, inputs…); an output is (row_key, candidate,
trace, tick, name, num, flag, str) with exactly one value column set. A trace
may be of any length: everything ordered goes through ``ranking`` in chunks of
ticks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelmill import schemas
from labelmill.functions import numeric as nm
from labelmill.operators import ordering, ranking

REFERENCE = "rank1"


def ticks_of(traces: DataFrame, text: str = "trace_json") -> DataFrame:
    """Trace JSON -> one row per tick: (…, dt, tick, at, values map); time is tick times dt."""
    parsed = traces.withColumn("_t", F.from_json(text, schemas.TRACE_TICKS))
    kept = [c for c in traces.columns if c != text]
    return parsed.select(*kept, F.col("_t.dt").alias("dt"), F.posexplode("_t.ticks").alias("tick", "values")).withColumn(
        "at", F.col("tick") * F.col("dt")
    )


def trace_differences(outputs: DataFrame, tolerance: float = nm.SIGNAL_TOLERANCE) -> DataFrame:
    """Per candidate: whether its outputs equal the reference's, and at how many points they differ.

    Candidates meet the reference in one aggregation on the point (row, trace,
    tick, name), so no join can be skewed by a busy row; a point only one side
    has is a difference, which covers tick counts and key sets.
    """
    point = ["row_key", "trace", "tick", "name"]
    packed = outputs.withColumn("v", F.struct("num", "flag", "str"))
    slots = packed.groupBy(*point).agg(
        *[
            F.any_value(F.when(F.col("candidate") == name, F.col("v")), ignoreNulls=True).alias(name)
            for name, _ in schemas.RANKS
        ]
    )
    others = [name for name, _ in schemas.RANKS]
    compared = slots.select(
        *point,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("candidate"),
                        F.col(name).isNotNull().alias("present"),
                        same_value(F.col(name), F.col(REFERENCE), tolerance).alias("same"),
                    )
                    for name in others
                ]
            )
        ),
    )
    return (
        compared.groupBy("row_key", "candidate")
        .agg(
            F.bool_and("same").alias("effect_matches"),
            F.count_if(~F.col("same")).alias("differences"),
            F.bool_or("present").alias("ran"),
        )
        .filter("ran")
        .drop("ran")
    )


def same_value(a: Column, b: Column, tolerance: float) -> Column:
    """Strings equal, booleans by truth, numbers within the tolerance; absent on one side is different."""

    def truth(v: Column) -> Column:
        return F.coalesce(v["flag"], v["num"] != 0)

    either_text = a["str"].isNotNull() | b["str"].isNotNull()
    either_flag = a["flag"].isNotNull() | b["flag"].isNotNull()
    same = (
        F.when(a.isNull() | b.isNull(), F.lit(False))
        .when(either_text, a["str"].eqNullSafe(b["str"]))
        .when(either_flag, truth(a) == truth(b))
        .otherwise(nm.within(a["num"], b["num"], tolerance))
    )
    return F.coalesce(same, F.lit(False))


def reference_matches(outputs: DataFrame, reference: DataFrame) -> DataFrame:
    """Tick by tick against a recorded return: outputs(row_key, candidate, trace, tick, num, flag),
    reference(row_key, trace, tick, ret text) -> (row_key, candidate, effect_matches).

    The candidates' values are packed per point, so the reference is joined once
    on (row, trace, tick); a tick only one side has is a mismatch.
    """
    point = ["row_key", "trace", "tick"]
    packed = outputs.select(*point, "candidate", F.struct("num", "flag").alias("v")).groupBy(*point).agg(
        *[
            F.any_value(F.when(F.col("candidate") == name, F.col("v")), ignoreNulls=True).alias(name)
            for name, _ in schemas.RANKS
        ]
    )
    joined = packed.join(reference.select(*point, "ret"), point, "full")

    def matches(v: Column) -> Column:
        shown = F.when(v["flag"], "true").otherwise("false")
        ok = F.when(v["flag"].isNotNull(), shown == F.col("ret")).otherwise(nm.close_reference(v["num"], F.col("ret")))
        return F.coalesce(v.isNotNull() & ok, F.lit(False))

    entries = [
        F.struct(F.lit(n).alias("candidate"), F.col(n).isNotNull().alias("present"), matches(F.col(n)).alias("same"))
        for n, _ in schemas.RANKS
    ]
    return (
        joined.select("row_key", F.inline(F.array(*entries)))
        .groupBy("row_key", "candidate")
        .agg(F.bool_and("same").alias("effect_matches"), F.bool_or("present").alias("ran"))
        .filter("ran")
        .drop("ran")
    )


def _seen(traces: DataFrame, keys: list[str], tick: str, chunk: str, order: list[str] | None, **flags: dict[str, Column]) -> DataFrame:
    """One scan; where the ticks are not there yet, ``order`` says what they follow and ``tick`` what they are called."""
    if order:
        return ranking.scan(traces, keys, order, chunk, position=tick, **flags)
    return ranking.scan(traces, keys, [tick], chunk, tick=tick, **flags)


def on_delay(traces: DataFrame, keys: list[str], tick: str, chunk: str, ok: Column, n: Column, order: list[str] | None = None) -> DataFrame:
    """``frozen`` from the n-th consecutive tick without ``ok`` on. With ``order`` the ticks are numbered in the same pass."""
    seen = _seen(traces, keys, tick, chunk, order, hits={"_last_ok": ok})
    frozen = F.col(tick) - F.coalesce("_last_ok", F.lit(-1)) >= n
    return seen.withColumn("frozen", frozen).drop("_last_ok")


def press_hold(
    traces: DataFrame, keys: list[str], tick: str, chunk: str, pressed: Column, n: Column, style: Column, order: list[str] | None = None
) -> DataFrame:
    """``style`` on the rising edge's tick and the n - 1 after it, else 0. With ``order`` the ticks are numbered in the same pass."""
    seen = _seen(traces, keys, tick, chunk, order, edges={"_edge": pressed})
    held = F.coalesce(F.col(tick) - F.col("_edge") < n, F.lit(False))
    return seen.withColumn("style", F.when(held, style).otherwise(F.lit(0))).drop("_edge")


def _with_stop(steps: DataFrame, keys: list[str], step: str, code: str, chunk: str) -> DataFrame:
    """Add ``_stop``: a failing step at or before this chunk, the first one where there are several.

    Minima per chunk and a carry over the chunks find it, and rows meet it on
    (group, chunk), so a group of any length is many tasks.
    """
    local = steps.groupBy(*keys, chunk).agg(F.min(F.when(F.col(code) != 0, F.col(step))).alias("_local"))
    stops = local.select(*keys, chunk, F.coalesce(ranking.earlier_min(keys, chunk, "_local"), F.col("_local")).alias("_stop"))
    return steps.join(stops, [*keys, chunk])


def steps_until_failure(steps: DataFrame, keys: list[str], step: str, code: str, chunk: str) -> DataFrame:
    """Per group: steps completed before the first failing one, and whether all ran.

    ``chunk`` never decreases with ``step`` (see ``ranking``).
    """
    marked = _with_stop(steps, keys, step, code, chunk)
    return marked.groupBy(*keys).agg(
        F.count_if(F.col("_stop").isNull() | (F.col(step) < F.col("_stop"))).alias("steps"),
        F.bool_and(F.col("_stop").isNull()).alias("runs"),
    )


def performed_steps(steps: DataFrame, keys: list[str], step: str, code: str, chunk: str) -> DataFrame:
    """The steps actually performed: up to and including the first failing one."""
    marked = _with_stop(steps, keys, step, code, chunk)
    return marked.filter(F.col("_stop").isNull() | (F.col(step) <= F.col("_stop"))).drop("_stop")


def pick_traces(rows: DataFrame, names: DataFrame, picks: int = 3, stride: int = 5) -> DataFrame:
    """Trace names for each row: (seed + stride * i) mod n over the name-sorted list.

    ``names(name)`` is the library of traces, a registry whose size is taken first.
    """
    n = names.count()
    if n <= ranking.REGISTRY_ROWS:
        numbered = names.select("name", (F.row_number().over(Window.orderBy("name")) - 1).cast("bigint").alias("_at"))
    else:
        numbered = ordering.numbered(names.select("name"), "name", name="_at")
    wanted = rows.withColumn("pick", F.explode(F.sequence(F.lit(0), F.lit(picks - 1)))).withColumn(
        "_at", F.pmod(F.col("seed") + F.col("pick") * stride, F.lit(max(n, 1))).cast("bigint")
    )
    return wanted.join(ranking.registry(numbered, n), "_at").drop("_at")
