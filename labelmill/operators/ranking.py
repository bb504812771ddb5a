"""Ordered work over groups of any size.

A window over a whole group puts the group in one task, and one group may hold a
third of the rows. These operators take a ``chunk`` column instead: any value
that never decreases along the group's order (an hour of the timestamp, the tick
divided by some thousands). Rows meet in one task per (group, chunk); what
crosses a chunk boundary is carried through a table with one row per chunk.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelmill.operators import ordering

TICKS_PER_CHUNK = 4096
REGISTRY_ROWS = 100_000


def _before(keys: Sequence[str], chunk: str):
    return Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)


def positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], chunk: str, name: str = "tick", start: int = 0
) -> DataFrame:
    """Number the rows of each group in order, as ``row_number`` would."""
    keys = list(keys)
    sizes = df.groupBy(*keys, chunk).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        *keys, chunk, F.coalesce(F.sum("_n").over(_before(keys, chunk)), F.lit(0)).alias("_offset")
    )
    local = Window.partitionBy(*keys, chunk).orderBy(*order)
    numbered = df.join(offsets, [*keys, chunk])
    at = F.col("_offset") + F.row_number().over(local) - 1 + start
    return numbered.withColumn(name, at).drop("_offset")


def last_seen(
    df: DataFrame, keys: Sequence[str], tick: str, chunk: str, flag: Column, name: str
) -> DataFrame:
    """The latest tick, this row's included, at which ``flag`` held; null when it never has."""
    keys = list(keys)
    marked = df.withColumn("_hit", F.when(flag, F.col(tick)))
    per_chunk = marked.groupBy(*keys, chunk).agg(F.max("_hit").alias("_chunk_hit"))
    carried = per_chunk.select(*keys, chunk, F.max("_chunk_hit").over(_before(keys, chunk)).alias("_carried"))
    local = (
        Window.partitionBy(*keys, chunk).orderBy(tick).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        marked.join(carried, [*keys, chunk])
        .withColumn(name, F.coalesce(F.max("_hit").over(local), F.col("_carried")))
        .drop("_hit", "_carried")
    )


def previous(df: DataFrame, keys: Sequence[str], tick: str, chunk: str, value: Column, name: str) -> DataFrame:
    """``lag`` by one row; null on the group's first row."""
    keys = list(keys)
    valued = df.withColumn("_value", value)
    last = valued.groupBy(*keys, chunk).agg(F.max_by("_value", tick).alias("_last"))
    over_chunks = Window.partitionBy(*keys).orderBy(chunk)
    carried = last.select(*keys, chunk, F.lag("_last").over(over_chunks).alias("_carried"))
    local = Window.partitionBy(*keys, chunk).orderBy(tick)
    first = F.row_number().over(local) == 1
    return (
        valued.join(carried, [*keys, chunk])
        .withColumn(name, F.when(first, F.col("_carried")).otherwise(F.lag("_value").over(local)))
        .drop("_value", "_carried")
    )


def scan(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], chunk: str, position: str | None = None, size: str | None = None,
    previous: Mapping[str, Column] | None = None, hits: Mapping[str, Column] | None = None, edges: Mapping[str, Column] | None = None, tick: str | None = None,
) -> DataFrame:
    """Everything ordered about a group in one pass: the rows meet once on (group, chunk), a state a chunk is carried on.

    Adds ``position`` (from 0) and ``size`` (rows of the group); for each entry of
    ``previous`` the value one row before, null on the first row; for each of ``hits``
    where the flag last held, this row included, and for each of ``edges`` where it last
    began to hold, null before the first time. "Where" is the position, or the value of
    ``tick``, which grows along the order. A null flag does not hold. Rows of a null
    key are a group like any other.

    A chunk's state is its count, its last values, its first and last flags and its last
    hits; two states that follow each other give one, which is what the windows over the
    chunks add up. The plan has one exchange of rows and two of states.
    """
    keys = list(keys)
    previous, hits = dict(previous or {}), {n: F.coalesce(c, F.lit(False)) for n, c in (hits or {}).items()}
    edges = {n: F.coalesce(c, F.lit(False)) for n, c in (edges or {}).items()}
    local = Window.partitionBy(*keys, chunk).orderBy(*order)
    so_far = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumn("_i", F.row_number().over(local) - 1)
    where = F.col(tick) if tick else F.col("_i")
    for name, value in previous.items():
        rows = rows.withColumns({f"_v_{name}": value, f"_p_{name}": F.lag(value).over(local)})
    for name, flag in hits.items():
        rows = rows.withColumn(f"_h_{name}", F.max(F.when(flag, where)).over(so_far))
    for name, flag in edges.items():
        rows = rows.withColumn(f"_f_{name}", flag).withColumn(f"_b_{name}", F.lag(f"_f_{name}").over(local))
        rows = rows.withColumn(f"_e_{name}", F.max(F.when(F.col(f"_f_{name}") & ~F.col(f"_b_{name}"), where)).over(so_far))

    state = [F.count(F.lit(1)).alias("_n"), F.min(where).alias("_start")]
    state += [F.max_by(f"_v_{n}", "_i").alias(f"_v_{n}") for n in previous] + [F.max(f"_h_{n}").alias(f"_h_{n}") for n in hits]
    for n in edges:
        state += [F.max(f"_e_{n}").alias(f"_e_{n}"), F.min_by(f"_f_{n}", "_i").alias(f"_first_{n}"), F.max_by(f"_f_{n}", "_i").alias(f"_last_{n}")]
    states = rows.groupBy(*keys, chunk).agg(*state)

    before, follows = _before(keys, chunk), Window.partitionBy(*keys).orderBy(chunk)
    states = states.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    base = F.lit(0) if tick else F.col("_offset")
    carried = {"_offset": F.col("_offset")}
    if size:
        states = states.withColumn("_size", F.sum("_n").over(Window.partitionBy(*keys)))
        carried["_size"] = F.col("_size")
    for n in previous:
        states = states.withColumn(f"_cv_{n}", F.lag(f"_v_{n}").over(follows))
        carried[f"_cv_{n}"] = F.col(f"_cv_{n}")
    for n in hits:
        states = states.withColumn(f"_ch_{n}", F.max(F.col(f"_h_{n}") + base).over(before))
        carried[f"_ch_{n}"] = F.col(f"_ch_{n}")
    for n in edges:
        begins = F.col(f"_first_{n}") & ~F.coalesce(F.lag(f"_last_{n}").over(follows), F.lit(False))
        states = states.withColumn(f"_cb_{n}", F.when(begins, F.col("_start") + base))
        states = states.withColumn(f"_ce_{n}", F.max(F.coalesce(F.col(f"_e_{n}") + base, F.col(f"_cb_{n}"))).over(before))
        carried |= {f"_cb_{n}": F.col(f"_cb_{n}"), f"_ce_{n}": F.col(f"_ce_{n}")}

    named = states.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, chunk])], *[c.alias(n) for n, c in carried.items()])
    same = [rows[k].eqNullSafe(named[f"_k{i}"]) for i, k in enumerate([*keys, chunk])]
    met = rows.join(named, functools.reduce(operator.and_, same))
    added = {}
    if position:
        added[position] = F.col("_offset") + F.col("_i")
    if size:
        added[size] = F.col("_size")
    added |= {n: F.when(F.col("_i") == 0, F.col(f"_cv_{n}")).otherwise(F.col(f"_p_{n}")) for n in previous}
    added |= {n: F.coalesce(F.col(f"_h_{n}") + base, F.col(f"_ch_{n}")) for n in hits}
    added |= {n: F.coalesce(F.col(f"_e_{n}") + base, F.col(f"_cb_{n}"), F.col(f"_ce_{n}")) for n in edges}
    return met.select(*[F.col(f"`{c}`") for c in df.columns if c not in added], *[c.alias(n) for n, c in added.items()])


def cut_by_count(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "chunk", rows: int = TICKS_PER_CHUNK) -> DataFrame:
    """Add a chunk for ``scan`` that holds at most so many rows, whatever the groups and their values are.

    The rows are numbered in the order of all groups, so a group of any size, or one
    whose rows all carry the same hour, is as many chunks as it has to be.
    """
    at = f"_{name}_at"
    return ordering.numbered(df, *keys, *order, name=at).withColumn(name, F.floor(F.col(at) / rows)).drop(at)


def earlier_min(keys: Sequence[str], chunk: str, value: str) -> Column:
    """Over a table with one row per chunk: the least value of the chunks before this one."""
    return F.min(value).over(_before(list(keys), chunk))


def registry(df: DataFrame, rows: int) -> DataFrame:
    """A registry whose size was taken, broadcast while it is one; beyond that the join stays a shuffle."""
    return F.broadcast(df) if rows <= REGISTRY_ROWS else df


def tick_chunk(tick: str, width: int = TICKS_PER_CHUNK) -> Column:
    return F.floor(F.col(tick) / width).cast("bigint")
