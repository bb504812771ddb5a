"""Two controllers in one program."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelmill.functions import programs as pg
from labelmill.functions import text as tx

#: Programs that are Python objects at a time.
PROGRAMS = 64

# The input declarations every controller shares, and the pairs
# composed, chosen with disjoint outputs.
SHARED_INPUTS = "in lx : REAL\nin ly : REAL\nin btn : BOOL\nin tracker_ok : BOOL\n"
PAIRS = [
    ("walk_from_stick", "tracker_lost_freezes"),
    ("face_the_stick", "button_sequence_then_idle"),
    ("speed_limited_run", "face_the_stick"),
    ("walk_from_stick", "button_sequence_then_idle"),
    ("tracker_lost_freezes", "button_sequence_then_idle"),
]


@F.arrow_udf(T.ArrayType(T.StringType()))
def _prefixed(lines: pa.Array, names: pa.Array, prefix: pa.Array) -> pa.Array:
    """Whole identifiers found in ``names`` get the prefix, in one pass over each line.

    A set lookup per identifier; the built-in array lookups scan the names. Of a
    batch only ``PROGRAMS`` programs are Python objects at a time, the rest stays in Arrow's buffers.
    """
    word = re.compile(r"\w+")

    def one(ls, ns, p):
        if ls is None:
            return None
        known = set(ns or ())
        return [line if line is None else word.sub(lambda m: p + m[0] if m[0] in known else m[0], line) for line in ls]

    parts = []
    for first in range(0, len(lines), PROGRAMS):
        some = (column.slice(first, PROGRAMS).to_pylist() for column in (lines, names, prefix))
        parts.append(pa.array([one(*row) for row in zip(*some)], pa.list_(pa.string())))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))


def _classed(lines: Column) -> Column:
    """Lines with their class, so each is classified once."""
    return F.transform(lines, lambda line: F.struct(pg.line_class(line).alias("c"), line.alias("l")))


def _section(classed: Column, name: str) -> Column:
    return F.transform(F.filter(classed, lambda e: e["c"] == name), lambda e: e["l"])


def own_names(lines: Column) -> Column:
    """Block and local names of a program."""

    def names(classed: Column) -> Column:
        blocks = F.transform(_section(classed, "block"), lambda line: F.substring_index(line, " = ", 1))
        local = F.transform(_section(classed, "var"), lambda line: F.get(F.split(line, " "), 1))
        return F.concat(blocks, local)

    return tx.let(_classed(lines), names)


def prefixed_lines(text: Column, prefix: str) -> Column:
    lines = tx.lines_of(text)
    return _prefixed(lines, own_names(lines), F.lit(prefix))


def _outputs(text: Column) -> Column:
    return F.filter(tx.lines_of(text), lambda line: F.startswith(line, F.lit("out ")))


def merge(a: Column, b: Column, name: Column, inputs: str = SHARED_INPUTS) -> Column:
    """One program from two: outputs, locals, blocks and writes, a's before b's in each section.

    Names of blocks and locals are prefixed ``a_`` and ``b_``; declared outputs
    are not, since the pairs do not share any.
    """

    def sections(both: Column) -> Column:
        inner = [_section(both[side], section) for section in ("var", "block", "write") for side in ("a", "b")]
        return F.array_join(F.concat(_outputs(a), _outputs(b), *inner), "\n")

    both = F.struct(_classed(prefixed_lines(a, "a_")).alias("a"), _classed(prefixed_lines(b, "b_")).alias("b"))
    return F.concat(F.lit("program "), name, F.lit("\n" + inputs), tx.let(both, sections), F.lit("\n"))


def pair_rows(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of two templates that share a seed, per template pair.

    rows(template_id, seed, …), pairs(pair, a_id, b_id): the pair table is a
    registry and broadcast; a row goes to the pairs its template is in and the
    two sides meet in one aggregation on (pair, seed), so the rows are read and
    built once. With ``pair`` among the rows' columns a row goes to that pair only.
    """
    others = [c for c in rows.columns if c not in ("template_id", "seed", "pair")]
    sides = pairs.select("*", F.explode(F.array("a_id", "b_id")).alias("template_id")).distinct()
    keys = ["template_id", "pair"] if "pair" in rows.columns else ["template_id"]
    placed = rows.join(F.broadcast(sides), keys)

    def side(name: str, column: str) -> Column:
        # a slot a column, so that a column nobody reads is neither built nor shuffled; the struct keeps a null one
        return F.any_value(F.when(F.col("template_id") == F.col(f"{name}_id"), F.struct(column)), ignoreNulls=True).alias(f"{name}_{column}")

    sided = [side(name, c) for name in "ab" for c in [*others, "template_id"]]
    met = placed.groupBy("pair", "a_id", "b_id", "seed").agg(*sided)
    return met.filter("a_template_id is not null and b_template_id is not null").select(
        "pair", "a_id", "b_id", "seed", *[F.col(f"{name}_{c}")[c].alias(f"{name}_{c}") for name in "ab" for c in others]
    )


def compose(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Composite rows: rows(template_id, seed, intent, frame_id, rank1, rank3, rank5, traces).

    rank3 takes a's mutant with b's reference, rank5 a's reference with b's
    refused form; the traces are a's.
    """
    met = pair_rows(rows, pairs)
    name = F.concat_ws("_", F.lit("compose"), "a_id", "b_id")

    def part(a: str, b: str) -> Column:
        return merge(F.col(f"a_{a}"), F.col(f"b_{b}"), name)

    return met.select(
        name.alias("template_id"),
        "seed",
        F.concat("a_intent", F.lit("; and "), "b_intent").alias("intent"),
        F.col("a_frame_id").alias("frame_id"),
        part("rank1", "rank1").alias("rank1"),
        part("rank3", "rank1").alias("rank3"),
        part("rank1", "rank5").alias("rank5"),
        F.col("a_traces").alias("traces"),
    )
