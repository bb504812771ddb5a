"""The corpus census and its hold-out gates.

``rows`` throughout: (split, family, template_id, frame_id, blocks array), one
row per root row. Everything is a narrow projection followed by partial
aggregation; no group is collected.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions import programs as pg
from labelmill.functions import text as tx


def reference_kinds(candidates: DataFrame) -> DataFrame:
    """Block kinds of each rank1 program: (row_key, blocks).

    The filter and the three columns reach the parquet scan, and the texts are
    parsed where they are read.
    """
    rank1 = candidates.filter(F.col("candidate") == "rank1")
    return rank1.select("row_key", pg.block_kinds(pg.kind_source(F.col("fbd_text"), F.col("fbd_xml"))).alias("blocks"))


def census_rows(root: DataFrame, candidates: DataFrame, family: Column, split: Column) -> DataFrame:
    """Root and candidates of a split -> census rows.

    Only keys and kinds are shuffled, never texts. A root row without a rank1
    candidate is kept and flagged ``missing``. There is a key per row, and keys
    in order compress so well that their file looks small enough to broadcast:
    the hint keeps them out of the driver.
    """
    kinds = reference_kinds(candidates).hint("merge")
    return root.join(kinds, F.col("key") == F.col("row_key"), "left").select(
        split.alias("split"),
        family.alias("family"),
        "template_id",
        "seed",
        F.coalesce(F.col("frame_id").cast("bigint"), F.lit(0)).alias("frame_id"),
        F.coalesce(kinds["blocks"], F.array().cast("array<string>")).alias("blocks"),
        F.col("row_key").isNull().alias("missing"),
        "key",
    )


def _train(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("split") == "train")


def tally_families(rows: DataFrame) -> DataFrame:
    return _train(rows).groupBy("family").agg(F.count(F.lit(1)).alias("n"))


def tally_templates(rows: DataFrame) -> DataFrame:
    return _train(rows).groupBy("template_id").agg(F.count(F.lit(1)).alias("n"))


def frame_label() -> Column:
    return F.concat_ws("#", "template_id", F.col("frame_id").cast("string"))


def tally_frames(rows: DataFrame) -> DataFrame:
    return _train(rows).groupBy(frame_label().alias("frame")).agg(F.count(F.lit(1)).alias("n"))


def tally_block_kinds(rows: DataFrame) -> DataFrame:
    """Rows using each kind: a kind counts once per row, before anything is shuffled."""
    kinds = _train(rows).select(F.explode(F.array_distinct("blocks")).alias("kind"))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def length_histogram(rows: DataFrame) -> DataFrame:
    """Rows per program length; repeats of a kind count."""
    return _train(rows).groupBy(F.size("blocks").alias("length")).agg(F.count(F.lit(1)).alias("n"))


def kinds_present(rows: DataFrame) -> DataFrame:
    return tally_block_kinds(rows).agg(F.count(F.lit(1)).alias("kinds"))


def most_common_kind(rows: DataFrame) -> DataFrame:
    """The top kind; a tie goes to the first by name."""
    return tally_block_kinds(rows).orderBy(F.desc("n"), "kind").limit(1)


def report(rows: DataFrame) -> DataFrame:
    """Every tally of the census as one tidy table (axis, value, n), from one scan.

    Each row turns into its (axis, value) pairs; the pairs are counted map-side,
    so what is shuffled is one record per distinct pair and task.
    """

    def pair(axis: str, value: Column) -> Column:
        return F.struct(F.lit(axis).alias("axis"), value.cast("string").alias("value"))

    train_pairs = F.concat(
        F.array(
            pair("families", F.col("family")),
            pair("templates", F.col("template_id")),
            pair("frames", frame_label()),
            pair("length_histogram", F.size("blocks")),
        ),
        F.transform(F.array_distinct("blocks"), lambda k: pair("block_kinds", k)),
    )
    split_pair = F.array(pair("rows", F.col("split")))
    pairs = F.when(F.col("split") == "train", F.concat(split_pair, train_pairs)).otherwise(split_pair)
    return rows.select(F.inline(pairs)).groupBy("axis", "value").agg(F.count(F.lit(1)).alias("n"))


def leaked_blocks(rows: DataFrame, holdout_blocks: Iterable[str]) -> DataFrame:
    """Held-out kinds found in training rows."""
    wanted = F.array(*[F.lit(b) for b in holdout_blocks]).cast("array<string>")
    hits = _train(rows).select(F.explode(F.array_intersect("blocks", wanted)).alias("kind"))
    return hits.distinct()


def leaked_templates(rows: DataFrame, holdout_templates: Iterable[str]) -> DataFrame:
    """Held-out templates found in training rows."""
    return _train(rows).filter(tx.one_of(F.col("template_id"), holdout_templates)).select("template_id").distinct()


def empty_axes(rows: DataFrame, holdout_blocks: Iterable[str]) -> DataFrame:
    """Held-out kinds no evaluation row exercises; an empty axis would read as a pass."""
    wanted = F.array(*[F.lit(b) for b in holdout_blocks]).cast("array<string>")
    seen = (
        rows.filter(F.col("split") == "evaluation")
        .select(F.explode(F.array_intersect("blocks", wanted)).alias("kind"))
        .distinct()
    )
    declared = rows.sparkSession.createDataFrame([(b,) for b in sorted(set(holdout_blocks))], "kind string")
    return declared.join(seen, "kind", "left_anti")


def missing_reference(rows: DataFrame) -> DataFrame:
    """Root rows without a rank1 candidate."""
    return rows.filter("missing").select("key")


def problems(
    rows: DataFrame, holdout_templates: Iterable[str] = (), holdout_blocks: Iterable[str] = ()
) -> DataFrame:
    """Every reason the census refuses: (subject, problem)."""
    leaks = leaked_blocks(rows, holdout_blocks).select(
        F.col("kind").alias("subject"),
        F.concat(F.lit("held-out block kind "), "kind", F.lit(" leaked into training")).alias("problem"),
    )
    families = leaked_templates(rows, holdout_templates).select(
        F.col("template_id").alias("subject"),
        F.concat(F.lit("held-out family "), "template_id", F.lit(" leaked into training")).alias("problem"),
    )
    empty = empty_axes(rows, holdout_blocks).select(
        F.col("kind").alias("subject"),
        F.concat(
            F.lit("held-out block kind "), "kind", F.lit(" appears in no holdout row either; the axis is empty")
        ).alias("problem"),
    )
    absent = missing_reference(rows).select(
        F.col("key").alias("subject"),
        F.concat(F.lit("root row "), "key", F.lit(" has no rank1 candidate")).alias("problem"),
    )
    return families.unionByName(leaks).unionByName(empty).unionByName(absent)


def planted_leak(rows: DataFrame) -> DataFrame:
    """Declare the most common training kind held out: what the census must then refuse."""
    top = most_common_kind(rows).select("kind")
    hits = _train(rows).select(F.explode(F.array_distinct("blocks")).alias("kind"))
    return hits.join(F.broadcast(top), "kind", "left_semi").groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
