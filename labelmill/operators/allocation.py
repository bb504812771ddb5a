"""Schedules: which template gets which seeds.

The template dimension is a registry: some tens of rows. The windows here have
no partition and run over that dimension alone; rows are generated from it in
pieces, so a template holding most of the seeds is still many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelmill.operators import ranking

SEEDS_PER_PIECE = 100_000
BLOCK = 10


def schedule_blocks(seeds: DataFrame, templates: DataFrame) -> DataFrame:
    """Seed i takes template (i div 10) mod n. seeds(seed), templates(ord, template_id) with ord from 0.

    ``spark.range(rows)`` renamed to ``seed`` gives a whole schedule.
    """
    n = templates.count()
    at = F.floor(F.col("seed") / BLOCK) % n
    registry = ranking.registry(templates.select(F.col("ord").cast("int").alias("ord"), "template_id"), n)
    return seeds.withColumn("ord", at.cast("int")).join(registry, "ord").select("template_id", "seed")


def capacity(spaces: DataFrame) -> DataFrame:
    return spaces.agg(F.sum("space").alias("space"))


def capacity_problem(spaces: DataFrame, rows: int) -> DataFrame:
    """A problem when the templates cannot produce as many distinct rows as asked."""
    return capacity(spaces).filter(F.coalesce("space", F.lit(0)) < rows).select(
        F.lit("allocation").alias("subject"),
        F.concat(F.lit("space "), F.coalesce("space", F.lit(0)).cast("string"), F.lit(f" is below the {rows} rows asked for")).alias("problem"),
    )


def allocate(spaces: DataFrame, rows: int) -> DataFrame:
    """spaces(ord, template_id, space) -> (ord, template_id, n), n summing to ``rows``.

    Each template first gets min(space, rows div templates). The remainder is
    dealt one at a time, in order, to templates with room; that is filling their
    spare space to a common level and giving the rest to the first in order. The
    level is found on the spare spaces sorted ascending: where i templates are
    full, the others share what is left equally.
    """
    everyone = Window.partitionBy()
    first = spaces.select(
        "ord", "template_id", F.col("space").cast("bigint").alias("space"),
        F.floor(F.lit(rows) / F.count(F.lit(1)).over(everyone)).cast("bigint").alias("_quota"),
    ).withColumn("_given", F.least("space", "_quota"))
    spare = first.withColumn("_spare", F.col("space") - F.col("_given")).withColumn(
        "_left", F.lit(rows) - F.sum("_given").over(everyone)
    )
    rising = Window.orderBy("_spare", "ord")
    ranked = (
        spare.withColumn("_below", F.coalesce(F.sum("_spare").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_sharing", F.count(F.lit(1)).over(everyone) - F.row_number().over(rising) + 1)
        .withColumn("_share", F.floor((F.col("_left") - F.col("_below")) / F.col("_sharing")).cast("bigint"))
    )
    level = F.coalesce(
        F.min(F.when(F.col("_share") < F.col("_spare"), F.struct("_spare", "ord", "_share"))).over(everyone)["_share"],
        F.max("_spare").over(everyone),
    )
    levelled = ranked.withColumn("_level", level).withColumn("_filled", F.least("_spare", "_level"))
    rest = F.col("_left") - F.sum("_filled").over(everyone)
    has_room = (F.col("_spare") > F.col("_level")).cast("bigint")
    turn = F.sum(has_room).over(Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        levelled.withColumn("_rest", rest)
        .withColumn("_turn", turn)
        .withColumn("_one", F.when((has_room == 1) & (F.col("_turn") <= F.col("_rest")), 1).otherwise(0))
        .select("ord", "template_id", (F.col("_given") + F.col("_filled") + F.col("_one")).alias("n"))
    )


def seed_ranges(counts: DataFrame) -> DataFrame:
    """Consecutive seed ranges in template order: (ord, template_id, n, first_seed)."""
    earlier = Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        "ord", "template_id", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("bigint").alias("first_seed")
    )


def jobs(ranges: DataFrame, per_piece: int = SEEDS_PER_PIECE) -> DataFrame:
    """Seed ranges -> one row per seed, a large range cut into pieces spread over tasks."""
    pieces = ranges.filter("n > 0").select(
        "template_id", "first_seed", "n",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / per_piece).cast("bigint"))).alias("piece"),
    )
    start = F.col("first_seed") + F.col("piece") * per_piece
    stop = F.least(start + per_piece, F.col("first_seed") + F.col("n")) - 1
    return pieces.repartition("template_id", "piece").select("template_id", F.explode(F.sequence(start, stop)).alias("seed"))
