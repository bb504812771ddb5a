"""Exact dedup by a content sort, in DataFrame operations only.

The rows are dealt out by range: splitters sampled from a bounded, order-keeping
key (the text's first characters and its hash) cut the key space, the shuffle's
sort spills to disk, and the window over the sorted rows compares each text in
full with its neighbour. Splitters never hold whole texts, so sampling stays
small however long a text is.

A text that holds many rows is counted first (partial counts of 8-byte hashes)
and dealt out over as many salts as it needs; the salts of such texts meet again
by SHA-256 in a table that has at most ``1 / hot_share`` texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelmill.llm.common import text_of

PREFIX_CHARS = 24
HOT_SHARE = 1e-4


def keep_one(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "min",
    normalise: Column | None = None, hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Every row with the id its group of equal texts keeps: keep_id, group_size, kept, text_sha256.

    ``keep`` is ``min`` or ``max``: which id of a group stays. ``normalise`` is the
    text that is compared (default: the text as it is). Null texts count as
    empty. Rows without an id count in group_size and are kept only if no row of
    their group has an id (keep_id is then null). Rows that repeat an id are all
    kept or all dropped. An empty table gives an empty result. Other columns,
    whatever their names, are not carried.
    """
    pick = {"min": F.min, "max": F.max}[keep]
    body = F.coalesce(normalise.cast("string"), F.lit("")) if normalise is not None else text_of(text_column)
    rows = docs.select(F.col(id_column).alias("id"), body.alias("body")).withColumn("h", F.xxhash64("body"))

    counted = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    most = F.greatest(rows.agg(F.count(F.lit(1)) * F.lit(hot_share)).scalar(), F.lit(1.0))
    # at most 1 / hot_share rows pass, whatever the size of the input
    hot = counted.withColumn("most", most).filter("n > most").select("h", F.ceil(F.col("n") / F.col("most")).alias("salts"))

    salted = rows.join(F.broadcast(hot), "h", "left").select(
        "id", "body", "h", F.substring("body", 1, PREFIX_CHARS).alias("prefix"),
        F.coalesce(F.pmod(F.xxhash64("id", F.lit(7)), F.col("salts")), F.lit(-1)).alias("salt"),
    )
    dealt = salted.repartitionByRange("prefix", "h", "salt").sortWithinPartitions("prefix", "h", "salt", "body")
    run = Window.partitionBy("prefix", "h", "salt", "body")
    runs = dealt.withColumns({"run_keep": pick("id").over(run), "run_size": F.count(F.lit(1)).over(run)}).select(
        "id", "salt", "run_keep", "run_size", F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256")
    )

    # one row per (hot text, salt), then one per hot text: bounded as ``hot`` is
    salts = rows.join(F.broadcast(hot), "h").select(
        "id", F.sha2(F.col("body").cast("binary"), 256).alias("sha"),
    )
    whole = salts.groupBy("sha").agg(pick("id").alias("all_keep"), F.count(F.lit(1)).alias("all_size"))
    met = runs.withColumn("sha", F.when(F.col("salt") >= 0, F.col("text_sha256"))).join(F.broadcast(whole), "sha", "left")
    keep_id = F.when(F.col("all_size").isNotNull(), F.col("all_keep")).otherwise(F.col("run_keep"))
    return met.select(
        F.col("id").alias(id_column), keep_id.alias("keep_id"),
        F.coalesce("all_size", "run_size").alias("group_size"), F.col("id").eqNullSafe(keep_id).alias("kept"), "text_sha256",
    )
