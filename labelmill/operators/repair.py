"""Joining artefacts back into a stage and deriving what is missing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions import text as tx

ARTEFACTS = ("fbd_text", "fbd_xml", "plan_json", "result_json")


def backfill(candidates: DataFrame, artefacts: DataFrame) -> DataFrame:
    """Candidates with their artefacts joined back; a missing one is the empty string.

    artefacts(template_id, seed, candidate, fbd_text, fbd_xml, plan_json,
    result_json). Old artefact columns are dropped before the join, so only keys
    and the new texts are shuffled.
    """
    keyed = candidates.drop(*ARTEFACTS, "fbd_path").select(
        "*", tx.key_template(F.col("row_key")).alias("template_id"), tx.key_seed(F.col("row_key")).alias("seed")
    )
    joined = keyed.join(artefacts, ["template_id", "seed", "candidate"], "left")
    path = F.concat_ws("/", F.lit("rows"), "template_id", F.col("seed").cast("string"), "candidate")
    filled = [F.coalesce(name, F.lit("")).alias(name) for name in ARTEFACTS]
    kept = [c for c in keyed.columns if c not in ("template_id", "seed")]
    return joined.select(*kept, *filled, path.alias("fbd_path"))


def backfill_missing(backfilled: DataFrame) -> DataFrame:
    """Candidates left with neither text nor XML."""
    return backfilled.filter((F.col("fbd_text") == "") & (F.col("fbd_xml") == "")).select("row_key", "candidate")


def sha_mismatch(backfilled: DataFrame) -> DataFrame:
    """Text that does not hash to its recorded sha, where both are there."""
    held = (F.col("fbd_text") != "") & (F.coalesce("fbd_sha", F.lit("")) != "")
    return backfilled.filter(held & (F.sha2("fbd_text", 256) != F.col("fbd_sha"))).select("row_key", "candidate")


def backfill_traces(root: DataFrame, traces: DataFrame) -> DataFrame:
    """Root rows with their traces; traces(template_id, seed, traces array). None is an empty array."""
    empty = F.array().cast("array<string>")
    return (
        root.drop("traces")
        .join(traces, ["template_id", "seed"], "left")
        .withColumn("traces", F.coalesce("traces", empty))
    )


def derive_memoised(
    rows: DataFrame, source: str, target: str, derive: Callable[[Column], Column]
) -> DataFrame:
    """Fill an empty ``target`` from ``source``, deriving once per distinct source text.

    ``derive`` maps a column to a column; it may be a pandas UDF around a costly
    converter. Rows that need nothing keep out of the join: only they would
    share its null key. The join key is the text's sha256, and distinct inputs
    are combined map-side, so copies shared by many rows cost one call and one
    row; a hot key on the big side is split by AQE, the other side being unique.
    A refused input leaves the empty string.
    """
    needs = (F.col(target) == "") & (F.col(source) != "")
    keyed = rows.withColumn("_key", F.sha2(source, 256))
    distinct = (
        keyed.filter(needs)
        .groupBy("_key")
        .agg(F.any_value(source).alias("_source"))
        .select("_key", F.coalesce(derive(F.col("_source")), F.lit("")).alias("_derived"))
    )
    wanting = keyed.filter(needs).join(distinct, "_key").withColumn(target, F.col("_derived"))
    kept = keyed.filter(~needs)
    columns = rows.columns
    return (
        wanting.select(*columns, F.when(F.col("_derived") != "", "derived").otherwise("refused").alias("outcome"))
        .unionByName(kept.select(*columns, F.lit("kept").alias("outcome")))
    )


def derive_counts(derived: DataFrame) -> DataFrame:
    """Derived and refused, counted per occurrence: one row."""
    return derived.agg(
        F.count_if(F.col("outcome") == "derived").alias("derived"),
        F.count_if(F.col("outcome") == "refused").alias("refused"),
    )


def verify_files(listing: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected listing(path, size, sha256) against actual(path, size, sha256).

    One status per path: empty (listed with size 0), missing, unlisted,
    size_mismatch before sha_mismatch, ok. An unknown sha passes.
    """
    want = listing.select("path", F.col("size").alias("want_size"), F.col("sha256").alias("want_sha"))
    got = actual.select("path", F.col("size").alias("got_size"), F.col("sha256").alias("got_sha"))
    status = (
        F.when(F.col("want_size") == 0, "empty")
        .when(F.col("got_size").isNull(), "missing")
        .when(F.col("want_size").isNull(), "unlisted")
        .when(F.col("want_size") != F.col("got_size"), "size_mismatch")
        .when(F.col("want_sha").isNotNull() & (F.col("want_sha") != F.col("got_sha")), "sha_mismatch")
        .otherwise("ok")
    )
    return want.join(got, "path", "full").select("path", status.alias("status"))
