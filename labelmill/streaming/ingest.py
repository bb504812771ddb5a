"""Incremental conversion of media archives: read in ranges, verified, refused or converted, with a manifest a subject.

The archive stream keeps its own list of the archives it has given out, in the
checkpoint, so a restarted run reads only those it has not committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labelmill.operators import media, repair
from labelmill.sources import archives, files, paths, zips
from labelmill.sources.stage import CODEC

#: States of an archive that are named in its subject's manifest and refuse nothing.
EMPTY = ("empty_archive", "no_entries")


def entry_stream(spark: SparkSession, base: str, log: str, range_bytes: int = zips.RANGE_BYTES) -> DataFrame:
    """Entries of archives as they arrive, with their subject and the key of their name."""
    spark.dataSource.register(zips.ZipEntries)
    rows = spark.readStream.format("zip_entries").option("log", log).option("rangeBytes", range_bytes).load(base)
    return media.keyed_entries(archives.with_subject(rows))


def verified(listed: DataFrame, expected: DataFrame | None) -> DataFrame:
    """Archives (path, size) -> (archive, size, sha256, problem), each hashed as it lies in the store.

    ``expected`` (path, size, sha256) is matched by the end of the path. A size that
    differs is said before a hash that does; an archive that is not listed, or listed
    without a hash, passes.
    """
    got = files.sums(listed.repartition("path"))
    if expected is None:
        return got.select(F.col("path").alias("archive"), "size", "sha256", F.lit(None).cast("string").alias("problem"))
    file = F.substring_index("path", "/", -1)
    told = repair.verify_files(expected.withColumn("path", file), got.withColumn("path", file))
    wrong = told.filter(F.col("status").endswith("_mismatch")).select(F.col("path").alias("file"), F.col("status").alias("problem"))
    return got.withColumn("file", file).join(wrong, "file", "left").select(F.col("path").alias("archive"), "size", "sha256", "problem")


def convert(batch: DataFrame, out: str, part: str, subjects: DataFrame, expected: DataFrame | None = None) -> None:
    """Entries of whole archives -> media, groups, manifest and refused below ``out``, each in the folder ``part``.

    An entry is refused for what the reader, its name, its subject's archive or its
    bytes say, or because ``subjects`` (sub_id, split) does not list the subject. An
    archive with a refused entry, or one that is not what ``expected`` says, gives no
    media, and its subject no manifest. The entries are written once beside the
    results while their archives are judged, then removed.
    """
    spark = batch.sparkSession
    splits = subjects.select(F.col("sub_id").alias("subject"), "split")
    pending = f"{out}/_pending/{part}"
    batch.join(splits, "subject", "left").write.mode("overwrite").options(**CODEC).parquet(pending)
    keyed = spark.read.parquet(pending)
    found = keyed.groupBy(F.col("archive").alias("path")).agg(F.max("archive_size").alias("size"), F.max("subject").alias("subject"), F.max("split").alias("split"))
    checks = f"{out}/archives/{part}"
    verified(found.select("path", "size"), expected).join(found.select(F.col("path").alias("archive"), "subject", "split"), "archive").write.mode("overwrite").parquet(checks)
    checked = spark.read.parquet(checks)

    unlisted = F.when(F.col("split").isNull(), "unknown_subject")
    read = F.when(~F.col("problem").isin(*EMPTY), F.col("problem"))
    of_bytes = F.when(F.col("problem").isNull(), media.entry_problem())
    judged = keyed.select("archive", "name", F.coalesce(read, of_bytes, unlisted).alias("problem")).filter("problem is not null")
    whole = checked.filter("problem is not null").select("archive", F.lit(None).cast("string").alias("name"), "problem")
    judged.unionByName(whole).write.mode("overwrite").parquet(f"{out}/refused/{part}")

    bad = spark.read.parquet(f"{out}/refused/{part}").select("archive").distinct()
    clean = keyed.filter("problem is null").join(bad, "archive", "left_anti")
    archives.write_media(clean, f"{out}/media/{part}", "overwrite")
    media.group_counts(clean).write.mode("overwrite").parquet(f"{out}/groups/{part}")
    failed = checked.join(bad, "archive").select("subject").distinct()
    complete = checked.filter("split is not null").join(failed, "subject", "left_anti")
    media.manifest(spark.read.parquet(f"{out}/groups/{part}"), complete).write.mode("overwrite").json(f"{out}/manifest/{part}")
    paths.remove(spark, pending)


def ingest(
    spark: SparkSession, base: str, out: str, checkpoint: str, subjects: DataFrame, expected: DataFrame | None = None, range_bytes: int = zips.RANGE_BYTES
) -> StreamingQuery:
    """Convert every archive not yet converted, of any size, then stop.

    A micro-batch is overwritten by its own id when it is retried, so a batch lost
    half-way is written once. No archive is left out: what is not converted is in
    ``refused``, empty archives are in the manifest.
    """
    return (
        entry_stream(spark, base, f"{checkpoint}/archives", range_bytes)
        .writeStream.foreachBatch(lambda batch, batch_id: convert(batch, out, f"batch={batch_id}", subjects, expected))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
