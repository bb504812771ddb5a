"""Media archives and subjects over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.functions import tables
from labelmill.operators import media
from labelmill.plans import bindings as b
from labelmill.sources import archives, files, paths
from labelmill.sources.stage import CODEC
from labelmill.streaming import ingest


def _keyed(spark: SparkSession, sf: str) -> DataFrame:
    return media.keyed_entries(b.entries(spark, sf))


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return _keyed(spark, sf).filter("reason is null")


def _parse(spark, sf):
    return _keyed(spark, sf).select("name", "kind", "sub_id", "trial", "position", "command", "frame", "stream", "mic", "reason")


def _problems(spark, sf):
    return media.entry_problems(_keyed(spark, sf))


def _groups(spark, sf):
    return media.group_counts(_clean(spark, sf))


def _archives(spark: SparkSession, sf: str) -> DataFrame:
    """(subject, split, archive, size, sha256): two archives per supplier, some of them empty."""
    s = b.table(spark, sf, "supplier")
    key = F.col("s_suppkey")
    both = F.explode(F.array(F.lit("_io"), F.lit("_ia"))).alias("sort")
    return s.select(key.alias("subject"), both).select(
        "subject", F.lit("train").alias("split"), F.concat(F.lit("sub_"), F.col("subject").cast("string"), "sort", F.lit(".zip")).alias("archive"),
        F.when(F.col("subject") % 9 == 4, 0).otherwise(F.col("subject") * 100 + 1).alias("size"), F.lit("").alias("sha256"),
    )


def _totals(spark, sf):
    return media.manifest_totals(_groups(spark, sf), _archives(spark, sf))


def _manifest(spark, sf):
    made = media.manifest(_groups(spark, sf), _archives(spark, sf))
    flat = made.select("subject", "rows", "bytes", F.explode("archives").alias("archive", "a"))
    return flat.select(
        "subject", "rows", "bytes", "archive", F.col("a.empty").alias("empty"),
        F.array_join(F.transform(F.map_entries("a.groups"), lambda g: F.concat_ws("=", g["key"], g["value"]["rows"].cast("string"))), ",").alias("groups"),
    )


def _stills(spark, sf):
    """Stills with the numbers brought into their narrow ranges, as a stage of real subjects has them."""
    small = _clean(spark, sf).withColumn("sub_id", F.col("sub_id") % 1000)
    return media.still_relation(small).select("sub_id", "trial", "position", "frame", F.col("image.path").alias("path"), F.md5("image.bytes").alias("md5"))


def _media_paths(spark, sf):
    rebuilt = F.when(F.col("kind") == "utterance", media.media_path("wav")).otherwise(media.media_path("png"))
    return _clean(spark, sf).select(rebuilt.alias("path"), (F.substring_index("name", "/", -1) == rebuilt).alias("same")).groupBy("same").agg(F.count(F.lit(1)).alias("n"))


ACC = ["Mask", "Glasses;Hat", "None", "Scarf;Mask;Hat"]


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    c = b.table(spark, sf, "customer")
    key = F.col("c_custkey")
    acc = F.array(*[F.lit(a) for a in ACC])
    return c.select(
        key.cast("int").alias("Sub_ID"), F.get(F.array(F.lit("Train"), F.lit("Valid"), F.lit("Test"), F.lit("Trial")), F.when(key % 50 == 7, 3).otherwise((key % 3).cast("int"))).alias("Split"),
        (key % 45 + 20).cast("int").alias("Age"), F.lit("F").alias("Gender"), F.col("c_mktsegment").alias("Ethnicity"),
        F.get(acc, (key % 4).cast("int")).alias("Acc_Trial_1"), F.get(acc, (F.col("c_nationkey") % 4).cast("int")).alias("Acc_Trial_2"),
    )


def _subject_split(spark, sf):
    return media.subject_split(_archives(spark, sf).drop("split"), media.subjects(_raw(spark, sf))).select("subject", "archive", "split")


def _resume(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    targets = b.table(spark, sf, "customer").select(F.col("c_custkey").alias("subject"))
    manifests = b.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("subject"))
    return targets, manifests


def small_numbers(entries: DataFrame) -> DataFrame:
    """Entries whose microphone numbers, order keys here, are brought into their narrow range."""
    number = r"^(.*_)(\d+)\.wav$"
    small = F.concat(F.regexp_extract("name", number, 1), (F.regexp_extract("name", number, 2).try_cast("bigint") % 100).cast("string"), F.lit(".wav"))
    return entries.withColumn("name", F.when(F.col("name").rlike(number), small).otherwise(F.col("name")))


#: Entries whose archives lie on disk at a time: about 4 GB of the archives written from the line items.
ENTRIES_A_WAVE = 16_000_000


def _waves(spark: SparkSession, sf: str, entries: DataFrame, folder: str) -> Iterator[int]:
    """Entries written as archives below ``folder``, whole subjects at a time in waves of about ``ENTRIES_A_WAVE``; (number) of each.

    When the next wave is asked for, the archives are removed, and the shuffles that
    made them are given back. The rows are counted from the footers.
    """
    n = max(1, -(-b.table(spark, sf, "lineitem").count() // ENTRIES_A_WAVE))
    for k in range(n):
        paths.make(spark, folder)
        part = entries.filter(F.pmod(F.xxhash64("subject"), F.lit(n)) == k)
        archives.write_archives(part, folder).agg(F.sum("length")).collect()
        yield k
        paths.remove(spark, folder)
        paths.give_back(spark)


def _kept(spark: SparkSession, sf: str, read: Callable[[str], DataFrame]) -> DataFrame:
    """What ``read`` finds in the archives written from the line items, kept wave by wave."""
    folder, kept = paths.scratch(spark), paths.scratch(spark)
    parts = []
    for k in _waves(spark, sf, b.entries(spark, sf), folder):
        parts.append(f"{kept}/{k}")
        read(folder).write.options(**CODEC).parquet(parts[-1])
    return spark.read.parquet(*parts)


def _read_back(spark, sf):
    """Every entry of the archives written from the line items, read back in ranges."""

    def read(folder: str) -> DataFrame:
        found = archives.entry_rows(spark, folder, range_bytes=1 << 16)
        return found.select(F.substring_index("archive", "/", -1).alias("archive"), "name", "size", F.md5("bytes").alias("md5"), "problem")

    return _kept(spark, sf, read)


def _read_by_function(spark, sf):
    """The same entries from the table function, in SQL over the ranges of the files."""
    tables.register(spark)

    def read(folder: str) -> DataFrame:
        there = files.found_files(spark, folder, "*.zip").select(F.concat(F.lit(f"{folder}/"), "path").alias("path"), "length")
        return spark.sql(
            "SELECT substring_index(archive, '/', -1) AS archive, name, size, md5(bytes) AS md5, problem FROM archive_entries(TABLE(SELECT * FROM {ranges}))",
            ranges=tables.archive_ranges(there, 1 << 16),
        )

    return _kept(spark, sf, read)


def _ingested(spark, sf):
    """Archives written from the line items and converted as they come: what is refused, the groups and the manifests.

    Every fifth subject has refused entries, the files of others differ from the listing in size or hash, some have no row in the table of subjects.
    """
    keyed = media.keyed_entries(small_numbers(b.entries(spark, sf)))
    folder, out, checkpoint = paths.scratch(spark), paths.scratch(spark), paths.scratch(spark)
    key = F.col("s_suppkey")
    subjects = b.table(spark, sf, "supplier").filter(key % 13 != 6).select(key.alias("sub_id"), F.get(F.array(F.lit("train"), F.lit("test"), F.lit("evaluation")), (key % 3).cast("int")).alias("split"))
    for _ in _waves(spark, sf, keyed.filter(media.entry_problem().isNull() | (F.col("subject") % 5 == 0)), folder):
        # the listing is what lies there, with a wrong size or hash for some subjects
        there = archives.with_subject(files.found_files(spark, folder, "*.zip").select(F.col("path").alias("archive"), F.col("length").alias("size")))
        expected = there.select(
            F.col("archive").alias("path"), (F.col("size") + F.when(F.col("subject") % 7 == 3, 1).otherwise(0)).alias("size"), F.when(F.col("subject") % 11 == 5, "0").alias("sha256")
        )
        ingest.ingest(spark, folder, out, checkpoint, subjects, expected, range_bytes=1 << 16).awaitTermination()
    file = F.substring_index("archive", "/", -1).alias("archive")
    refused = spark.read.parquet(f"{out}/refused/*").select(F.lit("refused").alias("what"), file, F.coalesce("name", F.lit("")).alias("name"), "problem", F.lit(1).cast("long").alias("rows"), F.lit(0).cast("long").alias("bytes"))
    groups = spark.read.parquet(f"{out}/groups/*").select(F.lit("group"), file, media.group_name(), F.lit(""), "rows", "bytes")
    manifests = spark.read.schema("subject bigint, split string, rows bigint, bytes bigint").json(f"{out}/manifest/*").select(F.lit("manifest"), F.col("subject").cast("string"), "split", F.lit(""), "rows", "bytes")
    return refused.union(groups).union(manifests)


QUERIES = {
    "archive_read_back": _read_back,
    "archive_entries_function": _read_by_function,
    "archive_ingest": _ingested,
    "entry_parse": _parse,
    "entry_problems": _problems,
    "group_counts": _groups,
    "manifest_totals": _totals,
    "subject_manifest": _manifest,
    "still_relation": _stills,
    "media_paths": _media_paths,
    "subjects": lambda spark, sf: media.subjects(_raw(spark, sf)),
    "subject_problems": lambda spark, sf: media.subject_problems(_raw(spark, sf)),
    "accessories_1nf": lambda spark, sf: media.subject_accessories(_raw(spark, sf)),
    "subject_split": _subject_split,
    "subjects_per_split": lambda spark, sf: media.subjects_per_split(media.subjects(_raw(spark, sf))),
    "resume_antijoin": lambda spark, sf: media.remaining(*_resume(spark, sf)),
    "resume_counts": lambda spark, sf: media.resume_counts(*_resume(spark, sf)),
}


def _e(sql: str) -> str:
    return f"WITH {b.ENTRIES_SQL} {sql}"


_GROUPS = """, groups AS (
  SELECT archive, CASE sort WHEN 0 THEN 'still' WHEN 1 THEN 'cmd' ELSE 'audio' END AS relation, CASE WHEN sort = 2 THEN 0 ELSE shown END AS stream, CAST(trial AS BIGINT) AS trial,
    count(*) AS rows, CAST(sum(size) AS BIGINT) AS bytes FROM keyed WHERE reason IS NULL GROUP BY ALL),
archives AS (SELECT s_suppkey AS subject, 'sub_' || s_suppkey || k.sort || '.zip' AS archive, s_suppkey % 9 = 4 AS empty FROM supplier, (VALUES ('_io'), ('_ia')) k(sort))
"""

_RAW = """
WITH raw AS (SELECT CAST(c_custkey AS INT) AS sub_id, CASE WHEN c_custkey % 50 = 7 THEN 'Trial' ELSE ['Train', 'Valid', 'Test'][c_custkey % 3 + 1] END AS s,
  CASE WHEN c_custkey % 50 <> 7 THEN ['train', 'test', 'evaluation'][c_custkey % 3 + 1] END AS split, CAST(c_custkey % 45 + 20 AS INT) AS age, c_mktsegment AS ethnicity,
  [['Mask'], ['Glasses', 'Hat'], [], ['Scarf', 'Mask', 'Hat']][c_custkey % 4 + 1] AS a1, [['Mask'], ['Glasses', 'Hat'], [], ['Scarf', 'Mask', 'Hat']][c_nationkey % 4 + 1] AS a2 FROM customer)
"""

_BYTES = "unhex(CASE WHEN n % 61 = 0 THEN 'FFD8FF' WHEN sort = 2 THEN '52494646' ELSE '89504E470D0A1A0A' END) || encode(name)"

_SMALL = r"CASE WHEN regexp_matches(name, '_\d+\.wav$') THEN regexp_extract(name, '^(.*_)\d+\.wav$', 1) || CAST(regexp_extract(name, '_(\d+)\.wav$', 1) AS BIGINT) % 100 || '.wav' ELSE name END"

_READ_BACK = f"SELECT archive, name, octet_length({_BYTES})::BIGINT AS size, md5({_BYTES}) AS md5, CAST(NULL AS VARCHAR) AS problem FROM keyed"

_INGESTED = f""", bad AS (SELECT * REPLACE ({_SMALL} AS name), coalesce(reason, CASE WHEN sub <> subject THEN 'subject_disagrees' WHEN n % 61 = 0 THEN CASE WHEN sort = 2 THEN 'not_a_wav' ELSE 'not_a_png' END END) AS wrong FROM keyed),
written AS (SELECT * FROM bad WHERE wrong IS NULL OR subject % 5 = 0),
files AS (SELECT DISTINCT archive, subject FROM written),
refused AS (
  SELECT archive, name, coalesce(wrong, CASE WHEN subject % 13 = 6 THEN 'unknown_subject' END) AS problem FROM written WHERE wrong IS NOT NULL OR subject % 13 = 6
  UNION ALL SELECT archive, '', CASE WHEN subject % 7 = 3 THEN 'size_mismatch' ELSE 'sha_mismatch' END FROM files WHERE subject % 7 = 3 OR subject % 11 = 5),
good AS (SELECT * FROM written WHERE archive NOT IN (SELECT archive FROM refused)),
complete AS (SELECT subject FROM files GROUP BY subject HAVING NOT bool_or(archive IN (SELECT archive FROM refused)))
SELECT 'refused' AS what, archive, name, problem, 1 AS rows, 0 AS bytes FROM refused
UNION ALL SELECT 'group', archive, CASE sort WHEN 0 THEN 'still' WHEN 1 THEN 'cmd' ELSE 'audio' END || CASE WHEN sort < 2 THEN '/' || ['thermal', 'visual', 'visual_aligned'][shown] ELSE '' END || '/trial_' || trial, '', count(*), CAST(sum(size) AS BIGINT) FROM good GROUP BY ALL
UNION ALL SELECT 'manifest', CAST(subject AS VARCHAR), ['train', 'test', 'evaluation'][subject % 3 + 1], '', count(*), CAST(sum(size) AS BIGINT) FROM good WHERE subject IN (SELECT subject FROM complete) GROUP BY subject
"""

ORACLES = {
    "archive_read_back": _e(_READ_BACK),
    "archive_entries_function": _e(_READ_BACK),
    "archive_ingest": _e(_INGESTED),
    "entry_parse": _e(
        """SELECT name, CASE WHEN reason IS NULL THEN kind END AS kind, CASE WHEN reason IS NULL THEN sub END AS sub_id, CASE WHEN reason IS NULL THEN CAST(trial AS BIGINT) END AS trial,
          CASE WHEN reason IS NULL THEN CAST(pos AS BIGINT) END AS position, CASE WHEN reason IS NULL AND sort > 0 THEN command END AS command,
          CASE WHEN reason IS NULL AND sort < 2 THEN CAST(frame AS BIGINT) END AS frame, CASE WHEN reason IS NULL THEN CASE WHEN sort = 2 THEN 0 ELSE shown END END AS stream,
          CASE WHEN reason IS NULL AND sort = 2 THEN CAST(frame AS BIGINT) END AS mic, reason FROM keyed"""
    ),
    "entry_problems": _e(
        """SELECT archive, name, problem FROM (SELECT archive, name, coalesce(reason, CASE WHEN sub <> subject THEN 'subject_disagrees' WHEN n % 61 = 0 THEN CASE WHEN sort = 2 THEN 'not_a_wav' ELSE 'not_a_png' END END) AS problem FROM keyed)
        WHERE problem IS NOT NULL"""
    ),
    "group_counts": _e(_GROUPS + "SELECT * FROM groups"),
    "manifest_totals": _e(
        _GROUPS
        + """SELECT subject, count(DISTINCT a.archive) AS archives, count(DISTINCT a.archive) FILTER (empty) AS empty, count(g.archive) AS groups, CAST(coalesce(sum(rows), 0) AS BIGINT) AS rows, CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes
        FROM archives a LEFT JOIN groups g ON a.archive = g.archive GROUP BY subject"""
    ),
    "subject_manifest": _e(
        _GROUPS
        + """, per AS (SELECT archive, string_agg(g || '=' || rows, ',' ORDER BY g) AS groups FROM (SELECT archive, relation || CASE WHEN stream > 0 THEN '/' || ['thermal', 'visual', 'visual_aligned'][stream] ELSE '' END || '/trial_' || trial AS g, rows FROM groups) GROUP BY archive),
        tot AS (SELECT subject, CAST(coalesce(sum(rows), 0) AS BIGINT) AS rows, CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes FROM archives a LEFT JOIN groups g ON a.archive = g.archive GROUP BY subject)
        SELECT a.subject, t.rows, t.bytes, a.archive, a.empty, p.groups FROM archives a JOIN tot t ON a.subject = t.subject LEFT JOIN per p ON a.archive = p.archive"""
    ),
    "still_relation": _e(
        f"""SELECT CAST(sub % 1000 AS SMALLINT) AS sub_id, CAST(trial AS TINYINT) AS trial, CAST(pos AS TINYINT) AS position, CAST(frame AS INT) AS frame,
        concat_ws('_', sub % 1000, trial, 1, pos, frame, shown) || '.png' AS path, md5({_BYTES}) AS md5 FROM keyed WHERE reason IS NULL AND sort = 0"""
    ),
    "media_paths": _e("SELECT true AS same, count(*) AS n FROM keyed WHERE reason IS NULL"),
    "subjects": _RAW + "SELECT sub_id, split, age, 'F' AS gender, ethnicity FROM raw",
    "subject_problems": _RAW + "SELECT CAST(sub_id AS VARCHAR) AS subject, 'unknown split Trial' AS problem FROM raw WHERE s = 'Trial'",
    "accessories_1nf": _RAW + "SELECT sub_id, 1 AS trial, unnest(a1) AS accessory FROM raw UNION ALL SELECT sub_id, 2, unnest(a2) FROM raw",
    "subject_split": _RAW + "SELECT s_suppkey AS subject, 'sub_' || s_suppkey || k.sort || '.zip' AS archive, split FROM supplier CROSS JOIN (VALUES ('_io'), ('_ia')) k(sort) LEFT JOIN raw ON sub_id = s_suppkey",
    "subjects_per_split": _RAW + "SELECT split, count(*) AS n FROM raw GROUP BY split",
    "resume_antijoin": "SELECT c_custkey AS subject FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)",
    "resume_counts": """SELECT count(*) FILTER (c_custkey IN (SELECT s_suppkey FROM supplier)) AS skipped, count(*) FILTER (c_custkey NOT IN (SELECT s_suppkey FROM supplier)) AS remaining FROM customer""",
}
