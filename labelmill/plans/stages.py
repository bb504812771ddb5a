"""Sources and sinks over the driver's tables: what is written is read back, from a shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill import schemas
from labelmill.operators import audit, media, mutations, relations, splits
from labelmill.operators.families import registry
from labelmill.plans import archives as archive_plans
from labelmill.plans import bindings as b
from labelmill.plans import audits, corpus
from labelmill.sources import archives, files, paths, snapshots, stage


def _versions(spark: SparkSession, sf: str) -> DataFrame:
    """A stage of the documents' programs in two versions: the second fills the texts from what the first one holds.

    A third commit that read the first version is refused, so the last version is the second.
    """
    base = paths.scratch(spark)
    root, candidates = b.document_stage(spark, sf)
    snapshots.commit(spark, base, {"root": root, "candidates": candidates}, 0)
    schema = candidates.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    held = snapshots.read(spark, base, "candidates", schema, 1)
    snapshots.commit(spark, base, {"candidates": held.withColumn("fbd_text", F.when(F.col("fbd_text") == "", F.col("fbd_xml")).otherwise(F.col("fbd_text")))}, 1)
    try:
        snapshots.commit(spark, base, {"candidates": held.limit(0)}, 1)
    except snapshots.Conflict:
        pass
    else:
        raise AssertionError("a commit over a version that is gone went through")
    last = snapshots.snapshot(spark, base)
    parts = [
        snapshots.read(spark, base, "candidates", schema, v).select(
            F.lit(v).alias("version"), (F.lit(v) == last.version).alias("is_last"), F.lit(last.relations["root"]["rows"]).alias("roots"), "row_key", "candidate", F.md5("fbd_text").alias("md5")
        )
        for v in snapshots.versions(spark, base)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


HELD_TEMPLATES = ["write", "face_the_stick", "godot_ui_text", "udon_blend", "trainer_rom"]


def _family_inputs(spark: SparkSession, sf: str, rows: int) -> dict[str, DataFrame]:
    """Programs for the families that take them: the documents' own, and a translation of every method that is asked for."""
    p = b.programs(spark, sf)
    # a program of calls alone has nothing to mutate; where no block has an opposite, what only passes a value on inverts it, so that one has
    decided = F.col("text").rlike(rf"(?m)^\w+ = ({'|'.join(mutations.OPPOSITE)})\(")
    text = F.when(decided, F.col("text")).otherwise(F.replace("text", F.lit(" = MOVE("), F.lit(" = NOT(")))
    named = p.filter(F.col("text").rlike(r" = [A-Z_]+\(")).select(F.concat(F.lit("and_"), F.col("doc_id").cast("string")).alias("name"), text.alias("text"))
    marked = F.replace("text", F.lit("in a : BOOL"), F.lit("in trigger : BOOL"))
    canonical = p.groupBy((F.col("doc_id") % 10).cast("int").alias("goal")).agg(F.min_by(marked, F.struct(F.length("text"), "doc_id")).alias("text"))
    text = F.concat(F.lit("program u\nr = ADD(IN1=a, IN2="), F.col("seed").cast("string"), F.lit(")\nret = r.OUT\n"))
    translated = registry.jobs(spark, "udon", min(rows, registry.capacity("udon"))).select(
        "template_id", "seed", text.alias("rank1"), F.replace(text, F.lit("ADD"), F.lit("SUB")).alias("rank3"), F.replace(text, F.lit("IN1=a"), F.lit("IN1=zz")).alias("rank5")
    )
    return {"base": named, "canonical": canonical, "translated": translated}


def _family_rows(spark: SparkSession, sf: str) -> int:
    """As many rows of each family as there are suppliers, at least one a template of the fixed ones: one number, read by the driver."""
    return b.table(spark, sf, "supplier").count() + 30


def _families(spark: SparkSession, sf: str) -> DataFrame:
    """Eight families allocated, made, split and written as one stage, read back: rows per family, split and relation.

    A family whose templates cannot give as many rows as are asked for gives all it can.
    """
    n = _family_rows(spark, sf)
    out, inputs = paths.scratch(spark), _family_inputs(spark, sf, n)
    wanted = {family: min(n, registry.capacity(family, inputs)) for family in registry.FAMILIES}
    registry.build(spark, out, wanted, inputs, holdout_templates=HELD_TEMPLATES)
    parts = []
    for split, folder in schemas.SPLIT_DIRS.items():
        tables = stage.read_split(spark, out, "corpus", folder)
        for relation, key in (("root", "key"), ("candidates", "row_key"), ("scores", "row_key"), ("joined", "key")):
            parts.append(tables[relation].groupBy(F.substring_index(key, "/", 1).alias("family")).agg(F.count(F.lit(1)).alias("n")).select("family", F.lit(split).alias("split"), F.lit(relation).alias("relation"), "n"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _artefact_folder(spark: SparkSession, sf: str) -> str:
    """Text files of the documents' programs, with traces, in a new folder: ``template/seed/candidate.suffix``."""
    folder = paths.scratch(spark)
    p = b.programs(spark, sf)
    base = F.concat_ws("/", "template_id", F.col("seed").cast("string"))
    trace = F.concat(F.lit('{"dt": 0.125, "ticks": [], "seed": '), F.col("seed").cast("string"), F.lit("}"))
    entries = F.array(
        F.struct(F.concat(base, F.lit("/rank1.fbd")).alias("path"), F.col("text").alias("text")),
        F.struct(F.concat(base, F.when(F.col("seed") % 5 == 0, "/notes.txt").otherwise("/rank1.plcopen.xml")).alias("path"), F.col("xml").alias("text")),
        F.struct(F.concat(base, F.lit("/trace_1.json")).alias("path"), trace.alias("text")),
        F.struct(F.concat(base, F.lit("/trace_0.json")).alias("path"), F.concat(trace, F.lit("\n")).alias("text")),
    )
    files.write_texts(p.select(F.inline(entries)), folder).agg(F.sum("size")).collect()
    return folder


def _artefacts(spark: SparkSession, sf: str) -> DataFrame:
    """Artefact files read back beside the traces of their rows."""
    folder = _artefact_folder(spark, sf)
    made = files.artefacts(spark, folder).select("template_id", "seed", "candidate", F.md5("fbd_text").alias("fbd"), F.md5("fbd_xml").alias("xml"), "plan_json", "result_json")
    return made.join(files.row_traces(spark, folder), ["template_id", "seed"]).withColumn("traces", F.md5(F.array_join("traces", "|")))


def _listing(spark: SparkSession, sf: str) -> DataFrame:
    """Files in the order of their paths, with their place in it."""
    return files.ordered_listing(spark, _artefact_folder(spark, sf))


def _staged_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Local paths in the staged files as they lie on disk."""
    folder = paths.scratch(spark)
    files.write_texts(b.staged_texts(spark, sf), folder).agg(F.sum("size")).collect()
    return audit.local_path_hits(files.staged_texts(spark, folder))


def _checksums(spark: SparkSession, sf: str) -> DataFrame:
    """Size and hash of every staged file, large ones hashed in pieces from the store."""
    folder = paths.scratch(spark)
    files.write_texts(b.staged_texts(spark, sf), folder).agg(F.sum("size")).collect()
    return files.checksums(spark, folder)


def _media(spark: SparkSession, sf: str) -> DataFrame:
    """The three media relations written by split and stream and read back: whole bytes by their hash."""
    clean = media.keyed_entries(archive_plans.small_numbers(b.entries(spark, sf))).filter(media.entry_problem().isNull())
    out = paths.scratch(spark)
    archives.write_media(clean.withColumn("split", F.lit("train")), out)
    parts = []
    for relation, content in (("still", "image"), ("cmd", "image"), ("audio", "audio")):
        held = spark.read.parquet(f"{out}/{relation}")
        number = lambda c, held=held: F.col(c).cast("int") if c in held.columns else F.lit(None).cast("int")
        parts.append(held.select(F.lit(relation).alias("relation"), "stream", F.col("sub_id").cast("int").alias("sub_id"), F.col("trial").cast("int").alias("trial"), F.col("position").cast("int").alias("position"), number("command").alias("command"), number("frame").alias("frame"), number("mic").alias("mic"), F.col(f"{content}.path").alias("path"), F.md5(f"{content}.bytes").alias("md5")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _groups_in_order(spark: SparkSession, sf: str) -> DataFrame:
    return media.group_order(archive_plans.QUERIES["group_counts"](spark, sf))


def _subjects_written(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as a subjects CSV, read under its schema, written as two tables and read back."""
    base = paths.scratch(spark)
    raw = archive_plans._raw(spark, sf)
    known = raw.filter(F.col("Split") != "Trial")
    known.write.option("header", True).csv(f"{base}/csv")
    archives.write_subjects(archives.read_subjects(spark, f"{base}/csv"), f"{base}/out")
    table, extra = spark.read.parquet(f"{base}/out/subjects"), spark.read.parquet(f"{base}/out/subject_accessories")
    few = extra.groupBy("sub_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", F.col("trial").cast("string"), "accessory"))), ",").alias("accessories"))
    return table.join(few, "sub_id", "left").select(F.col("sub_id").cast("int").alias("sub_id"), "split", F.col("age").cast("int").alias("age"), "gender", "ethnicity", F.coalesce("accessories", F.lit("")).alias("accessories"))


def _report(spark: SparkSession, sf: str) -> DataFrame:
    """The census as JSON lines, read back."""
    path = f"{paths.scratch(spark)}/report"
    stage.write_report(corpus.QUERIES["census_report"](spark, sf), path)
    return spark.read.schema("axis string, value string, n bigint").json(path)


def _census_of_stage(spark: SparkSession, sf: str) -> DataFrame:
    """Orders split, written as a stage of versions and read as census rows: blocks of the rank1 programs by split."""
    out = paths.scratch(spark)
    rows = splits.assign(b.order_rows(spark, sf), ["2-HIGH"], ["MOD"])
    verdicts = b.order_scores(spark, sf)
    for split in schemas.SPLIT_DIRS:
        part = rows.filter(F.col("split") == split).drop("split")
        root = relations.root_rows(part)
        stage.commit_split(spark, out, split, "fbd", root, relations.candidate_rows(part), relations.scores_of(verdicts, root))
    one = stage.manifest_table(rows, rows.select("template_id").distinct(), "fbd", ["2-HIGH"], ["MOD"])
    stage.write_manifest(spark, out, one)
    held = stage.read_census_rows(spark, out)
    return held.select("split", "family", F.explode("blocks").alias("kind")).groupBy("split", "family", "kind").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "stage_versions": _versions,
    "stage_census": _census_of_stage,
    "family_stage": _families,
    "artefact_files": _artefacts,
    "listing_in_order": _listing,
    "staged_file_hits": _staged_hits,
    "file_sums": _checksums,
    "media_written": _media,
    "groups_in_order": _groups_in_order,
    "subjects_written": _subjects_written,
    "report_written": _report,
}

_FILES = r"""
written AS (
  SELECT template_id || '/' || seed || n.name AS path, octet_length(encode(CASE n.i WHEN 0 THEN text WHEN 1 THEN xml ELSE '{"dt": 0.125, "ticks": [], "seed": ' || seed || '}' || CASE WHEN n.i = 3 THEN chr(10) ELSE '' END END)) AS length
  FROM programs, (VALUES (0, '/rank1.fbd'), (1, NULL), (2, '/trace_1.json'), (3, '/trace_0.json')) m(i, fixed), LATERAL (SELECT m.i, coalesce(m.fixed, CASE WHEN seed % 5 = 0 THEN '/notes.txt' ELSE '/rank1.plcopen.xml' END) AS name) n
)
"""

# --- the allocation of the families ------------------------------------------------------------


def _space_rows() -> str:
    """(family, ord, template_id, space) of the families whose templates are fixed."""
    out = []
    for name, family in registry.FAMILIES.items():
        if name != "harness":
            out += [f"('{name}', {i}, '{t}', {n}::BIGINT)" for i, (t, n) in enumerate(family.spaces({}).items())]
    return ", ".join(out)


_FAMILY_SQL = rf"""
WITH {b.PROGRAMS_SQL}, spaces(family, ord, template_id, space) AS (
  SELECT * FROM (VALUES {_space_rows()}) UNION ALL SELECT 'harness', row_number() OVER (ORDER BY doc_id) - 1, 'harness_and_' || doc_id, 20 FROM programs WHERE regexp_matches(text, ' = [A-Z_]+\(')),
asked AS (SELECT count(*) + 30 AS n FROM supplier),
given AS (SELECT family, ord, template_id, space, least(space, n // count(*) OVER (PARTITION BY family)) AS g, n FROM spaces, asked),
short AS (SELECT family, (max(n) - sum(g))::BIGINT AS missing FROM given GROUP BY family),
slots AS (SELECT g.family, ord, unnest(range(0, least(space - g.g, missing))) AS round FROM given g JOIN short s USING (family)),
dealt AS (SELECT family, ord, count(*) AS extra FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY round, ord) AS turn FROM slots) JOIN short USING (family) WHERE turn <= missing GROUP BY ALL),
counts AS (SELECT family, ord, template_id, g + coalesce(extra, 0) AS n FROM given LEFT JOIN dealt USING (family, ord)),
firsts AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY family ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM counts),
seeds AS (SELECT family, template_id, unnest(range(first, first + n::BIGINT)) AS seed FROM firsts),
placed AS (SELECT family, CASE WHEN template_id IN ({', '.join(f"'{t}'" for t in HELD_TEMPLATES)}) THEN 'evaluation' WHEN seed % 10 = 0 THEN 'test' ELSE 'train' END AS split FROM seeds)
SELECT family, split, relation, (count(*) * max(times))::BIGINT AS n FROM placed, (VALUES ('root', 1), ('candidates', 3), ('scores', 3), ('joined', 1)) r(relation, times) GROUP BY family, split, relation
"""

_MEDIA_BYTES = "unhex(CASE WHEN sort = 2 THEN '52494646' ELSE '89504E470D0A1A0A' END) || encode(name)"

ORACLES = {
    "stage_versions": f"""WITH {b.STAGE_SQL},
        cands AS (SELECT family || '/' || template_id || '/' || seed AS row_key, 'rank' || r.rank AS candidate, CASE WHEN seed % 4 = 0 THEN '' ELSE text END AS t, CASE WHEN seed % 4 = 0 THEN xml ELSE text END AS u
          FROM programs, (VALUES (1), (3), (5)) r(rank) WHERE NOT (r.rank = 1 AND seed % 61 = 60))
        SELECT v.v AS version, v.v = 2 AS is_last, (SELECT count(*) FROM programs) AS roots, row_key, candidate, md5(CASE v.v WHEN 1 THEN t ELSE u END) AS md5 FROM cands, (VALUES (1), (2)) v(v)""",
    "stage_census": f"""WITH {b.ORDERS_SQL}
        SELECT CASE WHEN template_id = '2-HIGH' OR kind = 'MOD' THEN 'evaluation' WHEN seed % 10 = 0 THEN 'test' ELSE 'train' END AS split, 'fbd' AS family, kind, count(*) AS n FROM order_rows GROUP BY ALL""",
    "family_stage": _FAMILY_SQL,
    "artefact_files": f"""WITH {b.PROGRAMS_SQL} SELECT template_id, seed, 'rank1' AS candidate, md5(text) AS fbd, md5(CASE WHEN seed % 5 = 0 THEN '' ELSE xml END) AS xml, '' AS plan_json, '' AS result_json,
        md5('{{"dt": 0.125, "ticks": [], "seed": ' || seed || '}}' || chr(10) || '|' || '{{"dt": 0.125, "ticks": [], "seed": ' || seed || '}}') AS traces FROM programs""",
    "listing_in_order": f"WITH {b.PROGRAMS_SQL}, {_FILES} SELECT row_number() OVER (ORDER BY path) - 1 AS number, path, length FROM written",
    "staged_file_hits": audits.ORACLES["local_path_hits"],
    "file_sums": f"WITH {b.STAGED_SQL} SELECT path, octet_length(encode(text)) AS size, sha256(text) AS sha256 FROM staged",
    "media_written": f"""WITH {b.ENTRIES_SQL} SELECT CASE sort WHEN 0 THEN 'still' WHEN 1 THEN 'cmd' ELSE 'audio' END AS relation, CASE WHEN sort = 2 THEN 'none' ELSE ['thermal', 'visual', 'visual_aligned'][shown] END AS stream,
        sub::INT AS sub_id, trial::INT AS trial, pos::INT AS position, CASE WHEN sort > 0 THEN command::INT END AS command, CASE WHEN sort < 2 THEN frame::INT END AS frame, CASE WHEN sort = 2 THEN (frame::BIGINT % 100)::INT END AS mic,
        string_split({archive_plans._SMALL}, '/')[-1] AS path, md5({_MEDIA_BYTES}) AS md5 FROM keyed WHERE reason IS NULL AND sub = subject AND n % 61 <> 0""",
    "groups_in_order": f"WITH {b.ENTRIES_SQL} {archive_plans._GROUPS} SELECT row_number() OVER (ORDER BY archive, relation, stream, trial) - 1 AS place, archive, relation, stream, trial, rows, bytes FROM groups",
    "subjects_written": archive_plans._RAW
    + """, acc AS (SELECT sub_id, '1:' || unnest(a1) AS x FROM raw UNION ALL SELECT sub_id, '2:' || unnest(a2) FROM raw)
        SELECT sub_id, split, age, 'F' AS gender, ethnicity, coalesce((SELECT string_agg(x, ',' ORDER BY x) FROM acc a WHERE a.sub_id = r.sub_id), '') AS accessories FROM raw r WHERE s <> 'Trial'""",
    "report_written": corpus.ORACLES["census_report"],
}
