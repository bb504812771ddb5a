"""Census, splits, relations and controls over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.functions import text as tx
from labelmill.operators import census, controls, gates, relations, splits
from labelmill.plans import bindings as b
from labelmill.sources import stage

GATE_BLOCKS = ["Node.get_3", "NOWHERE", "TOF"]
GATE_TEMPLATES = ["src7", "src9"]


def census_rows(spark: SparkSession, sf: str) -> DataFrame:
    root, candidates = b.document_stage(spark, sf)
    split = splits.split_name(F.col("template_id"), F.col("seed"), F.col("blocks"), b.HELD_TEMPLATES, b.HELD_BLOCKS)
    rows = census.census_rows(root.drop("family"), candidates, tx_family(), F.lit(""))
    return rows.withColumn("split", split)


def tx_family():
    return F.get(F.split("key", "/"), 0)


def _rows(fn):
    return lambda spark, sf: fn(census_rows(spark, sf))


def _planted_leak(spark, sf):
    return census.planted_leak(census_rows(spark, sf))


def _templates(spark: SparkSession, sf: str) -> DataFrame:
    """The registry: every source, and one nobody writes for each."""
    used = b.table(spark, sf, "documents").select("source").distinct()
    return used.select(F.explode(F.array("source", F.concat("source", F.lit("-unused")))).alias("template_id"))


def _template_counts(spark, sf):
    return splits.template_counts(census_rows(spark, sf), _templates(spark, sf))


def _minimum_rows(spark, sf):
    return gates.minimum_rows(census_rows(spark, sf), 1_000_000_000)


def _order_split(spark, sf):
    rows = splits.assign(b.order_rows(spark, sf), ["2-HIGH"], ["MOD"])
    return rows.select(tx.row_key(F.col("family"), F.col("template_id"), F.col("seed")).alias("key"), "split")


def _order_split_counts(spark, sf):
    return splits.counts(splits.assign(b.order_rows(spark, sf), ["2-HIGH"], ["MOD"]))


def _split_wide(spark, sf):
    return splits.counts_wide(splits.assign(b.order_rows(spark, sf), ["2-HIGH"], ["MOD"]))


def _root_rows(spark, sf):
    return relations.root_rows(b.order_rows(spark, sf)).withColumn("traces", F.size("traces"))


def _candidate_rows(spark, sf):
    return relations.candidate_rows(b.order_rows(spark, sf), F.col("seed") % 5 == 0)


def _score_rows(spark, sf):
    scores = b.order_scores(spark, sf)
    rows = scores.groupBy("row_key").agg(
        *[F.any_value(F.when(F.col("candidate") == n, F.struct(*relations.SCORE_COLUMNS)), ignoreNulls=True).alias(n) for n in ("rank1", "rank3", "rank5")]
    )
    flat = rows.select(
        F.lit("fbd").alias("family"), tx.key_template(F.col("row_key")).alias("template_id"), tx.key_seed(F.col("row_key")).alias("seed"),
        F.array("rank1", "rank3", "rank5").alias("scores"),
    )
    return relations.score_rows(flat)


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    # an order becomes three programs and three scores, which are sorted before they meet: a task has a bounded number of orders
    orders = b.spread_rows(b.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"))
    rows = b.order_rows(spark, sf, orders)
    return relations.joined_view(relations.root_rows(rows), relations.candidate_rows(rows), b.order_scores(spark, sf, orders))


def _joined_view(spark, sf):
    """The nested view, flattened with the candidate's place for comparison."""
    nested = _joined(spark, sf).select("key", "intent", "template_id", "seed", F.posexplode("candidates").alias("place", "c"))
    return nested.select(
        "key", "intent", "template_id", "seed", "place", "c.candidate", "c.rank", "c.fbd_text", "c.fbd_sha", "c.provenance",
        "c.scores.compiles", "c.scores.effect_matches", "c.scores.steps",
    )


def _unnested_scores(spark, sf):
    return relations.unnest_scores(_joined(spark, sf)).select("row_key", "candidate", "parses", "runs", "wall_ms", "refusal")


def _unnested_candidates(spark, sf):
    stale = relations.drop_candidate_fields(_joined(spark, sf), "fbd_path", "plan_json")
    return stale.select(F.col("key").alias("row_key"), F.inline("candidates")).select("row_key", "candidate", "rank", "fbd_sha")


def _planted_negative(spark, sf):
    broken = controls.assert_controls(controls.planted_negative(b.order_scores(spark, sf)))
    return broken.groupBy("control").agg(F.count(F.lit(1)).alias("n"))


def _null_gate(spark, sf):
    """The null gate on a relation whose shas and texts were lost on some rows."""
    rows = relations.candidate_rows(b.order_rows(spark, sf))
    seed = tx.key_seed(F.col("row_key"))
    return gates.null_gate(
        rows.withColumn("fbd_sha", F.when(seed % 5 != 0, F.col("fbd_sha"))).withColumn("provenance", F.when(seed % 7 != 0, F.col("provenance"))),
        "fbd_candidates",
    )


def _null_counts(spark, sf):
    d, lab = b.table(spark, sf, "documents"), b.table(spark, sf, "labels")
    return gates.null_counts(d.select("doc_id", "lang").join(lab, "doc_id", "left")).select("col", "nulls")


def _key_parts(spark, sf):
    rows = relations.candidate_rows(b.order_rows(spark, sf)).filter("candidate = 'rank1'")
    return rows.select("row_key", tx.key_template(F.col("row_key")).alias("template_id"), tx.key_seed(F.col("row_key")).alias("seed"))


def _missing_scores(spark, sf):
    rows = relations.candidate_rows(b.order_rows(spark, sf))
    kept = b.order_scores(spark, sf).filter(~((F.col("candidate") == "rank3") & (tx.key_seed(F.col("row_key")) % 19 == 0)))
    return relations.unscored(rows, kept)


def _duplicate_candidates(spark, sf):
    rows = relations.candidate_rows(b.order_rows(spark, sf)).select("row_key", "candidate")
    again = rows.filter((F.col("candidate") == "rank5") & (tx.key_seed(F.col("row_key")) % 23 == 0))
    return relations.duplicate_candidates(rows.unionByName(again))


def _manifest(spark, sf):
    rows = splits.assign(b.order_rows(spark, sf), ["2-HIGH"], ["MOD"])
    registry = b.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("template_id")).distinct()
    made = stage.manifest_table(rows, registry, "fbd", ["2-HIGH"], ["MOD"])
    flat = made.select("rows", "train_rows", "test_rows", "evaluation_rows", F.explode("templates").alias("template_id", "n"))
    return flat


def _configs(spark, sf):
    rows = splits.assign(b.order_rows(spark, sf)).withColumn("split", F.when(F.col("split") == "test", "train").otherwise(F.col("split")))
    registry = b.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("template_id")).distinct()
    made = stage.manifest_table(rows, registry, "fbd", [], [])
    listed = spark.createDataFrame(
        [("fbd", True), ("fbd_root", False), ("fbd_candidates", False), ("fbd_scores", False)], "relation string, is_default boolean"
    )
    return stage.dataset_configs(made, listed)


QUERIES = {
    "census_block_kinds": _rows(census.tally_block_kinds),
    "census_report": _rows(census.report),
    "tally_family": _rows(census.tally_families),
    "tally_template": _rows(census.tally_templates),
    "tally_frame": _rows(census.tally_frames),
    "length_histogram": _rows(census.length_histogram),
    "kinds_present": _rows(census.kinds_present),
    "most_common_kind": _rows(census.most_common_kind),
    "split_counts": _rows(splits.counts),
    "template_counts_zero_filled": _template_counts,
    "leaked_blocks": _rows(lambda rows: census.leaked_blocks(rows, GATE_BLOCKS)),
    "leaked_families": _rows(lambda rows: census.leaked_templates(rows, GATE_TEMPLATES)),
    "empty_axes": _rows(lambda rows: census.empty_axes(rows, GATE_BLOCKS)),
    "census_problems": _rows(lambda rows: census.problems(rows, GATE_TEMPLATES, GATE_BLOCKS)),
    "missing_reference": _rows(census.missing_reference),
    "planted_leak": _planted_leak,
    "minimum_rows": _minimum_rows,
    "split_assign": _order_split,
    "split_counts_orders": _order_split_counts,
    "split_counts_wide": _split_wide,
    "root_rows": _root_rows,
    "candidate_rows": _candidate_rows,
    "score_rows": _score_rows,
    "joined_view": _joined_view,
    "unnest_candidates": _unnested_candidates,
    "unnest_scores": _unnested_scores,
    "assert_controls": lambda spark, sf: controls.assert_controls(b.order_scores(spark, sf)),
    "planted_negative": _planted_negative,
    "null_gate": _null_gate,
    "null_counts": _null_counts,
    "key_parts": _key_parts,
    "unscored_candidates": _missing_scores,
    "duplicate_candidates": _duplicate_candidates,
    "manifest_counts": _manifest,
    "dataset_configs": _configs,
}


def _stage(sql: str) -> str:
    return f"WITH {b.STAGE_SQL} {sql}"


def _orders(sql: str) -> str:
    return f"WITH {b.ORDERS_SQL} {sql}"


_ORDER_SPLIT = """CASE WHEN template_id = '2-HIGH' OR list_contains(blocks, 'MOD') THEN 'evaluation' WHEN seed % 10 = 0 THEN 'test' ELSE 'train' END"""

ORACLES = {
    "census_block_kinds": _stage(
        "SELECT kind, count(*) AS n FROM (SELECT DISTINCT key, unnest(blocks) AS kind FROM rows WHERE split = 'train') GROUP BY kind"
    ),
    "census_report": _stage(
        """
        SELECT 'rows' AS axis, split AS value, count(*) AS n FROM rows GROUP BY split
        UNION ALL SELECT 'families', family, count(*) FROM rows WHERE split = 'train' GROUP BY family
        UNION ALL SELECT 'templates', template_id, count(*) FROM rows WHERE split = 'train' GROUP BY template_id
        UNION ALL SELECT 'frames', template_id || '#' || frame_id, count(*) FROM rows WHERE split = 'train' GROUP BY ALL
        UNION ALL SELECT 'length_histogram', CAST(len(blocks) AS VARCHAR), count(*) FROM rows WHERE split = 'train' GROUP BY ALL
        UNION ALL SELECT 'block_kinds', kind, count(*) FROM (SELECT DISTINCT key, unnest(blocks) AS kind FROM rows WHERE split = 'train') GROUP BY kind
        """
    ),
    "tally_family": _stage("SELECT family, count(*) AS n FROM rows WHERE split = 'train' GROUP BY family"),
    "tally_template": _stage("SELECT template_id, count(*) AS n FROM rows WHERE split = 'train' GROUP BY template_id"),
    "tally_frame": _stage("SELECT template_id || '#' || frame_id AS frame, count(*) AS n FROM rows WHERE split = 'train' GROUP BY ALL"),
    "length_histogram": _stage("SELECT CAST(len(blocks) AS INT) AS length, count(*) AS n FROM rows WHERE split = 'train' GROUP BY ALL"),
    "kinds_present": _stage("SELECT count(DISTINCT kind) AS kinds FROM (SELECT unnest(blocks) AS kind FROM rows WHERE split = 'train')"),
    "most_common_kind": _stage(
        "SELECT kind, count(*) AS n FROM (SELECT DISTINCT key, unnest(blocks) AS kind FROM rows WHERE split = 'train') GROUP BY kind ORDER BY n DESC, kind LIMIT 1"
    ),
    "split_counts": _stage("SELECT split, count(*) AS n FROM rows GROUP BY split"),
    "template_counts_zero_filled": _stage(
        "SELECT template_id, count(*) AS n FROM rows GROUP BY template_id UNION ALL SELECT DISTINCT template_id || '-unused', 0 FROM rows"
    ),
    "leaked_blocks": _stage(
        "SELECT DISTINCT kind FROM (SELECT unnest(blocks) AS kind FROM rows WHERE split = 'train') WHERE kind IN ('Node.get_3', 'NOWHERE', 'TOF')"
    ),
    "leaked_families": _stage("SELECT DISTINCT template_id FROM rows WHERE split = 'train' AND template_id IN ('src7', 'src9')"),
    "empty_axes": _stage(
        """SELECT kind FROM (VALUES ('Node.get_3'), ('NOWHERE'), ('TOF')) v(kind)
           WHERE kind NOT IN (SELECT unnest(blocks) FROM rows WHERE split = 'evaluation')"""
    ),
    "census_problems": _stage(
        """
        SELECT DISTINCT template_id AS subject, 'held-out family ' || template_id || ' leaked into training' AS problem
          FROM rows WHERE split = 'train' AND template_id IN ('src7', 'src9')
        UNION ALL SELECT DISTINCT kind, 'held-out block kind ' || kind || ' leaked into training'
          FROM (SELECT unnest(blocks) AS kind FROM rows WHERE split = 'train') WHERE kind IN ('Node.get_3', 'NOWHERE', 'TOF')
        UNION ALL SELECT kind, 'held-out block kind ' || kind || ' appears in no holdout row either; the axis is empty'
          FROM (VALUES ('Node.get_3'), ('NOWHERE'), ('TOF')) v(kind) WHERE kind NOT IN (SELECT unnest(blocks) FROM rows WHERE split = 'evaluation')
        UNION ALL SELECT key, 'root row ' || key || ' has no rank1 candidate' FROM rows WHERE missing
        """
    ),
    "missing_reference": _stage("SELECT key FROM rows WHERE missing"),
    "planted_leak": _stage(
        "SELECT kind, count(*) AS n FROM (SELECT DISTINCT key, unnest(blocks) AS kind FROM rows WHERE split = 'train') GROUP BY kind ORDER BY n DESC, kind LIMIT 1"
    ),
    "minimum_rows": _stage(
        """SELECT 'train' AS subject, count(*) FILTER (split = 'train') || ' train rows, below the floor of 1000000000' AS problem FROM rows"""
    ),
    "split_assign": _orders(f"SELECT key, {_ORDER_SPLIT} AS split FROM order_rows"),
    "split_counts_orders": _orders(f"SELECT {_ORDER_SPLIT} AS split, count(*) AS n FROM order_rows GROUP BY 1"),
    "split_counts_wide": _orders(
        f"""SELECT count(*) FILTER (s = 'train') AS train_rows, count(*) FILTER (s = 'test') AS test_rows,
            count(*) FILTER (s = 'evaluation') AS evaluation_rows FROM (SELECT {_ORDER_SPLIT} AS s FROM order_rows)"""
    ),
    "root_rows": _orders(
        """SELECT key, 'intent_to_fbd' AS task_type, 'instruction_following' AS dimension, 'input_intent' AS input_column, 'text' AS input_asset_kind,
           intent, template_id, seed, frame_id, array_to_string(list_sort(list_distinct(blocks)), ',') AS blocks, 0 AS traces, 'constructed:template' AS provenance
           FROM order_rows"""
    ),
    "candidate_rows": _orders(
        """SELECT key AS row_key, candidate, rank, CASE WHEN seed % 5 = 0 THEN '' ELSE fbd_text END AS fbd_text,
           CASE WHEN seed % 5 = 0 THEN fbd_text ELSE '' END AS fbd_xml, '' AS plan_json, '' AS result_json,
           'rows/' || template_id || '/' || seed || '/' || candidate AS fbd_path, sha256(fbd_text) AS fbd_sha,
           CASE WHEN seed % 5 = 0 THEN 'constructed:' ELSE 'constructed:fbd:' END || template_id || ':seed:' || seed AS provenance FROM cands"""
    ),
    "score_rows": _orders(
        """SELECT row_key, candidate, compiles AS parses, compiles, runs, effect_matches, steps, wall_ms,
           CASE WHEN compiles THEN '' ELSE 'refused: unknown pin' END AS refusal FROM scores"""
    ),
    "joined_view": _orders(
        """SELECT c.key, 'handle order ' || c.seed AS intent, c.template_id, c.seed, CAST((rank - 1) / 2 AS INT) AS place, c.candidate, rank, fbd_text,
           sha256(fbd_text) AS fbd_sha, 'constructed:fbd:' || c.template_id || ':seed:' || c.seed AS provenance, compiles, effect_matches, steps
           FROM cands c JOIN scores s ON c.key = s.row_key AND c.candidate = s.candidate"""
    ),
    "unnest_candidates": _orders("SELECT key AS row_key, candidate, rank, sha256(fbd_text) AS fbd_sha FROM cands"),
    "unnest_scores": _orders(
        """SELECT row_key, candidate, compiles AS parses, runs, wall_ms, CASE WHEN compiles THEN '' ELSE 'refused: unknown pin' END AS refusal FROM scores"""
    ),
    "assert_controls": _orders(
        """SELECT row_key, CASE WHEN i THEN 'identity' WHEN e THEN 'effect' ELSE 'negative' END AS control FROM (
             SELECT row_key, bool_or(candidate = 'rank1' AND NOT (compiles AND runs AND effect_matches)) AS i,
               bool_or(candidate = 'rank3' AND (NOT compiles OR effect_matches)) AS e, bool_or(candidate = 'rank5' AND compiles) AS n
             FROM scores GROUP BY row_key) WHERE i OR e OR n"""
    ),
    "planted_negative": "SELECT 'identity' AS control, count(*) AS n FROM orders",
    "null_gate": _orders(
        """SELECT 'fbd_candidates' AS subject, 'FAIL: fbd_candidates.fbd_sha carries ' || 3 * count(*) || ' null(s); the normal form forbids them' AS problem
           FROM order_rows WHERE seed % 5 = 0"""
    ),
    "null_counts": """
        SELECT col, nulls FROM (SELECT count(*) - count(d.doc_id) AS doc_id, count(*) - count(lang) AS lang, count(*) - count(quality) AS quality,
          count(*) - count(toxic) AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) UNPIVOT (nulls FOR col IN (doc_id, lang, quality, toxic))""",
    "key_parts": _orders("SELECT key AS row_key, template_id, seed FROM order_rows"),
    "unscored_candidates": _orders("SELECT key AS row_key, candidate FROM cands WHERE candidate = 'rank3' AND seed % 19 = 0"),
    "duplicate_candidates": _orders(
        "SELECT key || '/' || candidate AS subject, 'held 2 times' AS problem FROM cands WHERE candidate = 'rank5' AND seed % 23 = 0"
    ),
    "manifest_counts": _orders(
        f"""SELECT rows, train_rows, test_rows, evaluation_rows, template_id, n FROM
            (SELECT count(*) AS rows, count(*) FILTER (s = 'train') AS train_rows, count(*) FILTER (s = 'test') AS test_rows,
             count(*) FILTER (s = 'evaluation') AS evaluation_rows FROM (SELECT {_ORDER_SPLIT} AS s FROM order_rows)),
            (SELECT template_id, count(*) AS n FROM order_rows GROUP BY template_id)"""
    ),
    "dataset_configs": """
        SELECT config, config = 'fbd' AS is_default, split, dir || '/' || config || '/*.parquet' AS path
        FROM (VALUES ('fbd'), ('fbd_root'), ('fbd_candidates'), ('fbd_scores')) c(config), (VALUES ('train', 'data')) s(split, dir)
        WHERE (SELECT count(*) FROM orders) > 0""",
}
