"""Schedules, frames, seeds and generated rows over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.functions import numeric as nm
from labelmill.functions import text as tx
from labelmill.operators import allocation, mutations
from labelmill.operators.families import blocks, calls, chores, controllers, frames, methods, plans, settings
from labelmill.operators.draws import counted
from labelmill.plans import bindings as b
from labelmill.plans import draws_sql
from labelmill.plans.texts import merged


def _templates(spark: SparkSession, sf: str) -> DataFrame:
    """(ord, template_id): the sources, numbered from 0 by their own number."""
    d = b.table(spark, sf, "documents").select("source").distinct()
    return d.select(F.substr("source", F.lit(4)).cast("int").alias("ord"), F.col("source").alias("template_id"))


def _seeds(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("seed"))


def _schedule(spark, sf):
    return allocation.schedule_blocks(_seeds(spark, sf), _templates(spark, sf))


def _spaces(spark: SparkSession, sf: str) -> DataFrame:
    """(ord, template_id, space): capacities of very different size, from the documents of each source."""
    d = b.table(spark, sf, "documents")
    number = F.substr("source", F.lit(4)).cast("int")
    per = d.groupBy(number.alias("ord"), F.col("source").alias("template_id")).agg(F.count(F.lit(1)).alias("n"))
    return per.select("ord", "template_id", (F.col("n") * (F.col("ord") % 5 + 1) * (F.col("ord") % 3 + 1) + F.col("ord")).alias("space"))


def _wanted(spark: SparkSession, sf: str) -> int:
    """Seven tenths of the total space: one number, read by the driver."""
    return allocation.capacity(_spaces(spark, sf)).first()["space"] * 7 // 10


def _allocate(spark, sf):
    return allocation.allocate(_spaces(spark, sf), _wanted(spark, sf))


def _seed_ranges(spark, sf):
    return allocation.seed_ranges(_allocate(spark, sf))


def _jobs(spark, sf):
    return allocation.jobs(_seed_ranges(spark, sf), 100)


def _capacity_problem(spark, sf):
    return allocation.capacity_problem(_spaces(spark, sf), 10**12)


def _frame_jobs(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*[F.lit(t) for t in frames.FRAMES])
    key = F.col("o_orderkey")
    shown = [part for n in ("text", "path", "n", "k", "names", "gain", "cap", "ms", "style") for part in (F.lit(n), F.concat(F.lit(f"{n}{{x}}"), key.cast("string")))]
    return b.table(spark, sf, "orders").select(
        F.get(names, (key % 9).cast("int")).alias("template_id"), key.alias("seed"), F.create_map(*shown).alias("params")
    )


def _frame_pick(spark, sf):
    return frames.pick(_frame_jobs(spark, sf), frames.FRAMES, F.col("params")).select("template_id", "seed", "frame_id", "intent")


def _frame_problems(spark, sf):
    jobs = _frame_jobs(spark, sf)
    lost = F.map_filter("params", lambda name, _: ~((name == "path") & (F.col("seed") % 10 == 3)))
    return frames.unfilled_problems(jobs, frames.FRAMES, lost)


def _seed_mix(spark, sf):
    d = b.table(spark, sf, "documents")
    return d.select("doc_id", tx.mixed_seed(F.col("doc_id"), F.col("source")).alias("mixed"))


def _short_ids(spark, sf):
    d = b.table(spark, sf, "documents")
    return d.select("doc_id", tx.short_id(F.concat_ws("/", "source", F.col("doc_id").cast("string"))).alias("class_name"))


def _vectors(spark, sf):
    """Vector and transform readbacks of the order lines, to six places."""
    li = b.spread(b.table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber"))
    p, s, n = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    d = lambda c: c.cast("double")
    a = F.array(d(p % 9 - 4), d(s % 9 - 4), d(n - 4))
    c = F.array(d(s % 7 - 3), d(p % 5 - 2), d(n % 3 + 1))
    cross = nm.cross(a, c)
    unit = nm.normalised(F.array(F.lit(0.0), F.lit(0.0), d(n % 3 + 1), d(p % 4 + 1)))
    six = lambda v: F.format_string("%.6f", v + 0.0)
    return li.select(
        nm.dot(a, c).alias("dot"), six(nm.norm(a)).alias("norm"), *[F.get(cross, i).alias(f"c{i}") for i in range(3)],
        six(F.atan2(d(s % 11 - 5), d(n))).alias("angle"), six(F.hypot(d(s % 11 - 5), d(n))).alias("length"),
        nm.diagonal_determinant(c).alias("det"), six(F.get(unit, 3)).alias("qw"), F.get(nm.inverse_translation(a), 2).alias("inv"),
        nm.argb32(p % 5 / F.lit(4.0), s % 5 / F.lit(4.0), n % 5 / F.lit(4.0)).alias("argb"),
    ).groupBy("dot", "norm", "c0", "c1", "c2", "angle", "length", "det", "qw", "inv", "argb").agg(F.count(F.lit(1)).alias("n"))


def _csv_lists(spark, sf):
    e = b.table(spark, sf, "documents")
    text = F.concat("lang", F.lit(",,"), "source", F.when(F.col("doc_id") % 2 == 0, ",").otherwise(",x"))
    return e.select("doc_id", F.array_join(tx.csv_list(text), "|").alias("names"))


def _jobs_of(spark: SparkSession, sf: str, templates: list[str]) -> DataFrame:
    key = F.col("o_orderkey")
    names = F.array(*[F.lit(t) for t in templates])
    return b.spread_rows(b.table(spark, sf, "orders").select(F.get(names, (F.floor(key / 10) % len(templates)).cast("int")).alias("template_id"), key.alias("seed")))


def _corpus(spark, sf):
    """Controller rows for every order key, as the root and its three texts."""
    return controllers.rows(_jobs_of(spark, sf, list(controllers.TEXTS)), counted).drop("values", "traces")


def _controller_traces(spark, sf):
    made = controllers.rows(_jobs_of(spark, sf, list(controllers.TEXTS)), counted)
    return made.select("template_id", "seed", F.posexplode_outer("traces").alias("trace", "trace_json"))


def _chores(spark, sf):
    return chores.rows(_jobs_of(spark, sf, list(chores.DRAWS)), counted).select("template_id", "seed", "intent", "frame_id", "rank1", "rank3", "rank5")


def _composed(spark, sf):
    """Composites of two controllers; the texts by their hash."""
    made = controllers.composed_rows(_jobs_of(spark, sf, [f"compose_{i}" for i in range(5)]), counted).drop("traces")
    return made.withColumns({rank: F.sha2(rank, 256) for rank in ("rank1", "rank3", "rank5")})


def _planned(spark, sf):
    """Planned goals per order key; a goal's canonical text is the shortest program of its tenth of the documents, arguments marked."""
    goal = F.col("doc_id") % 10
    shortest = F.min_by("text", F.struct(F.length("text"), "doc_id")).alias("text")
    p = b.programs(spark, sf).groupBy(goal.alias("goal")).agg(shortest)
    marked = F.replace(F.replace("text", F.lit("a)"), F.lit('TEXT="ARG_TEXT ARG_DIR ARG_MSG")')), F.lit("in a : BOOL"), F.when(F.col("goal") > 5, "in trigger : BOOL").otherwise("in a : BOOL"))
    canonical = p.select(F.col("goal").cast("int").alias("goal"), marked.alias("text"))
    return plans.rows(_jobs_of(spark, sf, list(plans.DRAWS)), canonical, counted).drop("traces")


def _perturbed(spark, sf):
    """Every document's program with its literals redrawn by the document's seed."""
    p = b.programs(spark, sf).select("doc_id", "text")
    return blocks.perturb(p, tx.mixed_seed(F.col("doc_id"), F.lit("ton")), counted=True).select("doc_id", "perturbed", F.try_element_at("params", F.lit("pt")).alias("pt"))


def _perturbed_shape(spark, sf):
    """What redrawing leaves alone: the texts with their literals masked."""
    p = b.programs(spark, sf).select("doc_id", "text")
    made = blocks.perturb(p, tx.mixed_seed(F.col("doc_id"), F.lit("ton")))
    masked = F.regexp_replace(F.regexp_replace("perturbed", r"T#\d+ms", "T"), r"=-?\d+(\.\d+)?", "=N")
    return made.select("doc_id", F.sha2(masked, 256).alias("sha"))


def _methods(spark, sf):
    return methods.rows(_jobs_of(spark, sf, list(methods.DRAWS)), counted).select("template_id", "seed", "intent", "class_name", "class_source")


def _method_returns(spark, sf):
    """Returns as printed, numbers to six places."""
    made = methods.returns(methods.rows(_jobs_of(spark, sf, list(methods.DRAWS)), counted))
    number = F.col("ret").try_cast("double")
    return made.withColumn("ret", F.when(number.isNotNull(), F.format_string("%.6f", number)).otherwise(F.col("ret")))


def _settings(spark, sf):
    return settings.rows(_jobs_of(spark, sf, list(settings.CALLS))).drop("values", "traces")


def _settings_expected(spark, sf):
    """Expected readbacks of every configuration row, counted by template and kind."""
    wanted = settings.expectations(settings.rows(_jobs_of(spark, sf, list(settings.CALLS))))
    return wanted.groupBy("template_id", "kind").agg(F.count("expected").alias("n"))


def _calls(spark, sf):
    return calls.rows(_jobs_of(spark, sf, list(calls.CALLS))).drop("values", "traces")


def _calls_expected(spark, sf):
    """Expected returns of every call row, counted by template and kind."""
    wanted = calls.expectations(calls.rows(_jobs_of(spark, sf, list(calls.CALLS))))
    return wanted.groupBy("template_id", "kind").agg(F.count(F.lit(1)).alias("n"))


def _harness(spark, sf):
    """Block behaviours: every document is a base program under a behaviour's name, one row per document."""
    kinds = F.array(*[F.lit(k) for k in blocks.INTENTS])
    name = F.concat_ws("_", F.get(kinds, (F.col("doc_id") % len(blocks.INTENTS)).cast("int")), F.col("doc_id").cast("string"))
    base = b.programs(spark, sf).select(name.alias("name"), "text")
    jobs = b.table(spark, sf, "documents").select(F.concat(F.lit("harness_"), name).alias("template_id"), F.col("doc_id").alias("seed"))
    return blocks.rows(jobs, base).drop("traces")


QUERIES = {
    "schedule_blocks": _schedule,
    "allocate": _allocate,
    "seed_ranges": _seed_ranges,
    "seed_jobs": _jobs,
    "capacity_problem": _capacity_problem,
    "frame_pick_fill": _frame_pick,
    "frame_problems": _frame_problems,
    "seed_mix_crc32": _seed_mix,
    "short_ids": _short_ids,
    "vector_readback": _vectors,
    "csv_lists": _csv_lists,
    "generate_controllers": _corpus,
    "controller_traces": _controller_traces,
    "generate_chores": _chores,
    "generate_composed": _composed,
    "generate_plans": _planned,
    "perturb_literals": _perturbed,
    "perturb_keeps_shape": _perturbed_shape,
    "generate_methods": _methods,
    "method_returns": _method_returns,
    "generate_settings": _settings,
    "settings_expectations": _settings_expected,
    "generate_behaviours": _harness,
    "generate_calls": _calls,
    "calls_expectations": _calls_expected,
}

_SPACES = """
spaces AS (SELECT ord, 'src' || ord AS template_id, n * (ord % 5 + 1) * (ord % 3 + 1) + ord AS space FROM
  (SELECT CAST(substr(source, 4) AS INT) AS ord, count(*) AS n FROM documents GROUP BY 1)),
total AS (SELECT CAST(sum(space) AS BIGINT) * 7 // 10 AS rows, count(*) AS k FROM spaces),
given AS (SELECT ord, template_id, space, least(space, rows // k) AS g, rows FROM spaces, total),
slots AS (SELECT ord, unnest(range(0, space - g)) AS round FROM given),
dealt AS (SELECT ord, count(*) AS extra FROM (SELECT ord FROM slots ORDER BY round, ord LIMIT (SELECT max(rows) - CAST(sum(g) AS BIGINT) FROM given)) GROUP BY ord),
counts AS (SELECT ord, template_id, g + coalesce(extra, 0) AS n FROM given LEFT JOIN dealt USING (ord)),
ranges AS (SELECT ord, template_id, n, CAST(coalesce(sum(n) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_seed FROM counts)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_FRAMES = "frames(ord, template_id, frame_id, frame, k) AS (VALUES " + ", ".join(
    f"({i}, {_quoted(t)}, {j}, {_quoted(s)}, {len(ss)})" for i, (t, ss) in enumerate(frames.FRAMES.items()) for j, s in enumerate(ss)
) + ")"


_EXPECTED = ", ".join(f"({i}, '{t}', '{kind}')" for i, t in enumerate(settings.CALLS) for _, kind, _ in settings.EXPECTED[t])


_RETURNS = ", ".join(f"({i}, '{t}', '{kind}')" for i, t in enumerate(calls.CALLS) for _, kind, _ in calls.EXPECTED[t])


def _fill(column: str) -> str:
    for name in ("text", "path", "n", "k", "names", "gain", "cap", "ms", "style"):
        column = f"replace({column}, '{{{name}}}', '{name}<x>' || o_orderkey)"
    return f"replace({column}, '<x>', '{{x}}')"


ORACLES = {
    "schedule_blocks": """
        WITH t AS (SELECT CAST(substr(source, 4) AS INT) AS ord, source, count(*) OVER () AS n FROM (SELECT DISTINCT source FROM documents))
        SELECT source AS template_id, o_orderkey AS seed FROM orders, t WHERE o_orderkey // 10 % n = ord""",
    "allocate": f"WITH {_SPACES} SELECT ord, template_id, n FROM counts",
    "seed_ranges": f"WITH {_SPACES} SELECT ord, template_id, n, first_seed FROM ranges",
    "seed_jobs": f"WITH {_SPACES} SELECT template_id, unnest(range(first_seed, first_seed + n)) AS seed FROM ranges",
    "capacity_problem": f"WITH {_SPACES} SELECT 'allocation' AS subject, 'space ' || CAST(sum(space) AS BIGINT) || ' is below the 1000000000000 rows asked for' AS problem FROM spaces",
    "frame_pick_fill": f"WITH {_FRAMES} SELECT template_id, o_orderkey AS seed, CAST(frame_id AS BIGINT) AS frame_id, {_fill('frame')} AS intent FROM orders JOIN frames ON o_orderkey % 9 = ord AND o_orderkey % k = frame_id",
    "frame_problems": f"WITH {_FRAMES} SELECT template_id, o_orderkey AS seed, 'path' AS missing FROM orders JOIN frames ON o_orderkey % 9 = ord AND o_orderkey % k = frame_id WHERE o_orderkey % 10 = 3 AND contains(frame, '{{path}}')",
    "calls_expectations": f"SELECT template_id, kind, count(*) AS n FROM orders JOIN (VALUES {_RETURNS}) e(ord, template_id, kind) ON o_orderkey // 10 % {len(calls.CALLS)} = ord GROUP BY ALL",
    "settings_expectations": f"SELECT template_id, kind, count(*) AS n FROM orders JOIN (VALUES {_EXPECTED}) e(ord, template_id, kind) ON o_orderkey // 10 % {len(settings.CALLS)} = ord GROUP BY ALL",
    "short_ids": "SELECT doc_id, 'U' || substr(sha1(source || '/' || doc_id), 1, 10) AS class_name FROM documents",
    "vector_readback": """
        WITH v AS (SELECT (l_partkey % 9 - 4)::DOUBLE AS a0, (l_suppkey % 9 - 4)::DOUBLE AS a1, (l_linenumber - 4)::DOUBLE AS a2, (l_suppkey % 7 - 3)::DOUBLE AS b0, (l_partkey % 5 - 2)::DOUBLE AS b1,
          (l_linenumber % 3 + 1)::DOUBLE AS b2, (l_suppkey % 11 - 5)::DOUBLE AS y, l_linenumber::DOUBLE AS x, (l_partkey % 4 + 1)::DOUBLE AS w, l_partkey % 5 AS r, l_suppkey % 5 AS g, l_linenumber % 5 AS b FROM lineitem)
        SELECT a0 * b0 + a1 * b1 + a2 * b2 + 0.0::DOUBLE AS dot, printf('%.6f', sqrt(a0 * a0 + a1 * a1 + a2 * a2)) AS norm, a1 * b2 - a2 * b1 + 0.0::DOUBLE AS c0, a2 * b0 - a0 * b2 + 0.0::DOUBLE AS c1, a0 * b1 - a1 * b0 + 0.0::DOUBLE AS c2,
          printf('%.6f', atan2(y, x) + 0.0) AS angle, printf('%.6f', sqrt(x * x + y * y)) AS length, b0 * b1 * b2 + 0.0::DOUBLE AS det, printf('%.6f', w / sqrt(b2 * b2 + w * w)) AS qw, 0.0::DOUBLE - a2 AS inv,
          (255::BIGINT << 24) | ([0, 64, 128, 191, 255][r + 1]::BIGINT << 16) | ([0, 64, 128, 191, 255][g + 1]::BIGINT << 8) | [0, 64, 128, 191, 255][b + 1]::BIGINT AS argb, count(*) AS n
        FROM v GROUP BY ALL""",
    "csv_lists": "SELECT doc_id, lang || '|' || source || CASE WHEN doc_id % 2 = 0 THEN '' ELSE '|x' END AS names FROM documents",
    "perturb_keeps_shape": f"WITH {b.PROGRAMS_SQL} "
    + r"SELECT doc_id, sha256(regexp_replace(regexp_replace(text, 'T#\d+ms', 'T', 'g'), '=-?\d+(\.\d+)?', '=N', 'g')) AS sha FROM programs",
}
ORACLES |= draws_sql.ORACLES | {"generate_composed": draws_sql.composed(merged)}
