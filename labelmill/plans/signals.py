"""Traces, expectations and effect checks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.operators import expectations as ex
from labelmill.operators import traces as tr
from labelmill.plans import bindings as b

USER = ["user_id"]
ORDER = ["ts", "event_id"]


def _ticks(spark, sf):
    return b.trace_ticks(spark, sf).select("user_id", "tick", "event_id")


def _n():
    return F.col("user_id") % 3 + 1


def _on_delay(spark, sf):
    out = tr.on_delay(b.trace_events(spark, sf), USER, "tick", "hour", F.col("tracker_ok"), _n(), ORDER)
    return out.select("user_id", "tick", "frozen")


def _press_hold(spark, sf):
    out = tr.press_hold(b.trace_events(spark, sf), USER, "tick", "hour", F.col("btn"), _n(), (F.col("user_id") % 9 + 1).cast("int"), ORDER)
    return out.select("user_id", "tick", "style")


def _gain_cap():
    return F.lit(0.5) + F.col("user_id") % 8, F.lit(0.25) * (F.col("user_id") % 16)


def _walk(spark, sf):
    """Observed signals carry an error on some events; a user passes when every tick does."""
    gain, cap = _gain_cap()
    want = ex.walk(F.col("lx"), F.col("ly"), gain, cap)
    error = F.when(F.col("event_id") % 197 == 5, 0.01).otherwise(1e-9)
    seen = {name: value + error for name, value in want.items()}
    return ex.all_ticks(b.trace_ticks(spark, sf), USER, ex.matches_signals(want, seen))


def _face(spark, sf):
    want = ex.face(F.col("lx"), F.col("ly"))
    seen = {"face_x": F.col("lx"), "face_z": F.when(F.col("event_id") % 211 == 3, F.col("lx")).otherwise(F.col("ly"))}
    return ex.all_ticks(b.trace_ticks(spark, sf), USER, ex.matches_signals(want, seen))


def _clamp_speed(spark, sf):
    gain, cap = _gain_cap()
    return b.trace_ticks(spark, sf).select("user_id", "tick", ex.capped_speed(F.col("lx"), gain, cap).alias("speed"))


def _steps(spark: SparkSession, sf: str) -> DataFrame:
    ticks = b.trace_ticks(spark, sf)
    return ticks.select("user_id", "hour", "tick", F.when(F.col("event_id") % 173 == 9, 1).otherwise(0).alias("code"))


def _outputs(spark: SparkSession, sf: str, *keys: str) -> DataFrame:
    """Three candidates' outputs per order line: a number, a flag and a text, some of them off.

    Nine values are made of a line, so lines are dealt out by ``keys`` before, and stay where they are.
    """
    li = b.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    li = b.keyed_rows(li, b.tasks_of(li), *keys)
    li = li.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_partkey").alias("p"), F.max("l_quantity").alias("q"), F.max("l_returnflag").alias("f"))
    p = F.col("p")
    null = F.lit(None)
    off = F.when((F.col("rank") == 3) & (p % 50 == 7), 1.0).when(F.col("rank") == 3, 5e-7).otherwise(0.0)
    entries = F.array(
        F.struct(F.lit("speed").alias("name"), (F.col("q") + off).alias("num"), null.cast("boolean").alias("flag"), null.cast("string").alias("str")),
        F.struct(F.lit("held").alias("name"), null.cast("double").alias("num"), ((p % 2 == 0) != ((F.col("rank") == 5) & (p % 40 == 3))).alias("flag"), null.cast("string").alias("str")),
        F.struct(F.lit("state").alias("name"), null.cast("double").alias("num"), null.cast("boolean").alias("flag"), F.concat("f", F.when((F.col("rank") == 5) & (p % 60 == 4), "x").otherwise("")).alias("str")),
    )
    ranked = li.select("*", F.explode(F.array(F.lit(1), F.lit(3), F.lit(5))).alias("rank"))
    out = ranked.select(
        F.col("l_orderkey").alias("row_key"), F.concat(F.lit("rank"), F.col("rank").cast("string")).alias("candidate"), F.lit(0).alias("trace"),
        F.col("l_linenumber").alias("tick"), "p", "rank", F.inline(entries),
    )
    return out.filter(~((F.col("rank") == 5) & (p % 90 == 11) & (F.col("name") == "held"))).drop("p", "rank")


def _trace_diff(spark, sf):
    return tr.trace_differences(_outputs(spark, sf, "l_orderkey"))


def _reference_matches(spark, sf):
    point = ["l_orderkey", "l_linenumber"]
    outputs = _outputs(spark, sf, *point).filter("name <> 'state'").filter("name = 'speed' and row_key % 2 = 0 or name = 'held' and row_key % 2 = 1")
    li = b.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    li = b.keyed_rows(li, b.tasks_of(li), *point).groupBy(*point).agg(F.max("l_partkey").alias("p"), F.max("l_quantity").alias("q"))
    reference = li.select(
        F.col("l_orderkey").alias("row_key"), F.lit(0).alias("trace"), F.col("l_linenumber").alias("tick"),
        F.when(F.col("l_orderkey") % 2 == 1, F.when(F.col("p") % 2 == 0, "true").otherwise("false")).when(F.col("p") % 300 == 1, "oops").otherwise(F.col("q").cast("string")).alias("ret"),
    )
    return tr.reference_matches(outputs, reference)


def _trace_json(spark, sf):
    """Trace text parsed to ticks: a two-tick trace per event."""
    e = b.table(spark, sf, "events")
    text = F.concat(
        F.lit('{"dt": 0.125, "ticks": [{"n": '), F.col("event_id").cast("string"), F.lit(', "kind": "'), "event_type", F.lit('"}, {"n": 7, "on": true}]}')
    )
    ticks = tr.ticks_of(e.select("event_id", text.alias("trace_json")))
    return ticks.select("event_id", "tick", "at", F.map_keys("values").cast("string").alias("names"), F.try_element_at("values", F.lit("n")).alias("n"))


def _pick_traces(spark, sf):
    names = b.table(spark, sf, "nation").select(F.col("n_name").alias("name"))
    rows = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("seed"))
    return tr.pick_traces(rows, names).select("seed", "pick", "name")


def _api(spark, sf):
    """Position readbacks per order: class name, vector, basis and flag, some of them wrong."""
    orders = b.table(spark, sf, "orders").select("o_orderkey")
    tasks, o = b.tasks_of(orders), b.spread(orders)
    k = F.col("o_orderkey")
    x, y, z = ((k * m % 11 - 5).cast("string") for m in (1, 3, 7))
    vector = F.concat(F.lit("Vector3("), x, F.lit(".5, "), y, F.lit(", "), F.when(k % 17 == 2, "99").otherwise(z), F.lit(")"))
    basis = F.concat(F.lit("Transform3D(1, 0, 0, 0, 1, 0, 0, 0, 1, "), x, F.lit(", "), y, F.lit(", "), z, F.lit(")"))
    flag = F.when(k % 19 == 4, "false").otherwise("true")
    name = F.when(k % 23 == 5, "Label").otherwise("Node3D")
    returns = [F.concat(F.lit("&'"), name, F.lit("'")), vector, basis, flag]
    results = F.to_json(F.array(*[
        F.struct((F.lit(i != 3) | (k % 29 != 6)).alias("ok"), (F.translate(r, "'", '"') if i == 0 else r).alias("ret"), F.lit(f"c{i}").alias("command")) for i, r in enumerate(returns)
    ]))
    key = F.concat(F.lit("fbd/"), k.cast("string"))
    observed = o.select(key.alias("row_key"), F.lit("rank1").alias("candidate"), results.alias("result_json"))
    numbers = lambda *cs: F.array(*[c.cast("double") for c in cs])
    nothing = F.array().cast("array<double>")
    wants = [(0, "text", nothing, "Node3D"), (1, "numbers", numbers(F.concat(x, F.lit(".5")), y, z), ""), (2, "from9", numbers(x, y, z), ""),
             (2, "upto9", numbers(*[F.lit(v) for v in (1, 0, 0, 0, 1, 0, 0, 0, 1)]), ""), (3, "literal", nothing, "true")]
    entries = F.array(*[F.struct(F.lit(s).alias("step"), F.lit(kd).alias("kind"), n.alias("numbers"), F.lit(t).alias("text")) for s, kd, n, t in wants])
    return ex.api_readback(b.keyed_rows(observed, tasks, "row_key"), b.keyed_rows(o.select(key.alias("row_key"), F.inline(entries)), tasks, "row_key"))


def _config(spark, sf):
    """Term tables read back per order: a weight, a flag, a metric list and a gain list, some of them wrong."""
    orders = b.table(spark, sf, "orders").select("o_orderkey")
    tasks, o = b.tasks_of(orders), b.spread(orders)
    k = F.col("o_orderkey")
    key = F.concat(F.lit("trainer/"), k.cast("string"))
    weight = k % 40 / F.lit(8.0)
    seen = F.when(k % 13 == 1, weight + 0.5).otherwise(weight + 1e-7)
    table = F.to_json(F.struct(
        F.struct(F.struct(seen.alias("weight")).alias("pose")).alias("rewards"),
        F.struct(F.struct((k % 31 != 2).alias("use_default_offset")).alias("joint_pos")).alias("actions"),
        F.array(F.lit("mean_action_acc"), F.when(k % 37 == 3, "other").otherwise("rom_clearance")).alias("metrics"),
        F.struct(F.struct(F.when(k % 41 == 4, F.array().cast("array<double>")).otherwise(F.array(weight, weight)).alias("stiffness")).alias("pd")).alias("actuators"),
    ))
    observed = o.select(key.alias("row_key"), F.lit("rank1").alias("candidate"), table.alias("table_json"))
    wants = [("$.rewards.pose.weight", "close", weight.cast("string")), ("$.actions.joint_pos.use_default_offset", "equal", F.lit("true")),
             ("$.metrics", "member", F.lit("rom_clearance")), ("$.actuators.pd.stiffness", "each", weight.cast("string")), ("$.rewards", "member", F.lit("pose"))]
    entries = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(kd).alias("kind"), e.alias("expected")) for p, kd, e in wants])
    return ex.config_readback(b.keyed_rows(observed, tasks, "row_key"), b.keyed_rows(o.select(key.alias("row_key"), F.inline(entries)), tasks, "row_key"))


def _method_returns(spark, sf):
    """Every method formula on the order lines' numbers; the return is printed, numbers rounded to 6 places."""
    li = b.spread(b.table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"))
    p, s, n = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    ints = {"a": p % 19 - 9, "b": s % 19 - 9}
    reals = {"a": F.col("l_quantity"), "b": F.col("l_discount") * 8, "t": n / F.lit(8.0), "c": p % 2 == 0, "x": p % 11 - F.lit(5.5), "y": s % 11 - F.lit(5.5), "v": F.col("l_quantity"), "cap": F.lit(30.0), "flip": s % 2 == 0}
    flags = {"a": p % 2 == 0, "b": s % 2 == 0, "c": n % 2 == 0}
    three = {"a": F.col("l_quantity"), "b": F.col("l_tax") * 512, "c": F.lit(3.0)}
    lit = lambda **kw: {k: F.lit(v) for k, v in kw.items()}
    made = {
        "scale_add": ex.method_return("scale_add", ints, lit(k=3, c=-2)), "blend": ex.method_return("blend", reals, {}),
        "clamp_sum": ex.method_return("clamp_sum", ints, lit(lo=-4, hi=5)), "pick": ex.method_return("pick", reals, lit(k=1.5)),
        "in_band": ex.method_return("in_band", reals, lit(lo=-2.5, hi=2.5)), "branch_sum": ex.method_return("branch_sum", ints, lit(k=4)),
        "speed_cap": ex.method_return("speed_cap", reals, lit(g=1.25)), "either": ex.method_return("either", flags, {}),
        "min_max": ex.method_return("min_max", three, {}), "compare_scale": ex.method_return("compare_scale", ints, lit(k=2)),
        "weighted": ex.method_return("weighted", reals, lit(w1=0.25, w2=0.75)),
    }
    shown = {name: (value.cast("string") if name in ("in_band", "either", "compare_scale") else F.format_string("%.3f", value.cast("double"))) for name, value in made.items()}
    entries = F.array(*[F.struct(F.lit(name).alias("template"), value.alias("ret")) for name, value in shown.items()])
    return li.select(F.inline(entries)).groupBy("template", "ret").agg(F.count(F.lit(1)).alias("n"))


def _step_effects(spark, sf):
    """Effects of step programs per order: output text, produced files, content."""
    o = b.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    template = F.get(F.array(F.lit("write"), F.lit("write_then_read"), F.lit("run_print"), F.lit("write_then_count")), (k % 4).cast("int"))
    count = k % 3 + 1
    lines = F.when(template == "write_then_read", "WRITE_FILE#3 exit 0\nREAD_FILE#5 exit 0").otherwise(
        F.concat(F.when(template == "run_print", F.when(k % 10 == 6, k + 1).otherwise(k)).otherwise(count).cast("string"), F.lit("\nRUN#3 exit 0"))
    )
    wanted = F.transform(F.sequence(F.lit(1), count.cast("int")), lambda i: F.concat(F.lit("f"), i.cast("string")))
    produced = F.when(k % 11 == 3, F.slice(wanted, 2, 9)).otherwise(wanted)
    observed = o.select(
        k.cast("string").alias("row_key"), F.lit("rank1").alias("candidate"), template.alias("template_id"), (k % 13 != 7).alias("runs"), lines.alias("output"),
        produced.alias("produced"), wanted.alias("wanted"), F.lit("hello").alias("text"), F.when(k % 20 == 8, "hell").otherwise("hello").alias("content"),
        F.when(template == "run_print", k).otherwise(count).alias("number"),
    )
    return ex.step_effects(observed)


QUERIES = {
    "trace_ticks": _ticks,
    "on_delay": _on_delay,
    "press_hold": _press_hold,
    "walk_expect": _walk,
    "face_expect": _face,
    "clamp_speed": _clamp_speed,
    "steps_until_failure": lambda spark, sf: tr.steps_until_failure(_steps(spark, sf), USER, "tick", "code", "hour"),
    "performed_steps": lambda spark, sf: tr.performed_steps(_steps(spark, sf), USER, "tick", "code", "hour").select("user_id", "tick"),
    "trace_diff": _trace_diff,
    "reference_matches": _reference_matches,
    "trace_json_ticks": _trace_json,
    "trace_pick": _pick_traces,
    "api_readback": _api,
    "config_readback": _config,
    "csharp_formula_expect": _method_returns,
    "step_effects": _step_effects,
}


def _t(sql: str) -> str:
    return f"WITH {b.TRACE_SQL} {sql}"


_OUT = """
WITH li AS (SELECT l_orderkey, l_linenumber, max(l_partkey) AS p, max(l_quantity) AS q, max(l_returnflag) AS f FROM lineitem GROUP BY ALL),
pts AS (
  SELECT l_orderkey AS row_key, l_linenumber, p, n.name, 'rank' || c.rank AS candidate, CASE n.name WHEN 'speed' THEN NOT (c.rank = 3 AND p % 50 = 7)
    WHEN 'held' THEN NOT (c.rank = 5 AND (p % 40 = 3 OR p % 90 = 11)) ELSE NOT (c.rank = 5 AND p % 60 = 4) END AS same
  FROM li, (VALUES (1), (3), (5)) c(rank), (VALUES ('speed'), ('held'), ('state')) n(name)
)
"""

ORACLES = {
    "trace_ticks": _t("SELECT user_id, tick, event_id FROM ticks"),
    "on_delay": _t(
        "SELECT user_id, tick, tick - coalesce(max(CASE WHEN tracker_ok THEN tick END) OVER (PARTITION BY user_id ORDER BY tick), -1) >= user_id % 3 + 1 AS frozen FROM ticks"
    ),
    "press_hold": _t(
        """, edges AS (SELECT *, CASE WHEN btn AND NOT coalesce(lag(btn) OVER (PARTITION BY user_id ORDER BY tick), false) THEN tick END AS edge FROM ticks)
        SELECT user_id, tick, CAST(CASE WHEN tick - max(edge) OVER (PARTITION BY user_id ORDER BY tick) < user_id % 3 + 1 THEN user_id % 9 + 1 ELSE 0 END AS INT) AS style FROM edges"""
    ),
    "walk_expect": "SELECT user_id, bool_and(event_id % 197 <> 5) AS effect_matches FROM events GROUP BY user_id",
    "face_expect": _t("SELECT user_id, bool_and(NOT (event_id % 211 = 3 AND abs(lx - ly) > 1e-6)) AS effect_matches FROM ticks GROUP BY user_id"),
    "clamp_speed": _t("SELECT user_id, tick, greatest(0.0::DOUBLE, least(lx * (0.5::DOUBLE + user_id % 8), 0.25::DOUBLE * (user_id % 16))) AS speed FROM ticks"),
    "steps_until_failure": _t(
        """, f AS (SELECT *, min(CASE WHEN event_id % 173 = 9 THEN tick END) OVER (PARTITION BY user_id) AS stop FROM ticks)
        SELECT user_id, count(*) FILTER (stop IS NULL OR tick < stop) AS steps, bool_and(stop IS NULL) AS runs FROM f GROUP BY user_id"""
    ),
    "performed_steps": _t(
        """, f AS (SELECT *, max(CASE WHEN event_id % 173 = 9 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS failed FROM ticks)
        SELECT user_id, tick FROM f WHERE coalesce(failed, 0) = 0"""
    ),
    "trace_diff": _OUT + "SELECT row_key, candidate, bool_and(same) AS effect_matches, count(*) FILTER (NOT same) AS differences FROM pts GROUP BY ALL",
    "reference_matches": _OUT
    + """SELECT row_key, candidate, bool_and(CASE WHEN row_key % 2 = 1 THEN same ELSE NOT (p % 300 = 1) AND same END) AS effect_matches FROM pts
        WHERE name = CASE WHEN row_key % 2 = 1 THEN 'held' ELSE 'speed' END GROUP BY ALL HAVING NOT (candidate = 'rank5' AND row_key % 2 = 1 AND bool_and(p % 90 = 11))""",
    "trace_json_ticks": """SELECT event_id, CAST(t.tick AS INT) AS tick, CAST(t.tick * 0.125 AS DOUBLE) AS at, CASE t.tick WHEN 0 THEN '[n, kind]' ELSE '[n, on]' END AS names,
        CASE t.tick WHEN 0 THEN CAST(event_id AS VARCHAR) ELSE '7' END AS n FROM events, (VALUES (0), (1)) t(tick)""",
    "trace_pick": """
        WITH names AS (SELECT n_name AS name, row_number() OVER (ORDER BY n_name) - 1 AS place, count(*) OVER () AS n FROM nation)
        SELECT o_orderkey AS seed, CAST(p.pick AS INT) AS pick, name FROM orders, (VALUES (0), (1), (2)) p(pick), names WHERE (o_orderkey + 5 * p.pick) % n = place""",
    "api_readback": "SELECT 'fbd/' || o_orderkey AS row_key, 'rank1' AS candidate, NOT (o_orderkey % 23 = 5 OR (o_orderkey % 17 = 2) OR o_orderkey % 19 = 4 OR o_orderkey % 29 = 6) AS effect_matches FROM orders",
    "config_readback": "SELECT 'trainer/' || o_orderkey AS row_key, 'rank1' AS candidate, NOT (o_orderkey % 13 = 1 OR o_orderkey % 31 = 2 OR o_orderkey % 37 = 3 OR o_orderkey % 41 = 4) AS effect_matches FROM orders",
    "csharp_formula_expect": """
        WITH v AS (SELECT l_partkey % 19 - 9 AS a, l_suppkey % 19 - 9 AS b, l_quantity AS q, l_discount * 8 AS d, l_tax * 512 AS x3, l_linenumber / 8.0::DOUBLE AS t, l_partkey % 2 = 0 AS pe, l_suppkey % 2 = 0 AS se,
          l_linenumber % 2 = 0 AS ne, l_partkey % 11 - 5.5::DOUBLE AS x, l_suppkey % 11 - 5.5::DOUBLE AS y FROM lineitem),
        r AS (
          SELECT 'scale_add' AS template, printf('%.3f', (a * 3 + b + 2)::DOUBLE) AS ret FROM v
          UNION ALL SELECT 'blend', printf('%.3f', q * (1.0::DOUBLE - t) + d * t) FROM v
          UNION ALL SELECT 'clamp_sum', printf('%.3f', greatest(-4, least(a + b, 5))::DOUBLE) FROM v
          UNION ALL SELECT 'pick', printf('%.3f', CASE WHEN pe THEN q * 1.5::DOUBLE ELSE d END) FROM v
          UNION ALL SELECT 'in_band', CAST((x BETWEEN -2.5 AND 2.5) OR y < -2.5 AS VARCHAR) FROM v
          UNION ALL SELECT 'branch_sum', printf('%.3f', (CASE WHEN a + b > a - b THEN (a + b) * 4 ELSE a - b END)::DOUBLE) FROM v
          UNION ALL SELECT 'speed_cap', printf('%.3f', least(q * 1.25::DOUBLE, 30.0::DOUBLE)) FROM v
          UNION ALL SELECT 'either', CAST((pe OR se) AND NOT ne AS VARCHAR) FROM v
          UNION ALL SELECT 'min_max', printf('%.3f', greatest(least(q, x3), 3.0::DOUBLE)) FROM v
          UNION ALL SELECT 'compare_scale', CAST(a * 2 <> b AND a * 2 >= 0 AS VARCHAR) FROM v
          UNION ALL SELECT 'weighted', printf('%.3f', q * w + d * (1.0::DOUBLE - w)) FROM (SELECT *, CASE WHEN se THEN 0.75::DOUBLE ELSE 0.25::DOUBLE END AS w FROM v))
        SELECT template, ret, count(*) AS n FROM r GROUP BY ALL""",
    "step_effects": """
        WITH o AS (SELECT o_orderkey AS k, o_orderkey % 4 AS t, o_orderkey % 3 + 1 AS c FROM orders)
        SELECT CAST(k AS VARCHAR) AS row_key, 'rank1' AS candidate, k % 13 <> 7 AND CASE t WHEN 0 THEN k % 11 <> 3 AND k % 20 <> 8 WHEN 1 THEN k % 11 <> 3 WHEN 2 THEN k % 10 <> 6 ELSE k % 11 <> 3 END AS effect_matches FROM o""",
}
