"""Seeded source methods with the traces they are run on and the returns they must give."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions import literals as lt
from labelmill.functions import text as tx
from labelmill.operators import expectations as ex
from labelmill.operators.draws import all_drawn, apart, draw, drawn
from labelmill.operators.families.controllers import _by_template

# The method sources, their parameters and their constants' draws.
TICKS = 12
SOURCES = {
    "scale_add": "public int ScaleAdd(int a, int b)\n{\n    return a * {k} + b - {c};\n}",
    "blend": "public float Blend(float a, float b, float t)\n{\n    return a * (1.0f - t) + b * t;\n}",
    "clamp_sum": "public int ClampSum(int a, int b)\n{\n    return Mathf.Clamp(a + b, {lo}, {hi});\n}",
    "pick": "public float Pick(float a, float b, bool c)\n{\n    return c ? a * {kf} : b;\n}",
    "in_band": "public bool InBand(float x, float y)\n{\n    return x >= {lof} && x <= {hif} || y < {lof};\n}",
    "branch_sum": (
        "public int BranchSum(int a, int b)\n{\n    int s = a + b;\n    int d = a - b;\n    if (s > d)\n    {\n        s = s * {k};\n    }\n"
        "    else\n    {\n        s = d;\n    }\n    return s;\n}"
    ),
    "speed_cap": "public float SpeedCap(float v, float cap)\n{\n    float s = v * {gf};\n    if (s > cap)\n    {\n        s = cap;\n    }\n    return s;\n}",
    "either": "public bool Either(bool a, bool b, bool c)\n{\n    return (a || b) && !c;\n}",
    "min_max": "public float MinMax(float a, float b, float c)\n{\n    return Mathf.Max(Mathf.Min(a, b), c);\n}",
    "compare_scale": "public bool CompareScale(int a, int b)\n{\n    int s = a * {k};\n    return s != b && s >= 0;\n}",
    "weighted": "public float Weighted(float a, float b, bool flip)\n{\n    float w = flip ? {w2f} : {w1f};\n    return a * w + b * (1.0f - w);\n}",
}
PARAMETERS = {
    "scale_add": [("a", "int"), ("b", "int")],
    "blend": [("a", "float"), ("b", "float"), ("t", "float")],
    "clamp_sum": [("a", "int"), ("b", "int")],
    "pick": [("a", "float"), ("b", "float"), ("c", "bool")],
    "in_band": [("x", "float"), ("y", "float")],
    "branch_sum": [("a", "int"), ("b", "int")],
    "speed_cap": [("v", "float"), ("cap", "float")],
    "either": [("a", "bool"), ("b", "bool"), ("c", "bool")],
    "min_max": [("a", "float"), ("b", "float"), ("c", "float")],
    "compare_scale": [("a", "int"), ("b", "int")],
    "weighted": [("a", "float"), ("b", "float"), ("flip", "bool")],
}
CONSTANTS = {
    "scale_add": [("k", "randint", 2, 9), ("c", "randint", -5, 5)],
    "blend": [],
    "clamp_sum": [("lo", "randint", -9, 0), ("hi", "randint", 1, 9)],
    "pick": [("k", "uniform", 0.5, 3.0, 2)],
    "in_band": [("lo", "uniform", -5.0, 0.0, 1), ("hi", "uniform", 0.5, 5.0, 1)],
    "branch_sum": [("k", "randint", 2, 5)],
    "speed_cap": [("g", "uniform", 0.5, 2.0, 2)],
    "either": [],
    "min_max": [],
    "compare_scale": [("k", "randint", 2, 6)],
    "weighted": [("w1", "uniform", 0.1, 0.9, 2), ("w2", "uniform", 0.1, 0.9, 2)],
}
_INPUT = {"int": ("randint", -9, 9), "float": ("uniform", -5.0, 5.0, 3), "bool": ("coin",)}
HEAD = "using UdonSharp;\nusing UnityEngine;\n\npublic class {cls} : UdonSharpBehaviour\n{\n"

DRAWS = {
    f"udon_{name}": [*CONSTANTS[name], ("ticks", "repeat", 3 * TICKS, [(f"in_{p}", *_INPUT[kind]) for p, kind in PARAMETERS[name]])]
    for name in SOURCES
}


def _shown(values: Column, name: str, kind: str, at: Column) -> Column:
    """A drawn input as JSON."""
    text = F.get(all_drawn(values, f"in_{name}"), at)
    return F.lower(text) if kind == "bool" else text


def _trace(values: Column, template: str, nth: int) -> Column:
    def tick(i: Column) -> Column:
        fields = [F.concat(F.lit(f'"{p}": '), _shown(values, p, kind, i + nth * TICKS)) for p, kind in PARAMETERS[template]]
        return F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))

    ticks = F.transform(F.sequence(F.lit(0), F.lit(TICKS - 1)), tick)
    return F.concat(F.lit('{"dt": 0.125, "ticks": ['), F.array_join(ticks, ", "), F.lit("]}"))


def rows(jobs: DataFrame, drawing: Callable = draw) -> DataFrame:
    """jobs(template_id ``udon_<method>``, seed) -> (…, intent = the method, class_name, class_source, traces, values)."""
    seeded = F.col("template_id"), tx.mixed_seed(F.col("seed"), F.col("template_id"))
    made = jobs.withColumn("values", drawing(*seeded, DRAWS)).withColumn("_told", apart(drawing, *seeded, DRAWS, ["ticks"]))
    v, told = F.col("values"), F.col("_told")
    constants = ("k", "c", "lo", "hi", "g", "w1", "w2")
    plain = [part for n in constants for part in (F.lit(n), drawn(told, n))]
    printed = [part for n in constants for part in (F.lit(f"{n}f"), F.concat(lt.fixed_real(drawn(told, n).try_cast("double"), 3), F.lit("f")))]
    source = _by_template({f"udon_{name}": F.lit(text) for name, text in SOURCES.items()})
    method = tx.fill_placeholders(source, F.create_map(*plain, *printed))
    cls = tx.short_id(F.concat_ws("/", "template_id", F.col("seed").cast("string")))
    indented = F.array_join(F.transform(F.split(F.col("intent"), "\n"), lambda line: F.concat(F.lit("    "), line)), "\n")
    traces = _by_template({f"udon_{name}": F.array(*[_trace(v, name, i) for i in range(3)]) for name in SOURCES})
    return made.withColumn("intent", method).withColumn("class_name", cls).select(
        "template_id", "seed", "intent", (F.col("seed") % 3).alias("frame_id"), "class_name",
        F.concat(F.replace(F.lit(HEAD), F.lit("{cls}"), F.col("class_name")), indented, F.lit("\n}\n")).alias("class_source"),
        traces.alias("traces"), "values",
    )


def returns(made: DataFrame) -> DataFrame:
    """What each method returns on each tick of its traces: (template_id, seed, trace, tick, ret)."""
    v = F.col("values")
    typed = {"int": "int", "float": "double", "bool": "boolean"}

    def every(name: str) -> Column:
        """The returns on all ticks: the constants are read once a row, the ticks' inputs side by side."""
        steps, parameters = CONSTANTS[name], PARAMETERS[name]
        kind = {"randint": "int", "uniform": "double"}
        held = F.struct(F.lit(0).alias("_"), *[drawn(v, s[0]).try_cast(kind[s[1]]).alias(s[0]) for s in steps])
        inputs = F.arrays_zip(*[all_drawn(v, f"in_{p}").alias(p) for p, _ in parameters])

        def ret(constants: Column, tick: Column) -> Column:
            given = {p: tick[p].try_cast(typed[k]) for p, k in parameters}
            return ex.method_return(name, given, {s[0]: constants[s[0]] for s in steps}).cast("string")

        return tx.let(held, lambda constants: F.transform(inputs, lambda tick: ret(constants, tick)))

    unknown = F.array_repeat(F.lit(None).cast("string"), 3 * TICKS)
    every_one = _by_template({f"udon_{name}": every(name) for name in SOURCES}).otherwise(unknown)
    ticks = made.select("template_id", "seed", F.posexplode(every_one).alias("at", "ret"))
    return ticks.select(
        "template_id", "seed", F.floor(F.col("at") / TICKS).cast("int").alias("trace"), (F.col("at") % TICKS).alias("tick"), "ret"
    )
