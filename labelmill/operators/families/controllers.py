"""Per-frame controllers over stick, button and tracker inputs, each with three traces."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.functions import literals as lt
from labelmill.functions import text as tx
from labelmill.operators.compose import PAIRS, SHARED_INPUTS, merge
from labelmill.operators.draws import all_drawn, apart, as_params, draw, drawn, with_params
from labelmill.operators.families.frames import FRAMES, pick

# Trace length and tick, and the draws and texts of each template.
TICKS = 12
DT = 0.125


def _hundredths(text: Column) -> Column:
    return F.round(text.cast("double") * 100).cast("bigint")


_SWEEP = ("sweep", "repeat", TICKS, [("lx", "uniform", -1.0, 1.0, 3), ("ly", "uniform", -1.0, 1.0, 3)])

DRAWS = {
    "walk_from_stick": [
        ("gain", "uniform", 0.8, 1.5, 2), ("cap", "uniform", 0.6, 2.0, 2),
        ("wrong", "derive", lambda v: round(v["gain"][0] + 0.5, 2), lambda first: (_hundredths(first("gain")) + 50) / F.lit(100.0)), _SWEEP, _SWEEP,
    ],
    "face_the_stick": [_SWEEP, _SWEEP, _SWEEP],
    "tracker_lost_freezes": [("n", "randint", 2, 6), ("drops", "repeat", 3, [("at", "randint", 2, 5)])],
    "button_sequence_then_idle": [("style", "randint", 1, 9), ("n", "randint", 3, 8)],
    "speed_limited_run": [
        ("gain", "uniform", 1.5, 3.0, 2), ("cap", "uniform", 1.0, 2.5, 2),
        ("wrong", "derive", lambda v: round(v["cap"][0] / 2, 2), lambda first: F.floor(_hundredths(first("cap")) / 2) / F.lit(100.0)), _SWEEP, _SWEEP, _SWEEP,
    ],
}

TEXTS = {
    "walk_from_stick": (
        "program walk_from_stick\n" + SHARED_INPUTS + "out move_x : REAL\nout move_z : REAL\nout speed : REAL\n"
        "mx = MUL(IN1=lx, IN2={g})\nmz = MUL(IN1=ly, IN2={g})\nsp = LIMIT(MN={mn}, IN=mx.OUT, MX={c})\n"
        "move_x = mx.OUT\nmove_z = mz.OUT\nspeed = sp.OUT\n"
    ),
    "face_the_stick": (
        "program face_the_stick\n" + SHARED_INPUTS + "out face_x : REAL\nout face_z : REAL\n"
        "fx = MOVE(IN={x})\nfz = MOVE(IN={z})\nface_x = fx.OUT\nface_z = fz.OUT\n"
    ),
    "tracker_lost_freezes": (
        "program tracker_lost_freezes\n" + SHARED_INPUTS + "out chain_frozen : BOOL\n"
        "nt = NOT(IN=tracker_ok)\nlost = TON(IN=nt.OUT, PT={pt})\nchain_frozen = lost.Q\n"
    ),
    "button_sequence_then_idle": (
        "program button_sequence_then_idle\n" + SHARED_INPUTS + "out style : INT\nvar greeting : BOOL\n"
        "press = R_TRIG(CLK=btn)\nhold = TON(IN=greeting, PT=T#{ms}ms)\ng = SR(S1=press.Q, R=hold.Q)\n"
        "st = SEL(G=g.Q1, IN0=0, IN1={k})\ngreeting = g.Q1\nstyle = st.OUT\n{tail}"
    ),
    "speed_limited_run": (
        "program speed_limited_run\n" + SHARED_INPUTS + "{decl} speed : REAL\n"
        "mx = MUL(IN1=lx, IN2={g})\nsp = LIMIT(MN=0.0, IN=mx.OUT, MX={c})\nspeed = sp.OUT\n"
    ),
}
# What a text has in places that are lines or the words that class one, and what its refused form has there.
SHAPES = {"decl": ("out", "in"), "tail": ("", "style = press.Q\n")}


def _tick(lx: Column, ly: Column, btn: Column, tracker: Column) -> Column:
    return F.concat(
        F.lit('{"lx": '), lx, F.lit(', "ly": '), ly, F.lit(', "btn": '), btn.cast("string"), F.lit(', "tracker_ok": '), tracker.cast("string"), F.lit("}")
    )


def _trace(make) -> Column:
    ticks = F.transform(F.sequence(F.lit(0), F.lit(TICKS - 1)), make)
    return F.concat(F.lit('{"dt": 0.125, "ticks": ['), F.array_join(ticks, ", "), F.lit("]}"))


def sweep_trace(values: Column, nth: int) -> Column:
    """The nth sweep of the stick; its first tick is pinned to the corners."""

    def at(name: str, i: Column, pinned: str) -> Column:
        return F.when(i == 0, pinned).otherwise(F.get(all_drawn(values, name), i + nth * TICKS))

    return _trace(lambda i: _tick(at("lx", i, "1.0"), at("ly", i, "-1.0"), F.lit(False), F.lit(True)))


def pulse_trace() -> Column:
    """The button down on the second tick only."""
    return _trace(lambda i: _tick(F.lit("0.0"), F.lit("0.0"), i == 1, F.lit(True)))


def drop_trace(at: Column) -> Column:
    """The tracker lost from a tick on."""
    return _trace(lambda i: _tick(F.lit("0.0"), F.lit("0.0"), F.lit(False), i < at))


def _by_template(choices: dict[str, Column]) -> Column:
    result = None
    for template, value in choices.items():
        is_it = F.col("template_id") == template
        result = F.when(is_it, value) if result is None else result.when(is_it, value)
    return result


def _texts() -> Column:
    return _by_template({t: F.lit(text) for t, text in TEXTS.items()})


def _drawn_rows(jobs: DataFrame, drawing: Callable) -> DataFrame:
    """jobs(template_id, seed, …) -> rows before their texts are filled: intent, frame_id, the maps ``params``, ``wrong`` and ``refused``, traces, values."""
    carried = [c for c in jobs.columns if c not in ("template_id", "seed")]
    seeded = F.col("template_id"), F.col("seed")
    made = jobs.withColumn("values", drawing(*seeded, DRAWS)).withColumn("_told", apart(drawing, *seeded, DRAWS, ["sweep", "drops"]))
    v, told = F.col("values"), F.col("_told")
    real = lambda name: lt.fixed_real(drawn(told, name), 9)
    ms = drawn(told, "n").cast("int") * 125
    style = drawn(told, "style").cast("int")
    base = as_params(told)
    first = _by_template(
        {
            "walk_from_stick": with_params(base, g=real("gain"), c=real("cap"), mn=F.lit("0.0")),
            "face_the_stick": with_params(base, x=F.lit("lx"), z=F.lit("ly")),
            "tracker_lost_freezes": with_params(base, ms=ms, pt=F.concat(F.lit("T#"), ms.cast("string"), F.lit("ms"))),
            "button_sequence_then_idle": with_params(base, ms=ms, k=style, tail=F.lit(SHAPES["tail"][0])),
            "speed_limited_run": with_params(base, g=real("gain"), c=real("cap"), decl=F.lit(SHAPES["decl"][0])),
        }
    )
    p = F.col("params")
    wrong = _by_template(
        {
            "walk_from_stick": with_params(p, g=real("wrong")),
            "face_the_stick": with_params(p, x=F.lit("ly"), z=F.lit("lx")),
            "tracker_lost_freezes": with_params(p, pt=F.concat(F.lit("T#"), (ms * 2).cast("string"), F.lit("ms"))),
            "button_sequence_then_idle": with_params(p, k=F.when(style < 9, style + 1).otherwise(style - 1)),
            "speed_limited_run": with_params(p, c=real("wrong")),
        }
    )
    refused = _by_template(
        {
            "walk_from_stick": with_params(p, mn=F.lit("TRUE")),
            "face_the_stick": with_params(p, z=F.lit("lz")),
            "tracker_lost_freezes": with_params(p, pt=F.lit("TRUE")),
            "button_sequence_then_idle": with_params(p, tail=F.lit(SHAPES["tail"][1])),
            "speed_limited_run": with_params(p, decl=F.lit(SHAPES["decl"][1])),
        }
    )
    drops = [drop_trace(F.get(all_drawn(v, "at"), i).cast("int")) for i in range(3)]
    traces = _by_template(
        {
            "walk_from_stick": F.array(sweep_trace(v, 0), sweep_trace(v, 1), drop_trace(F.lit(6))),
            "face_the_stick": F.array(*[sweep_trace(v, i) for i in range(3)]),
            "tracker_lost_freezes": F.array(*drops),
            "button_sequence_then_idle": F.array(pulse_trace(), pulse_trace(), drop_trace(F.lit(4))),
            "speed_limited_run": F.array(*[sweep_trace(v, i) for i in range(3)]),
        }
    )
    told = pick(made.withColumn("params", first), FRAMES, F.col("params"))
    return told.select(
        "template_id", "seed", "intent", "frame_id", "params", wrong.alias("wrong"), refused.alias("refused"), traces.alias("traces"), "values", *carried
    )


def rows(jobs: DataFrame, drawing: Callable = draw) -> DataFrame:
    """jobs(template_id, seed, …) -> controller rows, with ``values`` holding the drawn constants. ``drawing`` is a mode of ``draws``."""
    carried = [c for c in jobs.columns if c not in ("template_id", "seed")]
    ranks = {"rank1": "params", "rank3": "wrong", "rank5": "refused"}
    return _drawn_rows(jobs, drawing).select(
        "template_id", "seed", "intent", "frame_id", *[tx.fill_placeholders(_texts(), F.col(params)).alias(rank) for rank, params in ranks.items()],
        "traces", "values", *carried,
    )


def merged_texts(spark: SparkSession) -> DataFrame:
    """(pair, plain, refused): the texts of each pair in one program, and with b's refused form, as pieces to be filled.

    They are merged once a pair, not once a row: what is filled in later, as ``a_`` or
    ``b_`` and its name, is never a line, a line's class, or the name of a block or a local.
    """
    names = sorted({name for text in TEXTS.values() for name in re.findall(r"\{(\w+)\}", text)} - set(SHAPES))
    # a place is one character that is part of no word while the texts are merged
    marks = {(side, name): chr(0xE000 + 256 * at + i) for at, side in enumerate("ab") for i, name in enumerate(names)}

    def marked(template: str, side: str, refused: bool = False) -> str:
        text = TEXTS[template]
        for name, forms in SHAPES.items():
            text = text.replace(f"{{{name}}}", forms[refused])
        return re.sub(r"\{(\w+)\}", lambda m: marks[side, m[1]], text)

    def put(b: str) -> Column:
        text = merge(F.col("a"), F.col(b), F.concat_ws("_", F.lit("compose"), "a_id", "b_id"))
        for (side, name), mark in marks.items():
            text = F.replace(text, F.lit(mark), F.lit(f"{{{side}_{name}}}"))
        return tx.placeholders(text)

    pairs = [(i, a, b, marked(a, "a"), marked(b, "b"), marked(b, "b", True)) for i, (a, b) in enumerate(PAIRS)]
    table = spark.createDataFrame(pairs, "pair int, a_id string, b_id string, a string, b string, b_refused string")
    return table.select("pair", put("b").alias("plain"), put("b_refused").alias("refused"))


def composed_rows(jobs: DataFrame, drawing: Callable = draw) -> DataFrame:
    """jobs(template_id ``compose_<i>``, seed), each once -> two controllers of one seed in one program, as ``compose`` makes them of ``rows``.

    Both sides are drawn where the job is, and fill the merged texts of their pair: no row is shuffled.
    """
    spark = jobs.sparkSession
    numbered = jobs.select("seed", F.substring_index("template_id", "_", -1).cast("int").alias("pair"))
    pairs = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(PAIRS)], "pair int, a_id string, b_id string")
    asked = numbered.join(F.broadcast(pairs), "pair")
    a = _drawn_rows(asked.withColumnRenamed("a_id", "template_id"), drawing).drop("refused", "values")
    of_a = {c: f"a_{c}" for c in ("intent", "frame_id", "params", "wrong", "traces")} | {"template_id": "a_id", "b_id": "template_id"}
    b = _drawn_rows(a.withColumnsRenamed(of_a), drawing).withColumnsRenamed({"refused": "b_refused", "params": "b_params", "intent": "b_intent"})

    def both(of_a: str, of_b: str) -> Column:
        return F.map_concat(F.transform_keys(of_a, lambda name, _: F.concat(F.lit("a_"), name)), F.transform_keys(of_b, lambda name, _: F.concat(F.lit("b_"), name)))

    met = b.select("pair", "seed", "a_id", F.col("template_id").alias("b_id"), *[f"a_{c}" for c in ("intent", "frame_id", "params", "wrong", "traces")], "b_intent", "b_params", "b_refused")
    return met.join(F.broadcast(merged_texts(spark)), "pair").select(
        F.concat_ws("_", F.lit("compose"), "a_id", "b_id").alias("template_id"),
        "seed",
        F.concat("a_intent", F.lit("; and "), "b_intent").alias("intent"),
        F.col("a_frame_id").alias("frame_id"),
        tx.filled(F.col("plain"), both("a_params", "b_params")).alias("rank1"),
        tx.filled(F.col("plain"), both("a_wrong", "b_params")).alias("rank3"),
        tx.filled(F.col("refused"), both("a_params", "b_refused")).alias("rank5"),
        F.col("a_traces").alias("traces"),
    )


def expected_signals(ticks: DataFrame) -> DataFrame:
    """Closed-form outputs of the controllers on their own traces.

    ticks(template_id, seed, trace, tick, lx, ly, values) -> one row per (…, name, num). The
    timed ones follow from the drawn tick of the drop and the pulse's second tick.
    """
    from labelmill.operators import expectations as ex

    v = F.col("values")
    gain, cap = drawn(v, "gain").cast("double"), drawn(v, "cap").cast("double")
    n, style = drawn(v, "n").cast("int"), drawn(v, "style").cast("int")
    walk = ex.walk(F.col("lx"), F.col("ly"), gain, cap)
    face = ex.face(F.col("lx"), F.col("ly"))
    at = F.get(all_drawn(v, "at"), F.col("trace").cast("int")).cast("int")
    frozen = (F.col("tick") >= at + n - 1).cast("double")
    played = F.when((F.col("trace") < 2) & F.col("tick").between(1, n), style).otherwise(0).cast("double")

    def signals(named: dict[str, Column]) -> Column:
        return F.array(*[F.struct(F.lit(name).alias("name"), value.alias("num")) for name, value in named.items()])

    expected = _by_template(
        {
            "walk_from_stick": signals(walk),
            "face_the_stick": signals(face),
            "tracker_lost_freezes": signals({"chain_frozen": frozen}),
            "button_sequence_then_idle": signals({"style": played}),
            "speed_limited_run": signals({"speed": ex.capped_speed(F.col("lx"), gain, cap)}),
        }
    )
    return ticks.select("template_id", "seed", "trace", "tick", F.inline(expected))
