"""Expected effects in closed form, and the comparison with what was observed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill import schemas
from labelmill.functions import numeric as nm
from labelmill.functions import text as tx


# --- controllers -----------------------------------------------------------------


def walk(lx: Column, ly: Column, gain: Column, cap: Column) -> dict[str, Column]:
    """Both axes scaled by the gain; speed is the x axis between 0 and the cap."""
    return {"move_x": lx * gain, "move_z": ly * gain, "speed": nm.clamp(lx * gain, 0.0, cap)}


def face(lx: Column, ly: Column) -> dict[str, Column]:
    return {"face_x": lx, "face_z": ly}


def capped_speed(lx: Column, gain: Column, cap: Column) -> Column:
    return nm.clamp(lx * gain, 0.0, cap)


def matches_signals(expected: dict[str, Column], observed: dict[str, Column]) -> Column:
    """Every named signal within the signal tolerance."""
    same = F.lit(True)
    for name, want in expected.items():
        same = same & nm.within(observed[name], want, nm.SIGNAL_TOLERANCE)
    return same


def all_ticks(checked: DataFrame, keys: list[str], ok: Column) -> DataFrame:
    """effect_matches per key: true when every tick of every trace is."""
    return checked.groupBy(*keys).agg(F.bool_and(F.coalesce(ok, F.lit(False))).alias("effect_matches"))


# --- step programs ---------------------------------------------------------------


def prints_line(output: Column, line: Column) -> Column:
    """Whether the captured output has the line on its own."""
    return F.contains(F.concat(F.lit("\n"), output, F.lit("\n")), F.concat(F.lit("\n"), line, F.lit("\n")))


def produced_all(produced: Column, wanted: Column) -> Column:
    return F.size(F.array_except(wanted, produced)) == 0


def step_effects(observed: DataFrame) -> DataFrame:
    """Step-program effects: observed(row_key, candidate, template_id, runs, output, produced array,
    wanted array, text, content, number) -> (row_key, candidate, effect_matches).

    write: the file holds the text; write_then_read: the file is there and the
    read exited 0; run_print: the number is a line of the output;
    write_then_count: the count is a line and every file is there.
    """
    there = produced_all(F.col("produced"), F.col("wanted"))
    number = F.col("number").cast("string")
    effect = (
        F.when(F.col("template_id") == "write", there & F.col("content").eqNullSafe(F.col("text")))
        .when(F.col("template_id") == "write_then_read", there & F.contains("output", F.lit("READ_FILE#5 exit 0")))
        .when(F.col("template_id") == "run_print", prints_line(F.col("output"), number))
        .when(F.col("template_id") == "write_then_count", there & prints_line(F.col("output"), number))
    )
    return observed.select(
        "row_key", "candidate", (F.col("runs") & F.coalesce(effect, F.lit(False))).alias("effect_matches")
    )


# --- readbacks -------------------------------------------------------------------


def api_readback(results: DataFrame, expectations: DataFrame) -> DataFrame:
    """Returns of performed calls against an expectation table.

    results(row_key, candidate, result_json); expectations(row_key, step, kind,
    numbers array, text). Kinds: numbers (vector within tolerance), exact
    (vector equal), count (as many numbers as ``numbers`` has), text (string
    name), literal (the printed text), unit (a vector of length 1),
    from9 / upto9 (the origin or the basis of a 12-vector), some (any number),
    differs (not what the step whose number is in ``text`` printed).

    (row_key, candidate, effect_matches); a step that did not run fails, and so does a
    row that is expected but has no results: its candidate is the empty string.
    """
    parsed = results.select("row_key", "candidate", F.from_json("result_json", schemas.RESULTS).alias("r"))
    step = F.get("r", F.col("step"))
    returned = parsed.join(expectations, "row_key", "right").select(
        "row_key", F.coalesce("candidate", F.lit("")).alias("candidate"),
        F.when(F.col("kind") == "differs", step["ok"] & ~step["ret"].eqNullSafe(F.get("r", F.col("text").try_cast("int"))["ret"]))
        .otherwise(tx.let(F.when(step["ok"], step["ret"]), _returned)).alias("ok")
    )
    return all_ticks(returned, ["row_key", "candidate"], F.col("ok"))


def _returned(ret: Column) -> Column:
    """Whether one printed return is what its expectation row asks for."""
    kind, want = F.col("kind"), F.col("numbers")

    def of_numbers(got: Column) -> Column:
        twelve = F.size(got) == 12
        return (
            F.when(kind == "numbers", nm.same_vector(got, want))
            .when(kind == "exact", nm.same_vector(got, want, 0.0))
            .when(kind == "count", F.size(got) == F.size(want))
            .when(kind == "some", F.size(got) > 0)
            .when(kind == "unit", (F.size(got) == 3) & nm.within(nm.norm(got), F.lit(1.0), nm.READBACK_TOLERANCE))
            .when(kind == "from9", twelve & nm.same_vector(F.slice(got, 10, 3), want))
            .when(kind == "upto9", twelve & nm.same_vector(F.slice(got, 1, 9), want))
        )

    return (
        F.when(kind == "text", tx.bare_string(ret) == F.col("text"))
        .when(kind == "literal", F.coalesce(ret == F.col("text"), F.lit(False)))
        .otherwise(tx.let(tx.numbers_in(ret), of_numbers))
    )


def config_readback(tables: DataFrame, expectations: DataFrame) -> DataFrame:
    """A term table read back against expected values.

    tables(row_key, candidate, table_json); expectations(row_key, path, kind,
    expected). Kinds: close (tolerant number), equal (same JSON scalar),
    member (a list or map under the path holds the name), each (a non-empty list
    of numbers all close). Paths are JSON paths such as ``$.rewards.pose.weight``.
    A row that is expected but has no table fails, its candidate the empty string.
    """
    value = F.call_function("get_json_object", F.col("table_json"), F.col("path"))
    checked = tables.join(expectations, "row_key", "right").select("row_key", F.coalesce("candidate", F.lit("")).alias("candidate"), tx.let(value, _configured).alias("ok"))
    return all_ticks(checked, ["row_key", "candidate"], F.col("ok"))


def _configured(value: Column) -> Column:
    """Whether one value of a term table is what its expectation row asks for."""
    kind, expected = F.col("kind"), F.col("expected")
    items = F.from_json(value, "array<string>")
    each = tx.let(items, lambda vs: F.forall(vs, lambda v: nm.close_config(v, expected)) & (F.size(vs) > 0))
    return (
        F.when(kind == "close", nm.close_config(value, expected))
        .when(kind == "equal", value == expected)
        .when(kind == "member", F.array_contains(F.coalesce(F.json_object_keys(value), items), expected))
        .when(kind == "each", each)
    )


# --- translated methods ----------------------------------------------------------


def method_return(template: str, arg: dict[str, Column], p: dict[str, Column]) -> Column:
    """What a seeded method returns on one tick's inputs; ``p`` holds its drawn constants."""
    a, b, c = arg.get("a"), arg.get("b"), arg.get("c")
    if template == "scale_add":
        return a * p["k"] + b - p["c"]
    if template == "blend":
        return a * (F.lit(1.0) - arg["t"]) + b * arg["t"]
    if template == "clamp_sum":
        return F.greatest(p["lo"], F.least(a + b, p["hi"]))
    if template == "pick":
        return F.when(c, a * p["k"]).otherwise(b)
    if template == "in_band":
        x, y = arg["x"], arg["y"]
        return x.between(p["lo"], p["hi"]) | (y < p["lo"])
    if template == "branch_sum":
        return F.when(a + b > a - b, (a + b) * p["k"]).otherwise(a - b)
    if template == "speed_cap":
        return F.least(arg["v"] * p["g"], arg["cap"])
    if template == "either":
        return (a | b) & ~c
    if template == "min_max":
        return F.greatest(F.least(a, b), c)
    if template == "compare_scale":
        return (a * p["k"] != b) & (a * p["k"] >= 0)
    if template == "weighted":
        w = F.when(arg["flip"], p["w2"]).otherwise(p["w1"])
        return a * w + b * (F.lit(1.0) - w)
    raise KeyError(template)


# --- coverage --------------------------------------------------------------------


def uncovered_signatures(table: DataFrame, used: DataFrame, excluded: DataFrame) -> DataFrame:
    """Signatures of a table no program uses and no exclusion names: (signature)."""
    covered = used.select("signature").union(excluded.select("signature")).distinct()
    return table.select("signature").join(covered, "signature", "left_anti")
