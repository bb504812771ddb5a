"""Programs as tables: rendering, edits and reads.

decl(program, section, pos, name, type), block(program, pos, id, kind, sig),
pin(program, block_id, pos, name, value), write(program, pos, name, value),
with value = struct(tag, text, pin, num).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions import literals as lt
from labelmill.operators import ranking

SECTIONS = {"program": 0, "in": 1, "out": 2, "var": 3, "block": 4, "write": 5}
LINES_PER_PART = 65536


def pin_lists(pin: DataFrame) -> DataFrame:
    """(program, block_id, pins text). A block has as many pins as its kind declares, so the list is short."""
    printed = pin.select("program", "block_id", F.struct("pos", F.concat_ws("=", "name", lt.value_text(F.col("value"))).alias("t")).alias("p"))
    grouped = printed.groupBy("program", "block_id").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    return grouped.select("program", "block_id", F.array_join(F.col("ps.t"), ", ").alias("pins"))


def render_lines(program: DataFrame, decl: DataFrame, block: DataFrame, pin: DataFrame, write: DataFrame) -> DataFrame:
    """The program text as ordered lines: (program, section, pos, line)."""
    head = program.select("program", F.lit(0).alias("section"), F.lit(0).cast("bigint").alias("pos"), F.concat(F.lit("program "), "program").alias("line"))
    section = F.when(F.col("section") == "in", 1).when(F.col("section") == "out", 2).otherwise(3)
    decls = decl.select(
        "program", section.alias("section"), F.col("pos").cast("bigint").alias("pos"),
        F.concat("section", F.lit(" "), "name", F.lit(" : "), "type").alias("line"),
    )
    called = F.concat(F.lit("CALL["), "sig", F.lit("]"))
    kind = F.when((F.col("kind") == "CALL") & F.col("sig").isNotNull(), called).otherwise(F.col("kind"))
    blocks = block.withColumnRenamed("id", "block_id").join(pin_lists(pin), ["program", "block_id"], "left")
    block_lines = blocks.select(
        "program", F.lit(4).alias("section"), F.col("pos").cast("bigint").alias("pos"),
        F.concat("block_id", F.lit(" = "), kind, F.lit("("), F.coalesce("pins", F.lit("")), F.lit(")")).alias("line"),
    )
    writes = write.select(
        "program", F.lit(5).alias("section"), F.col("pos").cast("bigint").alias("pos"),
        F.concat("name", F.lit(" = "), lt.value_text(F.col("value"))).alias("line"),
    )
    return head.unionByName(decls).unionByName(block_lines).unionByName(writes)


def render_text(lines: DataFrame, lines_per_part: int = LINES_PER_PART) -> DataFrame:
    """Lines -> text: (program, part, text), each part ending in a newline.

    A program of ordinary size is one part. A longer one is cut into parts of
    ``lines_per_part`` lines whose concatenation in order is the whole text, so
    no task gathers more than one part.
    """
    chunked = lines.withColumn("_chunk", F.col("section") * F.lit(1 << 40) + F.floor(F.col("pos") / lines_per_part))
    numbered = ranking.positions(chunked, ["program"], ["section", "pos"], "_chunk", "line_no")
    parts = numbered.withColumn("part", F.floor(F.col("line_no") / lines_per_part).cast("bigint"))
    gathered = parts.groupBy("program", "part").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("ls"))
    return gathered.select("program", "part", F.concat(F.array_join(F.col("ls.line"), "\n"), F.lit("\n")).alias("text"))


def value_problems(pin: DataFrame, write: DataFrame) -> DataFrame:
    """Values that cannot be printed: (program, name, problem)."""
    values = pin.select("program", "name", "value").unionByName(write.select("program", "name", "value"))
    return values.select("program", "name", lt.value_refusal(F.col("value")).alias("problem")).filter("problem is not null")


# --- edits -----------------------------------------------------------------------
#
# edit(program, op, block_id, pin, pin2, kind, value), at most one edit per
# (program, block, pin): edits are one small relation joined to the tables, and
# an edit that names nothing is a problem row.


def edit_problems(block: DataFrame, pin: DataFrame, edit: DataFrame) -> DataFrame:
    """Edits naming an absent block or pin: (program, problem). Dropping an absent pin is not a problem."""
    ids = block.select("program", F.col("id").alias("block_id"))
    no_block = edit.join(ids, ["program", "block_id"], "left_anti").select(
        "program", F.concat(F.lit("no block "), "block_id", F.lit(" in "), "program").alias("problem")
    )
    named = edit.filter(F.col("op").isin("set_pin", "swap_pins")).join(ids, ["program", "block_id"], "left_semi")
    wanted = named.select("program", "block_id", F.explode(F.array_compact(F.array("pin", "pin2"))).alias("name"))
    no_pin = wanted.join(pin.select("program", "block_id", "name"), ["program", "block_id", "name"], "left_anti").select(
        "program", F.concat("block_id", F.lit(" has no pin "), "name").alias("problem")
    )
    return no_block.unionByName(no_pin)


def set_pins(pin: DataFrame, edit: DataFrame) -> DataFrame:
    """Replace the named pins' values."""
    new = edit.filter("op = 'set_pin'").select("program", "block_id", F.col("pin").alias("name"), F.col("value").alias("_new"))
    joined = pin.join(new, ["program", "block_id", "name"], "left")
    return joined.withColumn("value", F.coalesce("_new", "value")).select(*pin.columns)


def swap_pins(pin: DataFrame, edit: DataFrame) -> DataFrame:
    """Exchange two pins' values: each pin takes the value of the pin the edit pairs it with."""
    swaps = edit.filter("op = 'swap_pins'")
    pairs = swaps.select("program", "block_id", F.col("pin").alias("name"), F.col("pin2").alias("_from")).unionByName(
        swaps.select("program", "block_id", F.col("pin2").alias("name"), F.col("pin").alias("_from"))
    )
    source = pin.select("program", "block_id", F.col("name").alias("_from"), F.col("value").alias("_new"))
    new = pairs.join(source, ["program", "block_id", "_from"]).drop("_from")
    joined = pin.join(new, ["program", "block_id", "name"], "left")
    return joined.withColumn("value", F.coalesce("_new", "value")).select(*pin.columns)


def drop_pins(pin: DataFrame, edit: DataFrame) -> DataFrame:
    gone = edit.filter("op = 'drop_pin'").select("program", "block_id", F.col("pin").alias("name"))
    return pin.join(gone, ["program", "block_id", "name"], "left_anti").select(*pin.columns)


def set_kinds(block: DataFrame, edit: DataFrame) -> DataFrame:
    new = edit.filter("op = 'set_kind'").select("program", F.col("block_id").alias("id"), F.col("kind").alias("_kind"))
    joined = block.join(new, ["program", "id"], "left")
    return joined.withColumn("kind", F.coalesce("_kind", "kind")).select(*block.columns)


def append(table: DataFrame, added: DataFrame) -> DataFrame:
    """add_block / write: rows go after the program's last position."""
    last = table.join(added.select("program").distinct(), "program", "left_semi").groupBy("program").agg(F.max("pos").alias("_last"))
    placed = added.join(last, "program", "left").withColumn("pos", F.coalesce(F.col("_last") + 1, F.lit(0)) + F.col("pos"))
    return table.unionByName(placed.select(*table.columns))


# --- reads -----------------------------------------------------------------------


def values(pin: DataFrame, write: DataFrame) -> DataFrame:
    """Every value a program reads: pins, then writes."""
    return pin.select("program", lt.value_text(F.col("value")).alias("text")).unionByName(
        write.select("program", lt.value_text(F.col("value")).alias("text"))
    )


def kinds(block: DataFrame) -> DataFrame:
    return block.select("program", "kind")


def signatures(block: DataFrame) -> DataFrame:
    return block.filter((F.col("kind") == "CALL") & F.col("sig").isNotNull()).select("program", F.col("sig").alias("signature"))


# --- call programs ---------------------------------------------------------------


def call_lines(steps: DataFrame) -> DataFrame:
    """Steps -> EN-chained CALL lines.

    steps(program, step, name, sig, target, args array<struct(name, value)>);
    steps are numbered 0.. without gaps, so the previous step is found by an
    equi-join on the number rather than by ordering a whole program, unless the rows
    say it in a column ``previous``, as ``ranking.scan`` gives it. An argument
    naming an earlier block's RET is a wire, everything else a quoted literal.
    """
    if "previous" in steps.columns:
        chained = steps.withColumn("_prev", F.col("previous"))
    else:
        before = steps.select("program", (F.col("step") + 1).alias("step"), F.col("name").alias("_prev"))
        chained = steps.join(before, ["program", "step"], "left")
    enable = F.when(F.col("_prev").isNotNull(), F.array(F.concat(F.lit("EN="), "_prev", F.lit(".ENO")))).otherwise(
        F.array().cast("array<string>")
    )

    def pin(arg: Column) -> Column:
        wire = arg["value"].rlike(r"^[A-Za-z_]\w*\.RET$")
        quoted = F.concat(F.lit('"'), arg["value"], F.lit('"'))
        return F.concat(arg["name"], F.lit("="), F.when(wire, arg["value"]).otherwise(quoted))

    pins = F.concat(enable, F.array(F.concat(F.lit("TARGET="), "target")), F.transform("args", pin))
    line = F.concat("name", F.lit(" = CALL["), "sig", F.lit("]("), F.array_join(pins, ", "), F.lit(")"))
    return chained.select("program", "step", line.alias("line"), *[c for c in ("name", "size") if "size" in steps.columns])


def call_program(calls: DataFrame, order: list[str], chunk: str) -> DataFrame:
    """calls(program, name, sig, target, args, …) in order -> (program, step, line), the closing write as step -1.

    Numbers, previous names and sizes come from one pass over the calls.
    """
    steps = ranking.scan(calls, ["program"], order, chunk, position="step", size="size", previous={"previous": F.col("name")})
    lines = call_lines(steps)
    last = F.when(F.col("step") == F.col("size") - 1, F.concat(F.lit("done = "), "name", F.lit(".ENO")))
    both = F.array(F.struct(F.col("step").cast("bigint").alias("step"), "line"), F.struct(F.lit(-1).cast("bigint").alias("step"), last.alias("line")))
    return lines.select("program", F.inline(both)).filter("line is not null")


def call_done(steps: DataFrame) -> DataFrame:
    """The closing write: done follows the last step's enable output."""
    return steps.groupBy("program").agg(F.max_by("name", "step").alias("_last")).select(
        "program", F.concat(F.lit("done = "), "_last", F.lit(".ENO")).alias("line")
    )
