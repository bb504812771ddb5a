"""Program text and program tables: parsing, rendering, edits, mutations, composition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.functions import literals as lt
from labelmill.functions import programs as pg
from labelmill.functions import tables
from labelmill.functions import text as tx
from labelmill.operators import compose, expectations, methods, mutations
from labelmill.operators import programs as op
from labelmill.plans import bindings as b
from labelmill.sources import files


def _kinds_parse(spark, sf):
    p = b.programs(spark, sf)
    kinds = pg.block_kinds(F.col("text"))
    return p.select("doc_id", F.array_join(kinds, ",").alias("kinds"), F.size(kinds).alias("n"))


def _xml_kinds(spark, sf):
    return b.programs(spark, sf).select("doc_id", F.array_join(pg.xml_kinds(F.col("xml")), ",").alias("kinds"))


def _signatures(spark, sf):
    used = b.programs(spark, sf).select("doc_id", F.explode(pg.signatures(F.col("text"))).alias("signature"))
    return used.groupBy("doc_id", "signature").agg(F.count(F.lit(1)).alias("n"))


def _used(spark, sf):
    return b.programs(spark, sf).select(F.explode(F.array_distinct(pg.signatures(F.col("text")))).alias("signature"))


def _covered(spark, sf):
    return _used(spark, sf).agg(F.countDistinct("signature").alias("covered"))


def _uncovered(spark, sf):
    """The table of signatures is the line numbers' getters; get_5 is excluded by name."""
    numbers = b.table(spark, sf, "lineitem").select("l_linenumber").distinct()
    declared = numbers.select(F.explode(F.array(F.col("l_linenumber"), F.col("l_linenumber") + 20)).alias("n"))
    declared = declared.select(F.concat(F.lit("Node.get_"), F.col("n").cast("string")).alias("signature"))
    excluded = numbers.filter("l_linenumber = 5").select(F.lit("Node.get_25").alias("signature"))
    return expectations.uncovered_signatures(declared, _used(spark, sf), excluded)


def _line_classes(spark, sf):
    lines = b.programs(spark, sf).select(F.explode(tx.lines_of(F.col("text"))).alias("line"))
    return lines.groupBy(pg.line_class(F.col("line")).alias("line_class")).agg(F.count(F.lit(1)).alias("n"))


def _mutations(spark, sf):
    p = b.programs(spark, sf).select("doc_id", "text")
    return mutations.mutations(p).select("doc_id", "stage", "line", "new")


def _first_mutation(spark, sf):
    p = b.programs(spark, sf).select("doc_id", "text")
    return mutations.first_mutation(p).select("doc_id", F.sha2("mutated", 256).alias("sha"))


def _first_visible(spark, sf):
    runs = b.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("row_key"), (F.col("l_linenumber") - 1).alias("ordinal"), (F.col("l_suppkey") % 5).alias("trace"),
        (F.col("l_suppkey") % 5 < 3).alias("picked"), F.col("l_returnflag").alias("output"),
    )
    return mutations.first_visible(runs)


def _step_text() -> Column:
    text = F.replace(F.replace("text", F.lit(" = MOVE("), F.lit(" = RUN(")), F.lit(" = NOT("), F.lit(" = WRITE_FILE("))
    return F.replace(F.replace(text, F.lit(".OUT"), F.lit(".ENO")), F.lit("IN2=1)"), F.lit('TEXT="one")'))


def _drop_last_step(spark, sf):
    p = b.programs(spark, sf).select("doc_id", _step_text().alias("text"))
    return p.select("doc_id", F.sha2(mutations.drop_last_step(F.col("text")), 256).alias("sha"))


def _change_hold(spark, sf):
    held = F.when(F.col("doc_id") % 3 == 0, F.regexp_replace("text", r"PT=T#(\d+)ms", "PT=$1.5")).when(
        F.col("doc_id") % 3 == 1, F.regexp_replace("text", r"IN2=(\d+)\)", "IN1=$1)")
    ).otherwise(F.replace("text", F.lit("R=x"), F.lit("IN1=TRUE")))
    return b.programs(spark, sf).select("doc_id", F.sha2(mutations.change_hold(held), 256).alias("sha"))


def _refused_forms(spark, sf):
    t = F.col("text")
    forms = {
        "input": mutations.refuse_input(t),
        "declared": mutations.refuse_declared_input(t),
        "kind": mutations.refuse_kind(t),
        "signature": mutations.refuse_signature(t, "Node3D.set_scale"),
    }
    entries = [F.struct(F.lit(n).alias("form"), F.sha2(v, 256).alias("sha")) for n, v in forms.items()]
    return b.programs(spark, sf).select("doc_id", F.inline(F.array(*entries)))


PAIRS = [(0, "src0", "src1"), (1, "src2", "src3"), (2, "src0", "src4")]


def _compose(spark, sf):
    p = b.programs(spark, sf)
    rows = p.select(
        "template_id", F.floor(F.col("doc_id") / 20).alias("seed"), F.concat(F.lit("do p"), F.col("doc_id").cast("string")).alias("intent"), "frame_id",
        F.col("text").alias("rank1"), mutations.refuse_declared_input(F.col("text")).alias("rank3"), mutations.refuse_kind(F.col("text")).alias("rank5"),
        F.array().cast("array<string>").alias("traces"),
    )
    pairs = spark.createDataFrame(PAIRS, "pair int, a_id string, b_id string")
    made = compose.compose(rows, pairs)
    return made.select(
        "template_id", "seed", "intent", "frame_id", *[F.sha2(r, 256).alias(r) for r in ("rank1", "rank3", "rank5")]
    )


def _render_lines(spark, sf):
    return op.render_lines(*b.program_tables(spark, sf)).select("program", "section", "pos", "line")


def _render_text(spark, sf):
    return op.render_text(op.render_lines(*b.program_tables(spark, sf))).select("program", "part", F.sha2("text", 256).alias("sha"))


def _edits(spark: SparkSession, sf: str) -> DataFrame:
    """One edit per order whose key ends in a given digit; some name an absent block or pin."""
    o = b.table(spark, sf, "orders")
    last = F.col("o_orderkey") % 10
    null = F.lit(None).cast("string")
    kind = F.when(last == 1, "set_pin").when(last == 2, "swap_pins").when(last == 3, "drop_pin").when(last == 4, "set_kind")
    absent = F.col("o_orderkey") % 110 == 1
    value = F.struct(
        F.lit("string").alias("tag"), F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("text"), null.alias("pin"), F.lit(None).cast("double").alias("num")
    )
    return o.filter(last.between(1, 4)).select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("program"), kind.alias("op"),
        F.concat(F.when(absent, "z").otherwise("b"), F.col("o_orderkey").cast("string")).alias("block_id"),
        F.when(F.col("o_orderkey") % 120 == 2, "NOPE").when(last < 4, F.lit("IN2")).alias("pin"),
        F.when(last == 2, F.lit("NOTE")).alias("pin2"), F.when(last == 4, F.lit("ADD")).alias("kind"), value.alias("value"),
    )


def _shown_pins(pin: DataFrame) -> DataFrame:
    return pin.select("program", "block_id", "pos", "name", lt.value_text(F.col("value")).alias("val"))


def _pins_after(edit):
    def query(spark, sf):
        _, _, _, pin, _ = b.program_tables(spark, sf)
        return _shown_pins(edit(pin, _edits(spark, sf)))

    return query


def _set_kind(spark, sf):
    _, _, block, _, _ = b.program_tables(spark, sf)
    return op.set_kinds(block, _edits(spark, sf)).select("program", "id", "kind")


def _edit_problems(spark, sf):
    _, _, block, pin, _ = b.program_tables(spark, sf)
    return op.edit_problems(block, pin, _edits(spark, sf))


def _append_blocks(spark, sf):
    _, _, block, _, _ = b.program_tables(spark, sf)
    customers = b.table(spark, sf, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("program"))
    added = customers.select("program", F.lit(0).cast("bigint").alias("pos"), F.lit("b_new").alias("id"), F.lit("NOT").alias("kind"), F.lit(None).cast("string").alias("sig"))
    return op.append(block, added).filter("id = 'b_new'").select("program", "pos", "id", "kind")


def _program_values(spark, sf):
    _, _, _, pin, write = b.program_tables(spark, sf)
    return op.values(pin, write).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


def _program_kinds(spark, sf):
    _, _, block, _, _ = b.program_tables(spark, sf)
    kinds = op.kinds(block).select("program", F.lit("kind").alias("what"), F.col("kind").alias("name"))
    called = op.signatures(block).select("program", F.lit("signature").alias("what"), F.col("signature").alias("name"))
    return kinds.unionByName(called).groupBy("program", "what", "name").agg(F.count(F.lit(1)).alias("n"))


def _value_problems(spark, sf):
    """Page addresses and pages as string values: the ones carrying a forbidden character are refused."""
    pages = b.table(spark, sf, "pages")
    null = F.lit(None)
    value = F.struct(F.lit("string").alias("tag"), F.col("shown").alias("text"), null.cast("string").alias("pin"), null.cast("double").alias("num"))
    shown = F.array(F.struct(F.lit("url").alias("name"), F.col("url").alias("shown")), F.struct(F.lit("html").alias("name"), F.col("html").alias("shown")))
    pin = pages.select(F.col("page_id").cast("string").alias("program"), F.inline(shown)).select("program", "name", value.alias("value"))
    return op.value_problems(pin, pin.limit(0)).select("program", "name", F.sha2("problem", 256).alias("sha"))


def _call_program(spark, sf):
    """A call per order in its customer's program; every step but the first waits for the one before."""
    o = b.table(spark, sf, "orders").select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("program"), "o_orderkey", "o_orderstatus",
        F.floor(F.col("o_orderkey") / 100000).alias("chunk"),
    )
    key = F.col("o_orderkey").cast("string")
    calls = o.select(
        "program", "o_orderkey", "chunk", F.concat(F.lit("s"), key).alias("name"), F.concat(F.lit("Order.set_"), "o_orderstatus").alias("sig"), F.lit('"desk"').alias("target"),
        F.array(
            F.struct(F.lit("key").alias("name"), key.alias("value")),
            F.struct(F.lit("src").alias("name"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("s"), key, F.lit(".RET"))).otherwise("x.y").alias("value")),
        ).alias("args"),
    )
    return op.call_program(calls, ["o_orderkey"], "chunk")


def _literals(spark, sf):
    li = b.table(spark, sf, "lineitem")
    return li.select(
        lt.fixed_real(F.col("l_extendedprice"), 3).alias("price"), lt.fixed_real(F.col("l_discount"), 4).alias("discount"),
        lt.duration(F.col("l_partkey") * 125).alias("hold"),
    ).groupBy("price", "discount", "hold").agg(F.count(F.lit(1)).alias("n"))


def _numbers(spark, sf):
    d = b.table(spark, sf, "documents")
    found = tx.numbers_in(F.col("text"))
    return d.select("doc_id", F.size(found).alias("n"), F.array_max(found).alias("largest")).filter("n > 0")


# --- methods -------------------------------------------------------------------------


def _sources(spark: SparkSession, sf: str) -> DataFrame:
    d = b.spread(b.table(spark, sf, "documents").select("doc_id", "source", "text"))

    def one(s: Column, i: Column) -> Column:
        h, n = F.length(s), i.cast("string")
        header = (
            F.when(h % 7 == 0, F.concat(F.lit("func f"), n, F.lit("(a: int, b: float) -> int:")))
            .when(h % 7 == 1, F.concat(F.lit("func f"), n, F.lit("() -> int:")))
            .when(h % 7 == 2, F.concat(F.lit("func f"), n, F.lit("(a: String) -> bool:")))
            .when(h % 7 == 3, F.concat(F.lit("func f"), n, F.lit("(a: int) -> String:")))
            .when(h % 7 == 4, F.concat(F.lit("func f"), n, F.lit("(a: int):")))
            .when(h % 7 == 5, F.concat(F.lit("func _f"), n, F.lit("(a: int) -> int:")))
            .otherwise(F.concat(F.lit("func udon_f"), n, F.lit("(a, b: int = 3) -> float:")))
        )
        body = F.when(h % 3 == 0, "\n\treturn a\nvar x = 1\n\tstray").when(h % 3 == 1, "\n\tvar c = a\n\n\treturn c").otherwise("")
        return F.concat(header, body)

    text = F.array_join(F.transform(b._parts(F.col("text")), one), "\n")
    return d.select(F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".gd")).alias("path"), F.concat(F.lit("extends Node\n"), text).alias("text"))


def _segments(spark, sf):
    m = methods.segments(_sources(spark, sf))
    return m.select(
        "path", "name", F.array_join(F.transform("params", lambda p: F.concat_ws(":", p["name"], p["type"])), ",").alias("params"),
        F.coalesce("ret", F.lit("-")).alias("ret"), F.array_join("body", "|").alias("body"),
    )


def _segments_by_function(spark, sf):
    """The methods again, from the table function over the sources' lines, many to a row, in SQL."""
    tables.register(spark)
    return spark.sql(
        """SELECT path, name, array_join(transform(params, p -> concat_ws(':', p.name, p.type)), ',') AS params, coalesce(ret, '-') AS ret, array_join(body, '|') AS body
        FROM method_segments(TABLE(SELECT path, line, value FROM {lines}))""",
        lines=files.line_runs(_sources(spark, sf)),
    )


def _header_refusals(spark, sf):
    found = methods.header_refusals(methods.segments(_sources(spark, sf)))
    return found.select("path", "name", F.coalesce("reason", F.lit("-")).alias("reason"))


def _refusal_tally(spark, sf):
    return methods.refusal_tally(methods.header_refusals(methods.segments(_sources(spark, sf))))


QUERIES = {
    "block_kinds_parse": _kinds_parse,
    "xml_kinds": _xml_kinds,
    "signatures": _signatures,
    "signatures_covered": _covered,
    "uncovered_signatures": _uncovered,
    "line_classes": _line_classes,
    "mutations": _mutations,
    "first_mutation": _first_mutation,
    "first_visible_mutation": _first_visible,
    "drop_last_step": _drop_last_step,
    "change_hold": _change_hold,
    "refused_forms": _refused_forms,
    "compose_pair": _compose,
    "render_program": _render_lines,
    "render_text": _render_text,
    "edit_set_pin": _pins_after(op.set_pins),
    "edit_swap_pins": _pins_after(op.swap_pins),
    "edit_drop_pin": _pins_after(op.drop_pins),
    "edit_set_kind": _set_kind,
    "edit_problems": _edit_problems,
    "append_blocks": _append_blocks,
    "program_values": _program_values,
    "program_kinds": _program_kinds,
    "forbidden_strings": _value_problems,
    "call_program": _call_program,
    "literal_forms": _literals,
    "numbers_in_text": _numbers,
    "method_segments": _segments,
    "method_segments_function": _segments_by_function,
    "method_header_refusals": _header_refusals,
    "refusal_tally": _refusal_tally,
}


def _programs(sql: str) -> str:
    return f"WITH {b.PROGRAMS_SQL} {sql}"


_LINES = r""", prog_lines AS (SELECT doc_id, string_split(substr(text, 1, length(text) - 1), chr(10)) AS ls FROM programs),
numbered AS (SELECT doc_id, unnest(range(0, len(ls))) AS line, unnest(ls) AS old FROM prog_lines)
"""

_MUTATIONS = _LINES + r""",
firsts AS (
  SELECT doc_id, min(line) FILTER (regexp_matches(old, '^\w+ = [A-Z_]+\(')) AS block_at, min(line) FILTER (regexp_matches(old, 'T#\d+ms')) AS time_at,
    min(line) FILTER (regexp_matches(old, '=-?\d+\.\d+')) AS real_at, min(line) FILTER (regexp_matches(old, '=-?\d+([^.\d]|$)')) AS int_at,
    min(line) FILTER (regexp_matches(old, '= [A-Z_]+\(.*?IN1=\w+(\.\w+)?, IN2=\w+(\.\w+)?')) AS pair_at
  FROM numbered GROUP BY doc_id
),
at_lines AS (SELECT n.*, f.* EXCLUDE (doc_id), regexp_extract(old, '^\w+ = ([A-Z_]+)\(', 1) AS kind FROM numbered n JOIN firsts f ON n.doc_id = f.doc_id),
made AS (
  SELECT doc_id, 0 AS stage, 0 AS pin, line, old, regexp_replace(old, 'S1=(\w+(\.\w+)?), R=(\w+(\.\w+)?)', 'S1=\3, R=\1') AS new FROM at_lines WHERE line = block_at AND kind = 'SR'
  UNION ALL SELECT doc_id, 1, 0, line, old, regexp_replace(old, '^(\w+ = )[A-Z_]+\(', '\1' || m.other || '(') FROM at_lines
    JOIN (VALUES ('AND','OR'),('OR','AND'),('XOR','OR'),('NOT','MOVE'),('TON','TOF'),('TOF','TON'),('MIN','MAX'),('MAX','MIN'),('ADD','SUB'),('SUB','ADD'),('MUL','ADD'),('LT','GE'),('GE','LT')) m(kind, other) USING (kind)
  UNION ALL SELECT doc_id, 2, 0, line, old, regexp_replace(old, 'T#\d+ms', 'T#' || (2 * TRY_CAST(regexp_extract(old, 'T#(\d+)ms', 1) AS BIGINT)) || 'ms') FROM at_lines WHERE line = time_at
  UNION ALL SELECT doc_id, 3, 0, line, old, regexp_replace(old, '=-?\d+\.\d+', '=' || (TRY_CAST(regexp_extract(old, '=(-?\d+\.\d+)', 1) AS DOUBLE) + 1)) FROM at_lines WHERE line = real_at
  UNION ALL SELECT doc_id, 4, 0, line, old, regexp_replace(old, '=-?\d+([^.\d]|$)', '=' || (TRY_CAST(regexp_extract(old, '=(-?\d+)([^.\d]|$)', 1) AS BIGINT) + 1) || '\1') FROM at_lines WHERE line = int_at
  UNION ALL SELECT doc_id, 5, 0, line, old, regexp_replace(old, 'IN1=(\w+(\.\w+)?), IN2=(\w+(\.\w+)?)', 'IN1=\3, IN2=\1') FROM at_lines
    WHERE line = pair_at AND kind NOT IN ('AND','OR','XOR','ADD','MUL','MIN','MAX','EQ','NE')
  UNION ALL SELECT doc_id, 6, p.ord, line, old, regexp_replace(old, p.pin || '=([abxy])([^A-Za-z0-9_.]|$)', p.pin || '=' || CASE regexp_extract(old, p.pin || '=([abxy])([^A-Za-z0-9_.]|$)', 1)
      WHEN 'a' THEN 'c' WHEN 'b' THEN 'd' WHEN 'x' THEN 'y' ELSE 'x' END || '\2')
    FROM at_lines, (VALUES (0, 'IN'), (1, 'IN1'), (2, 'IN2'), (4, 'S1')) p(ord, pin) WHERE regexp_matches(old, p.pin || '=[abxy]([^A-Za-z0-9_.]|$)')
),
muts AS (SELECT * FROM made WHERE new <> old)
"""

_STEPS = r""", steps AS (
  SELECT doc_id, replace(replace(replace(replace(text, ' = MOVE(', ' = RUN('), ' = NOT(', ' = WRITE_FILE('), '.OUT', '.ENO'), 'IN2=1)', 'TEXT="one")') AS text FROM programs),
step_lists AS (SELECT doc_id, text, string_split(substr(text, 1, length(text) - 1), chr(10)) AS ls FROM steps),
step_at AS (SELECT *, list_filter(range(1, len(ls) + 1), lambda i: regexp_matches(ls[i], '^\w+ = (RUN|WRITE_FILE|READ_FILE)\(')) AS ix FROM step_lists)
"""

_CLASS = r"""CASE WHEN starts_with(l, 'program ') OR starts_with(l, 'in ') THEN 'skip' WHEN starts_with(l, 'out ') THEN 'out' WHEN starts_with(l, 'var ') THEN 'var'
  WHEN regexp_matches(l, '^\w+ = [A-Z_]+[\[(]') THEN 'block' WHEN contains(l, ' = ') THEN 'write' ELSE 'skip' END"""

# every name of the documents' programs is hold, or b and digits
_NAMES = r"b\d+|hold"
_PREFIX = r"regexp_replace(l, '\b(%s)\b', '{p}\1', 'g')"


def _part(source: str, prefix: str, name: str, names: str) -> str:
    shown = "l" if name == "out" else (_PREFIX % names).format(p=prefix)
    return f"list_transform(list_filter({source}, lambda l: {_CLASS} = '{name}'), lambda l: {shown})"


def merged(a: str, c: str, names: str | None = None) -> str:
    """SQL of the hash of two programs in one; ``names`` is a pattern of what is prefixed."""
    sections = " || ".join(_part(src, prefix, name, names or _NAMES) for name in ("out", "var", "block", "write") for src, prefix in ((a, "a_"), (c, "b_")))
    return (
        "sha256('program compose_' || a_id || '_' || b_id || chr(10) || 'in lx : REAL' || chr(10) || 'in ly : REAL' || chr(10) || 'in btn : BOOL' || chr(10) "
        f"|| 'in tracker_ok : BOOL' || chr(10) || array_to_string({sections}, chr(10)) || chr(10))"
    )


_SOURCES = r"""
srcs AS (
  SELECT source || '/' || doc_id || '.gd' AS path, list_filter(regexp_split_to_array(text, '[.\n]+'), lambda s: length(s) > 0) AS ps FROM documents
),
hdrs AS (SELECT path, unnest(range(0, len(ps))) AS i, length(unnest(ps)) AS h FROM srcs),
meth AS (
  SELECT path, i, h, CASE h % 7 WHEN 5 THEN '_f' WHEN 6 THEN 'udon_f' ELSE 'f' END || i AS name,
    ['a:int,b:float', '', 'a:String', 'a:int', 'a:int', 'a:int', 'a:?,b:int'][h % 7 + 1] AS params, ['int', 'int', 'bool', 'String', '-', 'int', 'float'][h % 7 + 1] AS ret,
    CASE h % 3 WHEN 0 THEN chr(9) || 'return a' WHEN 1 THEN chr(9) || 'var c = a|' || chr(9) || 'return c' ELSE '' END AS body,
    ['-', 'no parameters', 'parameter type: String', 'return type: String', 'void method', 'runtime hook', 'runtime hook'][h % 7 + 1] AS reason
  FROM hdrs
)
"""


def _tables(sql: str) -> str:
    return f"WITH {b.PROGRAM_TABLES_SQL} {sql}"


_EDITS = r""", edit AS (
  SELECT 'c' || o_custkey AS program, o_orderkey % 10 AS d, o_orderkey AS k, CASE WHEN o_orderkey % 110 = 1 THEN 'z' ELSE 'b' END || o_orderkey AS block_id,
    CASE WHEN o_orderkey % 120 = 2 THEN 'NOPE' ELSE 'IN2' END AS pin FROM orders WHERE o_orderkey % 10 BETWEEN 1 AND 4)
"""

_LINES_OF_TABLES = r""",
pin_text AS (SELECT program, block_id, string_agg(name || '=' || val, ', ' ORDER BY pos) AS pins FROM pin GROUP BY ALL),
out_lines AS (
  SELECT 'c' || c_custkey AS program, 0 AS section, 0 AS pos, 'program c' || c_custkey AS line FROM customer
  UNION ALL SELECT 'c' || c_custkey, s.n, 0, s.line FROM customer, (VALUES (1, 'in x : REAL'), (2, 'out ret : REAL'), (3, 'var hold : BOOL'), (5, 'ret = b0.OUT')) s(n, line)
  UNION ALL SELECT program, 4, pos, id || ' = ' || CASE WHEN kind = 'CALL' THEN 'CALL[' || sig || ']' ELSE kind END || '(' || pins || ')'
    FROM block JOIN pin_text USING (program) WHERE block.id = pin_text.block_id
)
"""

ORACLES = {
    "block_kinds_parse": _programs(
        r"""SELECT doc_id, array_to_string(ks, ',') AS kinds, CAST(len(ks) AS INT) AS n FROM (SELECT doc_id, list_filter(regexp_extract_all(text, '(?m)^\w+ = ([A-Z_]+)[\[(]', 1), lambda k: k <> 'CALL')
            || regexp_extract_all(text, 'CALL\[([A-Za-z0-9_]+\.[A-Za-z0-9_]+)\]', 1) AS ks FROM programs)"""
    ),
    "xml_kinds": _programs("SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(xml, 'typeName=\"([A-Z_]+)\"', 1))), ',') AS kinds FROM programs"),
    "signatures": _programs(
        r"SELECT doc_id, signature, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, 'CALL\[([A-Za-z0-9_]+\.[A-Za-z0-9_]+)\]', 1)) AS signature FROM programs) GROUP BY ALL"
    ),
    "signatures_covered": _programs(
        r"SELECT count(DISTINCT s) AS covered FROM (SELECT unnest(regexp_extract_all(text, 'CALL\[([A-Za-z0-9_]+\.[A-Za-z0-9_]+)\]', 1)) AS s FROM programs)"
    ),
    "uncovered_signatures": _programs(
        r"""SELECT signature FROM (SELECT DISTINCT 'Node.get_' || (l_linenumber + d) AS signature FROM lineitem, (VALUES (0), (20)) v(d))
            WHERE signature <> 'Node.get_25' AND signature NOT IN (SELECT unnest(regexp_extract_all(text, 'CALL\[([A-Za-z0-9_]+\.[A-Za-z0-9_]+)\]', 1)) FROM programs)"""
    ),
    "line_classes": _programs(_LINES + f"SELECT {_CLASS.replace('(l,', '(old,')} AS line_class, count(*) AS n FROM numbered GROUP BY 1"),
    "mutations": _programs(_MUTATIONS + "SELECT doc_id, stage, CAST(line AS INT) AS line, new FROM muts"),
    "first_mutation": _programs(
        _MUTATIONS
        + """, chosen AS (SELECT doc_id, min_by(line, (stage, pin, line)) AS line, min_by(new, (stage, pin, line)) AS new FROM muts GROUP BY doc_id)
        SELECT p.doc_id, CASE WHEN c.doc_id IS NOT NULL THEN sha256(array_to_string(list_transform(ls, lambda l, i: CASE WHEN i = c.line + 1 THEN c.new ELSE l END), chr(10)) || chr(10)) END AS sha
        FROM prog_lines p LEFT JOIN chosen c ON p.doc_id = c.doc_id"""
    ),
    "first_visible_mutation": """
        WITH runs AS (SELECT l_orderkey AS row_key, l_linenumber - 1 AS ordinal, l_suppkey % 5 AS trace, l_suppkey % 5 < 3 AS picked, l_returnflag AS output FROM lineitem),
        cmp AS (SELECT r.*, r.output <> f.output AS differs FROM runs r JOIN runs f ON r.row_key = f.row_key AND r.trace = f.trace AND f.ordinal = 0 WHERE r.ordinal > 0),
        best AS (SELECT row_key, min(ordinal) FILTER (differs AND picked) AS p, min(trace * 100 + ordinal) FILTER (differs AND NOT picked) AS s FROM cmp GROUP BY row_key)
        SELECT row_key, CAST(coalesce(p, s % 100) AS INT) AS ordinal, CASE WHEN p IS NULL THEN s // 100 END AS spare_trace FROM best""",
    "drop_last_step": _programs(
        _STEPS
        + r"""SELECT doc_id, sha256(CASE WHEN len(ix) < 2 THEN regexp_replace(text, '(TEXT|ARGS)="([^"]*)"', '\1="\2 x"') ELSE
          array_to_string(list_transform(list_filter(ls, lambda l, i: i <> ix[len(ix)]), lambda l: replace(l, split_part(ls[ix[len(ix)]], ' = ', 1) || '.ENO', split_part(ls[ix[len(ix) - 1]], ' = ', 1) || '.ENO')), chr(10)) || chr(10) END) AS sha FROM step_at"""
    ),
    "change_hold": _programs(
        r""", held AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN regexp_replace(text, 'PT=T#(\d+)ms', 'PT=\1.5', 'g') WHEN 1 THEN regexp_replace(text, 'IN2=(\d+)\)', 'IN1=\1)', 'g')
          ELSE replace(text, 'R=x', 'IN1=TRUE') END AS text FROM programs)
        SELECT doc_id, sha256(CASE WHEN regexp_matches(text, 'PT=\d+\.\d+') THEN regexp_replace(text, 'PT=\d+\.\d+', 'PT=' || (TRY_CAST(regexp_extract(text, 'PT=(\d+\.\d+)', 1) AS DOUBLE) * 2))
          WHEN regexp_matches(text, 'IN1=\d+\)') THEN regexp_replace(text, 'IN1=\d+\)', 'IN1=' || (TRY_CAST(regexp_extract(text, 'IN1=(\d+)\)', 1) AS BIGINT) + 1) || ')')
          ELSE regexp_replace(text, 'IN1=TRUE', 'IN1=FALSE') END) AS sha FROM held"""
    ),
    "refused_forms": _programs(
        r"""SELECT doc_id, f.form, sha256(CASE f.form WHEN 'input' THEN regexp_replace(text, '=(a|n|x)\b', '=zz') WHEN 'declared' THEN regexp_replace(text, '=a\b', '=zz')
              WHEN 'kind' THEN regexp_replace(text, '= (RUN|WRITE_FILE|READ_FILE|SEL|TON|R_TRIG)\(', '= EXEC(') ELSE regexp_replace(text, 'CALL\[[A-Za-z0-9_]+\.[A-Za-z0-9_]+\]', 'CALL[Node3D.set_scale]') END) AS sha
            FROM programs, (VALUES ('input'), ('declared'), ('kind'), ('signature')) f(form)"""
    ),
    "compose_pair": _programs(
        r""", forms AS (SELECT template_id, doc_id // 20 AS seed, 'do p' || doc_id AS intent, frame_id, string_split(substr(text, 1, length(text) - 1), chr(10)) AS r1,
            string_split(regexp_replace(text, '=a\b', '=zz'), chr(10)) AS r3, string_split(regexp_replace(text, '= (RUN|WRITE_FILE|READ_FILE|SEL|TON|R_TRIG)\(', '= EXEC('), chr(10)) AS r5 FROM programs),
        met AS (SELECT p.a_id, p.b_id, a.seed, a.intent || '; and ' || b.intent AS intent, a.frame_id, a.r1 AS a1, a.r3 AS a3, b.r1 AS b1, b.r5 AS b5
          FROM (VALUES ('src0', 'src1'), ('src2', 'src3'), ('src0', 'src4')) p(a_id, b_id) JOIN forms a ON a.template_id = a_id JOIN forms b ON b.template_id = b_id AND a.seed = b.seed)
        """
        + f"SELECT 'compose_' || a_id || '_' || b_id AS template_id, seed, intent, frame_id, {merged('a1', 'b1')} AS rank1, {merged('a3', 'b1')} AS rank3, {merged('a1', 'b5')} AS rank5 FROM met"
    ),
    "render_program": _tables(_LINES_OF_TABLES + "SELECT program, section, pos, line FROM out_lines"),
    "render_text": _tables(_LINES_OF_TABLES + "SELECT program, CAST(0 AS BIGINT) AS part, sha256(string_agg(line, chr(10) ORDER BY section, pos) || chr(10)) AS sha FROM out_lines GROUP BY program"),
    "edit_set_pin": _tables(
        _EDITS
        + """SELECT p.program, p.block_id, pos, name, CASE WHEN e.k IS NOT NULL THEN '"v' || e.k || '"' ELSE val END AS val
        FROM pin p LEFT JOIN edit e ON e.d = 1 AND p.program = e.program AND p.block_id = e.block_id AND p.name = e.pin"""
    ),
    "edit_swap_pins": _tables(
        _EDITS
        + """SELECT p.program, p.block_id, p.pos, p.name, coalesce(o.val, p.val) AS val FROM pin p
        LEFT JOIN edit e ON e.d = 2 AND p.program = e.program AND p.block_id = e.block_id AND p.name IN (e.pin, 'NOTE')
        LEFT JOIN pin o ON o.program = e.program AND o.block_id = e.block_id AND o.name = CASE WHEN p.name = 'NOTE' THEN e.pin ELSE 'NOTE' END"""
    ),
    "edit_drop_pin": _tables(_EDITS + "SELECT p.* FROM pin p ANTI JOIN edit e ON e.d = 3 AND p.program = e.program AND p.block_id = e.block_id AND p.name = e.pin"),
    "edit_set_kind": _tables(_EDITS + "SELECT b.program, b.id, CASE WHEN e.k IS NOT NULL THEN 'ADD' ELSE kind END AS kind FROM block b LEFT JOIN edit e ON e.d = 4 AND b.program = e.program AND b.id = e.block_id"),
    "edit_problems": _tables(
        _EDITS
        + """SELECT program, 'no block ' || block_id || ' in ' || program AS problem FROM edit WHERE block_id LIKE 'z%'
        UNION ALL SELECT program, block_id || ' has no pin NOPE' FROM edit WHERE pin = 'NOPE' AND block_id LIKE 'b%' AND d IN (1, 2)"""
    ),
    "append_blocks": _tables("SELECT 'c' || c_custkey AS program, coalesce(max(o_orderkey) + 1, 0) AS pos, 'b_new' AS id, 'NOT' AS kind FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey"),
    "program_values": _tables("SELECT text, count(*) AS n FROM (SELECT val AS text FROM pin UNION ALL SELECT 'b0.OUT' FROM customer) GROUP BY text"),
    "program_kinds": _tables(
        "SELECT program, what, name, count(*) AS n FROM (SELECT program, 'kind' AS what, kind AS name FROM block UNION ALL SELECT program, 'signature', sig FROM block WHERE kind = 'CALL') GROUP BY ALL"
    ),
    "forbidden_strings": """SELECT program, name, sha256('literal carries a forbidden character: ' || shown) AS sha
        FROM (SELECT CAST(page_id AS VARCHAR) AS program, 'url' AS name, url AS shown FROM pages UNION ALL SELECT CAST(page_id AS VARCHAR), 'html', html FROM pages)
        WHERE regexp_matches(shown, '["''<>&]')""",
    "call_program": """
        WITH s AS (SELECT 'c' || o_custkey AS program, row_number() OVER w - 1 AS step, 's' || o_orderkey AS name, lag('s' || o_orderkey) OVER w AS prev,
          'Order.set_' || o_orderstatus AS sig, o_orderkey AS k FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
        SELECT program, step, name || ' = CALL[' || sig || '](' || coalesce('EN=' || prev || '.ENO, ', '') || 'TARGET="desk", key="' || k || '", src='
          || CASE WHEN k % 2 = 0 THEN 's' || k || '.RET' ELSE '"x.y"' END || ')' AS line FROM s
        UNION ALL SELECT program, -1, 'done = ' || max_by(name, step) || '.ENO' FROM s GROUP BY program""",
    "literal_forms": r"""
        WITH v AS (SELECT rtrim(printf('%.3f', l_extendedprice), '0') AS p, rtrim(printf('%.4f', l_discount), '0') AS d, l_partkey * 125 AS ms FROM lineitem)
        SELECT CASE WHEN p LIKE '%.' THEN p || '0' ELSE p END AS price, CASE WHEN d LIKE '%.' THEN d || '0' ELSE d END AS discount,
          CASE WHEN ms % 1000 = 0 THEN 'T#' || ms // 1000 || 's' ELSE 'T#' || ms || 'ms' END AS hold, count(*) AS n FROM v GROUP BY ALL""",
    "numbers_in_text": r"""
        SELECT doc_id, CAST(len(xs) AS INT) AS n, list_max(list_transform(xs, lambda x: CAST(x AS DOUBLE))) AS largest FROM
          (SELECT doc_id, regexp_extract_all(text, '(?:^|[^A-Za-z0-9_])(-?\d+(?:\.\d+)?(?:e[-+]?\d+)?)', 1) AS xs FROM documents) WHERE len(xs) > 0""",
    "method_segments": f"WITH {_SOURCES} SELECT path, name, params, ret, body FROM meth",
    "method_segments_function": f"WITH {_SOURCES} SELECT path, name, params, ret, body FROM meth",
    "method_header_refusals": f"WITH {_SOURCES} SELECT path, name, reason FROM meth",
    "refusal_tally": f"WITH {_SOURCES} SELECT CASE WHEN reason = '-' THEN 'lifted' ELSE split_part(reason, ':', 1) END AS kind, count(*) AS n FROM meth GROUP BY 1",
}
