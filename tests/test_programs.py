import pytest
from pyspark.sql import functions as F

from labelmill.functions import literals as lt
from labelmill.functions import programs as pg
from labelmill.functions import text as tx
from labelmill.operators import compose, methods, mutations
from labelmill.operators import programs as op

VALUE = "struct<tag: string, text: string, pin: string, num: double>"


def one(spark, text, make):
    return spark.createDataFrame([(text,)], "text string").select(make(F.col("text")).alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, kinds",
    [
        ('b3 = WRITE_FILE(PATH="x")', ["WRITE_FILE"]),
        ("a = TON[PT:=T#1s]\nb = c.OUT", ["TON"]),
        ("x = CALL[Anny.build](seed)\ny = AND(a, b)", ["AND", "Anny.build"]),
        ("x = CALL[nodot](s)", []),
        ("  b3 = AND(a)", []),
        ("program p\nvar done : BOOL\n", []),
        ("x = CALL[a.b.c](s)", []),
        ("x = OR(a)\ry = AND(b)", ["OR"]),
    ],
)
def test_block_kinds(spark, text, kinds):
    assert one(spark, text, pg.block_kinds) == kinds


def test_kinds_from_xml_when_text_is_empty(spark):
    rows = [("", '<block typeName="RUN"/><block typeName="CALL"/><block typeName="AND"/>'), ("a = OR(b)", "<x/>")]
    got = spark.createDataFrame(rows, "t string, x string").select(
        pg.block_kinds(pg.kind_source(F.col("t"), F.col("x"))).alias("k")
    )
    assert [r["k"] for r in got.collect()] == [["RUN", "AND"], ["OR"]]


def test_literals(spark):
    rows = [
        (("time_ms", None, None, 2000.0), "T#2s"), (("time_ms", None, None, 500.0), "T#500ms"),
        (("real", None, None, 2.0), "2.0"), (("bool", None, None, 0.0), "FALSE"), (("int", None, None, 30.0), "30"),
        (("ref", "b3", "ENO", None), "b3.ENO"), (("string", "hello", None, None), '"hello"'),
        (("code", "gain", "5.2.7", None), "gain#5.2.7"), (("real", None, None, 1.2), "1.2"),
    ]
    df = spark.createDataFrame(rows, f"v {VALUE}, want string")
    for r in df.select(lt.value_text(F.col("v")).alias("got"), "want").collect():
        assert r["got"] == r["want"]
    for bad in ["it's", "a<b", "x&y", 'say "hi"']:
        assert one(spark, bad, lt.forbidden_string)
    assert one(spark, "1.250", lambda c: lt.fixed_real(c, 3)) == "1.25"
    assert one(spark, "2", lambda c: lt.fixed_real(c, 3)) == "2.0"


def tables(spark):
    program = spark.createDataFrame([("write_hello",)], "program string")
    decl = spark.createDataFrame([("write_hello", "var", 0, "done", "BOOL")], "program string, section string, pos int, name string, type string")
    block = spark.createDataFrame(
        [("write_hello", 0, "b3", "WRITE_FILE", None), ("write_hello", 1, "b5", "READ_FILE", None)],
        "program string, pos int, id string, kind string, sig string",
    )
    pin = spark.createDataFrame(
        [
            ("write_hello", "b3", 0, "PATH", ("string", "out.txt", None, None)),
            ("write_hello", "b3", 1, "TEXT", ("string", "hello", None, None)),
            ("write_hello", "b5", 0, "EN", ("ref", "b3", "ENO", None)),
            ("write_hello", "b5", 1, "PATH", ("string", "out.txt", None, None)),
        ],
        f"program string, block_id string, pos int, name string, value {VALUE}",
    )
    write = spark.createDataFrame([("write_hello", 0, "done", ("ref", "b5", "ENO", None))], f"program string, pos int, name string, value {VALUE}")
    return program, decl, block, pin, write


def edit(spark, *rows):
    return spark.createDataFrame(
        [("write_hello", *r) for r in rows],
        f"program string, op string, block_id string, pin string, pin2 string, kind string, value {VALUE}",
    )


def rendered(program, decl, block, pin, write, **kw):
    parts = op.render_text(op.render_lines(program, decl, block, pin, write), **kw).orderBy("part").collect()
    return "".join(r["text"] for r in parts)


HELLO = (
    "program write_hello\nvar done : BOOL\n"
    'b3 = WRITE_FILE(PATH="out.txt", TEXT="hello")\nb5 = READ_FILE(EN=b3.ENO, PATH="out.txt")\ndone = b5.ENO\n'
)


def test_render(spark):
    t = tables(spark)
    assert rendered(*t) == HELLO
    assert rendered(*t, lines_per_part=2) == HELLO


def test_edits(spark):
    program, decl, block, pin, write = tables(spark)
    e = edit(spark, ("set_pin", "b3", "TEXT", None, None, ("string", "goodbye", None, None)))
    assert 'TEXT="goodbye"' in rendered(program, decl, block, op.set_pins(pin, e), write)
    e = edit(spark, ("drop_pin", "b3", "TEXT", None, None, None))
    assert "TEXT=" not in rendered(program, decl, block, op.drop_pins(pin, e), write)
    e = edit(spark, ("swap_pins", "b3", "PATH", "TEXT", None, None))
    assert 'b3 = WRITE_FILE(PATH="hello", TEXT="out.txt")' in rendered(program, decl, block, op.swap_pins(pin, e), write)
    e = edit(spark, ("set_kind", "b5", None, None, "WRITE_FILE", None))
    assert "b5 = WRITE_FILE(" in rendered(program, decl, op.set_kinds(block, e), pin, write)
    e = edit(spark, ("set_pin", "b9", "PATH", None, None, None), ("set_pin", "b3", "NOPE", None, None, None))
    problems = sorted(r["problem"] for r in op.edit_problems(block, pin, e).collect())
    assert problems == ["b3 has no pin NOPE", "no block b9 in write_hello"]
    more = spark.createDataFrame([("write_hello", 0, "b7", "CALL", "Node3D.set_position")], block.schema)
    grown = op.append(block, more)
    assert [r["signature"] for r in op.signatures(grown).collect()] == ["Node3D.set_position"]
    assert sorted(r["pos"] for r in grown.collect()) == [0, 1, 2]
    assert op.values(pin, write).count() == 5


def test_call_program(spark):
    steps = spark.createDataFrame(
        [
            ("p", 0, "n", "Node.get_node", '"/root/F"', [("path", "Body")]),
            ("p", 1, "s", "Node3D.set_position", "n.RET", [("position", "Vector3(1.0, 0.0, 0.0)")]),
            ("p", 2, "g", "Object.get", "n.RET", [("from", "s.RET")]),
        ],
        "program string, step int, name string, sig string, target string, args array<struct<name: string, value: string>>",
    )
    lines = [r["line"] for r in op.call_lines(steps).orderBy("step").collect()]
    assert lines == [
        'n = CALL[Node.get_node](TARGET="/root/F", path="Body")',
        's = CALL[Node3D.set_position](EN=n.ENO, TARGET=n.RET, position="Vector3(1.0, 0.0, 0.0)")',
        "g = CALL[Object.get](EN=s.ENO, TARGET=n.RET, from=s.RET)",
    ]
    assert op.call_done(steps).first()["line"] == "done = g.ENO"


def edits_of(spark, text):
    rows = mutations.mutations(spark.createDataFrame([(text,)], "text string")).orderBy("ordinal").collect()
    return [(r["stage"], r["line"], r["new"]) for r in rows]


def test_mutations_in_order(spark):
    text = "program p\nin a : BOOL\nl = SR(S1=a, R=b)\nt = TON(IN=l.Q1, PT=T#250ms)\ns = SUB(IN1=x, IN2=1.5)\nm = LIMIT(MN=0, IN=n, MX=3)\nw = s.OUT\n"
    assert edits_of(spark, text) == [
        (0, 2, "l = SR(S1=b, R=a)"),
        (1, 3, "t = TOF(IN=l.Q1, PT=T#250ms)"),
        (1, 4, "s = ADD(IN1=x, IN2=1.5)"),
        (2, 3, "t = TON(IN=l.Q1, PT=T#500ms)"),
        (3, 4, "s = SUB(IN1=x, IN2=2.5)"),
        (4, 5, "m = LIMIT(MN=1, IN=n, MX=3)"),
        # the pair's second operand is a word and an optional word: ``1.5`` counts
        (5, 4, "s = SUB(IN1=1.5, IN2=x)"),
        (6, 5, "m = LIMIT(MN=0, IN=m, MX=3)"),
        (6, 4, "s = SUB(IN1=y, IN2=1.5)"),
        (6, 2, "l = SR(S1=c, R=b)"),
    ]


def test_nary_kinds_and_nothing_to_mutate(spark):
    assert edits_of(spark, "a = AND(IN1=p, IN2=q, IN3=r)")[0] == (1, 0, "a = OR(IN1=p, IN2=q, IN3=r)")
    assert edits_of(spark, "program p\n") == []
    assert edits_of(spark, "a = SUB(IN1=p, IN2=q, IN3=r)") == [(5, 0, "a = SUB(IN1=q, IN2=p, IN3=r)")]


def test_apply_edit(spark):
    text = "program p\nt = TON(IN=a, PT=T#250ms)\n"
    got = mutations.first_mutation(spark.createDataFrame([(text,)], "text string")).first()["mutated"]
    assert got == "program p\nt = TOF(IN=a, PT=T#250ms)\n"


def test_first_visible(spark):
    rows = []
    for key, outputs in {
        "seen": {0: "abc", 1: "abc", 2: "abX"},
        "spare": {0: "abcd", 1: "abcd", 2: "abcY"},
        "blind": {0: "ab", 1: "ab"},
    }.items():
        for ordinal, out in outputs.items():
            rows += [(key, ordinal, i, i < 3, ch) for i, ch in enumerate(out)]
    runs = spark.createDataFrame(rows, "row_key string, ordinal int, trace int, picked boolean, output string")
    got = {r["row_key"]: (r["ordinal"], r["spare_trace"]) for r in mutations.first_visible(runs).collect()}
    assert got == {"seen": (2, None), "spare": (2, 3), "blind": (None, None)}


def test_step_mutations(spark):
    two = 'program p\na = WRITE_FILE(PATH="x")\nb = RUN(EN=a.ENO, CMD="y")\ndone = b.ENO\n'
    assert one(spark, two, mutations.drop_last_step) == 'program p\na = WRITE_FILE(PATH="x")\ndone = a.ENO\n'
    assert one(spark, 'a = WRITE_FILE(TEXT="x", T2="y")\n', mutations.drop_last_step) == 'a = WRITE_FILE(TEXT="x x", T2="y")\n'
    assert one(spark, "t = TON(IN=a, PT=2.5)\nu = TON(PT=2.5)\n", mutations.change_hold) == "t = TON(IN=a, PT=5.0)\nu = TON(PT=2.5)\n"
    assert one(spark, "s = SEL(IN1=4)\n", mutations.change_hold) == "s = SEL(IN1=5)\n"
    assert one(spark, "s = SEL(IN1=TRUE)\n", mutations.change_hold) == "s = SEL(IN1=FALSE)\n"


def test_refused_forms(spark):
    text = "in v : INT\nb = ADD(IN1=v, IN2=a)\nc = TON(IN=a)\nd = RUN(IN=n)\n"
    assert one(spark, text, mutations.refuse_input) == text.replace("IN2=a", "IN2=zz")
    assert one(spark, text, mutations.refuse_declared_input) == text.replace("IN1=v", "IN1=zz")
    assert one(spark, text, mutations.refuse_kind) == text.replace("= TON(", "= EXEC(")
    call = "x = CALL[A.b](s)\ny = CALL[C.d](t)\n"
    assert one(spark, call, lambda c: mutations.refuse_signature(c, "Z.z")) == "x = CALL[Z.z](s)\ny = CALL[C.d](t)\n"


def test_compose(spark):
    a = "program one\nin lx : REAL\nout speed : REAL\nvar g : BOOL\nm = MUL(IN1=lx, IN2=2.0)\ng = m.Q\nspeed = m.OUT\n"
    b = "program two\nin lx : REAL\nout face : REAL\nm = MOVE(IN=lx)\nmm = MOVE(IN=m.OUT)\nface = mm.OUT\n"
    df = spark.createDataFrame([(a, b)], "a string, b string").select(compose.merge(F.col("a"), F.col("b"), F.lit("both"), "in lx : REAL\n").alias("v"))
    assert df.first()["v"] == (
        "program both\nin lx : REAL\nout speed : REAL\nout face : REAL\nvar a_g : BOOL\n"
        "a_m = MUL(IN1=lx, IN2=2.0)\nb_m = MOVE(IN=lx)\nb_mm = MOVE(IN=b_m.OUT)\n"
        "a_g = a_m.Q\nspeed = a_m.OUT\nface = b_mm.OUT\n"
    )


SOURCE = """extends Node

func add_two(a: int, b: int = 3) -> int:
\treturn a + b

\tpass
var x = 1
func no_type(a) -> int:
\treturn a
func bad() -> String:
\treturn ""
func hook_less() -> int:
func void_one(a: int):
\tpass
func arr(a: int) -> Array[int]:
\treturn a
func not a header
\tloose
func bad_param(a: String) -> int:
func udon_x(a: int) -> int:
func _y(a: int) -> int:
"""


def test_methods(spark):
    got = methods.segments(spark.createDataFrame([("f", SOURCE)], "path string, text string")).collect()
    by = {r["name"]: r for r in got}
    assert list(by) == ["add_two", "no_type", "bad", "hook_less", "void_one", "arr", "bad_param", "udon_x", "_y"]
    assert by["add_two"]["body"] == ["\treturn a + b", "\tpass"]
    assert [tuple(p) for p in by["add_two"]["params"]] == [("a", "int"), ("b", "int")]
    assert [tuple(p) for p in by["no_type"]["params"]] == [("a", "?")]
    refusals = methods.header_refusals(methods.segments(spark.createDataFrame([("f", SOURCE)], "path string, text string")))
    why = {r["name"]: r["reason"] for r in refusals.collect()}
    assert why == {
        "add_two": None, "no_type": "parameter type: ?", "bad": "return type: String", "hook_less": "no parameters",
        "void_one": "void method", "arr": "return type: Array[int]", "bad_param": "parameter type: String",
        "udon_x": "runtime hook", "_y": "runtime hook",
    }
    tally = {r["kind"]: r["n"] for r in methods.refusal_tally(refusals).collect()}
    assert tally == {"lifted": 1, "parameter type": 2, "return type": 2, "no parameters": 1, "void method": 1, "runtime hook": 2}


def test_text_helpers(spark):
    params = spark.createDataFrame([("write {text} to {path}", {"text": "a{b}", "path": "x"}), ("{k} {q}", {"k": "1"})], "f string, p map<string, string>")
    got = params.select(tx.fill_placeholders(F.col("f"), F.col("p")).alias("v"), tx.unfilled(F.col("f"), F.col("p")).alias("u")).collect()
    assert [(r["v"], r["u"]) for r in got] == [("write a{b} to x", []), ("1 {q}", ["q"])]
    assert one(spark, "a,b,,", tx.csv_list) == ["a", "b"]
    assert one(spark, "Vector3(1, -2.5, 3e-1) n7", tx.numbers_in) == [1.0, -2.5, 0.3]
    assert one(spark, '&"name"', tx.bare_string) == "name"
    assert one(spark, "ab=12.5 c=7 d=8", lambda c: tx.splice_first(c, mutations.INTEGER, F.lit("9"))) == "ab=12.5 c=9 d=8"
    assert one(spark, "\U0001f600 T#5ms", lambda c: tx.splice_first(c, mutations.TIME, F.lit("Z"))) == "\U0001f600 Z"
