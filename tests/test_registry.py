"""Table functions, counted draws, the family registry, readbacks of what is not there."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from labelmill.functions import tables
from labelmill.operators import draws, gates, methods
from labelmill.operators import expectations as ex
from labelmill.operators.families import blocks, controllers, registry
from labelmill.sources import files, stage

SOURCE = "extends Node\nfunc a(x: int, y := 2, z) -> int:\n\treturn x\n\n\tx = 1\nnot body\n\tlost\nfunc _b():\r\n\tpass\r\nfunc broken(\n\tnothing\nfunc c( ) ->float :\n"


def test_methods_by_table_function(spark):
    texts = [("a.gd", SOURCE), ("b.gd", ""), ("c.gd", "no methods\n\tat all"), ("d.gd", "func only() -> bool:")]
    sources = spark.createDataFrame(texts, "path string, text string")
    tables.register(spark)
    got = spark.sql("SELECT * FROM method_segments(TABLE({lines}))", lines=files.text_lines(sources).repartition(5))
    want = methods.segments(sources)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect())) and got.count() == 4
    with pytest.raises(AnalysisException, match="needs a column line"):
        spark.sql("SELECT * FROM method_segments(TABLE({x}))", x=sources)
    with pytest.raises(AnalysisException, match="needs length as bigint"):
        spark.sql("SELECT * FROM archive_entries(TABLE(SELECT 'a' AS path, 'b' AS length, 1L AS first, 2L AS last))")


@pytest.mark.parametrize("most", [1, 2, 500])
def test_methods_of_lines_many_to_a_row(spark, most):
    texts = [("a.gd", SOURCE), ("b.gd", ""), ("c.gd", "no methods\n\tat all"), ("d.gd", "func only() -> bool:"), ("e.gd", None), ("f.gd", SOURCE * 3)]
    sources = spark.createDataFrame(texts, "path string, text string")
    tables.register(spark)
    runs = files.line_runs(sources, most)
    got = spark.sql("SELECT * FROM method_segments(TABLE({lines}))", lines=runs.repartition(5))
    want = methods.segments(sources)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    assert runs.count() == sum(-(-len(t.split("\n")) // most) for _, t in texts if t is not None)


def test_ranges_of_files(spark):
    listing = spark.createDataFrame([("a", 0), ("b", 10), ("c", 11), ("d", 25)], "path string, length bigint")
    got = sorted((r["path"], r["first"], r["last"]) for r in tables.archive_ranges(listing, 10).collect())
    assert got == [("a", 0, 0), ("b", 0, 10), ("c", 0, 10), ("c", 10, 11), ("d", 0, 10), ("d", 10, 20), ("d", 20, 25)]


PLAN = {"t": [
    ("u", "uniform", -1.0, 1.0, 3), ("r", "randint", 2, 5), ("c", "choice", [20.0, True, "x"]), ("b", "coin"),
    ("more", "repeat", "r", [("u2", "uniform", 0.5, 0.75, 2)]), ("twice", "repeat", 2, [("u", "uniform", 5.0, 6.0, 1)]), ("d", "derive", None, lambda first: first("r").cast("int") * 2),
]}


def test_counted_draws(spark):
    rows = spark.range(4000).select(F.lit("t").alias("t"), F.col("id").alias("seed"))
    got = rows.withColumn("v", draws.counted(F.col("t"), F.col("seed"), PLAN)).collect()
    assert [r["v"] for r in got] == [r["v"] for r in rows.repartition(7).withColumn("v", draws.counted(F.col("t"), F.col("seed"), PLAN)).orderBy("seed").collect()]
    for r in got:
        v = r["v"]
        assert len(v["u"]) == 3 and -1 <= float(v["u"][0]) <= 1 and all(5 <= float(x) <= 6 for x in v["u"][1:])
        assert int(v["r"][0]) in (2, 3, 4, 5) and len(v["u2"]) == int(v["r"][0]) and all(0.5 <= float(x) <= 0.75 for x in v["u2"])
        assert v["c"][0] in ("20.0", "True", "x") and v["b"][0] in ("True", "False") and int(v["d"][0]) == 2 * int(v["r"][0])
    mean = sum(float(r["v"]["u"][0]) for r in got) / len(got)
    assert abs(mean) < 0.05 and {r["v"]["r"][0] for r in got} == {"2", "3", "4", "5"} and len({r["v"]["u"][0] for r in got}) > 1500
    with pytest.raises(NotImplementedError):
        draws.counted(F.col("t"), F.col("seed"), {"t": [("s", "sample", [1, 2], 1)]})


def test_counted_literals(spark):
    p = spark.createDataFrame([(1, "a = TON(IN=b, PT=T#100ms)\nc = ADD(IN1=1.5, IN2=7)\n"), (2, "no literals")], "seed long, text string")
    got = {r["seed"]: r for r in blocks.perturb(p, F.col("seed"), counted=True).collect()}
    assert got[2]["perturbed"] == "no literals"
    changed = got[1]["perturbed"]
    assert changed.startswith("a = TON(IN=b, PT=T#") and changed.split("T#")[1].split("ms")[0] in map(str, blocks.TIMES_MS) and "." in changed.split("IN1=")[1].split(",")[0]


def test_spaces():
    assert registry.space([("a", "randint", 1, 4), ("b", "uniform", 0.0, 1.0, 1), ("c", "choice", ["x", "x", "y"]), ("d", "coin"), ("e", "derive", None)]) == 4 * 11 * 2 * 2
    assert registry.space([("r", "repeat", 3, [("a", "randint", 1, 2)])]) == 8
    assert registry.space(controllers.DRAWS["face_the_stick"], ("lx", "ly")) == 1
    assert registry.space([("a", "uniform", 0.0, 1.0, 9)] * 3) == registry.MOST_SPACE


def test_from_rows_to_stage(spark, tmp_path):
    out = str(tmp_path / "s")
    wanted = {"fbd": 40, "react": 25, "trainer": 13}
    counts = registry.build(spark, out, wanted, holdout_templates=["write"], holdout_blocks=["LIMIT"])
    assert sum(c["corpus_root"] for c in counts.values()) == 78 and all(c["corpus_candidates"] == c["corpus_scores"] == 3 * c["corpus_root"] for c in counts.values())
    held = {}
    for split, folder in stage.schemas.SPLIT_DIRS.items():
        root = stage.read_split(spark, out, "corpus", folder)["root"].collect()
        held[split] = root
        assert len(root) == counts[split]["corpus_root"]
    assert all(r["template_id"] != "write" and "LIMIT" not in r["blocks"].split(",") for s in ("train", "test") for r in held[s])
    assert all(r["template_id"] == "write" or "LIMIT" in r["blocks"].split(",") for r in held["evaluation"])
    assert all((r["seed"] % 10 == 0) == (s == "test") for s in ("train", "test") for r in held[s])
    xml = stage.read_split(spark, out, "corpus", "data")["candidates"].filter("row_key like 'fbd/%'")
    assert xml.filter("fbd_text <> '' or fbd_xml = ''").count() == 0


def test_what_a_family_cannot_give(spark):
    with pytest.raises(gates.Refused, match="is below the 10000 rows"):
        registry.jobs(spark, "harness", 10_000, {"base": spark.createDataFrame([("and_1", "x")], "name string, text string")})
    with pytest.raises(ValueError, match="needs canonical"):
        registry.rows(registry.jobs(spark, "plan", 5), "plan")
    asked = spark.createDataFrame([("write", 1), ("write", 2)], "template_id string, seed bigint")
    assert [r["subject"] for r in registry.lost(asked, asked.filter("seed = 1"), "fbd").collect()] == ["fbd/write/2"]


def test_never_read_back(spark):
    wants = spark.createDataFrame([("a", "$.x", "equal", "1"), ("b", "$.x", "equal", "1")], "row_key string, path string, kind string, expected string")
    seen = spark.createDataFrame([("a", "rank1", '{"x": 1}')], "row_key string, candidate string, table_json string")
    assert sorted(map(tuple, ex.config_readback(seen, wants).collect())) == [("a", "rank1", True), ("b", "", False)]
    calls = spark.createDataFrame([("a", 0, "literal", [], "1"), ("b", 0, "literal", [], "1")], "row_key string, step int, kind string, numbers array<double>, text string")
    results = spark.createDataFrame([("a", "rank1", '[{"ok": true, "ret": "1", "command": ""}]')], "row_key string, candidate string, result_json string")
    assert sorted(map(tuple, ex.api_readback(results, calls).collect())) == [("a", "rank1", True), ("b", "", False)]


def test_families_give_what_their_templates_can(spark, tmp_path):
    """a program whose blocks only pass values on, or latch late, gives its rows; templates with fewer rows than are asked for give them all."""
    import duckdb

    from labelmill.plans import stages

    # lengths of sentences choose the blocks: 15 a call, 14 a move, 6 a latch, 2 an exclusive or
    lengths = {1: (15, 14), 2: (15, 14, 6), 3: (6,), 4: (2, 14)}
    rows = [(i, ". ".join("x" * (n - bool(k)) for k, n in enumerate(lengths.get(i, (15,)))) + ".", "en", "src1", 1) for i in range(10)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(1, 91).withColumnRenamed("id", "s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    con = duckdb.connect()
    for name in ("documents", "supplier"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    got = {(r.family, r.split, r.relation, r.n) for r in stages.QUERIES["family_stage"](spark, str(tmp_path)).collect()}
    cursor = con.execute(stages.ORACLES["family_stage"])
    names = [d[0] for d in cursor.description]
    assert got == {tuple(dict(zip(names, row))[c] for c in ("family", "split", "relation", "n")) for row in cursor.fetchall()}
    assert sum(n for family, _, relation, n in got if relation == "root" and family == "harness") == 80
