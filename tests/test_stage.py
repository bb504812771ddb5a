import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from labelmill.operators import allocation, census, controls, gates, ranking, relations, splits
from labelmill.sources import files, snapshots, stage

IN_FLIGHT = "family string, template_id string, seed bigint, intent string, frame_id bigint, blocks array<string>, rank1 string, rank3 string, rank5 string"


def in_flight(spark, rows):
    return spark.createDataFrame(
        [("fbd", t, s, f"do {s}", s % 3, b, f"x = {b[0]}(a)\n", "y = NOT(a)\n", "zz\n") for t, s, b in rows], IN_FLIGHT
    )


def scores(spark, rows, broken=()):
    out = []
    for t, s, _ in rows:
        key = f"fbd/{t}/{s}"
        verdicts = {"rank1": (True, True, True), "rank3": (True, True, False), "rank5": (False, False, False)}
        for k, candidate, verdict in broken:
            if k == key:
                verdicts[candidate] = verdict
        out += [(key, c, v[0], v[0], v[1], v[2], 1, 2, "") for c, v in verdicts.items()]
    return spark.createDataFrame(
        out, "row_key string, candidate string, parses boolean, compiles boolean, runs boolean, effect_matches boolean, steps bigint, wall_ms bigint, refusal string"
    )


SPLIT_ROWS = [("a", 0, ["AND"]), ("a", 1, ["AND"]), ("b", 10, ["OR"]), ("held", 2, ["AND"]), ("a", 3, ["MOD"])]


def test_split(spark):
    got = splits.assign(in_flight(spark, SPLIT_ROWS), ["held"], ["MOD"]).select("split", "seed").collect()
    by = {}
    for r in got:
        by.setdefault(r["split"], []).append(r["seed"])
    assert {k: sorted(v) for k, v in by.items()} == {"evaluation": [2, 3], "test": [0, 10], "train": [1]}
    nulls = spark.createDataFrame([("a", 1, ["X", None])], "template_id string, seed bigint, blocks array<string>")
    assert splits.assign(nulls, [], ["MOD"]).first()["split"] == "train"


def written(spark, tmp_path, rows, family="fbd"):
    df = in_flight(spark, rows)
    root, cands = relations.root_rows(df), relations.candidate_rows(df)
    out = str(tmp_path / "stage")
    parts = splits.assign(df, ["held"], ["MOD"])
    counts = {}
    keyed = parts.select(F.concat_ws("/", "family", "template_id", F.col("seed").cast("string")).alias("k"), "split")
    for split in ("train", "test", "evaluation"):
        keys = keyed.filter(F.col("split") == split).select("k")
        counts[split] = stage.write_split(
            spark, out, split, family,
            root.join(keys, F.col("key") == F.col("k"), "left_semi"), cands.join(keys, F.col("row_key") == F.col("k"), "left_semi"),
            scores(spark, rows).join(keys, F.col("row_key") == F.col("k"), "left_semi"),
        )
    registry = spark.createDataFrame([("a",), ("b",), ("held",), ("unused",)], "template_id string")
    manifest = stage.manifest_table(parts, registry, family, ["held"], ["MOD"])
    document = stage.write_manifest(spark, out, manifest, counts=counts)
    return out, counts, document


def test_write_and_read_back(spark, tmp_path):
    out, counts, document = written(spark, tmp_path, SPLIT_ROWS)
    assert counts["train"] == {"fbd_root": 1, "fbd_candidates": 3, "fbd_scores": 3, "fbd": 1}
    assert counts["evaluation"]["fbd"] == 2
    assert document["templates"] == {"a": 3, "b": 1, "held": 1, "unused": 0} and document["rows"] == 5
    assert json.load(open(f"{out}/manifest.json"))["evaluation_rows"] == 2
    assert not [d for d in os.listdir(f"{out}/data") if d.startswith("_staging")]
    assert stage.read_family(spark, out) == "fbd"
    tables = stage.read_split(spark, out, "fbd", "test/data")
    nested = tables["joined"].orderBy("seed").collect()
    assert [c["rank"] for c in nested[0]["candidates"]] == [1, 3, 5]
    assert nested[0]["candidates"][1]["scores"]["compiles"] is True
    assert sorted(relations.unnest_scores(tables["joined"]).collect()) == sorted(tables["scores"].select("row_key", *relations.SCORE_COLUMNS).collect())
    assert sorted(relations.unnest_candidates(tables["joined"]).collect()) == sorted(tables["candidates"].select("row_key", *relations.CANDIDATE_COLUMNS).collect())
    rows = stage.read_census_rows(spark, out)
    assert {r["split"]: r["n"] for r in splits.counts(rows).collect()} == {"train": 1, "test": 2, "evaluation": 2}
    assert stage.read_split(spark, out, "fbd", "holdout/data")["root"].count() == 0
    configs = stage.dataset_configs(
        stage.manifest_table(rows, spark.createDataFrame([("a",)], "template_id string"), "fbd", [], []),
        spark.createDataFrame([("fbd", True), ("fbd_root", False)], "relation string, is_default boolean"),
    )
    assert configs.count() == 6


def test_null_refused_before_anything_is_there(spark, tmp_path):
    df = in_flight(spark, SPLIT_ROWS[:1])
    cands = relations.candidate_rows(df).withColumn("fbd_sha", F.lit(None).cast("string"))
    out = str(tmp_path / "s")
    with pytest.raises(gates.Refused, match=r"fbd_candidates.fbd_sha carries 3 null\(s\)"):
        stage.write_split(spark, out, "train", "fbd", relations.root_rows(df), cands, scores(spark, SPLIT_ROWS[:1]))
    assert not os.path.exists(f"{out}/data") or os.listdir(f"{out}/data") == []
    with pytest.raises(gates.Refused, match="carries 3 null"):
        gates.require_none(gates.null_gate(cands, "fbd_candidates"), "null gate")


def test_empty_split_and_replace_in_place(spark, tmp_path):
    df = in_flight(spark, SPLIT_ROWS)
    base = str(tmp_path / "r")
    assert stage.write_relations(spark, base, {"t": df.limit(0)}) == {"t": 0}
    assert spark.read.parquet(f"{base}/t").columns == df.columns
    assert stage.write_relations(spark, base, {"u": df}) == {"u": 5}
    again = spark.read.parquet(f"{base}/u").withColumn("intent", F.lit("repaired"))
    assert stage.replace_relation(spark, base, "u", again) == 5
    assert spark.read.parquet(f"{base}/u").select("intent").distinct().collect()[0][0] == "repaired"
    with pytest.raises(FileExistsError):
        stage.write_relations(spark, base, {"u": df})


def test_versions(spark, tmp_path):
    """A version whole or not at all; of two writers one is refused; what is replaced may be what was read; nothing is moved."""
    base = str(tmp_path / "v")
    df = in_flight(spark, SPLIT_ROWS)
    schema = df.schema.simpleString()[7:-1].replace(":", " ").replace("array<string>", "array<string>")
    assert snapshots.snapshot(spark, base) == snapshots.Snapshot() and snapshots.read(spark, base, "u", schema).collect() == []
    first = snapshots.commit(spark, base, {"t": df.limit(0), "u": df}, 0)
    assert (first.version, {n: r["rows"] for n, r in first.relations.items()}) == (1, {"t": 0, "u": 5})
    read = snapshots.read(spark, base, "u", schema, 1)
    second = snapshots.commit(spark, base, {"u": read.withColumn("intent", F.lit("repaired"))}, 1)
    assert second.version == 2 and second.relations["t"] == first.relations["t"]
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, base, {"u": df.limit(1)}, 1)
    with pytest.raises(gates.Refused, match=r"u.intent carries 5 null"):
        snapshots.commit(spark, base, {"u": df.withColumn("intent", F.lit(None).cast("string"))}, 2)
    assert snapshots.versions(spark, base) == [1, 2] and len(os.listdir(f"{base}/_data")) == 2
    assert {r["intent"] for r in snapshots.read(spark, base, "u", schema).collect()} == {"repaired"}
    assert {r["intent"] for r in snapshots.read(spark, base, "u", schema, 1).collect()} == {f"do {s}" for _, s, _ in SPLIT_ROWS}
    assert snapshots.expire(spark, base) == [1]
    assert snapshots.read(spark, base, "u", schema).count() == 5 and snapshots.read(spark, base, "t", schema).count() == 0
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, base, "u", schema, 1)


def test_versions_of_a_split(spark, tmp_path):
    df = in_flight(spark, SPLIT_ROWS)
    out = str(tmp_path / "s")
    root, cands, verdicts = relations.root_rows(df), relations.candidate_rows(df), scores(spark, SPLIT_ROWS)
    made = stage.commit_split(spark, out, "test", "fbd", root, cands, verdicts)
    assert {n: r["rows"] for n, r in made.relations.items()} == {"fbd_root": 5, "fbd_candidates": 15, "fbd_scores": 15, "fbd": 5}
    tables = stage.read_split(spark, out, "fbd", "test/data")
    assert tables["candidates"].count() == 15 and tables["joined"].count() == 5
    repaired = tables["candidates"].withColumn("fbd_text", F.concat("fbd_text", F.lit("# seen")))
    assert stage.replace_relation(spark, f"{out}/test/data", "fbd_candidates", repaired, made.version) == 15
    again = stage.read_split(spark, out, "fbd", "test/data")
    assert again["candidates"].filter("fbd_text like '%# seen'").count() == 15 and again["root"].count() == 5
    with pytest.raises(snapshots.Conflict):
        stage.replace_relation(spark, f"{out}/test/data", "fbd_candidates", repaired, made.version)


def test_controls_and_planted_negative(spark):
    rows = [("a", s, ["AND"]) for s in range(5)]
    broken = [("fbd/a/1", "rank1", (True, True, False)), ("fbd/a/2", "rank3", (True, True, True)), ("fbd/a/3", "rank5", (True, False, False))]
    got = {r["row_key"]: r["control"] for r in controls.assert_controls(scores(spark, rows, broken)).collect()}
    assert got == {"fbd/a/1": "identity", "fbd/a/2": "effect", "fbd/a/3": "negative"}
    planted = controls.planted_negative(scores(spark, rows))
    assert controls.assert_controls(scores(spark, rows)).count() == 0
    with pytest.raises(gates.Refused, match="identity control failed"):
        gates.require_none(controls.control_problems(planted), "controls")
    absent = scores(spark, rows).filter("candidate <> 'rank5'")
    assert {r["control"] for r in controls.assert_controls(absent).collect()} == {"negative"}


def test_census_gates_refuse_plants(spark, tmp_path):
    out, _, _ = written(spark, tmp_path, SPLIT_ROWS)
    rows = stage.read_census_rows(spark, out)
    assert census.problems(rows, ["held"], ["MOD"]).count() == 0
    planted = census.planted_leak(rows).first()
    assert planted["kind"] == "AND"
    with pytest.raises(gates.Refused, match="AND leaked into training"):
        gates.require_none(census.problems(rows, [], [planted["kind"]]), "census")
    names = {r["problem"] for r in census.problems(rows, ["a"], ["NOWHERE"]).collect()}
    assert names == {"held-out family a leaked into training", "held-out block kind NOWHERE appears in no holdout row either; the axis is empty"}
    report = {(r["axis"], r["value"]): r["n"] for r in census.report(rows).collect()}
    assert report["rows", "evaluation"] == 2 and report["block_kinds", "AND"] == 1 and report["frames", "a#1"] == 1


def test_missing_reference_is_a_problem(spark):
    root = spark.createDataFrame([("fbd/a/1", "a", 1, 0), ("fbd/a/2", "a", 2, 0)], "key string, template_id string, seed bigint, frame_id bigint")
    cands = spark.createDataFrame([("fbd/a/1", "rank1", "x = AND(a)", "")], "row_key string, candidate string, fbd_text string, fbd_xml string")
    rows = census.census_rows(root, cands, F.lit("fbd"), F.lit("train"))
    assert [r["problem"] for r in census.problems(rows).collect()] == ["root row fbd/a/2 has no rank1 candidate"]


def spaces(spark, **named):
    return spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(named.items())], "ord int, template_id string, space bigint")


def allocated(spark, rows, **named):
    return {r["template_id"]: r["n"] for r in allocation.allocate(spaces(spark, **named), rows).collect()}


def test_allocate(spark):
    assert allocated(spark, 30, a=100, b=3, c=100) == {"a": 14, "b": 3, "c": 13}
    assert allocated(spark, 6, a=3, b=3) == {"a": 3, "b": 3}
    assert allocated(spark, 10**9 + 1, a=10**12, b=1, c=5) == {"a": 10**9 - 5, "b": 1, "c": 5}
    assert allocation.capacity_problem(spaces(spark, a=3, b=3), 30).count() == 1
    assert allocation.capacity_problem(spaces(spark, a=3, b=3), 6).count() == 0
    counts = spark.createDataFrame([(0, "a", 2), (1, "z", 0), (2, "b", 3)], "ord int, template_id string, n bigint")
    jobs = allocation.jobs(allocation.seed_ranges(counts), 2).orderBy("seed").collect()
    assert [(r["template_id"], r["seed"]) for r in jobs] == [("a", 0), ("a", 1), ("b", 2), ("b", 3), ("b", 4)]


def test_allocate_agrees_with_dealing(spark):
    import random

    rng = random.Random(5)
    for _ in range(6):
        named = {f"t{i}": rng.choice([1, 2, 3, 7, 20, 60]) for i in range(rng.randint(1, 7))}
        rows = rng.randint(1, sum(named.values()))
        given = {t: min(s, rows // len(named)) for t, s in named.items()}
        left = rows - sum(given.values())
        while left:
            for t in named:
                if left and given[t] < named[t]:
                    given[t] += 1
                    left -= 1
        assert allocated(spark, rows, **named) == given


def test_chunked_ordering_on_one_hot_key(spark):
    """One key holds most rows; the chunked operators equal the plain definitions."""
    import random

    rng = random.Random(3)
    values = [("hot" if rng.random() < 0.8 else f"k{rng.randint(0, 3)}", i, rng.random() < 0.3) for i in range(600)]
    rng.shuffle(values)
    df = spark.createDataFrame(values, "k string, at int, flag boolean").withColumn("c", F.floor(F.col("at") / 37))
    ranked = ranking.positions(df, ["k"], ["at"], "c", "tick")
    seen = ranking.last_seen(ranked, ["k"], "tick", "c", F.col("flag"), "last")
    got = ranking.previous(seen, ["k"], "tick", "c", F.col("flag"), "was").collect()
    want = {}
    for k in {v[0] for v in values}:
        last, was = None, None
        for tick, (_, at, flag) in enumerate(sorted(v for v in values if v[0] == k)):
            last = tick if flag else last
            want[at] = (tick, last, was)
            was = flag
    assert {r["at"]: (r["tick"], r["last"], r["was"]) for r in got} == want

    def began(rows):
        """Where the flag last began to hold."""
        out, edge, was = [], None, False
        for tick, (_, _, flag) in enumerate(rows):
            edge, was = (tick if flag and not was else edge), flag
            out.append(edge)
        return out

    edges = {at: e for k in {v[0] for v in values} for rows in [sorted(v for v in values if v[0] == k)] for (_, at, _), e in zip(rows, began(rows))}
    sizes = {at: sum(v[0] == k for v in values) for k, at, _ in values}
    flag = F.col("flag")
    by_count = ranking.cut_by_count(df.drop("c"), ["k"], ["at"], "c", 50)
    for chunked in (df, by_count, df.withColumn("c", F.lit(0)), df.withColumn("c", F.col("at"))):
        found = ranking.scan(chunked, ["k"], ["at"], "c", position="tick", size="size", previous={"was": flag}, hits={"last": flag}, edges={"edge": flag}).collect()
        assert {r["at"]: (r["tick"], r["last"], r["was"]) for r in found} == want
        assert {r["at"]: r["edge"] for r in found} == edges and {r["at"]: r["size"] for r in found} == sizes
    assert by_count.groupBy("k", "c").count().agg(F.max("count")).first()[0] <= 50
    ticked = ranking.scan(df.withColumn("at2", F.col("at") * 10), ["k"], ["at"], "c", hits={"last": flag}, edges={"edge": flag}, tick="at2").collect()
    back = {(r["k"], r["at"]): r["at"] for r in found}
    place = {(r["k"], r["tick"]): r["at"] for r in found}
    assert all(r["last"] == (None if want[r["at"]][1] is None else 10 * place[r["k"], want[r["at"]][1]]) for r in ticked) and len(back) == 600
    assert all(r["edge"] == (None if edges[r["at"]] is None else 10 * place[r["k"], edges[r["at"]]]) for r in ticked)
    odd = spark.createDataFrame([(None, 1, True), (None, 2, None), ("a", 1, None)], "k string, at int, flag boolean").withColumn("c", F.lit(1))
    told = ranking.scan(odd, ["k"], ["at"], "c", position="tick", edges={"edge": flag}, hits={"last": flag}).collect()
    assert sorted((r["k"] or "", r["at"], r["tick"], r["edge"], r["last"]) for r in told) == [("", 1, 0, 0, 0), ("", 2, 1, 0, 0), ("a", 1, 0, None, None)]
    assert ranking.scan(odd.limit(0), ["k"], ["at"], "c", position="tick").collect() == []


def test_artefacts_traces_and_listings(spark, tmp_path):
    rows = tmp_path / "rows"
    for name, text in {"t/1/rank1.fbd": "x = AND(a)\n", "t/1/rank1.plcopen.xml": "<p/>", "t/1/trace_1.json": "B", "t/1/trace_0.json": "A", "t/2/rank5.plan.json": "{}"}.items():
        path = rows / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    got = {(r["seed"], r["candidate"]): r for r in files.artefacts(spark, str(rows)).collect()}
    assert got[1, "rank1"]["fbd_text"] == "x = AND(a)\n" and got[1, "rank1"]["fbd_xml"] == "<p/>" and got[1, "rank1"]["plan_json"] == ""
    assert got[2, "rank5"]["plan_json"] == "{}" and got[2, "rank5"]["fbd_text"] == ""
    assert [(r["seed"], r["traces"]) for r in files.row_traces(spark, str(rows)).collect()] == [(1, ["A", "B"])]
    assert {r["path"]: r["length"] for r in files.listing(spark, str(rows)).collect()}["t/1/rank1.fbd"] == 11
    sums = {r["path"]: r["sha256"] for r in files.checksums(spark, str(rows)).collect()}
    assert sums["t/1/trace_0.json"] == hashlib.sha256(b"A").hexdigest()
    (rows / "note one.md").write_text("first\nsecond /home/x\n")
    staged = files.staged_texts(spark, str(tmp_path))
    assert [r["path"] for r in staged.collect()] == []
    lines = files.text_lines(files.staged_texts(spark, str(rows)).filter("path like 'note%'")).collect()
    assert [(r["path"], r["line"], r["value"]) for r in lines][:2] == [("note one.md", 1, "first"), ("note one.md", 2, "second /home/x")]


def test_files_beyond_one_value(spark, tmp_path, monkeypatch):
    """With the limit set low: large files are hashed in pieces, and large archives are read from the file."""
    import hashlib
    import zipfile

    from labelmill.sources import archives

    with zipfile.ZipFile(tmp_path / "sub 1_io.zip", "w") as z:
        z.writestr("a/b.png", b"x" * 5000)
        z.writestr("a/c.png", b"y" * 10)
    (tmp_path / "small.txt").write_bytes(b"z")
    monkeypatch.setattr(files, "MOST_BYTES", 1000)
    monkeypatch.setattr(archives, "MOST_BYTES", 1000)
    sums = {r["path"]: r["sha256"] for r in files.checksums(spark, str(tmp_path)).collect()}
    assert sums == {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in tmp_path.iterdir()}
    entries = archives.expand(archives.archive_files(spark, str(tmp_path))).collect()
    assert {(r["name"], len(r["bytes"])) for r in entries} == {("a/b.png", 5000), ("a/c.png", 10)}


def test_row_keys_are_not_broadcast(spark, sf):
    """Keys grow with the rows, however small their file looks: no join of the census gathers them in the driver."""
    from labelmill.plans import bindings as b

    rows = b.order_rows(spark, sf)
    root, candidates = relations.root_rows(rows), relations.candidate_rows(rows)
    kept = relations.scores_of(b.order_scores(spark, sf), root.filter("seed % 10 = 0"))
    held = census.census_rows(root.drop("intent"), candidates, F.lit("fbd"), F.lit("train"))
    joined = relations.joined_view(root, candidates, kept)
    for df, merged in ((kept, 1), (held, 1), (joined, 2)):  # the joined view reads the kept scores
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == merged and "BroadcastHashJoin" not in plan


def test_small_files_stay_out_of_python(spark, tmp_path, monkeypatch):
    """Many small files and a larger one: same hashes, and Python tasks by cores, not by files."""
    content = {f"d{i % 3}/f{i}.txt": f"text {i}\nä".encode() for i in range(40)} | {"large.bin": b"\xff\xfe" * 5000}
    for name, data in content.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    monkeypatch.setattr(files, "PIECE", 4096)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    try:
        found = files.checksums(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() <= len(content) + 4 * spark.sparkContext.defaultParallelism - 4
        assert {r.path: (r.size, r.sha256) for r in found.collect()} == {k: (len(v), hashlib.sha256(v).hexdigest()) for k, v in content.items()}
        texts = files.read_texts(spark, str(tmp_path))
        assert "Scan text" not in texts._jdf.queryExecution().toString() and "FileScan text" not in texts._jdf.queryExecution().toString()
        got = {r.path: bytes(r.b) for r in texts.select("path", F.col("text").cast("binary").alias("b")).collect()}
        assert got == content
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_empty_files_are_listed_and_hashed(spark, tmp_path):
    """a file of no bytes is a file; one that a lost task left half-way is none."""
    folder = str(tmp_path / "out")
    texts = spark.createDataFrame([("a/1.md", ""), ("a/2.md", "x"), ("b/c/3.txt", None)], "path string, text string")
    files.write_texts(texts, folder).collect()
    (tmp_path / "out" / "taken").mkdir()
    with pytest.raises(Exception, match="taken"):
        files.write_texts(spark.createDataFrame([("taken", "half")], "path string, text string"), folder).collect()
    want = {"a/1.md": b"", "a/2.md": b"x", "b/c/3.txt": b""}
    assert {r.path: (r.size, r.sha256) for r in files.checksums(spark, folder).collect()} == {k: (len(v), hashlib.sha256(v).hexdigest()) for k, v in want.items()}
    assert files.checksums(spark, str(tmp_path / "out" / "taken")).collect() == []


def test_files_are_listed_in_order_by_tasks(spark, tmp_path):
    """a listing of many folders gives no task for every few of them, and empty files have their place."""
    for i in range(60):
        (tmp_path / f"t{i % 7}" / str(i)).mkdir(parents=True)
        (tmp_path / f"t{i % 7}" / str(i) / "a b+ä%41.txt").write_bytes(b"x" * (i % 3))
    want = sorted((p.relative_to(tmp_path).as_posix(), p.stat().st_size) for p in tmp_path.rglob("*.txt"))
    found = files.ordered_listing(spark, f"file:{tmp_path}", "*.txt")
    assert sorted((r.number, r.path, r.length) for r in found.collect()) == [(i, *x) for i, x in enumerate(want)]
    assert files.ordered_listing(spark, str(tmp_path), "*.md").collect() == []


def test_many_small_files_share_tasks(spark, tmp_path):
    """artefacts and traces are opened by as many tasks as there are cores, not by one for every few files."""
    for i in range(50):
        (tmp_path / "t" / str(i)).mkdir(parents=True)
        for name in ("rank1.fbd", "trace_0.json", "notes.txt"):
            (tmp_path / "t" / str(i) / name).write_text("" if i == 7 else name)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    try:
        assert files.read_texts(spark, str(tmp_path)).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        assert {r.seed: r.fbd_text for r in files.artefacts(spark, str(tmp_path)).collect()} == {i: "" if i == 7 else "rank1.fbd" for i in range(50)}
        assert {r.seed: r.traces for r in files.row_traces(spark, str(tmp_path)).collect()} == {i: ["" if i == 7 else "trace_0.json"] for i in range(50)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("name", ["archive_read_back", "archive_entries_function", "archive_ingest"])
def test_archives_lie_on_disk_in_waves(spark, sf, tmp_path, monkeypatch, name):
    """the archives of some subjects are written, read and removed before the next are; rows as in SQL."""
    import duckdb

    from labelmill.plans import archives as plans
    from labelmill.sources import paths

    asides, held, remove = iter(range(100)), [], paths.remove
    monkeypatch.setattr(plans, "ENTRIES_A_WAVE", 2000, raising=False)
    monkeypatch.setattr(paths, "scratch", lambda spark: f"{tmp_path}/{next(asides)}")
    monkeypatch.setattr(paths, "remove", lambda spark, path: (held.append(len([f for f in os.listdir(path) if f.endswith(".zip")])), remove(spark, path)))
    got = plans.QUERIES[name](spark, sf)
    con = duckdb.connect()
    for table in ("lineitem", "supplier"):
        con.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    cursor = con.execute(plans.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr) == sorted(cursor.fetchall(), key=repr)
    assert list(tmp_path.rglob("*.zip")) == [] and sum(1 for n in held if n) >= 3 and max(held) < sum(held)
