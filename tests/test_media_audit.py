import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from labelmill.functions import numeric as nm
from labelmill.functions import payload as pl
from labelmill.operators import audit, gates, measure, media, repair, traces
from labelmill.sources import archives
from labelmill.streaming import ingest

PNG = bytes.fromhex("89504E470D0A1A0A") + b"x"
WAV = b"RIFFxx"


def parsed(spark, *names):
    df = media.keyed_entries(spark.createDataFrame([(n,) for n in names], "name string"))
    return {r["name"]: r for r in df.collect()}


def test_entry_names(spark):
    still = "sub_140_io/trial_1/rgb_image_aligned/140_1_1_7_791_3.png"
    cmd = "sub_24_ia/trial_2/thr_image_cmd/24_2_2_1_1016_10_1.png"
    wav = "sub_24_ia/trial_1/mic1_audio_cmd_trim/24_1_2_9_365_1.wav"
    refused = {
        "sub_1_io/trial_1/thr_image/1_1_1_7_791_3.png": "stream_dir_disagrees",
        "sub_1_io/trial_2/thr_image/1_1_1_7_791_1.png": "trial_dir_disagrees",
        "sub_1_io/trial_1/thr_image/1_1_2_7_791_1.png": "unrecognised_fields",
        "sub_1_io/trial_1/thr_image/1_1_x_7_791_1.png": "not_an_integer",
        "sub_1_io/trial_x/thr_image/1_1_1_7_791_1.png": "not_an_integer",
        "sub_1_io/thr_image/1_1_1_7_791_1.png": "unrecognised_path",
    }
    got = parsed(spark, still, cmd, wav, *refused)
    assert [got[still][c] for c in ("kind", "sub_id", "trial", "position", "frame", "stream", "reason")] == ["still", 140, 1, 7, 791, 3, None]
    assert [got[cmd][c] for c in ("kind", "position", "command", "frame", "stream")] == ["cmd", 1, 1016, 10, 1]
    assert [got[wav][c] for c in ("kind", "position", "command", "mic", "frame")] == ["utterance", 9, 365, 1, None]
    assert {n: got[n]["reason"] for n in refused} == refused


def make_zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("sub/", b"")
        for name, data in members.items():
            z.writestr(name, data)


MEMBERS = {
    "sub_24_io/trial_1/rgb_image/24_1_1_1_5_2.png": PNG,
    "sub_24_io/trial_1/rgb_image/24_1_1_1_6_2.png": PNG,
    "sub_24_io/trial_1/thr_image/24_1_1_1_5_1.png": PNG,
    "sub_24_io/trial_2/mic1_audio_cmd_trim/24_2_2_1_7_1.wav": WAV,
}


def test_archives_to_media(spark, tmp_path):
    make_zip(tmp_path / "sub_24_io.zip", MEMBERS)
    (tmp_path / "sub_25_io.zip").write_bytes(b"")
    entries = archives.with_subject(archives.expand(archives.archive_files(spark, str(tmp_path))))
    keyed = media.keyed_entries(entries)
    assert media.entry_problems(keyed).count() == 0
    groups = {(r["relation"], r["stream"], r["trial"]): (r["rows"], r["bytes"]) for r in media.group_counts(keyed).collect()}
    assert groups == {("still", 2, 1): (2, 18), ("still", 1, 1): (1, 9), ("audio", 0, 2): (1, 6)}
    out = str(tmp_path / "out")
    archives.write_media(keyed.withColumn("split", F.lit("train")), out)
    back = spark.read.parquet(f"{out}/still")
    assert back.filter("stream = 'visual'").count() == 2
    assert {r["p"] for r in back.select(F.col("image.path").alias("p")).collect()} == {"24_1_1_1_5_2.png", "24_1_1_1_6_2.png", "24_1_1_1_5_1.png"}
    assert spark.read.parquet(f"{out}/audio").select("command", "mic").first() == (7, 1)


def test_refused_bytes_and_subject(spark, tmp_path):
    make_zip(tmp_path / "sub_3_io.zip", {"sub_3_io/trial_1/thr_image/3_1_1_1_5_1.png": WAV, "sub_3_io/trial_1/thr_image/4_1_1_1_5_1.png": PNG})
    keyed = media.keyed_entries(archives.with_subject(archives.expand(archives.archive_files(spark, str(tmp_path)))))
    assert sorted(r["problem"] for r in media.entry_problems(keyed).collect()) == ["not_a_png", "subject_disagrees"]


def test_incremental_ingest_converts_each_archive_once(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    source.mkdir()
    make_zip(source / "sub_24_io.zip", MEMBERS)
    subjects = spark.createDataFrame([(24, "train"), (30, "test")], "sub_id bigint, split string")
    ingest.ingest(spark, str(source), out, checkpoint, subjects).awaitTermination()
    make_zip(source / "sub_30_io.zip", {"sub_30_io/trial_1/thr_image/30_1_1_1_5_1.png": PNG})
    make_zip(source / "sub_31_io.zip", {"sub_31_io/trial_1/thr_image/30_1_1_1_5_1.png": PNG})
    ingest.ingest(spark, str(source), out, checkpoint, subjects).awaitTermination()
    ingest.ingest(spark, str(source), out, checkpoint, subjects).awaitTermination()
    groups = spark.read.parquet(f"{out}/groups/*").select(F.substring_index("archive", "/", -1).alias("a"), "rows").collect()
    assert sorted((r["a"], r["rows"]) for r in groups) == [("sub_24_io.zip", 1), ("sub_24_io.zip", 1), ("sub_24_io.zip", 2), ("sub_30_io.zip", 1)]
    assert [r["problem"] for r in spark.read.parquet(f"{out}/refused/*").collect()] == ["subject_disagrees"]


def read_ranges(spark, base, size):
    return archives.entry_rows(spark, str(base), range_bytes=size)


def test_archive_of_many_ranges(spark, tmp_path):
    """Every entry once, whatever the ranges; an archive larger than a range is many tasks; what cannot be read is named."""
    names = {f"sub_24_io/trial_1/rgb_image/24_1_1_1_{k}_2.png": PNG + bytes([k % 256]) * (k * 7) for k in range(200)}
    make_zip(tmp_path / "sub_24_io.zip", names)
    make_zip(tmp_path / "sub_25_io.zip", {})
    (tmp_path / "sub_26_io.zip").write_bytes(b"")
    (tmp_path / "sub_27_io.zip").write_bytes(b"no archive at all" * 99)
    broken = tmp_path / "sub_28_io.zip"
    make_zip(broken, {"a.png": b"0123456789" * 20, "b.png": PNG})
    broken.write_bytes(broken.read_bytes().replace(b"0123456789" * 20, b"x123456789" * 20, 1))
    for size in (100, 5000, 1 << 30):
        found = read_ranges(spark, tmp_path, size)
        rows = found.collect()
        good = {r["name"]: bytes(r["bytes"]) for r in rows if r["problem"] is None}
        assert good == {**names, "b.png": PNG}
        assert len(rows) == 205
        assert sorted((r["archive"][-13:], r["name"], r["problem"]) for r in rows if r["problem"]) == [
            ("sub_25_io.zip", None, "no_entries"), ("sub_26_io.zip", None, "empty_archive"), ("sub_27_io.zip", None, "unreadable_archive"), ("sub_28_io.zip", "a.png", "unreadable_entry"),
        ]
        assert (found.rdd.getNumPartitions() > 100) == (size == 100)
    assert read_ranges(spark, tmp_path / "nowhere", 100).collect() == []


def test_archives_written_and_read_back(spark, tmp_path):
    rows = [(f"sub_{k % 5}_io.zip", f"e{k}", bytes([k]) * k) for k in range(90)]
    entries = spark.createDataFrame(rows, "archive string, name string, bytes binary").repartition(6)
    written = archives.write_archives(entries, str(tmp_path / "z")).collect()
    assert {r["archive"]: r["length"] for r in written} == {p.name: p.stat().st_size for p in (tmp_path / "z").iterdir()}
    back = read_ranges(spark, tmp_path / "z", 300).collect()
    assert sorted((r["archive"].rsplit("/", 1)[1], r["name"], bytes(r["bytes"])) for r in back) == sorted(rows)


def test_ingest_verifies_and_names(spark, tmp_path):
    """Sizes and hashes against a listing, empty archives in the manifest, no manifest for a subject with a refused archive."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for k in (1, 2, 3, 4):
        make_zip(source / f"sub_{k}_io.zip", {f"sub_{k}_io/trial_1/thr_image/{k}_1_1_1_5_1.png": PNG})
    (source / "sub_1_ia.zip").write_bytes(b"")
    make_zip(source / "sub_2_ia.zip", {"sub_2_ia/trial_1/thr_image_cmd/2_1_2_1_9_5_1.png": PNG})
    size = (source / "sub_1_io.zip").stat().st_size
    listing = [("x/sub_1_io.zip", size, None), ("x/sub_2_io.zip", size + 1, "0"), ("x/sub_3_io.zip", size, "0")]
    expected = spark.createDataFrame(listing, "path string, size bigint, sha256 string")
    subjects = spark.createDataFrame([(1, "train"), (2, "test"), (3, "train")], "sub_id bigint, split string")
    ingest.ingest(spark, str(source), out, str(tmp_path / "ck"), subjects, expected, range_bytes=64).awaitTermination()
    refused = spark.read.parquet(f"{out}/refused/*").collect()
    assert sorted((r["archive"].rsplit("/", 1)[1], r["name"] is None, r["problem"]) for r in refused) == [
        ("sub_2_io.zip", True, "size_mismatch"), ("sub_3_io.zip", True, "sha_mismatch"), ("sub_4_io.zip", False, "unknown_subject"),
    ]
    made = spark.read.json(f"{out}/manifest/*").collect()
    assert [(m["subject"], m["split"], m["rows"], m["bytes"]) for m in made] == [(1, "train", 1, 9)]
    held = made[0]["archives"].asDict()
    assert sorted((k.rsplit("/", 1)[1], v["empty"], v["size"]) for k, v in held.items()) == [("sub_1_ia.zip", True, 0), ("sub_1_io.zip", False, size)]
    media_names = {r["p"] for kind in ("still", "cmd") for r in spark.read.parquet(f"{out}/media/*/{kind}").select(F.col("image.path").alias("p")).collect()}
    assert media_names == {"1_1_1_1_5_1.png", "2_1_2_1_9_5_1.png"}
    assert not (tmp_path / "out" / "_pending" / "batch=0").exists()


def test_late_archives_with_old_dates(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    source.mkdir()
    subjects = spark.createDataFrame([(1, "train"), (2, "train")], "sub_id bigint, split string")
    make_zip(source / "sub_2_io.zip", {"sub_2_io/trial_1/thr_image/2_1_1_1_5_1.png": PNG})
    ingest.ingest(spark, str(source), out, checkpoint, subjects).awaitTermination()
    make_zip(source / "sub_1_io.zip", {"sub_1_io/trial_1/thr_image/1_1_1_1_5_1.png": PNG})
    os.utime(source / "sub_1_io.zip", (1, 1))
    for _ in range(2):
        ingest.ingest(spark, str(source), out, checkpoint, subjects).awaitTermination()
    assert sorted(r["subject"] for r in spark.read.json(f"{out}/manifest/*").collect()) == [1, 2]


def test_subjects(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("Sub_ID,Split,Age,Gender,Ethnicity,Acc_Trial_1,Acc_Trial_2\n1,Train,30,F,x,None,Hat;Mask\n2,Valid,31,M,y,Hat,None\n3,Test,32,F,z,None,None\n4,Other,1,F,z,None,None\n")
    raw = archives.read_subjects(spark, str(path))
    assert {r["sub_id"]: r["split"] for r in media.subjects(raw).collect()} == {1: "train", 2: "test", 3: "evaluation", 4: None}
    with pytest.raises(gates.Refused, match="unknown split Other"):
        gates.require_none(media.subject_problems(raw), "subjects")
    archives.write_subjects(raw.filter("Sub_ID < 4"), str(tmp_path / "out"))
    acc = spark.read.parquet(str(tmp_path / "out/subject_accessories")).collect()
    assert sorted((r["sub_id"], r["trial"], r["accessory"]) for r in acc) == [(1, 2, "Hat"), (1, 2, "Mask"), (2, 1, "Hat")]
    assert dict(spark.read.parquet(str(tmp_path / "out/subjects")).dtypes)["sub_id"] == "smallint"


def values(spark, rows):
    return spark.createDataFrame(rows, "repo string, tbl string, col string, pos bigint, value string")


def test_payload_plants(spark):
    files = spark.createDataFrame([("r", "beside.parquet"), ("r", "assets/x/garment-0-front.jpg"), ("q", "readme.md")], "repo string, path string")
    features = spark.createDataFrame([("r", "absent", "image"), ("r", "image", "image")], "repo string, name string, dtype string")
    clean = values(spark, [("r", "clean.parquet", "fbd_text", 0, "program p\nvar done : BOOL\n"), ("r", "clean.parquet", "key", 0, "a")])
    assert audit.path_findings(clean, files).count() == 0
    planted = values(
        spark,
        [("r", "d.parquet", "fbd_text", 0, "rows/t/0/rank1.fbd"), ("r", "b.parquet", "front", 0, "./assets/x/garment-0-front.jpg"), ("r", "b.parquet", "front", 1, "assets/x/garment-0-front.jpg")],
    )
    binary = spark.createDataFrame([("r", "m.parquet", "png", 0, bytearray(PNG)), ("r", "m.parquet", "image", 0, bytearray(PNG))], "repo string, tbl string, col string, pos bigint, value binary")
    columns = spark.createDataFrame([("r", "m.parquet", "png"), ("r", "m.parquet", "image")], "repo string, tbl string, col string")
    found = {(r["kind"], r["repo"], r["col"]): r["detail"] for r in audit.findings(planted, binary, files, features, columns).collect()}
    assert set(found) == {
        ("dangling_path", "r", "fbd_text"), ("payload_beside", "r", "front"), ("bare_media", "r", "png"), ("undelivered_feature", "r", "absent"), ("no_parquet", "q", "(none)"),
    }
    assert found["payload_beside", "r", "front"].startswith("points at 2 file(s) shipped beside")


def test_payload_path_shapes(spark):
    shapes = {"a/b.png": True, "PNG": False, "png": False, " x.WAV ": True, "a b.png": False, "a\nb.png": False, "": False, "x.doc": False, ".json": True}
    df = spark.createDataFrame(list(shapes.items()), "v string, want boolean").withColumn("got", pl.payload_path(F.col("v")))
    assert df.filter("got <> want").count() == 0


def test_nested_leaves_and_local_paths(spark):
    rows = [("f", 1, (["ok", "C:\\Users\\x"], {"k": "/mnt/c/y"}), "Camera3D:/root/x", bytearray(b"/home/"))]
    df = spark.createDataFrame(rows, "file string, pos int, s struct<a: array<string>, m: map<string, string>>, plain string, raw binary")
    hits = audit.local_path_columns(audit.string_leaves(df, ["file", "pos"]))
    assert sorted(r["col"] for r in hits.collect()) == ["s.a", "s.m.value"]
    assert [r["col"] for r in audit.binary_leaves(df, ["file", "pos"]).collect()] == ["raw"]
    texts = spark.createDataFrame([("m.json", "ok\n/HOME/x\nc:/y"), ("rows/a.json", "/home/x"), ("a.bin", "/home/x"), ("c.md", "Camera3D:/root")], "path string, text string")
    assert [(r["path"], r["line"]) for r in audit.first_hit_per_file(texts.filter(pl.publishable_text(F.col("path")))).collect()] == [("m.json", 2)]
    problems = audit.publication_problems(audit.string_leaves(df, ["file", "pos"]), texts.select("path"), texts)
    assert problems.count() == 3


def test_trust(spark):
    trust = spark.createDataFrame([("huggingface.co/good",), ("lab/one",), ("org",)], "object string")
    sources = spark.createDataFrame([("good/anything",), ("lab/one/",), ("lab/two",), ("org/x",), ("org/x/y",), ("org",)], "source string")
    assert sorted(r["source"] for r in audit.trusted(sources, trust).collect()) == ["good/anything", "lab/one/", "org", "org/x"]
    assert sorted(r["problem"] for r in audit.untrusted(sources, trust).collect()) == ["REFUSED: lab/two is not a trusted data source", "REFUSED: org/x/y is not a trusted data source"]


def test_derive_calls_once_per_distinct_text(spark):
    rows = spark.createDataFrame([(i, "", "same") for i in range(50)] + [(100, "has", "x"), (101, "", ""), (102, "", "bad")], "id int, t string, x string")
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def convert(text):
        calls.add(1)
        return "" if text == "bad" else text.upper()

    out = repair.derive_memoised(rows, "x", "t", lambda c: convert(c)).collect()
    assert calls.value == 2
    assert {(r["t"], r["outcome"]) for r in out} == {("SAME", "derived"), ("has", "kept"), ("", "kept"), ("", "refused")} and len(out) == 53


def test_tokenizer_hook(spark):
    df = spark.createDataFrame([("a b c",), ("dd",)], "text string")
    count = measure.tokenizer_udf(lambda: lambda texts: [len(t) for t in texts])
    assert measure.token_stats(df, "text", count).first()["total"] == 7
    assert measure.token_stats(df).first() == (2.0, 2.0, 3, 4)


def test_trace_differences(spark):
    rows = []
    for candidate, speed, held, state, ticks in (("rank1", 1.0, True, "x", 2), ("rank3", 1.0 + 5e-7, True, "x", 2), ("rank5", 1.0, False, "x", 3)):
        for tick in range(ticks):
            rows += [("k", candidate, 0, tick, "speed", speed, None, None), ("k", candidate, 0, tick, "held", None, held, None), ("k", candidate, 0, tick, "state", None, None, state)]
    outputs = spark.createDataFrame(rows, "row_key string, candidate string, trace int, tick int, name string, num double, flag boolean, str string")
    got = {r["candidate"]: (r["effect_matches"], r["differences"]) for r in traces.trace_differences(outputs).collect()}
    # the reference differs from itself where only another candidate has a tick
    assert got["rank3"][0] is False and got["rank5"] == (False, 5)
    two = outputs.filter("candidate <> 'rank5'")
    assert {r["candidate"]: r["effect_matches"] for r in traces.trace_differences(two).collect()} == {"rank1": True, "rank3": True}


def test_numbers(spark):
    df = spark.createDataFrame([("1.0", "1.00005"), ("x", "1"), (None, "1")], "a string, b string")
    assert [r[0] for r in df.select(nm.close_config(F.col("a"), F.col("b"))).collect()] == [True, False, False]
    one = spark.range(1)
    v = one.select(nm.cross(F.array(*[F.lit(float(x)) for x in (1, 0, 0)]), F.array(*[F.lit(float(x)) for x in (0, 1, 0)])).alias("c"), nm.argb32(F.lit(0.5), F.lit(0.0), F.lit(1.0)).alias("p")).first()
    assert v["c"] == [0.0, 0.0, 1.0] and v["p"] == 0xFF8000FF


def test_columns_of_the_audited_tables(spark, sf):
    """The shared pictures are values of assets, no column that a table delivers."""
    from labelmill.plans import audits

    assert {r["col"] for r in audits._columns(spark, sf).collect()} == {"fbd_path", "note", "image", "blob", "plain"}


def test_small_archives_share_tasks(spark):
    """As many tasks as are of use, however fine the ranges asked for; every byte is in one of them."""
    from labelmill.sources import zips

    listing = [(f"sub_{k}_io.zip", 1000 + k % 70_000) for k in range(100_000)]
    made = zips.planned(listing, 1 << 16)
    assert len(made) <= 2 * zips.ENOUGH_TASKS
    assert sorted(s for r in made for s in r.spans) == sorted((path, n, 0, n) for path, n in listing)
    large = zips.planned([("a.zip", 1 << 40)], 1 << 16)
    assert [s[2:] for r in large for s in r.spans] == [(a, a + zips.RANGE_BYTES) for a in range(0, 1 << 40, zips.RANGE_BYTES)]


def test_many_subjects_are_few_files(spark, tmp_path):
    """Files follow the bytes, not the subjects; subject numbers beyond the narrow integer are kept."""
    names = [f"sub_{k}_io/trial_{t}/thr_image/{k}_{t}_1_1_5_1.png" for k in (*range(40), 40_000) for t in (1, 2)]
    keyed = media.keyed_entries(spark.createDataFrame([(n.split("/")[0] + ".zip", n, PNG) for n in names], "archive string, name string, bytes binary"))
    archives.write_media(keyed.withColumn("split", F.lit("train")), str(tmp_path / "out"))
    assert len(list((tmp_path / "out/still").rglob("*.parquet"))) <= 8
    back = spark.read.parquet(str(tmp_path / "out/still")).select("sub_id", "trial", "stream").collect()
    assert sorted(map(tuple, back)) == [(k, t, "thermal") for k in (*range(40), 40_000) for t in (1, 2)]


def test_subjects_beyond_the_narrow_integer(spark, tmp_path):
    raw = spark.createDataFrame([(7, "Train", 30, "F", "x", "Hat", "None"), (90_000, "Test", 31, "F", "y", "None", "Mask")], "Sub_ID int, Split string, Age int, Gender string, Ethnicity string, Acc_Trial_1 string, Acc_Trial_2 string")
    archives.write_subjects(raw, str(tmp_path / "out"))
    assert {r["sub_id"] for r in spark.read.parquet(str(tmp_path / "out/subjects")).collect()} == {7, 90_000}
    assert {r["sub_id"] for r in spark.read.parquet(str(tmp_path / "out/subject_accessories")).collect()} == {7, 90_000}
