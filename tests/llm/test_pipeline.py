"""The pipeline's stages, one by one and together, against plain versions."""

import random
from collections import Counter

import corpus_pipeline
from labelmill.llm import decontaminate, language, simhash

from .test_dedup import plain_lines

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def planted(spark, tmp_path):
    """Clean documents, exact and near copies, texts without letters, a banner on many sites, a benchmark passage."""
    draw = random.Random(12)
    vocabulary = {lang: [f"{a}{b}{c}" for a in first for b in "aeiou" for c in last] for lang, first, last in (("xx", ["th", "wh", "st", "pr"], ["ng", "sh", "ck", "ly"]), ("yy", ["z", "qu", "ll", "ñ"], ["os", "as", "ez", "ió"]))}

    def prose(lang, n):
        words = [draw.choice(vocabulary[lang]) + draw.choice(["", "", str(draw.randint(0, 99))]) for _ in range(n)]
        return "\n".join(" ".join(words[k : k + 12]) for k in range(0, n, 12))

    rows = [(i, prose("xx" if i % 3 else "yy", 150), "xx" if i % 3 else "yy", f"site{i % 14}") for i in range(60)]
    rows = [(i, t + "\nplease accept all our cookies" if i < 40 else t, lang, s) for i, t, lang, s in rows]
    item = prose("xx", 24).replace("\n", " ")
    rows += [(100, rows[45][1], "yy", "site1"), (101, rows[46][1].replace(rows[46][1].split()[3], "changed", 1), "xx", "site2")]
    rows += [(102, prose("xx", 80) + "\n" + item, "xx", "site3"), (103, "123 !!! 456", None, "site4"), (104, None, None, None), (105, "", "xx", "site5")]
    docs = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return rows


def test_planted(spark, tmp_path):
    rows = planted(spark, tmp_path)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == set(range(60))
    left = {i: t for i, t, _ in plain_lines([(i, t, s) for i, t, _, s in rows if i < 103], 10, 10)}
    assert sum("cookies" in t for t in left.values()) == 1
    assert sum("cookies" in r.decoded for r in got.values()) == 1
    assert all(r.n_tokens == len(r.token_ids) > 0 for r in got.values())


def test_stages(spark, sf, tmp_path):
    """Each stage on the rows the one before it kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs.collect()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = docs.collect()
        if k < 4:
            assert docs.columns == COLUMNS
        kept = {r.doc_id for r in after}
        assert len(kept) == len(after) and kept <= {r.doc_id for r in before}
        if name == "language ID":
            assert all(not language.words_of(r.text or "") for r in before if r.doc_id not in kept)
        if name == "line dedup":
            want = {i: t for i, t, _ in plain_lines([(r.doc_id, r.text, r.source) for r in before], 10, 10)}
            assert {r.doc_id: r.text for r in after} == {i: t for i, t in want.items() if t.strip() or t == [r.text for r in before if r.doc_id == i][0]}
            assert all(r.n_chars == len(r.text) for r in after)
        if name == "SimHash near-dedup":
            shingles = {r.doc_id: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} for r in before for w in [r.text.lower().split()]}
            same = Counter(r.text for r in before)
            assert all(same[r.text] == 1 or r.doc_id == min(x.doc_id for x in before if x.text == r.text) for r in after)
            # every dropped document is close to one that stays or to another dropped one
            for i in {r.doc_id for r in before} - kept:
                assert max(len(shingles[i] & s) / len(shingles[i] | s) for j, s in shingles.items() if j < i) > 0.6
            ids = sorted(kept)
            close = [(a, b) for n, a in enumerate(ids) for b in ids[:n] if len(shingles[a] & shingles[b]) >= 0.85 * len(shingles[a] | shingles[b])]
            assert len(close) <= 1
        if name == "benchmark decontamination":
            items = [decontaminate.words_of(r.text.encode()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            windows = {tuple(w[j : j + 10]) for w in items for j in range(len(w) - 9)}
            for r in before:
                w = decontaminate.words_of(r.text.encode())
                assert (r.doc_id not in kept) == any(tuple(w[j : j + 10]) in windows for j in range(len(w) - 9))
        before = after


def test_empty_and_odd(spark, odd, sf):
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, odd, sf)
        assert out.columns == odd.columns and out.count() > 0
        assert stage(spark, odd.filter("doc_id < -1"), sf).collect() == []
    assert corpus_pipeline.STAGES[4][1](spark, odd, sf).count() == odd.count()


def test_arrangement():
    assert simhash.SIMILAR["shingle_words"] == 5
