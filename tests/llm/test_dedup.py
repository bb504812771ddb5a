"""Exact, line, substring and suffix dedup and SimHash against plain versions."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from labelmill.llm import exact_dedup, line_dedup, queries, simhash, substring_dedup, suffix_dedup
from labelmill.llm.anchors import find_anchors, gram_hashes
from labelmill.llm.components import components
from labelmill.llm.suffix_array import suffix_array

NO_ID = (1 << 63) - 1


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("hot_share", [1e-4, 0.2])
def test_exact(odd, odd_rows, keep, hot_share):
    groups = defaultdict(list)
    for i, t in odd_rows:
        groups[t or ""].append(i)
    want = []
    for i, t in odd_rows:
        ids = [x for x in groups[t or ""] if x is not None]
        best = (min if keep == "min" else max)(ids) if ids else None
        want.append((i, best, len(groups[t or ""]), i == best, digest((t or "").encode())))
    got = [tuple(r) for r in exact_dedup.keep_one(odd, keep=keep, hot_share=hot_share).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_exact_normalised(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "A b"), (2, "a B"), (3, "c")], "doc_id long, text string")
    got = {r.doc_id: r.keep_id for r in exact_dedup.keep_one(docs, normalise=F.lower("text")).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def plain_lines(rows, min_sites, min_texts):
    """rows: (id, text, site). Returns what is left of each text and the lines that went."""
    judged = defaultdict(list)
    for i, t, site in rows:
        lines = [x.strip(" ") for x in (t or "").split("\n")]
        for x in dict.fromkeys(lines):
            if len(re.split(r"[ \t\x0b\f\r]+", x)) >= 3:
                judged[x].append((i, t or "", site))
    marks = {}
    for x, seen in judged.items():
        if len({s for _, _, s in seen if s is not None}) >= min_sites and len({t for _, t, _ in seen}) >= min_texts:
            marks[x] = min((i is not None, i or 0) for i, *_ in seen)
    out = []
    for i, t, _ in rows:
        left, seen, gone = [], set(), 0
        for raw in ([] if t is None else t.split("\n")):
            x = raw.strip(" ")
            if x in marks and not (marks[x] == (i is not None, i or 0) and x not in seen):
                gone += 1
            else:
                left.append(raw)
            seen.add(x)
        out.append((i, None if t is None else "\n".join(left), gone))
    return out


def test_lines(spark):
    draw = random.Random(2)
    rows = []
    for i in range(120):
        own = [" ".join(f"w{draw.randint(0, 400)}" for _ in range(5)) for _ in range(4)]
        for banner, often in (("accept all cookies please", 0.6), ("two words", 0.9), ("seen on few sites", 0.1), (" blanks  around it ", 0.5)):
            if draw.random() < often:
                own.insert(draw.randint(0, len(own)), banner)
                if draw.random() < 0.2:
                    own.append(banner.strip())
        rows.append((i, "\n".join(own), f"s{i % 15}"))
    copy = "\n".join(" ".join(f"c{k}{j}" for j in range(5)) for k in range(4))
    rows += [(200 + i, copy, f"s{i}") for i in range(14)] + [(300, None, "s1"), (301, "", None), (302, "accept all cookies please", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [(r.doc_id, r.text, r.n_removed) for r in line_dedup.clean_lines(docs).collect()]
    want = plain_lines(rows, line_dedup.MIN_SITES, line_dedup.MIN_TEXTS)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(gone for *_, gone in got) and all(not gone for i, _, gone in got if 200 <= i < 214)


def test_footers_of_any_hash(spark):
    """A footer on many sites goes whatever its hash; the only line that pages share goes, too, and so do many of them."""
    draw = random.Random(8)
    low = next(f for k in range(9999) if hashlib.md5((f := f"all rights reserved {k}").encode()).hexdigest().startswith("00"))
    high = next(f for k in range(9999) if hashlib.md5((f := f"all rights reserved {k}").encode()).hexdigest().startswith("ff"))
    rows = []
    for i in range(400):
        own = [" ".join(f"w{draw.randint(0, 9999)}" for _ in range(5)) for _ in range(2)]
        rows.append((i, "\n".join([*own, low, high, "contact us by mail", "terms of use apply"]), f"s{i % 40}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup.clean_lines(docs).collect()}
    assert got == {0: (6, 0)} | {i: (6, 4) for i in range(1, 400)}
    copies = docs.filter("doc_id = 0").select(F.explode(F.sequence(F.lit(0), F.lit(99))).alias("doc_id"), "text").withColumn("source", F.concat(F.lit("s"), "doc_id"))
    assert line_dedup.clean_lines(copies).filter("n_removed > 0").count() == 0


def test_lines_odd(odd, odd_rows):
    cleaned = line_dedup.clean_lines(odd)
    assert cleaned.columns == [*odd.columns, "n_lines", "n_removed"]
    rows = cleaned.collect()
    assert Counter((r.doc_id, r.text) for r in rows if not r.n_removed) <= Counter(odd_rows) and len(rows) == len(odd_rows)


def fingerprint(text: bytes, size: int) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), text))
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(ids, prints, radius=2):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for k, i in enumerate(ids):
        least[find(k)].append(i)
    return [min((i for i in least[find(k)] if i is not None), default=None) for k in range(len(ids))]


def test_simhash(odd, odd_rows):
    prints = [fingerprint((t or "").encode(), 3) for _, t in odd_rows]
    want = [(i, f, c) for (i, _), f, c in zip(odd_rows, prints, plain_groups([i for i, _ in odd_rows], prints))]
    got = [(r.id, r.fingerprint[0] % (1 << 64), r.component_id) for r in simhash.groups(odd).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("paired", [1, 64])
def test_links_of_a_dense_group(spark, monkeypatch, paired):
    """Fingerprints packed around a few centres: large buckets are linked as pairs would be."""
    monkeypatch.setattr(simhash, "PAIRED", paired)
    draw = random.Random(4)
    prints = set()
    for _ in range(3):
        centre = draw.getrandbits(64)
        for _ in range(60):
            f = centre
            for _ in range(draw.randint(0, 5)):
                f ^= 1 << draw.randrange(64)
            prints.add(f)
    prints = sorted(prints)
    signed = [f - (1 << 64) if f >> 63 else f for f in prints]
    nodes = spark.createDataFrame([(f, [f]) for f in signed], "node long, fingerprint array<bigint>")
    roots = {r.node: r.root for r in components(simhash.links(nodes)).collect()}
    got = Counter(roots.get(f, f) for f in signed)
    want = Counter(plain_groups(signed, prints))
    assert sorted(got.values()) == sorted(want.values())


def test_wide_arrangement(spark):
    """Similar texts of five-word shingles meet, others do not, and one of each group stays with its columns."""
    draw = random.Random(6)
    rows, n = [], 0
    for group in range(12):
        words = [f"w{draw.randint(0, 3000)}" for _ in range(300)]
        for copy in range(3):
            mine = list(words)
            for k in draw.sample(range(300), 2 * copy):
                mine[k] = f"x{draw.randint(0, 9999)}"
            rows.append((n, " ".join(mine), group, "kept"))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, group int, root string")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.group) for r in kept.collect()) == [(3 * g, g) for g in range(12)]


def test_one_of_each_odd(odd, odd_rows):
    kept = simhash.one_of_each(odd).collect()
    assert len(kept) == len({(r.doc_id, r.text) for r in kept}) < len(odd_rows)
    assert {r.doc_id for r in kept} >= {0, 100, 103, 105}
    assert not {101, 104, 106, 112} & {r.doc_id for r in kept}


def test_components(spark):
    draw = random.Random(8)
    edges = [(k, k + 1) for k in range(60)] + [(100, 200 + k) for k in range(40)] + [(500, 500), (7, 3), (7, 3)] + [(draw.randint(900, 960), draw.randint(900, 960)) for _ in range(40)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root}


def plain_windows(rows, symbols, window, earlier):
    """For each row a mask of the symbols that go."""
    held = [symbols((t or "").encode()) for _, t in rows]
    seen = defaultdict(list)
    for k, s in enumerate(held):
        for i in range(len(s) - window + 1):
            seen[tuple(s[i : i + window]) if isinstance(s, list) else s[i : i + window]].append(k)
    ids = [NO_ID if i is None else i for i, _ in rows]
    out = []
    for k, s in enumerate(held):
        mask = np.zeros(len(s), bool)
        for i in range(len(s) - window + 1):
            at = seen[tuple(s[i : i + window]) if isinstance(s, list) else s[i : i + window]]
            if (min(ids[x] for x in at) < ids[k]) if earlier else len(at) > 1:
                mask[i : i + window] = True
        out.append(mask)
    return held, out


def short(odd_rows):
    return [(i, t) for i, t in odd_rows if len(t or "") < 100_000]


@pytest.mark.parametrize("held", [substring_dedup.HELD, 1])
def test_substrings(odd, odd_rows, held):
    held_words, masks = plain_windows(odd_rows, substring_dedup.words_of, 13, True)
    want = [(i, len(w), int(m.sum()), b" ".join(x for x, g in zip(w, m) if not g).decode()) for (i, _), w, m in zip(odd_rows, held_words, masks)]
    found = substring_dedup.remove_repeats(odd, held=held).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found), key=repr) == sorted(want, key=repr)
    assert all(sum(s.words for s in r.spans) == r.n_removed for r in found) and any(r.n_removed for r in found)


@pytest.mark.parametrize("held", [suffix_dedup.HELD, 1])
def test_suffixes(odd, odd_rows, held):
    rows = short(odd_rows)
    texts, masks = plain_windows(rows, bytes, 200, False)
    want = [(i, len(t), int(m.sum()), bytes(np.frombuffer(t, np.uint8)[~m])) for (i, _), t, m in zip(rows, texts, masks)]
    found = suffix_dedup.remove_repeats(odd.filter("text is null or length(text) < 100000"), held=held).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in found), key=repr) == sorted(want, key=repr)
    assert any(r.n_removed for r in found)


def test_suffix_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    texts, masks = plain_windows(rows, bytes, 200, False)
    want = {}
    for (i, _), t, m in zip(rows, texts, masks):
        edges = np.diff(np.concatenate([[0], m.view(np.int8), [0]]))
        want[i] = (len(t), int(m.sum()), int((edges == 1).sum()), digest(bytes(np.frombuffer(t, np.uint8)[~m])))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op6_suffix_dedup(spark, sf).collect()} == want


def test_simhash_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    prints = [fingerprint(t.encode(), 3) for _, t in rows]
    want = {i: (f"{f:016x}", c) for (i, _), f, c in zip(rows, prints, plain_groups([i for i, _ in rows], prints))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op1_simhash(spark, sf).collect()} == want


def test_suffix_array():
    draw = random.Random(1)
    for _ in range(400):
        x = [draw.randint(1, draw.randint(1, 4)) for _ in range(draw.randint(0, 60))] + [0]
        assert suffix_array(np.array(x)).tolist() == sorted(range(len(x)), key=lambda i: x[i:])
    with pytest.raises(ValueError):
        suffix_array(np.array([1, 0, 0]))


def test_repeats_within_symbols():
    """Windows that begin and end inside words, periodic ones, and scripts without blanks."""
    draw = random.Random(9)
    for case in range(60):
        signs = [b"ab ", b"a", b"abc d", "日本 ".encode(), b"xy"][case % 5]
        base = bytes(draw.choice(signs) for _ in range(120))
        spans = list(dict.fromkeys(bytes(draw.choice(signs) for _ in range(draw.randint(0, 4))) + base[draw.randint(0, 20) :] + bytes(draw.choice(signs) for _ in range(5)) for _ in range(4)))
        number, start = suffix_dedup.repeats(spans, 20)
        seen = Counter(s[i : i + 20] for s in spans for i in range(len(s) - 19))
        assert set(zip(number.tolist(), start.tolist())) == {(k, i) for k, s in enumerate(spans) for i in range(len(s) - 19) if seen[s[i : i + 20]] > 1}


def test_anchors_follow_content():
    """Equal windows have equal anchors at equal offsets, over stretch borders too."""
    draw = np.random.default_rng(3)
    passage = draw.integers(0, 1 << 63, 80, dtype=np.uint64)
    places = []
    for before in (5, 1000, (1 << 20) - 30):
        grams = gram_hashes(np.concatenate([draw.integers(0, 1 << 63, before, dtype=np.uint64), passage]), 3)
        at, first, last = find_anchors(grams, 13, 3)
        assert (last[:-1] + 1 == first[1:]).all() and first[0] == 0 and last[-1] == before + 80 - 13
        own = {s: p for p, a, b in zip(at.tolist(), first.tolist(), last.tolist()) for s in range(max(a, before), b + 1)}
        places.append([own[before + s] - before for s in range(80 - 12)])
    assert places[0] == places[1] == places[2]


def test_empty(none_of):
    for found in (
        exact_dedup.keep_one(none_of), line_dedup.clean_lines(none_of), simhash.groups(none_of), simhash.one_of_each(none_of),
        substring_dedup.remove_repeats(none_of), suffix_dedup.remove_repeats(none_of),
    ):
        assert found.collect() == []


def test_wide_groups_of_any_size(spark):
    """A large group that drifts away from its smallest id: groups are those of brute force at the threshold."""
    draw = random.Random(3)
    rows, base = [], [f"w{draw.randint(0, 9999)}" for _ in range(220)]
    for chain in range(30):
        words = list(base)
        for step in range(8):
            for k in draw.sample(range(220), 3):
                words[k] = f"x{draw.randint(0, 99999)}"
            rows.append((len(rows), " ".join(words)))
    for pair in range(150):
        words = [f"y{draw.randint(0, 9999)}" for _ in range(200)]
        near = list(words)
        for k in draw.sample(range(0, 200, 7), 4):
            near[k] = f"z{draw.randint(0, 99999)}"
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(near))]
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    similar = 0
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                similar += 1
                a_, b_ = sorted((find(a), find(b)))
                root[b_] = a_
    want = {i: find(i) for i, _ in rows}
    got = {r.id: r.component_id for r in simhash.groups(spark.createDataFrame(rows, "doc_id long, text string"), **simhash.SIMILAR).collect()}
    assert similar > 150
    # no document is drawn into a group it is not in, and at most a few in a hundred of the pairs at the threshold are not found
    assert all(want[got[i]] == want[i] for i in got)
    assert sum(got[i] != want[i] for i in got) <= 0.02 * len(rows)


def test_wide_recall_at_the_threshold():
    """Of pairs whose similarity is 0.8 to 0.82, the share that the arrangement makes candidates."""
    draw, way = random.Random(10), simhash.SIMILAR
    found = []
    while len(found) < 400:
        words = [f"w{draw.randint(0, 99999)}" for _ in range(draw.randint(150, 400))]
        near = list(words)
        for k in draw.sample(range(len(words)), round(len(words) * 0.023)):
            near[k] = f"x{draw.randint(0, 99999)}"
        hashes = [np.unique(simhash._shingle_hashes(" ".join(w).encode(), way["shingle_words"])) for w in (words, near)]
        both = len(np.intersect1d(*hashes))
        if not 0.8 <= both / (len(hashes[0]) + len(hashes[1]) - both) <= 0.82:
            continue
        ends = np.array([len(hashes[0]), len(hashes[0]) + len(hashes[1])])
        flat = np.concatenate(hashes)
        bits = [simhash._majority(simhash._mixed(flat, k), ends) for k in range(way["bits"] // 64)]
        differ = np.unpackbits(np.array([b[0] ^ b[1] for b in bits]).astype(">u8").view(np.uint8))
        width = way["bits"] // way["blocks"]
        equal = (differ[: width * way["blocks"]].reshape(-1, width).sum(1) == 0).sum() >= way["agree"]
        found.append(bool(equal and differ.sum() <= way["radius"]))
    print("recall", sum(found) / len(found))
    assert sum(found) >= 0.97 * len(found)


def test_wide_nodes_are_numbers(spark):
    """Nodes of wide fingerprints travel with each of their keys, so they are numbers, not digests; groups stay the same."""
    words = [f"w{i}" for i in range(300)]
    near = [*words[:-1], "other"]
    texts = [" ".join(words), " ".join(near), " ".join(words), "one two three four five six", None, ""]
    found = simhash.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), **simhash.SIMILAR)
    assert dict(found.dtypes)["root"] == "bigint"
    assert {r.id: r.component_id for r in found.collect()} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 4}


def test_wide_buckets_give_near_pairs_only(spark, monkeypatch):
    """Strangers that share a block do not leave their bucket; near ones do, as pairs or, where they are many, as members."""
    draw = np.random.default_rng(5)
    way = {k: simhash.SIMILAR[k] for k in ("bits", "blocks", "agree", "radius")}
    prints = draw.integers(0, 2, (330, 1024), dtype=np.uint8)
    for i in range(1, 60, 2):  # pairs of about the similarity sought
        prints[i] = prints[i - 1] ^ (draw.random(1024) < 0.15)
    for i in range(60, 90):  # a group of near copies
        prints[i] = prints[60] ^ (draw.random(1024) < 0.02)
    prints[90:200, 32:48] = prints[90, 32:48]  # strangers in one bucket
    prints[210:, 512:528] = prints[210, 512:528]  # a bucket too large to be compared
    prints[210] = prints[211] ^ (draw.random(1024) < 0.1)
    monkeypatch.setattr(simhash, "WHOLE", 118)
    packed = np.packbits(prints, axis=1).view(">u8").astype(np.uint64).view(np.int64)
    nodes = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(packed)], "node long, fingerprint array<bigint>").repartition(3)
    met = simhash._met(nodes, **way).collect()
    pairs = {(min(r.u, r.v), max(r.u, r.v)) for r in met if r.v is not None}
    crowded = {}
    for r in met:
        if r.v is None:
            crowded.setdefault(r.bucket, set()).add(r.u)
    blocks = np.packbits(prints, axis=1).view(">u2")
    told = {p for ms in crowded.values() for p in ((a, b) for a in ms for b in ms if a < b)}
    want = {
        (a, b) for a in range(len(prints)) for b in range(a + 1, len(prints))
        if (blocks[a] == blocks[b]).any() and (prints[a] ^ prints[b]).sum() <= way["radius"]
    }
    assert len([p for p in want if p[0] < 60]) > 20 and (210, 211) in want
    assert want <= pairs | told
    assert any(ms >= set(range(211, 330)) for ms in crowded.values()) and all(ms <= set(range(60, 90)) or ms >= set(range(211, 330)) for ms in crowded.values())
    assert sum(90 <= a < 200 for a, _ in pairs) < 60  # of 5,995 that share the block


def test_spent_shuffles_are_given_back(spark):
    """When the near copies are known, the files of the shuffles that led there are gone; only those of small rounds may be left."""
    draw = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(draw.choice(words) for _ in range(80)) for _ in range(300)]
    docs = spark.createDataFrame([(i, t + " ende" * (i % 2)) for i, t in enumerate(texts + texts)], "doc_id long, text string").repartition(4)
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def written():
        return sum(f.length() for f in (found.apply(k) for found in [files.getAllFiles()] for k in range(found.size())) if f.getName().startswith("shuffle_"))

    before = written()
    kept = simhash.one_of_each(docs)
    for _ in range(40):
        if (left := written() - before) < 200_000:
            break
        time.sleep(0.25)
    assert left < 200_000
    assert kept.count() == 300
