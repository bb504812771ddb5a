"""Filter interactions, importance resampling and packing, against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations, permutations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labelmill.llm import interactions, packing, resampling

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def plain_audit(rows, labels):
    """rows (id, text, source), labels {id: (quality, toxic)} -> the audit's rows."""
    told = []
    for i, text, part in rows:
        text = text or ""
        w = [x for x in re.split("[ \t-\r]+", text) if x]
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows),
        }
        told.append((part or "", fails, *(x == 1 for x in labels.get(i, (0, 0)))))
    out, shapley = [], Counter()
    for part in {t[0] for t in told}:
        mine = [t for t in told if t[0] == part]
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = [t for t in mine if not any(t[1][g] for g in order[:k])]
                gone = [t for t in before if t[1][f]]
                failing = sum(t[1][f] for t in mine)
                alone = sum(t[1][f] and sum(t[1].values()) == 1 for t in mine)
                out.append((part, "".join(order), k + 1, len(before) - len(gone), len(gone), failing - len(gone), alone, sum(t[2] for t in gone), sum(t[3] for t in gone)))
                shapley[part, f] += len(gone)
    return {(*r, shapley[r[0], r[1][r[2] - 1]]) for r in out}


def test_audit(spark, odd, odd_rows):
    rows = [(r.doc_id, r.text, r.source) for r in odd.select("doc_id", "text", "source").collect()]
    rows += [(200 + k, "WORD " * 210 if k % 2 else "a b # " * 70, "site1") for k in range(4)] + [(7, "a b # " * 70, None)]
    docs = spark.createDataFrame([(i, t, s, "clash") for i, t, s in rows], "doc_id long, text string, source string, mask string")
    said = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 205) if i % 5] + [(None, 1, 1), (9, None, 1)]
    labels = spark.createDataFrame(said, "doc_id long, quality int, toxic int")
    plain = defaultdict(lambda: (0, 0))
    for i, q, t in said:
        if i is not None:
            plain[i] = (max(plain[i][0], q or 0), max(plain[i][1], t or 0))
    got = [tuple(r) for r in interactions.audit(docs, labels).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_audit(rows, plain)


def test_audit_of_nothing_and_other_filters(spark, odd, none_of, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert interactions.audit(none_of, labels).collect() == []
    two = interactions.audit(odd, labels, {"X": F.col("text").isNull(), "Y": F.length("text") < 50}, repeats=None)
    assert {r.filter_order for r in two.collect()} == {"XY", "YX"}
    assert two.filter("filter_order = 'XY' and step = 1").agg(F.sum("removed")).first()[0] == 1
    empty_labels = interactions.audit(odd, labels.filter("doc_id < -1"))
    assert empty_labels.agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


def features(text, longest):
    w = [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if x]
    return w, [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def plain_resample(rows, target, percent, least, longest, buckets, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t, longest)[1])
    t = Counter(bucket(f) for x in target for f in features(x, longest)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets))))
    out = []
    for i, text in rows:
        w, f = features(text, longest)
        weight = sum(gain(bucket(x)) for x in f)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((len(w) >= least, i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    ranked = sorted((r for r in out if r[0]), key=lambda r: (-r[4], r[1] is None, r[1], -r[3], -r[2]))
    most = percent * len(ranked) // 100
    return sorted([(*r[1:], k + 1 if k < most else None) for k, r in enumerate(ranked)] + [(*r[1:], None) for r in out if not r[0]], key=repr)


@pytest.mark.parametrize("longest,buckets,percent", [(1, 10_000, 30), (2, 97, 50), (3, 1000, 100)])
def test_resample(spark, odd, odd_rows, longest, buckets, percent):
    target = spark.createDataFrame([("the house of the Straße",), (None,), ("haus und x1",)], "text string")
    got = resampling.resample(odd, target, percent, 20, longest, buckets, 7)
    assert "text" not in got.select("doc.*").columns
    got = got.select("doc.doc_id", "n_features", "weight", "score", "rank").collect()
    want = plain_resample(odd_rows, [r.text for r in target.collect()], percent, 20, longest, buckets, 7)
    assert sorted(map(tuple, got), key=repr) == want


def test_resample_of_nothing(spark, odd, none_of):
    target = odd.select("text").limit(3)
    assert resampling.resample(none_of, target).collect() == []
    assert resampling.resample(odd, none_of.select("text")).count() == odd.count()


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_of_a_slice(kind):
    texts = pa.array(["The House of", "DES Hauses", None, "", "x1 Straße, the END"], kind).fill_null("")
    for first in range(len(texts)):
        numbers, ends, dictionary = resampling.words(texts.slice(first))
        again = resampling.words(pa.array(texts.slice(first).to_pylist(), kind))
        assert [dictionary[n].as_py() for n in numbers] == [again[2][n].as_py() for n in again[0]] and ends.tolist() == again[1].tolist()


def test_resample_of_many_texts(spark):
    """More text in a batch than one piece holds."""
    rows = [(i, " ".join(f"W{i}x{j} House" for j in range(3000))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    target = docs.filter("doc_id >= 100").select("text")
    got = resampling.resample(docs, target, 30, 20, 1, 997, 7).select("doc.doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=repr) == plain_resample(rows, [t for i, t in rows if i >= 100], 30, 20, 1, 997, 7)


def plain_ids(text):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def held(placed, capacity):
    """Sequences are gapless from 0 and within the capacity."""
    by = defaultdict(list)
    for r in placed:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("capacity", [2048, 37])
def test_packing(spark, odd, odd_rows, capacity):
    more = ["<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "á ́b e̸ ̸", "ΑΣ Σ ΟΔΟΣ.", "x y z\u0085q\x1cr", "it's DON'T we'll", "\x0b\x0c a",
            " ".join(a + w + z for w in ("Éclair", "straße", "ÀÞÿ", "abc", "İx", "ǅ", "Kelvin", "a1b", "ﬁ", "J̌", "it's") for a in ("", "'", "x") for z in ("", ",", "'.", "!?)", "'s", "̸"))]
    docs = odd.unionByName(spark.createDataFrame([(900 + k, t) for k, t in enumerate(more)], "doc_id long, text string"), allowMissingColumns=True)
    rows = odd_rows + [(900 + k, t) for k, t in enumerate(more)]
    cuts = packing.token_pieces(docs, TOKENIZER, capacity, 0)
    placed = packing.place(cuts, capacity).collect()
    got = Counter((r.id, r.piece, r.start, bytes(r.ids)) for r in placed)
    want = Counter()
    for i, t in rows:
        ids = plain_ids(t)
        want.update((i, k // capacity, k, np.array(ids[k : k + capacity], "<u4").tobytes()) for k in range(0, len(ids), capacity))
    assert got == want
    assert all(r.length == len(r.ids) // 4 for r in placed)
    least = -(-sum(r.length for r in placed) // capacity)
    assert held(placed, capacity) <= least * 1.02 + 1


def test_sequences(spark, odd):
    placed = packing.place(packing.token_pieces(odd, TOKENIZER, 64), 64)
    by = defaultdict(list)
    for r in placed.collect():
        by[r.sequence_id].append(r)
    made = packing.sequences(placed).collect()
    assert {r.sequence_id: bytes(r.ids) for r in made} == {k: b"".join(bytes(r.ids) for r in sorted(v, key=lambda r: r.offset)) for k, v in by.items()}
    assert all(r.length == len(r.ids) // 4 == sum(p.length for p in r.pieces) for r in made)


def test_packing_of_nothing(spark, none_of):
    assert packing.place(packing.token_pieces(none_of, TOKENIZER)).collect() == []


def fewest(sizes, capacity):
    """The least number of sequences, by trying."""
    best = len(sizes)

    def put(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(sizes):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= sizes[k]}:
            rest = list(rooms)
            rest.remove(room)
            put(k + 1, [*rest, room - sizes[k]])
        put(k + 1, [*rooms, capacity - sizes[k]])

    sizes = sorted(sizes, reverse=True)
    put(0, [])
    return best


def test_reduction_loses_nothing():
    """What the reduction fixes leaves the least number of sequences within reach."""
    draw = random.Random(4)
    fixed = 0
    for _ in range(400):
        capacity = draw.randint(8, 30)
        sizes = [draw.randint(draw.choice([1, capacity // 4]), capacity) for _ in range(draw.randint(1, 9))]
        plan = packing.Plan(np.bincount(sizes, minlength=capacity + 1), capacity)
        only = packing.Plan.__new__(packing.Plan)
        only.capacity, only.left, only.used, only.sequences, only.entries = capacity, np.bincount(sizes, minlength=capacity + 1), np.zeros(capacity + 1, int), 0, []
        only.reduce()
        rest = np.repeat(np.arange(capacity + 1), only.left).tolist()
        assert only.sequences + fewest(rest, capacity) == fewest(sizes, capacity)
        assert plan.sequences <= fewest(sizes, capacity) * 11 // 9 + 1
        fixed += only.sequences
    assert fixed > 800


def test_best_fit_is_best_fit():
    """The plan on counts puts pieces where best fit puts them one by one."""
    draw = random.Random(6)
    for _ in range(60):
        capacity = draw.randint(20, 60)
        sizes = sorted((draw.randint(1, capacity) for _ in range(80)), reverse=True)
        plan = packing.Plan.__new__(packing.Plan)
        plan.capacity, plan.left, plan.used, plan.sequences, plan.entries = capacity, np.bincount(sizes, minlength=capacity + 1), np.zeros(capacity + 1, int), 0, []
        plan.best_fit()
        rooms = []
        for size in sizes:
            fitting = [r for r in rooms if r >= size]
            if fitting:
                rooms.remove(min(fitting))
            rooms.append((min(fitting) if fitting else capacity) - size)
        fill = np.zeros(plan.sequences, int)
        for length, _, many, each, first, _ in plan.entries:
            fill[first : first + many] += length * each
        assert sorted((capacity - fill).tolist()) == sorted(rooms)
        assert all(a != b for a, b in combinations(plan.entries, 2))
