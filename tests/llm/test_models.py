"""Language identification, language model, tokens, licences and decontamination against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from labelmill.llm import bpe, decontaminate, language, licenses, lm, queries

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


def documents(spark, sf):
    return [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]


# language

def plain_marginals(evidence, transitions, initial):
    n, size = evidence.shape
    forward, backward = np.zeros((n, size)), np.zeros((n, size))
    for t in range(n):
        for k in range(size):
            before = [initial[k]] if t == 0 else [forward[t - 1, j] + transitions[j, k] for j in range(size)]
            forward[t, k] = np.logaddexp.reduce(before) + evidence[t, k]
    for t in range(n - 2, -1, -1):
        for k in range(size):
            backward[t, k] = np.logaddexp.reduce([transitions[k, j] + evidence[t + 1, j] + backward[t + 1, j] for j in range(size)])
    out = np.exp(forward + backward - np.logaddexp.reduce(forward[-1]))
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("lengths", [[1], [64], [1, 2, 63, 64, 65, 130, 1], [5] * 40])
def test_forward_backward(lengths):
    draw = np.random.default_rng(1)
    evidence, transitions, initial = draw.normal(size=(sum(lengths), 3)), draw.normal(size=(3, 3)), draw.normal(size=3)
    first = np.zeros(sum(lengths), bool)
    first[np.cumsum([0, *lengths[:-1]])] = True
    got = language.forward_backward(evidence, first, transitions, initial)
    at = 0
    for n in lengths:
        assert np.allclose(got[at : at + n], plain_marginals(evidence[at : at + n], transitions, initial))
        at += n


def test_pair_gradient():
    """Expected pairs are the slope of the log partition sum by the transitions."""
    draw = np.random.default_rng(2)
    lengths = [5, 1, 3, 70]
    evidence, transitions, initial = draw.normal(size=(sum(lengths), 3)) * 2, draw.normal(size=(3, 3)), draw.normal(size=3)
    first = np.zeros(sum(lengths), bool)
    first[np.cumsum([0, *lengths[:-1]])] = True

    def log_sum(moves):
        total, at = 0.0, 0
        for n in lengths:
            message = initial + evidence[at]
            for t in range(1, n):
                message = np.logaddexp.reduce(message[:, None] + moves, axis=0) + evidence[at + t]
            total, at = total + np.logaddexp.reduce(message), at + n
        return total

    forward, backward = language.messages(evidence, first, transitions, initial)
    inner = np.flatnonzero(~first[1:])
    got = language.pairs(evidence, inner, transitions, forward, backward).sum(axis=0)
    for j in range(3):
        for k in range(3):
            step = np.zeros((3, 3))
            step[j, k] = 1e-5
            assert abs((log_sum(transitions + step) - log_sum(transitions - step)) / 2e-5 - got[j, k]) < 1e-4


def test_words_are_read_whole():
    """What stands after many letters changes the evidence; words of one text do not change another's."""
    model = language.train([("der hund und die katze sind in dem haus " * 5, "de"), ("the dog and the cat are in the house " * 5, "en")] * 20)
    a, b = model.evidence(["x" * 40 + "thehouse", "x" * 40 + "derkatze"])
    assert a.argmax() == 1 and b.argmax() == 0
    words = ["a", "ab", "abc", "x" * 300, "é", "日本語"]
    alone = np.concatenate([model.evidence([w]) for w in words])
    assert np.allclose(alone, model.evidence(words))


def test_prediction_from_a_model(spark, odd, odd_rows):
    """Every row's prediction is what plain recursions over its words give."""
    model = language.train([("der hund und die katze sind in dem haus " * 5, "de"), ("the dog and the cat are in the house " * 5, "en")] * 20)
    small = [(i, t) for i, t in odd_rows if len(t or "") < 3000]
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(small)], "doc_id long, text string")
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    for k, (_, text) in enumerate(small):
        words = language.words_of(text or "")
        if not words:
            assert (got[k].lang_pred, got[k].score) == ("und", 0)
            continue
        shares = plain_marginals(model.evidence(words), model.transitions, model.initial).mean(axis=0)
        assert got[k].lang_pred == model.languages[shares.argmax()] and abs(got[k].score - shares.max()) < 1e-9 and got[k].n_words == len(words)


def test_language_query(spark, sf):
    got = {r.doc_id: r for r in queries.op2_language_id(spark, sf).collect()}
    rows = documents(spark, sf)
    assert set(got) == {i for i, *_ in rows}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in rows)
    held = [(i, lang) for i, _, lang in rows if got[i].held_out]
    assert sum(got[i].lang_pred == lang for i, lang in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_code_switching():
    """A passage of another language is labelled as such inside a text."""
    texts = [("der hund und die katze sind in dem haus " * 5, "de"), ("the dog and the cat are in the house " * 5, "en")] * 20
    model = language.train(texts)
    words = language.words_of("the dog and the house der hund und die katze the cat and the dog")
    found = model.marginals(words, np.eye(len(words))[0].astype(bool)).argmax(axis=1)
    assert "".join(model.languages[k][0] for k in found) == "e" * 5 + "d" * 5 + "e" * 5


def test_language_odd(odd, none_of):
    model = language.fit(odd)
    assert model.languages == ["de", "en", "ja"]
    found = language.predict(odd, model).collect()
    assert len(found) == odd.count()
    for r in found:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und" and r.score == 0) if not letters else (r.lang_pred in model.languages and 0 < r.score <= 1)
    nothing = language.fit(none_of)
    assert {r.lang_pred for r in language.predict(odd, nothing).collect()} == {"und"}
    assert language.predict(none_of, model).collect() == []
    kept = language.predict(odd, model, prefix="new_")
    assert kept.columns == [*odd.columns, "new_lang_pred", "new_score", "new_n_words", "new_shares"]


# language model

def test_lm_query(spark, sf):
    rows = documents(spark, sf)
    tokens = {i: [*lm.words_of(t.encode()), b""] for i, t, _ in rows}
    trained = [i for i in tokens if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = Counter(w for i in trained for w in tokens[i])
    total, kinds = sum(counts.values()), len(counts)
    held = base = score = 0
    for r in queries.op3_lm_scoring(spark, sf).collect():
        mine = tokens[r.doc_id]
        want = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in mine)
        assert r.base_score == pytest.approx(want, rel=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(mine), sum(w in counts for w in mine), total)
        assert r.held_out == (r.doc_id not in trained)
        if r.held_out:
            held, base, score = held + len(mine), base + r.base_score, score + r.score
    assert score / held > base / held + 0.1


def test_lm_sums_to_one(spark):
    """Over every next token, the unseen one of each class included, probabilities sum to one."""
    draw = random.Random(3)
    texts = [" ".join(draw.choice(["a", "b", "cc", "dd", "eee", f"w{draw.randint(0, 300)}"]) for _ in range(30)) for _ in range(80)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    model, counts = lm.fit(frame)
    of_class = Counter()
    for r in counts.collect():
        k = model.classes[model.words[r.token]]
        of_class[k] += 1.0 if k < lm.OWN else (r.c + 0.5) / model.masses[k]
    for k in range(lm.OWN, lm.CLASSES):
        of_class[k] += 0.5 / model.masses[k]
    contexts = np.array([[0, 1, 2], [lm.CLASSES] * 3, [lm.OWN, 3, lm.CLASSES]])
    for context in contexts:
        logs = model.class_log10(np.tile(context, (lm.CLASSES, 1)), np.arange(lm.CLASSES))
        assert sum(10**x for x in logs) == pytest.approx(1, abs=1e-4)
    used = {k for k in of_class}
    assert all(of_class[k] == pytest.approx(1) for k in used)


def test_lm_score_token_by_token(spark):
    """score is, token by token, the class's probability after the three classes before it, times the token's share of its class."""
    draw = random.Random(9)
    pick = lambda n: " ".join(draw.choice(["the", "dog", "Runs", "far", f"x{draw.randint(0, 400)}", f"zq{draw.randint(0, 9)}"]) for _ in range(n))
    texts = [pick(draw.randint(1, 40)) for _ in range(120)]
    model, counts = lm.fit(spark.createDataFrame([(t,) for t in texts], "text string"), most_words=150)
    c = {r.token: r.c for r in counts.collect()}
    own = [t for t, k in zip(model.words, model.classes) if k < lm.OWN]
    kind = lambda w: own.index(w) if w in own else lm._ending_class(w)
    assert all(model.classes[model.words[w]] == kind(w) for w in own)
    asked = [*texts[:20], "", None, "never seen words zq1", "x" * 50]
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    for r in lm.score(docs, model, counts).collect():
        words = [*(asked[r.doc_id] or "").lower().split(), ""]
        kinds, want = [kind(w) for w in words], 0.0
        for i, w in enumerate(words):
            before = [kinds[i - j] if i >= j else lm.CLASSES for j in (1, 2, 3)]
            scores = model.target @ sum(model.context[j][before[j]] for j in range(3)) + model.bias
            want += (scores[kinds[i]] - np.logaddexp.reduce(scores.astype(float))) / math.log(10)
            want += 0 if kinds[i] < lm.OWN else math.log10((c.get(w, 0) + 0.5) / model.masses[kinds[i]])
        assert r.score == pytest.approx(want, rel=1e-5)


def test_lm_gathers_from_all_texts(spark):
    """What only the ends of long texts say is learned, and every token is seen once."""
    texts = ["a b " * 30_000 + "q r " * 30_000] * 6
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    model, _ = lm.fit(frame)
    kind = {w: int(model.classes[model.words[w]]) for w in "abqr"}
    after = lambda w, then: model.class_log10(np.array([[kind[w], kind[then], kind[w]]]), np.array([kind[then]]))[0]
    assert after("q", "r") > math.log10(0.8) and after("a", "b") > math.log10(0.8)


def test_lm_split_of_words(spark, odd, none_of):
    """Counts that travel and counts that are joined give the same scores."""
    texts = odd.selectExpr("coalesce(text, '') as text")
    scores = []
    for most in (100_000, 6_000):
        model, counts = lm.fit(texts, most_words=most)
        scores.append(sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 3)) for r in lm.score(odd, model, counts).collect()), key=repr))
    assert scores[0] == scores[1]
    model, counts = lm.fit(none_of.selectExpr("text"))
    found = lm.score(odd, model, counts).collect()
    assert len(found) == odd.count() and all(abs(r.base_score) < 1e-6 and r.n_known == 0 and r.score < 0 for r in found)
    assert lm.score(none_of, model, counts).collect() == []


# tokens

@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def encoder():
    said = bpe.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    return bpe.TextEncoder(bpe.Automaton(said["vocabulary"], said["merges"], said["word_end"]), said["front"], said["special"])


def test_tokens_as_the_library(library, encoder):
    draw = random.Random(3)
    signs = "aabbrrlloo  éÉßñΣσςİıſK中文字🙂👍🏽́é\x1c\x1f\x85\xa0 　\t\n''ssttrevmld!!??..12٣½"
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 80))) for _ in range(3000)]
    texts += [draw.choice("abehlmotuz!?=-r") * draw.randint(1, 70) + draw.choice(["", "a", " s"]) for _ in range(800)]
    texts += ["", " ", "<|startoftext|>Hi<|endoftext|> x<|endoftext|>", "<|STARTOFTEXT|>", "it's they're ROCK'N'ROLL", "a" * 20_000]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == want, text
        assert encoder.decode(want) == library.decode(want, skip_special_tokens=False)


def test_every_code_point(library, encoder):
    """All signs Unicode may have, alone and between letters and digits."""
    points = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(0xE0000, 0xE0200)]
    texts = ["".join(f"a{p}b{p}1 {p} " for p in points[k : k + 64]) for k in range(0, len(points), 64)]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert encoder.encode(text) == want.ids, text[:40]


def test_automaton_against_merging():
    """Random merge tables over three signs: the automaton's path is what merging in order gives."""
    draw = random.Random(7)
    for _ in range(60):
        pieces, merges = ["a", "b", "c"], []
        for _ in range(draw.randint(1, 12)):
            u, v = draw.choice(pieces), draw.choice(pieces)
            if u + v not in pieces and len(u + v) < 9:
                pieces.append(u + v)
                merges.append((u, v))
        vocabulary = {p: i for i, p in enumerate(pieces)}
        encoder = bpe.WordEncoder(bpe.Automaton(vocabulary, merges))
        for _ in range(60):
            word = "".join(draw.choice("abc") for _ in range(draw.randint(1, 14)))
            parts = list(word)
            for u, v in merges:
                k = 0
                while k + 1 < len(parts):
                    if parts[k] == u and parts[k + 1] == v:
                        parts[k : k + 2] = [u + v]
                    k += 1
            assert [pieces[i] for i in encoder.encode(word)] == parts


def test_tokens_query(spark, sf, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op4_bpe(spark, sf).collect()}
    for i, text, _ in documents(spark, sf):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_tokens_odd(odd, none_of, library):
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode(odd, path)
    assert coded.columns == [*odd.columns, "token_ids", "decoded"]
    rows = coded.collect()
    assert len(rows) == odd.count()
    assert all(list(r.token_ids) == library.encode(r.text or "", add_special_tokens=False).ids for r in rows)
    assert bpe.encode(none_of, path).collect() == []


# licences

def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for k, y in enumerate(b):
            before, row[k + 1] = row[k + 1], before + 1 if x == y else max(row[k + 1], row[k])
    return row[-1]


def test_alignment():
    draw = random.Random(5)
    for _ in range(300):
        a = [draw.randint(0, 12) for _ in range(draw.randint(0, 14))]
        b = [draw.randint(0, 12) for _ in range(draw.randint(0, 14))]
        pairs = licenses.align(a, b)
        assert all(a[i] == b[k] for i, k in pairs) and all(p < q and r < s for (p, r), (q, s) in zip(pairs, pairs[1:]))
        assert len(pairs) <= longest_common(a, b)
    words = list(range(30))
    assert len(licenses.align(words, words[:10] + [99, 98] + words[10:20] + words[22:])) == 28


def test_licenses_found():
    """Planted notices, exact, reflowed, with words changed, left out and put in, and more than once; none where too little is left."""
    draw = random.Random(6)
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, text in licenses.TEMPLATES.items():
        template = decontaminate.words_of(text.encode())
        for change in range(4):
            mine = list(template)
            spare = int(len(template) * 0.2) if change else 0
            for k in sorted(draw.sample(range(1, len(mine) - 1), min(spare, len(mine) - 2)), reverse=True):
                mine[k : k + 1] = [[b"other"], [], [mine[k], b"put", b"in"]][change - 1]
            filler = [f"w{draw.randint(0, 99)}".encode() for _ in range(200)]
            found = scanner.scan(filler[:70] + mine + filler[70:140] + mine + filler[140:])
            own = [s for s in found if s[0] == name]
            assert len(own) == 2 and all(s[3] >= 0.8 for s in own)
            assert 70 - 2 <= own[0][1] <= 72 and abs(own[0][2] - len(mine)) <= 3
        half = template[: len(template) // 2]
        assert not [s for s in scanner.scan(filler[:50] + half + filler[50:]) if s[0] == name]


def test_license_query(spark, sf):
    """Every row of the table; where a notice line stands verbatim it is found."""
    got = {r.doc_id: r for r in queries.op8_license_scan(spark, sf).collect()}
    rows = documents(spark, sf)
    assert set(got) == {i for i, *_ in rows}
    for i, text, _ in rows:
        words = b" " + b" ".join(decontaminate.words_of(text.encode())) + b" "
        assert got[i].n_words == len(words.split())
        for name, template in licenses.TEMPLATES.items():
            if b" " + b" ".join(decontaminate.words_of(template.encode())) + b" " in words:
                assert name in got[i].licenses.split(",")
        if not re.search("licen|permi|redistr", text, re.I):
            assert got[i].n_spans == 0


def test_licenses_odd(odd, none_of):
    found = licenses.scan(odd)
    assert found.count() == odd.count() and found.filter("size(spans) > 0").count() == 0
    assert licenses.scan(none_of).collect() == []
    own = {(r.doc_id, r.n_words): r.spans for r in licenses.scan(odd, {"a": "haus und", "none": "!!!"}, coverage=1.0).collect()}
    want = [(r.doc_id, w) for r in odd.collect() for w in [decontaminate.words_of((r.text or "").encode())]]
    with_it = [(i, len(w)) for i, w in want if (b"haus", b"und") in zip(w, w[1:])]
    assert with_it and all(own[k] for k in with_it)


# decontamination

def test_decontamination_odd(spark, odd, none_of, odd_rows):
    shared = [t for i, t in odd_rows if i == 105 and len(t) > 20][0]
    items = spark.createDataFrame(
        [
            ("x", " ".join(shared.split()[5:22]), "c"), ("y", "DER! die", "c"), ("y", "haus the and", "c"), (None, " ".join(shared.split()[30:45]), "c"), ("z", None, "c"),
            ("z", "", "c"), ("w", "nicht in den texten vorhanden hier gar nichts davon ist da", "c"), ("one", "x1", None), ("ja", "日本語のテキスト" * 60, None),
        ],
        "item_id string, text string, id string",
    )
    windows = []
    for r in items.collect():
        words = decontaminate.words_of((r.text or "").encode())
        n = min(10, len(words))
        windows += [(r.item_id, words[k : k + n]) for k in range(len(words) - n + 1) if words]
    want = []
    for i, t in odd_rows:
        words = decontaminate.words_of((t or "").encode())
        hit, names = set(), set()
        index = {}
        for n in {len(w) for _, w in windows}:
            for k in range(len(words) - n + 1):
                index.setdefault(tuple(words[k : k + n]), []).append(k)
        for name, w in windows:
            for k in index.get(tuple(w), []):
                hit |= set(range(k, k + len(w)))
                names |= {name} - {None}
        want.append((i, len(words), len(hit), sorted(names), bool(hit)))
    found = decontaminate.find(odd, items)
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(c for *_, c in want) and not all(c for *_, c in want)
    assert not [r for r in decontaminate.find(odd, items.filter("item_id = 'none'")).collect() if r.contaminated]
    assert decontaminate.find(none_of, items).collect() == []
