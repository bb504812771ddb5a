"""A log-bilinear language model: corpus counts in Spark, vectors by noise-contrastive estimation, whole texts scored.

A token is a word or the end of a text. Every token has a class: the most frequent
tokens are classes of their own, the others are classed by their last letters,
unknown ones too. The probability of a token is that of its class, given the
classes of the three tokens before it, times its share of its class. Shares come
from counts over all training texts, add-half smoothed, with one place in each
class for what was never seen; so the probabilities of all tokens sum to one.

Class probabilities are log-bilinear: the vectors of the context classes, each
through the matrix of its position, add up to a predicted vector, whose product
with the class vectors gives the scores. The vectors are trained by telling real
classes from noise, on every token of every training text: each task learns from the
texts it reads, all from one start, and the tasks' vectors are averaged by the tokens
they saw. Scoring normalises over all classes in batched products, once for each
different context of a batch.

Counts of the ``most_words`` most frequent words travel to the tasks; those of the
others are joined on the word, where no key can be hot.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import LOWER, Memo, cut, pieces, text_of, texts_of

OWN = 128
SHARED = 128
CLASSES = OWN + SHARED
ORDER = 3
WIDTH = 32
NOISE = 32
#: Tokens of a step.
STEP = 4096
#: Frequent words whose counts travel to the tasks.
MOST_WORDS = 100_000
#: Words counted in a task before their counts are passed on.
COUNTED = 200_000
#: The end of a text; no word is empty.
END = ""


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def _ending(token: Column) -> Column:
    return F.pmod(F.xxhash64(F.substring(token, -2, 2)), F.lit(SHARED)) + OWN


def _ending_class(word: str) -> int:
    """As ``_ending``: Spark's hash of a string is XXH64 of its bytes with seed 42."""
    signed = xxhash.xxh64_intdigest(word[-2:].encode(), 42)
    return (signed - (1 << 64) if signed >> 63 else signed) % SHARED + OWN


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token, c) over all texts, the end of each counted as a token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def passed_on() -> pa.RecordBatch:
            tokens, n = pa.array(counts.keys(), pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64())
            counts.clear()
            return pa.RecordBatch.from_arrays([tokens, n], names=["token", "c"])

        for whole in batches:
            for batch in pieces(whole):
                for text in texts_of(batch):
                    counts.update(words_of(text))
                counts[b""] += batch.num_rows
                if len(counts) > COUNTED:
                    yield passed_on()
        if counts:
            yield passed_on()

    return texts.select("text").mapInArrow(run, "token string, c long").groupBy("token").agg(F.sum("c").alias("c"))


@dataclass
class Model:
    """Bounded tables: words, their counts and classes; class masses; vectors."""

    tokens: int
    kinds: int
    words: dict[str, int]
    counts: np.ndarray
    classes: np.ndarray
    masses: np.ndarray
    context: np.ndarray
    target: np.ndarray
    bias: np.ndarray

    def class_log10(self, contexts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """log10 of the wanted classes' probabilities; contexts are rows of ORDER classes, CLASSES where there is no token."""
        keys = contexts @ (np.int64(CLASSES + 1) ** np.arange(ORDER))
        _, one, back = np.unique(keys, return_index=True, return_inverse=True)
        order = np.argsort(back, kind="stable")
        bounds = np.searchsorted(back[order], np.arange(0, len(one) + 4096, 4096))
        out = np.empty(len(wanted))
        for k, at in enumerate(range(0, len(one), 4096)):
            some = contexts[one[at : at + 4096]]
            predicted = self.context[0][some[:, 0]]
            for i in range(1, ORDER):
                predicted = predicted + self.context[i][some[:, i]]
            scores = predicted @ self.target.T + self.bias
            top = scores.max(axis=1, keepdims=True)
            total = np.log(np.exp(scores - top).sum(axis=1)) + top[:, 0]
            here = order[bounds[k] : bounds[k + 1]]
            row = back[here] - at
            out[here] = scores[row, wanted[here]] - total[row]
        return out / np.log(10)


def contexts_of(classes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Classes of the ORDER tokens before each token; ``place`` is a token's number in its text."""
    out = np.full((len(classes), ORDER), CLASSES, np.int64)
    for i in range(ORDER):
        inside = place > i
        out[inside, i] = classes[np.flatnonzero(inside) - i - 1]
    return out


def _summed(rows: np.ndarray, kinds: np.ndarray, size: int) -> np.ndarray:
    """Rows added up by kind."""
    out = np.zeros((size, rows.shape[1]), rows.dtype)
    order = np.argsort(kinds, kind="stable")
    sorted_kinds = kinds[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_kinds[1:] != sorted_kinds[:-1]]))
    out[sorted_kinds[starts]] = np.add.reduceat(rows[order], starts, axis=0)
    return out


class Trainer:
    """Noise-contrastive estimation: NOISE classes drawn from the class frequencies against each real one, anew for each step."""

    def __init__(self, noise: np.ndarray, rate: float = 0.1, seed: int = 3):
        self.draw, self.rate = np.random.default_rng(seed), rate
        self.context = self.draw.normal(0, 0.1, (ORDER, CLASSES + 1, WIDTH)).astype(np.float32)
        self.target = self.draw.normal(0, 0.1, (CLASSES, WIDTH)).astype(np.float32)
        self.bias = np.log(noise).astype(np.float32)
        self.expected = np.log(NOISE * noise).astype(np.float32)
        self.draws = noise.cumsum() / noise.sum()
        self.past = [np.full_like(x, 1e-1) for x in (self.context, self.target, self.bias)]
        self.tokens = 0

    def learn(self, contexts: np.ndarray, wanted: np.ndarray) -> None:
        """One pass over some tokens, in an order of their own."""
        self.tokens += len(wanted)
        for some in np.array_split(self.draw.permutation(len(wanted)), max(1, len(wanted) // STEP)):
            if len(some):
                self._step(contexts[some], wanted[some])

    def _step(self, ctx: np.ndarray, real: np.ndarray) -> None:
        context, target, bias = self.context, self.target, self.bias
        predicted = sum(context[i][ctx[:, i]] for i in range(ORDER))
        # the drawn classes are noise to every token of the step, so their scores are one product
        drawn = np.minimum(np.searchsorted(self.draws, self.draw.random(NOISE)), CLASSES - 1)
        own = target[real]
        right = 1 / (1 + np.exp((predicted * own).sum(axis=1) + bias[real] - self.expected[real]))
        wrong = -1 / (1 + np.exp(self.expected[drawn] - predicted @ target[drawn].T - bias[drawn]))
        into = right[:, None] * own + wrong @ target[drawn]
        steps = [
            np.stack([_summed(into, ctx[:, i], CLASSES + 1) for i in range(ORDER)]),
            _summed(right[:, None] * predicted, real, CLASSES) + _summed(wrong.T @ predicted, drawn, CLASSES),
            (np.bincount(real, right, CLASSES) + np.bincount(drawn, wrong.sum(axis=0), CLASSES)).astype(np.float32),
        ]
        for values, step, past in zip((context, target, bias), steps, self.past):
            past += step**2
            values += self.rate * step / np.sqrt(past)

    def vectors(self) -> np.ndarray:
        """All of them in a row."""
        return np.concatenate([x.ravel() for x in (self.context, self.target, self.bias)]).astype(np.float64)


def unpacked(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, target and bias from ``Trainer.vectors``."""
    first, second = ORDER * (CLASSES + 1) * WIDTH, CLASSES * WIDTH
    flat = flat.astype(np.float32)
    return flat[:first].reshape(ORDER, CLASSES + 1, WIDTH), flat[first : first + second].reshape(CLASSES, WIDTH), flat[first + second :]


def train_vectors(texts: DataFrame, words: dict[str, int], classes: np.ndarray, noise: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors learned from every token of the texts (text): a task's by its own texts, then the mean by tokens.

    What a task passes on has a fixed size; the sums are made in two steps, so no task
    adds up more than about the root of the number of tasks. Without a text the
    vectors are those at the start.
    """
    shared = texts.sparkSession.sparkContext.broadcast((words, classes, noise))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, kinds_of, share = shared.value
        named = {w.encode(): int(kinds_of[i]) for w, i in frequent.items()}
        memo = Memo(lambda w: named[w] if w in named else _ending_class(w.decode()))
        trainer = Trainer(share)
        for whole in batches:
            for batch in pieces(whole):
                memo.trim()
                tokens = [[*words_of(t), b""] for t in texts_of(batch)]
                sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
                kinds = np.fromiter((k for t in tokens for k in map(memo.__getitem__, t)), np.int64, int(sizes.sum()))
                trainer.learn(contexts_of(kinds, np.arange(len(kinds)) - np.repeat(np.cumsum(sizes) - sizes, sizes)), kinds)
        if trainer.tokens:
            yield packed(trainer.tokens, trainer.vectors() * trainer.tokens)

    def packed(tokens: float, sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([float(tokens)]), pa.array([sums.tobytes()], pa.binary())], names=["tokens", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, sums = 0.0, None
        for batch in batches:
            for n, part in zip(batch.column("tokens").to_pylist(), batch.column("sums")):
                tokens += n
                part = np.frombuffer(part.as_buffer())
                sums = part.copy() if sums is None else sums + part
        if sums is not None:
            yield packed(tokens, sums)

    schema = "tokens double, sums binary"
    # a task's row is kept before the sums ask for it
    learned = cut(texts.select("text").mapInArrow(learn, schema))
    between = max(1, math.isqrt(learned.rdd.getNumPartitions()))
    row = learned.repartition(between).mapInArrow(add, schema).repartition(1).mapInArrow(add, schema).first()
    return unpacked(np.frombuffer(row["sums"]) / row["tokens"] if row else Trainer(noise).vectors())


def _frequent(counts: DataFrame, most_words: int) -> list[tuple[str, int]]:
    """The most frequent tokens, at most ``most_words``, by falling count.

    Counts are put into eighths of powers of two, some hundreds of sizes at most;
    the largest sizes that fit together are collected, so no more than the words
    that are kept ever reach the driver.
    """
    size = F.floor(F.log2("c") * 8).cast("int")
    least, held = None, 0
    for row in sorted(counts.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        held += row["n"]
        if held > most_words:
            break
        least = row["size"]
    if least is None:
        return []
    return sorted(((r["token"], r["c"]) for r in counts.filter(size >= least).collect()), key=lambda x: (-x[1], x[0]))


def fit(texts: DataFrame, most_words: int = MOST_WORDS) -> tuple[Model, DataFrame]:
    """Texts (text) -> the model and the counts (token, c) of every token of all of them.

    Counts, class masses, totals and vectors cover all texts, whole. Null texts are empty.
    """
    counts = cut(count_tokens(texts))
    frequent = _frequent(counts, most_words)
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    own = {token: i for i, (token, _) in enumerate(frequent[:OWN])}
    rest = counts.filter(~F.col("token").isin(list(own))) if own else counts
    masses = np.full(CLASSES, 0.5)
    for token, c in frequent[:OWN]:
        masses[own[token]] = c + 0.5
    for row in rest.groupBy(_ending(F.col("token")).alias("k")).agg(F.sum(F.col("c") + 0.5).alias("mass")).collect():
        masses[row["k"]] += row["mass"]
    classes = np.array([own.get(t, -1) if t in own else _ending_class(t) for t, _ in frequent], np.int64)
    words = {t: i for i, (t, _) in enumerate(frequent)}

    vectors = train_vectors(texts, words, classes, masses / masses.sum())
    return Model(total["n"] or 0, total["v"], words, np.array([c for _, c in frequent], np.float64), classes, masses, *vectors), counts


def _score_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        logs, log_masses = np.log10(model.counts + 0.5), np.log10(model.masses)
        own = model.classes < OWN
        shares = np.where(own, 0.0, logs - log_masses[model.classes]) if len(logs) else logs
        words = {w.encode(): i for w, i in model.words.items()}
        # a frequent word by its number, another by its class below zero
        memo = Memo(lambda w: words[w] if w in words else -1 - _ending_class(w.decode()))
        for whole in batches:
            for batch in pieces(whole):
                memo.trim()
                tokens = [[*words_of(t), b""] for t in texts_of(batch)]
                sizes = np.array([len(t) for t in tokens], np.int64)
                begin = np.cumsum(sizes) - sizes
                code = np.fromiter((c for t in tokens for c in map(memo.__getitem__, t)), np.int64, int(sizes.sum()))
                known = code >= 0
                kinds = -1 - code
                kinds[known] = model.classes[code[known]]
                base = np.zeros(len(code))
                share = -log_masses[kinds]
                base[known], share[known] = logs[code[known]], shares[code[known]]
                place = np.arange(len(code)) - np.repeat(begin, sizes)
                score = model.class_log10(contexts_of(kinds, place), kinds) + share
                rare = [[w for w, c in zip(t, code[b : b + n].tolist()) if c < 0] for t, b, n in zip(tokens, begin.tolist(), sizes.tolist())]
                offsets = np.concatenate([[0], np.cumsum([len(r) for r in rare])]).astype(np.int32)
                names = pa.array([w for r in rare for w in r], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"), pa.array(sizes), pa.array(np.add.reduceat(known.astype(np.int64), begin)),
                        pa.array(np.add.reduceat(base, begin)), pa.array(np.add.reduceat(score, begin)), pa.ListArray.from_arrays(pa.array(offsets), names),
                    ],
                    names=["id", "n_tokens", "n_known", "base", "score", "rare"],
                )

    return run


def score(docs: DataFrame, model: Model, counts: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row per row of ``docs``: id, n_tokens, n_known, train_tokens, base_score, score.

    base_score is the add-half unigram log10 probability, score the model's. Null
    and empty texts are one token, the end. Rows that repeat are one row each, a
    null id stays null, other columns are not read. A model without training
    tokens knows none: base_score is 0 and score that of unknown words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    read = docs.select(F.col(id_column).cast("long").alias("id"), text_of(text_column).alias("text"))
    first = cut(read.mapInArrow(_score_rows(shared), "id long, n_tokens long, n_known long, base double, score double, rare array<string>"))
    # the checkpoint fixes the rows' places, so their numbers hold
    rows = first.withColumn("n", F.monotonically_increasing_id())
    looked_up = rows.select("n", F.explode("rare").alias("token")).join(counts, "token", "left")
    half = F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    added = looked_up.groupBy("n").agg(F.sum(half).alias("more"), F.count("c").alias("more_known"))
    level = float(np.log10(model.tokens + 0.5 * (model.kinds + 1)))
    more, more_known = F.coalesce("more", F.lit(0.0)), F.coalesce("more_known", F.lit(0))
    return rows.drop("rare").join(added, "n", "left").select(
        F.col("id").alias(id_column), "n_tokens", (F.col("n_known") + more_known).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(level)).alias("base_score"), (F.col("score") + more).alias("score"),
    )
