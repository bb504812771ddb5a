"""Language identification by a linear-chain conditional random field over words.

Every word of a text is labelled with a language. A word's evidence is the sum of
weights of its features: beginnings and ends of one to three letters, runs of two
and three letters, and the word itself (the lexicon), hashed into a table of
fixed size. Learned transitions hold neighbouring words together, so a passage in
another language is labelled as one. Forward-backward gives each word's
probabilities; a text's language is the one with the largest mean.

Training data has one label per text. Training chains are several texts in turn,
so that transitions see languages change. They come from a sample of bounded
size, ``most_rows`` whole texts chosen by their hash; prediction covers every letter
of every word of every text. Features of a text are its words only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from labelmill.llm.common import pieces, texts_of

TABLE_BITS = 18
MOST_ROWS = 1500
UNKNOWN = "und"
CHUNK = 64
_WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def _mixed(kind: int, parts: list[np.ndarray]) -> np.ndarray:
    """Feature numbers from a kind and the letters that make the feature."""
    h = np.full(parts[0].shape, kind * 0x9E3779B97F4A7C15 % (1 << 64), np.uint64)
    for part in parts:
        h = (h ^ part) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return (h & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int32)


def _feature_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of some words, flat, and where each word's begin. Every letter of a word counts, however long it is."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    # all words in a row, a zero before and after each: its edges belong to its runs
    flat = np.frombuffer(("\0" + "\0\0".join(words) + "\0").encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.cumsum(lengths + 2)
    begins = ends - lengths - 2
    owner = np.repeat(np.arange(len(words)), lengths + 2)
    features, of = [], []

    def add(kind: int, parts: list[np.ndarray], at: np.ndarray) -> None:
        features.append(_mixed(kind, parts))
        of.append(at)

    for size in (2, 3):
        at = np.flatnonzero(owner[: len(flat) - size + 1] == owner[size - 1 :])
        add(size - 1, [flat[at + k] for k in range(size)], owner[at])
    for size in (1, 2, 3):
        at = np.flatnonzero(lengths >= size)
        add(2 + size, [flat[begins[at] + 1 + k] for k in range(size)], at)
        add(5 + size, [flat[ends[at] - 2 - k] for k in range(size)], at)
    # the lexicon: a sum over the word's letters, each mixed with its place, and its length
    place = (np.arange(len(flat)) - np.repeat(begins, lengths + 2)).astype(np.uint64)
    letter = (flat ^ (place * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0x94D049BB133111EB)
    letter = (letter ^ (letter >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    add(9, [np.add.reduceat(letter, begins), lengths.astype(np.uint64)], np.arange(len(words)))
    of = np.concatenate(of)
    order = np.argsort(of, kind="stable")
    counts = np.bincount(of, minlength=len(words))
    return np.concatenate(features)[order], np.cumsum(counts) - counts


@dataclass
class Model:
    """Weights per feature and language, log transitions, log of the first word's languages."""

    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    initial: np.ndarray

    def evidence(self, words: list[str]) -> np.ndarray:
        features, begin = _feature_rows(words)
        return np.add.reduceat(self.weights[features], begin, axis=0)

    def marginals(self, words: list[str], first: np.ndarray) -> np.ndarray:
        """Probabilities of each language at each word. ``first`` marks words that begin a text."""
        distinct: dict[str, int] = {}
        which = np.fromiter((distinct.setdefault(w, len(distinct)) for w in words), np.int64, len(words))
        return forward_backward(self.evidence(list(distinct))[which], first, self.transitions, self.initial)


def forward_backward(evidence: np.ndarray, first: np.ndarray, transitions: np.ndarray, initial: np.ndarray) -> np.ndarray:
    """Marginals of many chains laid end to end."""
    forward, backward = messages(evidence, first, transitions, initial)
    both = forward * backward
    return both / both.sum(axis=1, keepdims=True)


def pairs(evidence: np.ndarray, at: np.ndarray, transitions: np.ndarray, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    """Probabilities of the labels of words ``at`` and the words after them: what leads to the one, the step, what follows the other."""
    local = np.exp(evidence[at + 1] - evidence[at + 1].max(axis=1, keepdims=True))
    joint = forward[at][:, :, None] * np.exp(transitions)[None] * (local * backward[at + 1])[:, None, :]
    return joint / joint.sum(axis=(1, 2), keepdims=True)


def messages(evidence: np.ndarray, first: np.ndarray, transitions: np.ndarray, initial: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages of many chains laid end to end, each word's to a scale of its own.

    The step into a word is a matrix: the transitions times the word's evidence, or,
    where a chain begins, the initial weights whatever came before. Products of such
    matrices over chunks of equal length run side by side; the messages that enter
    the chunks follow from those products, and the messages inside run side by side again.
    """
    n, size = evidence.shape
    many = -(-n // CHUNK)
    local = np.exp(evidence - evidence.max(axis=1, keepdims=True))
    padded = np.ones((many * CHUNK, size))
    padded[:n] = local
    starts = np.zeros(many * CHUNK, bool)
    starts[:n] = first
    starts[n:] = True
    padded, starts = padded.reshape(many, CHUNK, size), starts.reshape(many, CHUNK)
    move, begin = np.exp(transitions), np.exp(initial)

    def normal(x: np.ndarray) -> np.ndarray:
        return x / x.sum(axis=-1, keepdims=True)

    def onward(message: np.ndarray, k: int) -> np.ndarray:
        carried = np.where(starts[:, k, None], begin, message @ move)
        return normal(carried * padded[:, k])

    # a chunk without a chain's begin passes on what enters by its product, any other forgets it
    entering = np.full((many, size), 1.0 / size)
    basis = np.broadcast_to(np.eye(size), (many, size, size)).copy()
    for k in range(CHUNK):
        stepped = np.where(starts[:, k, None, None], begin, basis @ move) * padded[:, k, None, :]
        basis = stepped / stepped.sum(axis=(1, 2), keepdims=True)
    at = np.full(size, 1.0 / size)
    for c in range(many):
        entering[c] = at
        at = normal(at @ basis[c])
    forward = np.empty_like(padded)
    message = entering
    for k in range(CHUNK):
        message = onward(message, k)
        forward[:, k] = message

    # backward: what follows a word, one where the next word begins another chain
    following = np.concatenate([starts.reshape(-1)[1:], [True]]).reshape(many, CHUNK)
    nexts = np.concatenate([padded.reshape(-1, size)[1:], np.ones((1, size))]).reshape(many, CHUNK, size)
    backs = np.broadcast_to(np.eye(size), (many, size, size)).copy()
    for k in range(CHUNK - 1, -1, -1):
        stepped = np.where(following[:, k, None, None], 1.0, (move[None] * nexts[:, k, None, :]) @ backs)
        backs = stepped / stepped.sum(axis=(1, 2), keepdims=True)
    leaving = np.empty((many, size))
    at = np.ones(size)
    for c in range(many - 1, -1, -1):
        leaving[c] = at
        at = normal(backs[c] @ at)
    backward = np.empty_like(padded)
    message = leaving
    for k in range(CHUNK - 1, -1, -1):
        message = normal(np.where(following[:, k, None], 1.0, (message * nexts[:, k]) @ move.T))
        backward[:, k] = message
    return forward.reshape(-1, size)[:n], backward.reshape(-1, size)[:n]


def train(texts: list[tuple[str, str]], rounds: int = 4, rate: float = 0.2, texts_per_chain: int = 3, seed: int = 1) -> Model:
    """Fits weights and transitions by the gradient of the chains' log likelihood, a batch of chains at a time."""
    languages = sorted({lang for _, lang in texts})
    number = {lang: i for i, lang in enumerate(languages)}
    size = max(1, len(languages))
    read = [(words_of(text), number[lang]) for text, lang in texts]
    read = [(words, lang) for words, lang in read if words]
    model = Model(languages, np.zeros((1 << TABLE_BITS, size)), np.zeros((size, size)), np.zeros(size))
    squares = np.full((1 << TABLE_BITS, size), 1e-2)
    order = np.random.default_rng(seed)
    for _ in range(rounds if size > 1 else 0):
        turn = order.permutation(len(read))
        for at in range(0, len(turn), 32):
            chosen = [read[i] for i in turn[at : at + 32]]
            words = [w for ws, _ in chosen for w in ws]
            truth = np.repeat([lang for _, lang in chosen], [len(ws) for ws, _ in chosen])
            first = np.zeros(len(words), bool)
            first[np.cumsum([0, *[len(ws) for ws, _ in chosen[:-1]]])[::texts_per_chain]] = True
            features, begin = _feature_rows(words)
            evidence = np.add.reduceat(model.weights[features], begin, axis=0)
            forward, backward = messages(evidence, first, model.transitions, model.initial)
            found = forward * backward
            found /= found.sum(axis=1, keepdims=True)
            wrong = -found
            wrong[np.arange(len(words)), truth] += 1
            slope = np.zeros_like(model.weights)
            counts = np.diff(np.concatenate([begin, [len(features)]]))
            np.add.at(slope, features, np.repeat(wrong, counts, axis=0))
            slope /= len(chosen)
            touched = np.unique(features)
            squares[touched] += slope[touched] ** 2
            model.weights[touched] += rate * slope[touched] / np.sqrt(squares[touched])
            # pairs of neighbours: seen less expected
            inner = np.flatnonzero(~first[1:])
            pair = pairs(evidence, inner, model.transitions, forward, backward)
            seen = np.zeros((size, size))
            np.add.at(seen, (truth[inner], truth[inner + 1]), 1)
            model.transitions += rate * (seen - pair.sum(axis=0)) / max(1, len(inner)) * 5
            heads = np.flatnonzero(first)
            model.initial += rate * np.mean(np.eye(size)[truth[heads]] - found[heads], axis=0)
    return model


def fit(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", most_rows: int = MOST_ROWS) -> Model:
    """Learns from at most ``most_rows`` labelled rows, those with the smallest text hashes.

    The sample depends on the texts only and is the same at every run. Rows without
    a text or a label are left out. With no labelled row the model knows no language.
    """
    labelled = docs.filter(F.col(text_column).isNotNull() & F.col(lang_column).isNotNull()).select(
        F.col(text_column).cast("string").alias("text"), F.col(lang_column).cast("string").alias("lang")
    ).withColumn("h", F.xxhash64("text", F.lit(11)))
    # hashes and labels are compared first; texts of the chosen ones only
    chosen = labelled.groupBy("h").agg(F.min("lang").alias("lang")).orderBy("h").limit(most_rows)
    rows = labelled.join(F.broadcast(chosen), ["h", "lang"]).groupBy("h", "lang").agg(F.min("text").alias("text"))
    return train([(row["text"], row["lang"]) for row in sorted(rows.collect())])


PREDICTED = "lang_pred string, score double, n_words long, shares array<double>"


def predict(docs: DataFrame, model: Model, text_column: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with its own columns and lang_pred, score, n_words, shares (a share per language of the model).

    score is the share of the language that has most of the text, 0 to 1; ties go
    to the language that sorts first. A text that is null or has no letter is
    ``und`` with score 0, and so is every text if the model knows no language.
    Rows stay one for one. The new columns' names begin with ``prefix``; columns
    of ``docs`` that have these names are replaced.
    """
    added = StructType.fromDDL(", ".join(prefix + part for part in PREDICTED.split(", ")))
    rest = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added.names])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        size = len(known.languages)
        for whole in batches:
            for batch in pieces(whole, text_column):
                words = [words_of(t.decode()) for t in texts_of(batch, text_column)]
                counts = np.array([len(w) for w in words], np.int64)
                full = np.flatnonzero(counts) if size else np.empty(0, np.int64)
                shares = np.zeros((len(words), size))
                if len(full):
                    begin = (np.cumsum(counts) - counts)[full]
                    first = np.zeros(int(counts.sum()), bool)
                    first[begin] = True
                    found = known.marginals([w for ws in words for w in ws], first)
                    shares[full] = np.add.reduceat(found, begin, axis=0) / counts[full, None]
                best = shares.argmax(axis=1) if size else np.zeros(len(words), np.int64)
                told = np.isin(np.arange(len(words)), full)
                names = [known.languages[b] if t else UNKNOWN for b, t in zip(best.tolist(), told.tolist())]
                score = np.clip(shares[np.arange(len(words)), best], 0, 1) if size else np.zeros(len(words))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(names, pa.string()), pa.array(score), pa.array(counts), pa.array(list(shares), pa.list_(pa.float64()))],
                    names=[*batch.schema.names, *added.names],
                )

    return rest.mapInArrow(run, StructType(rest.schema.fields + added.fields))
