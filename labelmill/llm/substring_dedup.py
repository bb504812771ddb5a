"""Substring dedup over words by prefix-partitioned suffix trees.

The suffixes that matter start at candidate windows (see ``anchors``). They are
split by a prefix of variable length: an anchor of a few words as a rule, the
whole window where so many suffixes share the anchor that the group would not
fit in memory. The subtree of a group is built from the root down: the suffixes
of a node are split by their next word, a suffix alone in its node is a leaf and
is done with, and what is left at the depth of a window are the internal nodes
deep enough to be repeats. The smallest id below such a node is where its string
starts first; every other start below it repeats that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.anchors import NO_ID, Kind, repeated_windows, with_copies
from labelmill.llm.common import WORD_GAPS, Memo, pieces, texts_of

WINDOW_WORDS = 13
GRAM_WORDS = 4
#: Spans of an anchor a task holds at a time: some 6 MB.
HELD = 50_000
_GAPS = bytes(32 if b in WORD_GAPS else b for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_GAPS).split()


class _Reader:
    def __init__(self):
        self.memo = Memo(lambda word: xxhash.xxh64_intdigest(word, 5))

    def __call__(self, text: bytes):
        words = words_of(text)
        self.memo.trim()
        return words, np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))


def _write(words: list[bytes], a: int, b: int) -> bytes:
    return b" ".join(words[a:b])


def _subtrees(window: int):
    def resolve(groups: np.ndarray, ids: np.ndarray, spans: list[bytes]):
        """Span number, first and last start (in the span) of each run of starts that an earlier document has."""
        numbers: dict[bytes, int] = {}
        split = [s.split(b" ") for s in spans]
        symbols = np.fromiter((numbers.setdefault(w, len(numbers)) for s in split for w in s), np.int64, sum(map(len, split)))
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        begin = np.cumsum(lengths) - lengths
        starts = lengths - window + 1
        span = np.repeat(np.arange(len(split)), starts)
        offset = np.arange(len(span)) - np.repeat(np.cumsum(starts) - starts, starts)
        at = begin[span] + offset
        node = np.unique(groups, return_inverse=True)[1][span]
        live = np.arange(len(span))
        for depth in range(window):
            _, node, size = np.unique(node * len(numbers) + symbols[at[live] + depth], return_inverse=True, return_counts=True)
            inner = size[node] > 1
            live, node = live[inner], node[inner]
            if not len(live):
                break
        if not len(live):
            none = np.empty(0, np.int64)
            return none, none, none
        least = np.full(int(node.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, node, ids[span[live]])
        again = np.sort(live[ids[span[live]] > least[node]])
        if not len(again):
            return again, again, again
        fresh = np.concatenate([[True], (again[1:] != again[:-1] + 1) | (span[again[1:]] != span[again[:-1]])])
        head = np.flatnonzero(fresh)
        tail = np.concatenate([head[1:], [len(again)]]) - 1
        return span[again[head]], offset[again[head]], offset[again[tail]]

    return resolve


def covered(size: int, window: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which of ``size`` symbols a window that starts in one of the runs first .. last covers."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, first, 1)
    np.add.at(edges, last + window, -1)
    return np.cumsum(edges[:-1]) > 0


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window_words: int = WINDOW_WORDS, held: int = HELD) -> DataFrame:
    """A row per row of ``docs``: id, n_words, n_removed, spans, kept (the words that stay, joined by blanks).

    A word goes if a window of ``window_words`` words that covers it also starts
    in a document with a smaller id. ``spans`` lists the removed runs (first word,
    number of words). Null, empty and short texts have no windows. A row without
    an id comes after all ids, and two such rows repeat nothing of each other;
    rows that repeat an id do not repeat each other. An empty table stays empty.
    """
    kind = Kind(window_words, GRAM_WORDS, held, _Reader, _write, earlier=True)
    rows, told = with_copies(docs, id_column, text_column)
    later = told.filter("first < id").select("row", "id", F.lit(True).alias("copy"))
    runs = repeated_windows(rows.join(later.select("row"), "row", "left_anti"), kind, _subtrees(window_words))
    gathered = runs.groupBy("row", "id").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    state = gathered.join(later, ["row", "id"], "full").withColumnRenamed("id", "state_id")
    whole = rows.join(state, "row", "left").select(
        "id", "text", F.when(F.col("id") == F.col("state_id"), F.col("runs")).alias("runs"), F.coalesce(F.col("copy") & (F.col("id") == F.col("state_id")), F.lit(False)).alias("copy")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for all_rows in batches:
            for batch in pieces(all_rows):
                sizes, gone, spans, kept = [], [], [], []
                for text, found, copy in zip(texts_of(batch), batch.column("runs"), batch.column("copy").to_pylist()):
                    words = words_of(text)
                    mask = np.zeros(len(words), bool)
                    if copy and len(words) >= window_words:
                        mask[:] = True
                    elif found.is_valid:
                        first, last = (x.to_numpy() for x in found.values.flatten())
                        mask = covered(len(words), window_words, first, last)
                    sizes.append(len(words))
                    gone.append(int(mask.sum()))
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                    spans.append([{"first": a, "words": b - a} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())])
                    kept.append(b" ".join([w for w, m in zip(words, mask.tolist()) if not m]) if gone[-1] else b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))), pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names=["id", "n_words", "n_removed", "spans", "kept"],
                )

    out = whole.mapInArrow(run, "id long, n_words long, n_removed long, spans array<struct<first:bigint,words:bigint>>, kept string")
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias(id_column), "n_words", "n_removed", "spans", "kept")
