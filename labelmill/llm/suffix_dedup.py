"""Suffix-array dedup: bytes of 200-byte strings that occur anywhere else.

Candidate windows come as spans (see ``anchors``). Within a group equal spans are
one, and a group with a single span needs no sorting: its windows repeat if the
span does. The others are laid end to end and cut into symbols that end at
blanks, so a suffix array over symbols (see ``suffix_array``) is as good as one
over bytes and several times shorter. A window that starts inside a symbol is the
rest of that symbol and a suffix from the next one; sorted by that rest and the
suffix's rank, equal windows are neighbours, and neighbours are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.anchors import NO_ID, Kind, repeated_windows, with_copies
from labelmill.llm.common import WORD_GAPS, pieces, texts_of
from labelmill.llm.substring_dedup import covered
from labelmill.llm.suffix_array import suffix_array

WINDOW_BYTES = 200
GRAM_BYTES = 32
#: Spans of an anchor a task holds at a time: some 6 MB.
HELD = 20_000
#: Symbols end after these bytes: blanks, and a quarter of the bytes that go on a sign beyond ASCII, for scripts without blanks.
_ENDS = np.zeros(256, bool)
_ENDS[list(WORD_GAPS)] = True
_ENDS[0x80:0x90] = True
_BYTE_HASHES = np.random.default_rng(9).integers(0, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


def _read():
    def reader(text: bytes):
        return text, _BYTE_HASHES[np.frombuffer(text, np.uint8)]

    return reader


def _write(text: bytes, a: int, b: int) -> bytes:
    return text[a:b]


def _ranks(raw: bytes, edges: np.ndarray, closing: np.ndarray) -> np.ndarray:
    """Ranks of the suffixes that start at symbols. ``edges`` are the symbols' ends, ``closing`` marks those that end a span."""
    ends = edges.tolist()
    symbols = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]
    number = {s: i + 2 for i, s in enumerate(sorted(set(symbols)))}
    numbered = np.fromiter(map(number.__getitem__, symbols), np.int64, len(symbols))
    # a sign below all symbols after each span, and one below that at the end
    after = np.cumsum(closing) - closing
    laid = np.ones(len(symbols) + int(closing.sum()) + 1, np.int64)
    at = np.arange(len(symbols)) + after
    laid[at] = numbered
    laid[-1] = 0
    rank = np.empty(len(laid), np.int64)
    rank[suffix_array(laid)] = np.arange(len(laid))
    return rank[at]


def _powers(n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = _BASE
    return np.multiply.accumulate(out)


def repeats(spans: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """(span number, start) of the windows of different spans that occur at another place among them."""
    raw = b"".join(spans)
    data = np.frombuffer(raw, np.uint8)
    lengths = np.fromiter(map(len, spans), np.int64, len(spans))
    closing_at = np.cumsum(lengths)
    ends = _ENDS[data].copy()
    ends[closing_at - 1] = True
    edges = np.flatnonzero(ends) + 1
    closing = np.isin(edges, closing_at)
    rank = _ranks(raw, edges, closing)

    count = lengths - window + 1
    span = np.repeat(np.arange(len(spans)), count)
    start = np.arange(len(span)) - np.repeat(np.cumsum(count) - count, count)
    at = (closing_at - lengths)[span] + start
    # the first symbol that starts after the window does, and the bytes before it: what precedes a window plays no part
    starts = np.concatenate([[0], edges[:-1]])
    symbol = np.searchsorted(starts, at, side="right")
    inside = symbol < len(starts)
    symbol = np.minimum(symbol, len(starts) - 1)
    rest = np.where(inside, np.minimum(starts[symbol] - at, window), window)
    # a blank-free window is its own rest
    key = np.where(rest < window, rank[symbol], 0)
    # polynomial sums of random byte values, so that a rest is the difference of two sums
    n = len(data)
    power = _powers(n + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE_HASHES[data] * power[:n], dtype=np.uint64)])
    told = (sums[at + rest] - sums[at]) * power[n - at]
    told ^= (rest.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.lexsort((key, told))
    same = np.flatnonzero(told[order[1:]] == told[order[:-1]])
    again = np.zeros(len(at), bool)
    rows = np.lib.stride_tricks.sliding_window_view(data, window)
    for k in range(0, len(same), 20_000):
        a, b = order[same[k : k + 20_000]], order[same[k : k + 20_000] + 1]
        equal = (rows[at[a]] == rows[at[b]]).all(axis=1)
        again[a[equal]] = True
        again[b[equal]] = True
    return span[again], start[again]


def _resolve(window: int):
    def resolve(groups: np.ndarray, ids: np.ndarray, spans: list[bytes]):
        numbers: dict[tuple[int, bytes], int] = {}
        which = np.fromiter((numbers.setdefault(k, len(numbers)) for k in zip(groups.tolist(), spans)), np.int64, len(spans))
        times = np.bincount(which)
        owner = np.fromiter((g for g, _ in numbers), np.int64, len(numbers))
        _, back, many = np.unique(owner, return_inverse=True, return_counts=True)
        distinct = [s for _, s in numbers]
        mixed = np.flatnonzero(many[back] > 1)
        masks = [np.full(len(s) - window + 1, t > 1) for s, t in zip(distinct, times.tolist())]
        if len(mixed):
            number, start = repeats([distinct[i] for i in mixed], window)
            bounds = np.searchsorted(number, np.arange(len(mixed) + 1))
            for k, i in enumerate(mixed.tolist()):
                masks[i][start[bounds[k] : bounds[k + 1]]] = True
        runs = []
        for mask in masks:
            turns = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
            runs.append((turns[::2], turns[1::2] - 1))
        counts = np.array([len(runs[w][0]) for w in which.tolist()], np.int64)
        row = np.repeat(np.arange(len(spans)), counts)
        none = np.empty(0, np.int64)
        first = np.concatenate([none, *[runs[w][0] for w in which.tolist()]])
        last = np.concatenate([none, *[runs[w][1] for w in which.tolist()]])
        return row, first, last

    return resolve


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window_bytes: int = WINDOW_BYTES, held: int = HELD) -> DataFrame:
    """A row per row of ``docs``: id, n_bytes, n_removed, spans, kept (the bytes that stay).

    A byte goes if a string of ``window_bytes`` bytes that covers it also starts at
    another place of any document, its own included. ``spans`` lists the removed
    runs (first byte, number of bytes). Null, empty and short texts hold no such
    string. Rows that repeat, whatever their ids, repeat each other. A null id
    stays null; an empty table stays empty.
    """
    kind = Kind(window_bytes, GRAM_BYTES, held, _read, _write, earlier=False)
    rows, told = with_copies(docs, id_column, text_column)
    # equal texts take part once; all of them are repeats
    later = told.filter("first < id").select("row")
    runs = repeated_windows(rows.join(later, "row", "left_anti"), kind, _resolve(window_bytes))
    gathered = runs.groupBy("row", "id").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    state = gathered.join(told.select("row", "id", F.lit(True).alias("copy")), ["row", "id"], "full").withColumnRenamed("id", "state_id")
    whole = rows.join(state, "row", "left").select(
        "id", "text", F.when(F.col("id") == F.col("state_id"), F.col("runs")).alias("runs"),
        F.coalesce(F.col("copy") & (F.col("id") == F.col("state_id")), F.lit(False)).alias("copy"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for all_rows in batches:
            for batch in pieces(all_rows):
                sizes, gone, spans, kept = [], [], [], []
                for text, found, copy in zip(texts_of(batch), batch.column("runs"), batch.column("copy").to_pylist()):
                    mask = np.zeros(len(text), bool)
                    if copy and len(text) >= window_bytes:
                        mask[:] = True
                    elif found.is_valid:
                        first, last = (x.to_numpy() for x in found.values.flatten())
                        mask = covered(len(text), window_bytes, first, last)
                    sizes.append(len(text))
                    gone.append(int(mask.sum()))
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))).tolist()
                    spans.append([{"first": a, "bytes": b - a} for a, b in zip(edges[::2], edges[1::2])])
                    kept.append(np.frombuffer(text, np.uint8)[~mask].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("bytes", pa.int64())]))), pa.array(kept, pa.binary()),
                    ],
                    names=["id", "n_bytes", "n_removed", "spans", "kept"],
                )

    out = whole.mapInArrow(run, "id long, n_bytes long, n_removed long, spans array<struct<first:bigint,bytes:bigint>>, kept binary")
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias(id_column), "n_bytes", "n_removed", "spans", "kept")
