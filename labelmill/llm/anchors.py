"""Windows that repeat, found without moving every window: anchors, candidates, spans.

A window of W symbols has an anchor: the place of the smallest hash among its
runs of ``gram`` symbols, the leftmost if there are several. Equal windows have
equal anchors at equal offsets, so a window can only repeat if its anchor's hash
does, and windows in a row share anchors. The steps:

1. every anchor's hash is counted over all documents (partial counts first);
2. places of hashes that repeat are joined back and gathered per document;
3. a document's candidate windows leave it as spans, one for each anchor place:
   the windows in a row that have this anchor;
4. spans are dealt out by group and ``resolve`` decides, group by group, which
   windows repeat; a group's rows come sorted, and whole groups are handed over
   whenever enough have gathered, so memory holds some groups, not a partition;
5. what is found goes back to the documents.

A group is an anchor's hash. A hash with more places than a task is to hold would
be a group of any size, so its windows are taken one by one, and each window is a
group: those are counted by partial aggregation and never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import pieces, text_of, texts_of

#: Bytes of spans that are resolved at a time, and window starts whose anchors are sought at a time.
HELD_BYTES = 4 << 20
STRETCH = 1 << 20
NO_ID = (1 << 63) - 1
_PLACE_BITS = 22
#: Anchors are named by 48 bits: what two anchors of one name cost is a candidate that does not repeat.
_ANCHOR_MASK = np.uint64((1 << 48) - 1)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Kind:
    """What a symbol is. ``read`` gives a text's symbols and their hashes, ``write`` the bytes of some symbols in a row."""

    window: int
    gram: int
    #: places of an anchor's hash that a task is to hold at a time, at most
    held: int
    read: Callable
    write: Callable
    #: whether a repeat counts only if it starts in a document with a smaller id
    earlier: bool


def _joined(first: np.ndarray, size: int, second: np.ndarray) -> np.ndarray:
    """Hashes of runs: ``size`` symbols, then what ``second`` hashes."""
    n = max(0, len(second) - size)
    out = first[:n] * np.uint64(0x9E3779B97F4A7C15) + second[size:]
    out ^= out >> np.uint64(31)
    return out * _MIX


def gram_hashes(hashes: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every ``gram`` symbols in a row, from runs of half the length and single symbols."""
    runs, size = hashes, 1
    for bit in f"{gram:b}"[1:]:
        runs, size = _joined(runs, size, runs), 2 * size
        if bit == "1":
            runs, size = _joined(runs, size, hashes), size + 1
    return runs ^ (runs >> np.uint64(29))


def find_anchors(grams: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one text's gram hashes: place of each anchor, first and last window start that has it."""
    width = window - gram + 1
    starts = len(grams) - width + 1
    if starts <= 0:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    found = []
    for at in range(0, starts, STRETCH):
        part = grams[at : min(at + STRETCH, starts) + width - 1]
        least = (part >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(part), dtype=np.uint64)
        step = 1
        while step * 2 <= width:
            least = np.minimum(least[: len(least) - step], least[step:])
            step *= 2
        if step < width:
            least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
        found.append((least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64) + at)
    places = np.concatenate(found)
    first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    return places[first], first, np.concatenate([first[1:], [starts]]) - 1


def _spans_of(kind: Kind, reader, text: bytes):
    symbols, hashes = reader(text)
    grams = gram_hashes(hashes, kind.gram) if len(hashes) >= kind.window else np.empty(0, np.uint64)
    places, first, last = find_anchors(grams, kind.window, kind.gram)
    return symbols, (grams[places] & _ANCHOR_MASK).view(np.int64), places, first, last


def _anchor_rows(kind: Kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = kind.read()
        for whole in batches:
            for batch in pieces(whole):
                anchors, counts, places = [], [], []
                for text in texts_of(batch):
                    _, hashed, at, _, _ = _spans_of(kind, reader, text)
                    anchors.append(hashed)
                    places.append(at)
                    counts.append(len(at))
                row = np.repeat(np.arange(len(counts)), counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(anchors)), batch.column("id").take(pa.array(row)), batch.column("row").take(pa.array(row)), pa.array(np.concatenate(places))],
                    names=["anchor", "id", "row", "place"],
                )

    return run


SPAN = "anchor long, id long, row long, start long, span binary"
WINDOW = "digest binary, id long, row long, start long"


def _span_rows(kind: Kind, single: bool):
    """Documents with their candidate places -> spans, or, where the anchor has too many places, windows by their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = kind.read()
        for whole in batches:
            for batch in pieces(whole):
                out: tuple[list, ...] = ([], [], [], [], [])
                held = 0
                for text, id_, row, marked in zip(texts_of(batch), batch.column("id").to_pylist(), batch.column("row").to_pylist(), batch.column("places")):
                    symbols, hashed, places, first, last = _spans_of(kind, reader, text)
                    wanted = marked.values.to_numpy()
                    for k in np.flatnonzero(np.isin(places, wanted)).tolist():
                        a, b = int(first[k]), int(last[k])
                        for s, end in [(s, s + kind.window) for s in range(a, b + 1)] if single else [(a, b + kind.window)]:
                            span = kind.write(symbols, s, end)
                            for values, value in zip(out, (int(hashed[k]), id_, row, s, hashlib.md5(span).digest() if single else span)):
                                values.append(value)
                            held += len(out[4][-1])
                    if held > HELD_BYTES:
                        yield _record(out, single)
                        out, held = ([], [], [], [], []), 0
                if out[0]:
                    yield _record(out, single)

    return run


def _record(out: tuple[list, ...], single: bool) -> pa.RecordBatch:
    anchor, id_, row, start = (pa.array(v, pa.int64()) for v in out[:4])
    body = pa.array(out[4], pa.binary())
    if single:
        return pa.RecordBatch.from_arrays([body, id_, row, start], names=["digest", "id", "row", "start"])
    return pa.RecordBatch.from_arrays([anchor, id_, row, start, body], names=["anchor", "id", "row", "start", "span"])


RUN = "row long, id long, first long, last long"


def _resolved(resolve: Callable, window: int):
    """Sorted spans -> runs of window starts that repeat. ``resolve(groups, ids, spans)`` gives a mask of starts per span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def settle(rows: pa.Table) -> pa.RecordBatch:
            which, first, last = resolve(
                rows.column("anchor").to_numpy(), rows.column("id").to_numpy(), [x.as_py() for x in rows.column("span")]
            )
            start = rows.column("start").to_numpy()[which]
            return pa.RecordBatch.from_arrays(
                [rows.column("row").combine_chunks().take(pa.array(which)), rows.column("id").combine_chunks().take(pa.array(which)), pa.array(start + first), pa.array(start + last)],
                names=["row", "id", "first", "last"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.column("span").nbytes
            if size < HELD_BYTES:
                continue
            rows = pa.Table.from_batches(held)
            anchors = rows.column("anchor").to_numpy()
            # the last group may go on in the next batch
            whole = int(np.searchsorted(anchors, anchors[-1], side="left"))
            if whole:
                yield settle(rows.slice(0, whole))
                held = rows.slice(whole).to_batches()
                size = sum(x.column("span").nbytes for x in held)
        if held:
            yield settle(pa.Table.from_batches(held))

    return run


def repeated_windows(texts: DataFrame, kind: Kind, resolve: Callable) -> DataFrame:
    """Texts (id, row, text) -> runs (row, id, first, last) of window starts that repeat, as ``kind.earlier`` asks.

    ``row`` names a row; equal texts other than the one with the smallest id are
    not to be among ``texts``.
    """
    places = texts.mapInArrow(_anchor_rows(kind), "anchor long, id long, row long, place long")
    counted = places.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count(F.lit(1)).alias("n"))
    repeated = counted.filter("a < b" if kind.earlier else "n > 1").select("anchor", (F.col("n") > kind.held).alias("many"))
    marked = (
        places.select("anchor", "row", "place").join(repeated, "anchor").groupBy("row")
        .agg(F.collect_list(F.when(~F.col("many"), F.col("place"))).alias("few"), F.collect_list(F.when(F.col("many"), F.col("place"))).alias("many"))
    )
    few, many = (
        texts.join(marked.filter(F.size(c) > 0).select("row", F.col(c).alias("places")), "row").select("row", "id", "text", "places") for c in ("few", "many")
    )
    trees = few.mapInArrow(_span_rows(kind, single=False), SPAN)
    found = trees.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_resolved(resolve, kind.window), RUN)
    windows = many.mapInArrow(_span_rows(kind, single=True), WINDOW)
    seen = windows.groupBy("digest").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    again = windows.join(seen, "digest").filter("id > least" if kind.earlier else "n > 1")
    return found.unionByName(again.select("row", "id", F.col("start").alias("first"), F.col("start").alias("last")))


def with_copies(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, row, text) of ``docs``, and for each row whose text is not alone (row, id, copies, first)."""
    rows = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"), text_of(text_column).alias("text"))
    rows = rows.select("id", F.xxhash64("id", "text").alias("row"), "text")
    digest = F.unhex(F.md5("text"))
    copies = rows.groupBy(digest.alias("u")).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    told = rows.select("id", "row", digest.alias("u")).join(copies, "u").select("id", "row", "copies", "first").distinct()
    return rows, told
