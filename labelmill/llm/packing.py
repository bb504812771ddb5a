"""Packing documents into sequences of a fixed length, by dominance reduction and best fit.

What decides a packing is only how many pieces there are of each length, so it is
planned on those counts: at most ``capacity`` numbers, however large the corpus.

Reduction (Martello and Toth): a set of pieces that holds a piece p and dominates
every other set with p is a sequence of some best packing. With r the room beside p
and b the longest piece that fits there, these are such sets: p alone if nothing
fits; p and b if they fill the sequence, if no two pieces fit beside p, or if at most
two do and none such two are longer together than b; p, b and the longest y that
fits beside them if at most two pieces fit beside p and any two that are longer
together than b have a smaller one no longer than y. Each is fixed as often as the
counts allow and leaves a smaller instance. What is left goes, longest first, where
it fits best.

The plan is a list of intervals: of all pieces in order of length, numbers i to j go
to sequences s, s + 1, ..., so many each, at an offset. The pieces are numbered by a
global order by range, and each task looks its pieces up in the plan.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from labelmill.llm.common import pieces, text_of
from labelmill.llm.words import Parts, parts_at_blanks
from labelmill.operators.ordering import cut, numbered

CAPACITY = 2048


class WordIds(Parts):
    """Parts coded by the tokenizer's own library: words of letters by its model alone."""

    def __init__(self, said: str):
        self.tokenizer = Tokenizer.from_str(said)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        super().__init__()

    def whole(self, parts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def words(self, words: list[str]) -> list[bytes]:
        tokenize = self.model.tokenize
        return [array("I", [t.id for t in tokenize(word)]).tobytes() for word in words]


#: The coder of a worker process, by tokenizer: its words serve the next tasks, too. Never more than one.
_KEPT: dict[str, WordIds] = {}


def _coder(name: str, said: Broadcast) -> WordIds:
    if name not in _KEPT:
        # a worker is one of many already; the library's own threads would only hold memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _KEPT.clear()
        _KEPT[name] = WordIds(said.value)
    return _KEPT[name]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, h, piece, start, length, ids): each document's ids and ``end_id``, cut only where they are more than ``capacity``.

    ``ids`` are little-endian unsigned 32-bit numbers; h is a hash of the text. Null
    and empty texts are one piece that holds the end alone.
    """
    opened = Tokenizer.from_file(tokenizer)
    opened.no_truncation()
    opened.no_padding()
    if not parts_at_blanks(lambda text: opened.encode(text, add_special_tokens=False).ids):
        raise ValueError("the tokenizer gives blanks a meaning: texts cannot be coded word by word")
    said = opened.to_str()
    shared = docs.sparkSession.sparkContext.broadcast(said)
    name = hashlib.md5(said.encode()).hexdigest()
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _coder(name, shared)
        for whole in batches:
            for batch in pieces(whole):
                rows, at, ids = [], [], []
                for row, coded in enumerate(encoder.texts(batch.column("text"))):
                    coded += end
                    for k in range(0, len(coded), step):
                        rows.append(row)
                        at.append(k)
                        ids.append(coded[k : k + step])
                at = np.array(at, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(rows)), batch.column("h").take(pa.array(rows)), pa.array(at // step, pa.int32()), pa.array(at // 4),
                        pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                    ],
                    names=["id", "h", "piece", "start", "length", "ids"],
                )

    read = docs.select(F.col(id_column).alias("id"), F.xxhash64(text_of(text_column)).alias("h"), text_of(text_column).alias("text"))
    added = StructType.fromDDL("piece int, start long, length long, ids binary")
    return read.mapInArrow(run, StructType([*read.schema.fields[:2], *added.fields]))


class Plan:
    """A packing of counted lengths. ``counts[l]`` pieces have length l, 1 <= l <= capacity."""

    def __init__(self, counts: np.ndarray, capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = counts.astype(np.int64).copy()
        self.used = np.zeros(capacity + 1, np.int64)
        self.sequences = 0
        #: (length, first of the length's pieces, sequences, pieces per sequence, first sequence, offset)
        self.entries: list[tuple[int, int, int, int, int, int]] = []
        self.reduce()
        self.fixed = self.sequences
        self.best_fit()

    def put(self, length: int, sequences: int, each: int, first: int, offset: int) -> None:
        self.entries.append((length, int(self.used[length]), sequences, each, first, offset))
        self.used[length] += sequences * each
        self.left[length] -= sequences * each

    def dominant(self, p: int) -> list[int] | None:
        """A set with a piece of length p that dominates all others with p, if one of three pieces at most does."""
        room, left = self.capacity - p, self.left
        left[p] -= 1  # what may stand beside this piece
        try:
            lengths = np.flatnonzero(left[: room + 1])
            if not len(lengths):
                return [p]
            b = int(lengths[-1])
            smallest = np.repeat(lengths[:3], np.minimum(left[lengths[:3]], 3))[:3]
            if b == room or len(smallest) < 2 or smallest[:2].sum() > room:
                return [p, b]
            if len(smallest) > 2 and smallest.sum() <= room:
                return None  # three fit beside p: too many sets to compare with
            # of every smaller piece of a pair the longest larger one that fits with it
            low = lengths[lengths <= room // 2]
            high = lengths[np.searchsorted(lengths, room - low, side="right") - 1]
            real = (high > low) | ((high == low) & (left[low] > 1))
            low, high = low[real], high[real]
            longer = low + high > b
            if not longer.any():
                return [p, b]
            left[b] -= 1
            beside = np.flatnonzero(left[: room - b + 1])
            left[b] += 1
            if len(beside) and low[longer].max() <= beside[-1]:
                return [p, b, int(beside[-1])]
            return None
        finally:
            left[p] += 1

    def reduce(self) -> None:
        changed = True
        while changed:
            changed = False
            for p in range(self.capacity, 0, -1):
                while self.left[p]:
                    chosen = self.dominant(p)
                    if chosen is None:
                        break
                    changed = True
                    kinds = {length: chosen.count(length) for length in chosen}
                    # fewer pieces are fewer sets to dominate: it holds until one of them runs out
                    times = min(int(self.left[length]) // n for length, n in kinds.items())
                    offset = 0
                    for length, n in kinds.items():
                        self.put(length, times, n, self.sequences, offset)
                        offset += length * n
                    self.sequences += times

    def best_fit(self) -> None:
        """Longest first, each where it leaves least room. Sequences filled alike are one group (first, how many), by room."""
        groups: dict[int, list[tuple[int, int]]] = {}
        rooms = np.zeros(self.capacity + 1, bool)
        for length in range(self.capacity, 0, -1):
            while n := int(self.left[length]):
                open_rooms = np.flatnonzero(rooms[length:])
                if len(open_rooms):
                    room = length + int(open_rooms[0])
                    first, many = groups[room].pop()
                    rooms[room] = bool(groups[room])
                else:
                    room, first, many = self.capacity, self.sequences, -(-n // (self.capacity // length))
                    self.sequences += many
                # the room that a piece leaves in a sequence is the least one for the next of its length
                each = room // length
                full = min(many, n // each)
                rest = min(n - full * each, each - 1) if full < many else 0
                for at, count, per in ((first, full, each), (first + full, min(rest, 1), rest), (first + full + min(rest, 1), many - full - min(rest, 1), 0)):
                    if count:
                        if per:
                            self.put(length, count, per, at, self.capacity - room)
                        groups.setdefault(room - per * length, []).append((at, count))
                        rooms[room - per * length] = True

    def table(self) -> np.ndarray:
        """Entries as (first number, length, pieces per sequence, first sequence, offset), numbers running over all pieces, longest first."""
        before = np.concatenate([np.cumsum(self.used[::-1])[::-1][1:], [0]])
        rows = [(before[length] + first, length, each, sequence, offset) for length, first, _, each, sequence, offset in self.entries]
        return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(cuts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cuts`` (id, h, piece, length and any others) with sequence_id and offset, as long: as few sequences as found.

    A sequence is at most ``capacity`` long and has no gap. Rows that are equal in
    length, id, h and piece take each other's places. An empty table stays empty.
    """
    held = cut(cuts)
    counts = np.zeros(capacity + 1, np.int64)
    for row in held.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["count"]
    shared = cuts.sparkSession.sparkContext.broadcast(Plan(counts, capacity).table())
    placed = numbered(held, F.col("length").desc(), F.col("id").asc_nulls_last(), "h", "piece", name="_number")
    added = StructType.fromDDL("sequence_id long, offset long")
    names = cuts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, length, each, sequence, offset = shared.value.T
        for batch in batches:
            number = batch.column("_number").to_numpy()
            at = np.searchsorted(first, number, side="right") - 1
            turn, k = np.divmod(number - first[at], each[at])
            found = [pa.array(sequence[at] + turn), pa.array(offset[at] + k * length[at])]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *found], names=[*names, *added.names])

    return placed.select(*names, "_number").mapInArrow(run, StructType([*cuts.schema.fields, *added.fields]))


def sequences(placed: DataFrame) -> DataFrame:
    """Placed pieces with their ids -> (sequence_id, length, ids, pieces): the sequences as they are trained on, at most ``capacity`` ids each."""
    listed = placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.array_sort(F.collect_list(F.struct("offset", "id", "piece", "length", "ids"))).alias("pieces"))
    joined = F.unhex(F.array_join(F.transform("pieces", lambda p: F.hex(p["ids"])), ""))
    return listed.select("sequence_id", "length", joined.alias("ids"), F.transform("pieces", lambda p: p.dropFields("ids")).alias("pieces"))
