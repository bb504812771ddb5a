"""Benchmark decontamination by a prefix-filtered set join, exact containment of item windows.

A window of an item occurs in a document only if every shingle of the window
does, so one necessary shingle is enough to find candidates: the rarest one,
with its offset in the window. The documents are read twice. The first pass
counts, over all documents, how often the benchmark's shingles occur; a window
with a shingle that never occurs is done with. The second pass finds the places
of the chosen shingles, and a join on the shingle brings windows and places
together. A window must lie inside the document at its offset (length and
position bounds) and is then compared word by word.

A bitmap of fixed size keeps other shingles out of the shuffle; it only saves
work, whatever the size of the benchmark: the join decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from collections.abc import Iterator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelmill.llm.common import Memo, cut, pieces, text_of, texts_of

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
BITMAP_BITS = 1 << 23
# a bitmap of the built-in bitmap functions holds 32768 bits
BUCKET_BITS = 32768

#: ASCII capitals to small letters, every other ASCII sign that is no digit or letter to a blank.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def _shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` words in a row."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out += hashes[k : k + n] * _MULTIPLIERS[k]
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def _word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 10)


def _item_windows(window_words: int):
    """Items -> (item, window, length, tokens): the windows of an item and the hashes of each one's shingles."""
    schema = pa.schema([("item", pa.string()), ("window", pa.string()), ("length", pa.int32()), ("tokens", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                rows = []
                for item, text in zip(batch.column("item").to_pylist(), texts_of(batch)):
                    words = words_of(text)
                    hashes = np.array([_word_hash(w) for w in words], np.uint64)
                    length = min(window_words, len(words))
                    for i in range(len(words) - length + 1 if words else 0):
                        tokens = _shingles(hashes[i : i + length], min(SHINGLE_WORDS, length)).view(np.int64)
                        rows.append({"item": item, "window": b" ".join(words[i : i + length]).decode(), "length": length, "tokens": tokens.tolist()})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return run, "item string, window string, length int, tokens array<bigint>"


def _bitmap(tokens: DataFrame) -> bytes:
    """Two bits for each token, in a bitmap of BITMAP_BITS / 8 bytes however many tokens there are."""
    bit = F.explode(F.array(F.col("token").bitwiseAND(BITMAP_BITS - 1), F.shiftrightunsigned("token", 33).bitwiseAND(BITMAP_BITS - 1)))
    rows = (
        tokens.select(bit.alias("bit")).groupBy((F.col("bit") / BUCKET_BITS).cast("int").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.col("bit") % BUCKET_BITS).alias("bits")).collect()
    )
    out = bytearray(BITMAP_BITS // 8)
    for row in rows:
        at = row["bucket"] * BUCKET_BITS // 8
        out[at : at + len(row["bits"])] = row["bits"]
    return bytes(out)


class _Places:
    """The places in documents of the shingles that a bitmap holds."""

    def __init__(self, bitmap: bytes, sizes: list[int]):
        self.bits = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little").view(bool)
        self.sizes, self.memo = sizes, Memo(_word_hash)

    def find(self, texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text; text number, word number and hash of each place."""
        split = [words_of(t) for t in texts]
        self.memo.trim()
        counts = np.array([len(w) for w in split], np.int64)
        ends = np.cumsum(counts)
        hashes = np.fromiter((h for w in split for h in map(self.memo.__getitem__, w)), np.uint64, int(ends[-1]) if len(ends) else 0)
        mask = np.uint64(BITMAP_BITS - 1)
        docs, places, tokens = [], [], []
        for size in self.sizes:
            found = _shingles(hashes, size)
            at = np.flatnonzero(self.bits[found & mask])
            at = at[self.bits[(found[at] >> np.uint64(33)) & mask]]
            doc = np.searchsorted(ends, at, side="right")
            inside = at + size <= ends[doc]
            docs.append(doc[inside])
            places.append((at - (ends - counts)[doc])[inside])
            tokens.append(found[at][inside])
        return split, np.concatenate(docs), np.concatenate(places), np.concatenate(tokens).view(np.int64)


def _count_places(bitmap: bytes, sizes: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Places(bitmap, sizes)
        for whole in batches:
            for batch in pieces(whole):
                tokens, counts = np.unique(finder.find(texts_of(batch))[3], return_counts=True)
                if len(tokens):
                    yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(counts)], names=["token", "n"])

    return run


PLACE = pa.struct([("token", pa.int64()), ("place", pa.int32()), ("before", pa.int32()), ("context", pa.string())])
PLACES = "id long, h long, n_words long, places array<struct<token:bigint,place:int,before:int,context:string>>"


def _list_places(bitmap: bytes, sizes: list[int], window_words: int):
    """A row per document; each place with the words that a window around it could take in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Places(bitmap, sizes)
        for whole in batches:
            for batch in pieces(whole):
                split, docs, places, tokens = finder.find(texts_of(batch))
                order = np.argsort(docs, kind="stable")
                rows = []
                for d, p, t in zip(docs[order].tolist(), places[order].tolist(), tokens[order].tolist()):
                    first = max(0, p - window_words + 1)
                    rows.append({"token": t, "place": p, "before": p - first, "context": b" ".join(split[d][first : p + window_words]).decode()})
                offsets = np.concatenate([[0], np.cumsum(np.bincount(docs, minlength=len(split)))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"), batch.column("h"), pa.array([len(w) for w in split], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows, PLACE)),
                    ],
                    names=["id", "h", "n_words", "places"],
                )

    return run


def find(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text", window_words: int = WINDOW_WORDS,
) -> DataFrame:
    """A row per row of ``docs``: id, h (hash of the text), n_words, n_hit, n_items, items, contaminated.

    Words are runs of letters, digits and signs beyond ASCII, ASCII capitals made
    small. ``items`` lists, sorted as strings, the items with a window that
    occurs. Null and empty texts have no words and hold nothing; an item without
    words is never found; items without an id make words hits but are not listed;
    items that repeat an id are one item. Rows of ``docs`` that are equal get equal
    results, and a null id stays null. An empty table on either side gives no
    hits. Other columns are not read.
    """
    build, schema = _item_windows(window_words)
    spread = cut(items.select(F.col(item_column).cast("string").alias("item"), text_of(item_text_column).alias("text")).mapInArrow(build, schema))
    sizes = sorted(row["size"] for row in spread.select(F.least("length", F.lit(SHINGLE_WORDS)).alias("size")).distinct().collect()) or [SHINGLE_WORDS]
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text_of(text_column)).alias("h"), text_of(text_column).alias("text"))

    # order shingles by rarity, over all documents
    windows = spread.select("window", "length", "tokens").distinct()
    offsets = windows.select("window", "length", F.posexplode("tokens").alias("offset", "token"))
    seen = (
        texts.select("text").mapInArrow(_count_places(_bitmap(offsets.select("token")), sizes), "token bigint, n bigint")
        .groupBy("token").agg(F.sum("n").alias("n"))
    )
    ranked = offsets.join(seen, "token", "left").groupBy("window", "length").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "offset")).alias("rarest")
    )
    prefixes = cut(ranked.filter("rarest.n > 0").select("window", "length", "rarest.token", "rarest.offset"))

    # the places of the chosen shingles, windows that fit there, then the words themselves
    listed = cut(texts.mapInArrow(_list_places(_bitmap(prefixes.select("token")), sizes, window_words), PLACES))
    near = listed.select(F.struct("id", "h").alias("row"), F.explode("places").alias("p")).select("row", "p.*")
    met = near.join(prefixes, "token").withColumn("words", F.split("context", " "))
    fits = (F.col("before") >= F.col("offset")) & (F.col("before") - F.col("offset") + F.col("length") <= F.size("words"))
    same = F.array_join(F.slice("words", F.col("before") - F.col("offset") + 1, F.col("length")), " ") == F.col("window")
    hits = met.filter(fits).filter(same).select("row", (F.col("place") - F.col("offset")).alias("start"), "length", "window").distinct()
    hits = cut(hits)

    ordered = Window.partitionBy("row").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    reach = F.greatest(F.coalesce(F.max(end).over(ordered), F.lit(0)), F.col("start"))
    covered = hits.withColumn("fresh", F.greatest(end - reach, F.lit(0))).groupBy("row").agg(F.sum("fresh").cast("long").alias("n_hit"))
    owners = spread.filter("item is not null").select("item", "window").distinct()
    named = (
        hits.select("row", "window").distinct().join(owners, "window").groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    found = covered.join(named, "row", "left")
    none = F.array().cast("array<string>")
    items_found = F.coalesce("items", none)
    return (
        listed.select(F.struct("id", "h").alias("row"), "n_words").join(found, "row", "left")
        .select(
            F.col("row.id").alias(id_column), F.col("row.h").alias("h"), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.size(items_found).cast("long").alias("n_items"), items_found.alias("items"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )
