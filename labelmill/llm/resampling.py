"""Target-distribution importance resampling: draw the documents whose word features look most like a target's.

Features are runs of words, hashed into a fixed number of buckets. The gain of a
bucket is the log ratio of its smoothed share in the target to that in the
documents; a document's weight is the sum of its features' gains, and Gumbel noise
from its id turns taking the highest scores into drawing by weight without
replacement.

Text work is Arrow kernels on whole batches: lower case, split, flatten,
dictionary. A run of n words is a pair of shifted numbers, of the run of n - 1
words and of the next word, so only distinct pairs are joined and hashed; counts
come from bincount, weights from take and a segmented sum. The bucket counts of a
task are one array; tasks meet in an aggregation over at most ``buckets`` keys, and
the table of gains, of that size, travels to every task. The draw is a global
order by range, not a sort in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import pieces, text_of
from labelmill.operators.ordering import numbered

GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of each text -> (numbers, ends, dictionary): all words in a row as numbers, where each text's end, and the word of each number."""
    # lower case first: of a slice that was cast the kernel reads the wrong bytes
    lowered = pc.ascii_lower(texts).cast(pa.large_string())
    split = pc.split_pattern_regex(lowered, pattern=GAPS)
    flat = pc.list_flatten(split)
    # a gap at either end of a text leaves an empty string
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    lengths = pc.list_value_length(split).to_numpy()
    ends = np.concatenate([[0], np.cumsum(real)])[np.cumsum(lengths)]
    coded = pc.dictionary_encode(flat.filter(pa.array(real)))
    return coded.indices.to_numpy().astype(np.int64), ends, coded.dictionary


def buckets_of(texts: pa.Array, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 .. longest: (bucket of every run of n words, number of such runs per text)."""
    numbers, ends, dictionary = words(texts)
    starts = np.concatenate([[0], ends[:-1]])
    runs, names, last = numbers, [x.as_buffer().to_pybytes() for x in dictionary], ends
    single = names
    for n in range(1, longest + 1):
        if n > 1:
            # a run of n starts where one of n - 1 does, in the same text, if a word follows
            size = np.maximum(last - starts, 0)
            has_next = np.ones(len(runs), bool)
            has_next[np.cumsum(size)[size > 0] - 1] = False
            first = np.cumsum(size) - size
            where = np.repeat(starts - first, size) + np.arange(len(runs))
            pairs = runs[has_next] * len(single) + numbers[where[has_next] + n - 1]
            distinct, runs = np.unique(pairs, return_inverse=True)
            names = [names[a] + b" " + single[b] for a, b in zip((distinct // max(len(single), 1)).tolist(), (distinct % max(len(single), 1)).tolist())]
            last = np.maximum(last - 1, starts)
        hashed = np.fromiter((crc32(name) % buckets for name in names), np.int64, len(names))
        yield hashed.take(runs), np.maximum(last - starts, 0)


def bucket_counts(docs: DataFrame, text_column: str = "text", longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """(bucket, n): how often features of each bucket stand in all texts; buckets without any are left out. Null texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in pieces(whole):
                for hashed, _ in buckets_of(batch.column("text"), longest, buckets):
                    total += np.bincount(hashed, minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    return docs.select(text_of(text_column).alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_column: str = "text", target_column: str = "text", longest: int = 1, buckets: int = 10_000) -> np.ndarray:
    """floor(1000 * ln of the smoothed share in the target over that in the documents), per bucket."""
    counted = bucket_counts(docs, text_column, longest, buckets).withColumn("side", F.lit(0)).unionByName(
        bucket_counts(target, target_column, longest, buckets).withColumn("side", F.lit(1))
    )
    both = np.zeros((2, buckets))
    for row in counted.collect():  # at most 2 * buckets rows
        both[row.side, row.bucket] = row.n
    (s, t), (all_s, all_t) = both, both.sum(1)
    return np.floor(1000 * np.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text_column: str = "text", longest: int = 1) -> DataFrame:
    """``docs`` with its own columns and _n_words, _n_features, _weight: the sum of the gains of a text's features, 0 without any."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    kept = [c for c in docs.columns if c != text_column]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), text_of(text_column).alias("text"))
    schema = rows.select("doc").schema.add("_n_words", "long").add("_n_features", "long").add("_weight", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for whole in batches:
            for batch in pieces(whole):
                features = weights = n_words = np.zeros(batch.num_rows, np.int64)
                for n, (hashed, sizes) in enumerate(buckets_of(batch.column("text"), longest, len(table))):
                    sums = np.concatenate([[0], np.cumsum(table.take(hashed))])
                    ends = np.cumsum(sizes)
                    weights = weights + sums[ends] - sums[ends - sizes]
                    features = features + sizes
                    n_words = n_words if n else sizes
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc"), *[pa.array(x, pa.int64()) for x in (n_words, features, weights)]], names=["doc", "_n_words", "_n_features", "_weight"]
                )

    return rows.mapInArrow(run, schema)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1, buckets: int = 10_000, seed: int = 2024,
    id_column: str = "doc_id", text_column: str = "text", target_column: str = "text",
) -> DataFrame:
    """Every row of ``docs``: (doc, n_features, weight, score, rank); ``doc`` is a struct of its columns without the text.

    Of the N documents with at least ``least_words`` words the floor(percent * N / 100)
    highest scores are drawn and ranked from 1, ties by the smaller id, rows without an
    id after the others; rank is null for all others. score is weight plus noise from
    the SHA-256 of ``seed:id`` (a null id reads as empty). Null and empty texts have no
    features and weight 0. Rows that repeat an id are each drawn for themselves. An
    empty table gives no rows; an empty target makes rare features weigh most.
    """
    gain = gains(docs, target, text_column, target_column, longest, buckets)
    weighed = weigh(docs, gain, text_column, longest)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"doc.`{id_column}`").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))
    scored = weighed.withColumn("_score", F.col("_weight") + noise).withColumn("_short", F.col("_n_words") < least_words)
    order = [F.col("_short").asc(), F.col("_score").desc(), F.col(f"doc.`{id_column}`").asc_nulls_last(), F.col("_weight").desc(), F.col("_n_features").desc()]
    placed = numbered(scored, *order, name="_number")
    # the long enough ones come first in the order, so a number below the bound is one of them
    drawn = placed.agg(F.floor(F.count(F.when(~F.col("_short"), True)) * percent / 100)).scalar()
    return placed.select(
        "doc", F.col("_n_features").alias("n_features"), F.col("_weight").alias("weight"), F.col("_score").alias("score"),
        F.when(F.col("_number") < drawn, F.col("_number") + 1).alias("rank"),
    )
