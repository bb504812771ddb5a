"""What several operators share: reading a table, typed columns, cutting lineage, packing Arrow results."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_GAPS = b"\t\n\x0b\x0c\r "
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the folder the cluster shares.

    The folder is the one ``spark.checkpoint.dir`` names; a temporary one is
    taken only where the session names none, as in tests.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint(eager=True)


def settled(df: DataFrame) -> DataFrame:
    """``cut``, and what it took to get there is given back: for tables that large shuffles have made.

    Spark removes the files of shuffles and checkpoints that nothing refers to any more when
    the driver collects its memory, which a driver that holds little does not do for long.
    """
    done = cut(df)
    del df
    gc.collect()
    done.sparkSession.sparkContext._jvm.System.gc()
    return done


def text_of(column: str = "text") -> Column:
    """A text, null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_key(id_column: str = "doc_id", column: str = "text") -> Column:
    """Names a row by its id and text, so that rows that repeat an id, or have none, stay apart.

    Equal rows share a key: what is found for one holds for the others.
    """
    return F.struct(F.col(id_column).alias("id"), F.xxhash64(text_of(column)).alias("h"))


def arrow_map(df: DataFrame, build: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """mapInArrow with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = build(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


PIECE_BYTES = 2 << 20


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``limit`` bytes of text, so that Python objects stay few at a time. A text is never cut."""
    texts = batch.column(batch.schema.get_field_index(column))
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text.as_buffer()) if text.is_valid else 0
        if held >= limit:
            yield batch.slice(first, i + 1 - first)
            first, held = i + 1, 0
    if first < batch.num_rows:
        yield batch.slice(first)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of each text, null as empty."""
    return [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in batch.column(batch.schema.get_field_index(column))]


class Memo(dict):
    """Values of a function, kept for words that return; forgotten when too many are held."""

    def __init__(self, build: Callable, most: int = 300_000):
        super().__init__()
        self.build, self.most = build, most

    def __missing__(self, key):
        self[key] = value = self.build(key)
        return value

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the one that driver and executors share, ``spark.checkpoint.dir``."""
    return f"{(spark.conf.get('spark.checkpoint.dir', None) or tempfile.mkdtemp(prefix='spark-')).rstrip('/')}/{uuid.uuid4().hex}"
