"""A training corpus from raw documents: language, boilerplate lines, near copies, benchmarks, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
keep the columns of ``documents``. Every stage reads all rows it is given and the
whole of each text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.llm import bpe, decontaminate, language, line_dedup, simhash
from labelmill.llm.common import row_key, shared_folder, table

#: Least share of the language a text has most of; below that the text is in no language.
MIN_SHARE = 0.35


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts in no one language. The model learns from the labelled rows of ``docs``."""
    told = language.predict(docs, language.fit(docs), prefix="_")
    kept = told.filter((F.col("_lang_pred") != language.UNKNOWN) & (F.col("_score") >= MIN_SHARE))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that stand on many sites; a document of nothing else goes."""
    cleaned = line_dedup.clean_lines(docs)
    changed = cleaned.filter((F.col("n_removed") == 0) | (F.length(F.trim("text")) > 0))
    columns = [F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return changed.select(*columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies (five-word shingles, similarity 0.8)."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten words in a row of a benchmark item."""
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"))
    leaks = found.filter("contaminated").select(F.struct(F.col("doc_id").alias("id"), "h").alias("row"))
    return docs.select(F.struct("*").alias("doc"), row_key().alias("row")).join(leaks, "row", "left_anti").select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and what they decode to."""
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "decoded")


STAGES = [
    ("language ID", identify_language),
    ("line dedup", remove_boilerplate),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding", encode),
]

#: Language, fingerprints and token ids are beyond SQL; the tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's rows are a Parquet table in the shared folder before the next one starts."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark)
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
