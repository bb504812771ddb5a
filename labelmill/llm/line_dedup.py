"""Line dedup: removes lines that stand on many sites, in DataFrame operations only.

One HyperLogLog sketch per line hash counts the sites that carry the line, a
second one the different documents around it; sketches are built before the
shuffle and merged by the aggregation, so a line that stands everywhere is one
row per task. Lines whose estimates are near a threshold are counted exactly.

Copies of one document carry the same lines to many sites without those being
boilerplate. Each document is signed by the hash of its whole text, which copies
share; a line counts as boilerplate only where it stands in enough different texts,
too, whatever the number of copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import cut, row_key, text_of

MIN_SITES = 10
MIN_WORDS = 3
MIN_TEXTS = 10
SKETCH_LOG2 = 12
#: Six standard errors of a sketch with 2^12 registers: estimates nearer to a threshold are counted.
NEAR = 0.1


def _key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _lines(docs: DataFrame, id_column: str, text_column: str, site_column: str) -> DataFrame:
    """A row per document and different line: (row, site, signature, line)."""
    lines = docs.select(
        row_key(id_column, text_column).alias("row"), F.col(site_column).cast("string").alias("site"),
        F.transform(F.split(text_of(text_column), "\n", -1), lambda x: F.trim(x)).alias("lines"), _key(text_of(text_column)).alias("signature"),
    )
    judged = lines.select("row", "site", "signature", F.explode(F.array_distinct("lines")).alias("text"))
    return judged.filter(F.size(F.split("text", r"[ \t\x0B\f\r]+")) >= MIN_WORDS).select("row", "site", "signature", _key(F.col("text")).alias("line"))


def boilerplate(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", site_column: str = "source",
    min_sites: int = MIN_SITES, min_texts: int = MIN_TEXTS,
) -> DataFrame:
    """Line hashes that stand on min_sites sites or more and in min_texts different texts or more: (line, first).

    ``first`` is the row key of the smallest document that has the line.
    """
    lines = _lines(docs, id_column, text_column, site_column)
    sketched = lines.groupBy("line").agg(
        F.hll_sketch_agg("site", F.lit(SKETCH_LOG2)).alias("sites"), F.hll_sketch_agg("signature", F.lit(SKETCH_LOG2)).alias("signatures"),
        F.count(F.lit(1)).alias("documents"), F.min("row").alias("first"),
    )
    # a line in fewer documents than are asked for needs no estimate
    judged = cut(sketched.filter(F.col("documents") >= max(min_sites, min_texts)).select(
        "line", "first",
        F.coalesce(F.hll_sketch_estimate("sites"), F.lit(0)).alias("sites"), F.hll_sketch_estimate("signatures").alias("signatures"),
    ))
    sure = (F.col("sites") >= min_sites * (1 + NEAR)) & (F.col("signatures") >= min_texts * (1 + NEAR))
    never = (F.col("sites") < min_sites * (1 - NEAR)) | (F.col("signatures") < min_texts * (1 - NEAR))
    near = judged.filter(~sure & ~never)
    exact = (
        lines.join(near.select("line"), "line", "left_semi").groupBy("line")
        .agg(F.countDistinct("site").alias("sites"), F.countDistinct("signature").alias("signatures"), F.min("row").alias("first"))
        .filter((F.col("sites") >= min_sites) & (F.col("signatures") >= min_texts))
    )
    return judged.filter(sure).select("line", "first").unionByName(exact.select("line", "first"))


def clean_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", site_column: str = "source",
    min_sites: int = MIN_SITES, min_texts: int = MIN_TEXTS,
) -> DataFrame:
    """``docs`` with its own columns and n_lines, n_removed; boilerplate lines are taken out of the text.

    A line is compared after trimming blanks; lines of fewer than three words
    are never judged. A boilerplate line stays once, at its first place in the
    document with the smallest id. A null text stays null with no lines; an empty
    text is one empty line. Rows without a site count for no site; without an id
    they come before all ids. Repeated rows are treated alike. Columns of ``docs``
    named n_lines or n_removed are replaced; an empty table stays empty.
    """
    named = docs.select(F.struct("*").alias("doc"), row_key(id_column, text_column).alias("row"))
    text = F.col(f"doc.`{text_column}`").cast("string")
    marks = boilerplate(docs, id_column, text_column, site_column, min_sites, min_texts)
    lines = _lines(docs, id_column, text_column, site_column)
    gone = lines.join(marks, "line").groupBy("row").agg(
        F.map_from_entries(F.collect_set(F.struct(F.hex("line"), F.col("row") == F.col("first")))).alias("removed")
    )
    # a text's own lines bound its map; a document without boilerplate has none
    parts = F.split(text, "\n", -1)
    kept = F.filter(
        F.transform(parts, lambda x, i: F.struct(x.alias("x"), i.alias("i"), F.hex(_key(F.trim(x))).alias("k"))),
        lambda s: ~F.map_contains_key("removed", s["k"])
        | (F.element_at("removed", s["k"]) & (F.array_position(F.transform(parts, lambda y: F.trim(y)), F.trim(s["x"])) == s["i"] + 1)),
    )
    left = named.join(gone, "row", "left").withColumn("kept", F.when(F.col("removed").isNotNull(), F.transform(kept, lambda s: s["x"])))
    n = F.when(text.isNull(), 0).otherwise(F.size(parts)).cast("long")
    cleaned = F.when(F.col("kept").isNull(), text).otherwise(F.array_join("kept", "\n"))
    return left.select(
        *[cleaned.alias(c) if c == text_column else F.col(f"doc.`{c}`") for c in docs.columns if c not in ("n_lines", "n_removed")],
        n.alias("n_lines"), F.when(F.col("kept").isNull(), F.lit(0).cast("long")).otherwise(n - F.size("kept")).alias("n_removed"),
    )
