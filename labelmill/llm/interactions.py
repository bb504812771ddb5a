"""Filter interaction audit: what each filter of a chain takes, in every order the chain could run in.

Whether a document fails a filter does not depend on the order. So the documents
are counted first, by part and mask (one bit per filter failed): at most
``2 ** filters`` cells a part, from partial aggregations. All orders are then a
matter of the cells: each cell folds over the array of orders, a constant of the
plan, carrying whether its documents are gone yet, and gives one weighted struct
per order and step; the arrays of a part's cells are summed element by element.

One filter may be "identical to the text of a smaller id, anywhere in the table".
Equal texts meet by SHA-256 after they were counted per text and part; which rows
hold a text's smallest id comes from counts, so a text that a third of all rows
share is one row per part when it meets itself.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelmill.llm.common import text_of

WORD = r"[^\x20\x09-\x0D]+"


def text_filters(text_column: str = "text", least_words: int = 200, distinct_share: int = 50, capital_share: int = 2, signs: str = "#$%&*|") -> dict[str, Column]:
    """Failure conditions on a text, by letter: A too few words, B too few distinct words, C too many capitals, D holds one of the signs.

    Shares are in percent. Null reads as empty, which fails A alone.
    """
    text = text_of(text_column)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < least_words,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * distinct_share,
        "C": capitals * 100 > F.length(text) * capital_share,
        "D": text.rlike("[" + "".join(f"\\{s}" for s in signs) + "]"),
    }


def masks(
    docs: DataFrame, labels: DataFrame, filters: dict[str, Column], repeats: str | None = "E",
    id_column: str = "doc_id", text_column: str = "text", part_column: str = "source",
) -> DataFrame:
    """(part, mask, n, good, toxic): how many documents of a part fail just the filters of a mask, and how many of them are good or toxic.

    Bit k of a mask is the k-th filter; ``repeats`` names the last one, a text that
    a smaller id has too. ``labels`` has (id, quality, toxic); a document is good or
    toxic if a row of its id says 1. A null part counts as the empty string. Rows
    without an id have no label, fail no repeat and make none. Rows that repeat an
    id and text are counted each.
    """
    mask = F.lit(0)
    for k, fails in enumerate(filters.values()):
        mask = mask + F.when(fails, 1 << k).otherwise(0)
    read = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
        F.sha2(text_of(text_column).cast("binary"), 256).alias("sha"), mask.alias("mask"),
    )
    rows = read.groupBy("id", "part", "sha", "mask").agg(F.count(F.lit(1)).alias("n"))
    said = labels.groupBy(F.col(id_column).alias("id")).agg(
        F.coalesce(F.max(F.expr("quality = 1")), F.lit(False)).alias("good"), F.coalesce(F.max(F.expr("toxic = 1")), F.lit(False)).alias("toxic")
    ).filter("good or toxic")
    # rows without an id find no label, wherever they are dealt
    where = F.when(F.col("id").isNull(), F.xxhash64("sha")).otherwise(F.lit(0))
    told = rows.withColumn("deal", where).join(said.withColumn("deal", F.lit(0).cast("long")), ["id", "deal"], "left").select(
        "id", "part", "sha", "mask", "n", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    )
    if repeats is None:
        counted = told.select("part", "mask", "good", "toxic", "n")
    else:
        nameless = F.when(F.col("id").isNull(), F.col("n")).otherwise(0)
        texts = told.groupBy("sha", "part", "mask", "good", "toxic").agg(
            F.sum("n").alias("n"), F.sum(nameless).alias("nameless"), F.min("id").alias("least"), F.min_by("n", "id").alias("at_least")
        )
        first = F.min("least").over(Window.partitionBy("sha"))
        spared = F.col("nameless") + F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
        both = F.array(
            F.struct(F.col("mask").alias("mask"), F.col("spared").alias("n")),
            F.struct((F.col("mask") + (1 << len(filters))).alias("mask"), (F.col("n") - F.col("spared")).alias("n")),
        )
        counted = texts.withColumn("first", first).withColumn("spared", spared).select("part", "good", "toxic", F.inline(both)).filter("n > 0")
    return counted.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")
    )


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def interactions(cells: DataFrame, letters: str) -> DataFrame:
    """Cells of ``masks`` -> (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    One row per part, order and step, zeros included; a part without a cell has
    none. The filters named by ``letters`` run from left to right; step counts from 1.
    """
    orders = [list(p) for p in permutations(range(len(letters)))]
    constant = F.array(*[F.array(*[F.lit(k) for k in order]) for order in orders])
    zero = F.lit(0).cast("long")

    def folded(cell: Column) -> Column:
        """What a cell adds to every order and step: an array of structs, steps of an order side by side."""

        def step(state: Column, k: Column) -> Column:
            fails = cell["mask"].bitwiseAND(F.call_function("shiftleft", F.lit(1), k)) > 0
            gone, n = state["gone"], cell["n"]
            now = fails & ~gone
            out = F.struct(
                F.when(gone | fails, zero).otherwise(n).alias("kept"), F.when(now, n).otherwise(zero).alias("removed"),
                F.when(fails & gone, n).otherwise(zero).alias("redundant"),
                F.when(cell["mask"] == F.call_function("shiftleft", F.lit(1), k), n).otherwise(zero).alias("unique_fails"),
                F.when(now, cell["good"]).otherwise(zero).alias("good_lost"), F.when(now, cell["toxic"]).otherwise(zero).alias("toxic_lost"),
            )
            return F.struct((gone | fails).alias("gone"), F.concat(state["steps"], F.array(out)).alias("steps"))

        shape = "array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"
        start = F.struct(F.lit(False).alias("gone"), F.array().cast(shape).alias("steps"))
        return F.flatten(F.transform(constant, lambda order: F.aggregate(order, start, step, lambda s: s["steps"])))

    def plus(a: Column, b: Column) -> Column:
        return F.struct(*[(a[c] + b[c]).alias(c) for c in COUNTS])

    # at most 2 ** filters cells a part
    listed = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    none = F.array_repeat(F.struct(*[zero.alias(c) for c in COUNTS]), len(orders) * len(letters))
    summed = listed.select("part", F.aggregate("cells", none, lambda total, cell: F.zip_with(total, folded(cell), plus)).alias("steps"))
    names = F.array(*[F.lit("".join(letters[k] for k in order)) for order in orders])
    told = summed.select("part", F.posexplode("steps").alias("at", "counts")).select(
        "part", F.element_at(names, (F.col("at") / len(letters)).cast("int") + 1).alias("filter_order"), (F.col("at") % len(letters) + 1).alias("step"), "counts.*"
    )
    return told.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", F.substring("filter_order", F.col("step"), F.lit(1)))))


def audit(
    docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None, repeats: str | None = "E",
    id_column: str = "doc_id", text_column: str = "text", part_column: str = "source",
) -> DataFrame:
    """The rows of ``interactions`` for a table of documents.

    ``filters`` are failure conditions on the columns of ``docs`` by letter, those of
    ``text_filters`` if not given; ``repeats`` is the letter of "a smaller id has this
    text" (None leaves it out). ``shapley`` of a row is what its filter removes,
    summed over all orders. An empty table gives no rows; other columns, whatever
    their names, are not read.
    """
    filters = text_filters(text_column) if filters is None else filters
    return interactions(masks(docs, labels, filters, repeats, id_column, text_column, part_column), "".join([*filters, *([repeats] if repeats else [])]))
