"""The four stage relations and the ways between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill import schemas
from labelmill.functions import text as tx

CANDIDATE_COLUMNS = [
    "candidate", "rank", "fbd_text", "fbd_xml", "plan_json", "result_json", "fbd_path", "fbd_sha", "provenance",
]
SCORE_COLUMNS = [
    "candidate", "parses", "compiles", "runs", "effect_matches", "steps", "wall_ms", "refusal",
]


def stub_dimension(spark) -> DataFrame:
    """family -> the four stub columns; eight rows."""
    rows = [(family, *stub) for family, stub in schemas.STUBS.items()]
    return spark.createDataFrame(
        rows, "family string, task_type string, dimension string, input_column string, input_asset_kind string"
    )


def root_rows(rows: DataFrame) -> DataFrame:
    """In-flight rows -> root relation: stub literals, canonical blocks, provenance.

    ``rows`` carries family, template_id, seed, intent, frame_id, blocks
    (array) and, optionally, traces (array). A row of a family without a stub
    keeps null stub columns, which the null gate refuses; ``unknown_families``
    names it.
    """
    traces = F.col("traces") if "traces" in rows.columns else F.array().cast("array<string>")
    with_stub = rows.join(F.broadcast(stub_dimension(rows.sparkSession)), "family", "left")
    return with_stub.select(
        tx.row_key(F.col("family"), F.col("template_id"), F.col("seed")).alias("key"),
        "task_type", "dimension", "input_column", "input_asset_kind", "intent", "template_id",
        F.col("seed").cast("bigint").alias("seed"),
        F.coalesce(F.col("frame_id").cast("bigint"), F.lit(0)).alias("frame_id"),
        tx.joined_set(F.col("blocks")).alias("blocks"),
        traces.alias("traces"),
        F.lit("constructed:template").alias("provenance"),
    )


def unknown_families(rows: DataFrame) -> DataFrame:
    """Rows of a family that has no stub: (subject, problem)."""
    return rows.filter(F.col("family").isNull() | ~F.col("family").isin(*schemas.STUBS)).select(
        tx.row_key(F.col("family"), F.col("template_id"), F.col("seed")).alias("subject"), F.lit("unknown family").alias("problem")
    )


def candidate_of_ranks(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Unpivot one column per rank into one row per rank: (…, candidate, rank, fbd_text)."""
    entries = [
        F.struct(F.lit(name).alias("candidate"), F.lit(rank).alias("rank"), columns[name].alias("fbd_text"))
        for name, rank in schemas.RANKS
    ]
    return rows.select("*", F.inline(F.array(*entries)))


def candidate_rows(rows: DataFrame, xml: Column | None = None) -> DataFrame:
    """In-flight rows with rank1/rank3/rank5 texts -> candidate relation.

    ``xml`` marks a family that stores XML instead of text: where it is true the
    texts go to ``fbd_xml`` and ``fbd_text`` stays empty.
    """
    as_xml = xml if xml is not None else F.lit(False)
    flat = candidate_of_ranks(rows, {name: F.col(name) for name, _ in schemas.RANKS})
    empty = F.lit("")
    source = F.col("fbd_text")
    seed = F.col("seed").cast("string")
    return flat.select(
        tx.row_key(F.col("family"), F.col("template_id"), F.col("seed")).alias("row_key"),
        "candidate",
        "rank",
        F.when(as_xml, empty).otherwise(source).alias("fbd_text"),
        F.when(as_xml, source).otherwise(empty).alias("fbd_xml"),
        empty.alias("plan_json"),
        empty.alias("result_json"),
        F.concat_ws("/", F.lit("rows"), "template_id", seed, "candidate").alias("fbd_path"),
        F.sha2(source, 256).alias("fbd_sha"),
        F.when(as_xml, tx.provenance(F.col("template_id"), F.col("seed")))
        .otherwise(tx.provenance(F.col("template_id"), F.col("seed"), F.col("family")))
        .alias("provenance"),
    )


def score_rows(rows: DataFrame) -> DataFrame:
    """Rows with an array of score structs -> score relation."""
    return rows.select(
        tx.row_key(F.col("family"), F.col("template_id"), F.col("seed")).alias("row_key"), F.inline("scores")
    ).select("row_key", *SCORE_COLUMNS)


def _slot(name: str, column: str) -> Column:
    """One rank's value in a group; its state is one value, combined map-side."""
    return F.any_value(F.when(F.col("candidate") == name, F.col(column)), ignoreNulls=True)


def joined_view(root: DataFrame, candidates: DataFrame, scores: DataFrame) -> DataFrame:
    """Root with its candidates nested in rank order, each carrying its scores.

    The rank vocabulary is fixed, so the nested array is built from three
    aggregate slots per row rather than a collected list. Candidates and scores
    meet in the same aggregation, so the texts are shuffled once, and the join
    with the root reuses that partitioning. A candidate without a score keeps a
    null one, which ``unscored`` and the null gate name. A root row without
    candidates keeps an empty list and is named by the census.
    """
    held = candidates.select("row_key", "candidate", F.struct(*CANDIDATE_COLUMNS).alias("c"))
    verdicts = scores.select("row_key", "candidate", F.struct(*SCORE_COLUMNS).alias("s"))
    both = held.unionByName(verdicts, allowMissingColumns=True)
    slots = both.groupBy("row_key").agg(
        *[_slot(name, part).alias(f"{part}_{name}") for name, _ in schemas.RANKS for part in ("c", "s")]
    )
    entries = [
        F.when(F.col(f"c_{name}").isNotNull(), F.col(f"c_{name}").withField("scores", F.col(f"s_{name}")))
        for name, _ in schemas.RANKS
    ]
    nested = slots.select("row_key", F.array_compact(F.array(*entries)).alias("candidates"))
    held = F.coalesce("candidates", F.array().cast(nested.schema["candidates"].dataType))
    return root.join(nested.hint("merge"), F.col("key") == F.col("row_key"), "left").select(
        "key", "intent", "template_id", "seed", "traces", held.alias("candidates")
    )


def scores_of(scores: DataFrame, root: DataFrame) -> DataFrame:
    """The scores of the root rows, such as a split's. The keys grow with the rows, so they are never broadcast."""
    return scores.join(root.select(F.col("key").alias("row_key")).hint("merge"), "row_key", "left_semi")


def unscored(candidates: DataFrame, scores: DataFrame) -> DataFrame:
    """Candidates no score row names."""
    return candidates.select("row_key", "candidate").join(scores, ["row_key", "candidate"], "left_anti")


def duplicate_candidates(candidates: DataFrame) -> DataFrame:
    """(row_key, candidate) must be a key: anything held twice is a problem."""
    return (
        candidates.groupBy("row_key", "candidate")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(
            "row_key",
            F.concat_ws("/", "row_key", "candidate").alias("subject"),
            F.concat(F.lit("held "), F.col("n").cast("string"), F.lit(" times")).alias("problem"),
        )
        .drop("row_key")
    )


def unnest_candidates(joined: DataFrame) -> DataFrame:
    """Joined view -> candidate relation."""
    return joined.select(F.col("key").alias("row_key"), F.inline("candidates")).select("row_key", *CANDIDATE_COLUMNS)


def unnest_scores(joined: DataFrame) -> DataFrame:
    """Joined view -> score relation."""
    exploded = joined.select(F.col("key").alias("row_key"), F.explode("candidates").alias("c"))
    return exploded.select("row_key", "c.scores.*").select("row_key", *SCORE_COLUMNS)


def drop_candidate_fields(joined: DataFrame, *names: str) -> DataFrame:
    """Remove fields from every nested candidate, such as a stale ``traces`` or the foreign key."""
    return joined.withColumn("candidates", F.transform("candidates", lambda c: c.dropFields(*names)))
