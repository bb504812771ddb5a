"""Sentence frames: the same diagram under several intents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.functions import text as tx

# The sentences of each template, in order.
FRAMES = {
    "write": [
        "write {text} to {path}",
        "put the text {text} into a file called {path}",
        "create {path} containing {text}",
        "save {text} as {path}",
    ],
    "write_then_read": [
        "write {text} to {path}, then check that {path} exists",
        "create {path} with {text} and confirm the file is there afterwards",
        "after saving {text} into {path}, read {path} back to be sure",
    ],
    "run_print": [
        "run python and print {n}",
        "use python to print the number {n}",
        "print {n} with a python one-liner",
    ],
    "write_then_count": [
        "create {k} file(s) named {names} and count the files in the directory",
        "make the files {names} ({k} of them), then report how many files the directory holds",
        "write {names} and count what is in the folder afterwards",
    ],
    "walk_from_stick": [
        "walk where the left stick points, {gain} times the stick, at most {cap} metres per second",
        "move in the stick's direction with gain {gain}; never faster than {cap} m/s",
        "the left stick drives walking: scale it by {gain} and cap the speed at {cap}",
    ],
    "face_the_stick": [
        "face the way the left stick points",
        "turn to face the stick direction every frame",
        "keep the facing aligned with the left stick",
    ],
    "tracker_lost_freezes": [
        "freeze the hair chains once the tracker has been gone for {ms} milliseconds",
        "if the tracker drops out for {ms} ms, stop the chain simulation",
        "when tracking is lost for longer than {ms} milliseconds, hold the chains still",
    ],
    "button_sequence_then_idle": [
        "when the button is pressed play style {style} for {ms} milliseconds, then idle",
        "on a button press, switch to style {style}, hold it {ms} ms, and go back to idle",
        "a press of the button starts style {style}; after {ms} milliseconds return to idle",
    ],
    "speed_limited_run": [
        "run at {gain} times the stick, never faster than {cap} metres per second",
        "scale the stick by {gain} for running speed and limit it to {cap} m/s",
        "running speed is the stick times {gain}, clamped at {cap}",
    ],
}


def frame_dimension(spark: SparkSession, frames: dict[str, list[str]] = FRAMES) -> DataFrame:
    """(template_id, frame_id, frame, frames): a row per sentence, with its template's count."""
    rows = [(t, i, s, len(ss)) for t, ss in frames.items() for i, s in enumerate(ss)]
    return spark.createDataFrame(rows, "template_id string, frame_id bigint, frame string, frames int")


def pick(rows: DataFrame, frames: dict[str, list[str]], params: Column) -> DataFrame:
    """Add ``frame_id`` (seed modulo the template's frames) and the filled ``intent``.

    The dimension has some tens of rows and is broadcast.
    """
    dimension = frame_dimension(rows.sparkSession, frames)
    counts = dimension.select("template_id", "frames").distinct()
    numbered = rows.join(F.broadcast(counts), "template_id").withColumn("frame_id", F.col("seed") % F.col("frames")).drop("frames")
    sentences = dimension.select("template_id", "frame_id", "frame")
    filled = numbered.join(F.broadcast(sentences), ["template_id", "frame_id"])
    return filled.withColumn("intent", tx.fill_placeholders(F.col("frame"), params)).drop("frame")


def unframed(rows: DataFrame, frames: dict[str, list[str]]) -> DataFrame:
    """Rows of a template that has no sentences, which ``pick`` cannot tell: (subject, problem)."""
    return rows.filter(F.col("template_id").isNull() | ~F.col("template_id").isin(*frames)).select(
        F.concat_ws("/", "template_id", F.col("seed").cast("string")).alias("subject"), F.lit("no sentence for the template").alias("problem")
    )


def unfilled_problems(rows: DataFrame, frames: dict[str, list[str]], params: Column) -> DataFrame:
    """Rows whose frame wants a name the row does not carry: (template_id, seed, missing)."""
    dimension = frame_dimension(rows.sparkSession, frames)
    counts = dimension.select("template_id", "frames").distinct()
    numbered = rows.join(F.broadcast(counts), "template_id").withColumn("frame_id", F.col("seed") % F.col("frames")).drop("frames")
    joined = numbered.join(F.broadcast(dimension.drop("frames")), ["template_id", "frame_id"])
    missing = tx.unfilled(F.col("frame"), params)
    return joined.select("template_id", "seed", F.array_join(missing, ",").alias("missing")).filter("missing <> ''")
