"""Media archives: entry names, checks, grouping, manifests, subjects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions import payload as pl
from labelmill.functions import text as tx
from labelmill.operators import ordering

# Stream numbers, the directory each stream is kept in and the
# split names of the subjects table.
STREAMS = {1: "thermal", 2: "visual", 3: "visual_aligned"}
STREAM_DIRS = {
    "thr_image": 1, "rgb_image": 2, "rgb_image_aligned": 3,
    "thr_image_cmd": 1, "rgb_image_cmd": 2, "rgb_image_cmd_aligned": 3,
}
SUBJECT_SPLITS = {"Train": "train", "Valid": "test", "Test": "evaluation"}

INTEGER = r"^[+-]?[0-9]+$"
FIELDS = ["kind", "sub_id", "trial", "position", "command", "frame", "stream", "mic"]


def _lookup(entries: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(v) for pair in entries.items() for v in pair]), key)


def _int(text: Column) -> Column:
    return F.when(text.rlike(INTEGER), text.try_cast("bigint"))


def _file_parts(parts: Column) -> Column:
    """struct(ok, trial, directory, stem, extension) of a split name."""
    trial, file = F.get(parts, 1), F.get(parts, 3)
    stem = F.when(file.rlike(r"[^.]\.[^.]*$"), F.regexp_replace(file, r"\.[^.]*$", "")).otherwise(file)
    return F.struct(
        ((F.size(parts) == 4) & F.startswith(trial, F.lit("trial_"))).alias("ok"),
        F.substr(trial, F.lit(7)).alias("trial"),
        F.get(parts, 2).alias("directory"),
        F.split(stem, "_").alias("texts"),
        F.when(file.rlike(r"[^.]\.[^.]*$"), F.concat(F.lit("."), F.substring_index(file, ".", -1))).otherwise("").alias("extension"),
    )


def _sorted_out(f: Column, n: Column) -> Column:
    """struct(kind, stream): what the integers ``n`` of the file name say the entry is."""
    extension, third = f["extension"], F.get(n, 2)
    still = (extension == ".png") & (F.size(n) == 6) & (third == 1)
    command = (extension == ".png") & (F.size(n) == 7) & (third == 2)
    utterance = (extension == ".wav") & F.startswith(f["directory"], F.lit("mic")) & (F.size(n) == 6) & (third == 2)
    return F.struct(
        F.when(still, "still").when(command, "cmd").when(utterance, "utterance").alias("kind"),
        F.when(still, F.get(n, 5)).when(command, F.get(n, 6)).otherwise(F.lit(0).cast("bigint")).alias("stream"),
    )


def _reason(f: Column, n: Column, k: Column) -> Column:
    integers = f["trial"].rlike(INTEGER) & F.forall(f["texts"], lambda t: t.rlike(INTEGER))
    declared = _lookup(STREAM_DIRS, f["directory"]).cast("bigint")
    return (
        F.when(~f["ok"], "unrecognised_path")
        .when(~integers, "not_an_integer")
        .when(k["kind"].isNull(), "unrecognised_fields")
        .when((k["kind"] != "utterance") & ~declared.eqNullSafe(k["stream"]), "stream_dir_disagrees")
        .when(_int(f["trial"]) != F.get(n, 1), "trial_dir_disagrees")
    )


def _key(n: Column, k: Column, reason: Column) -> Column:
    kind = k["kind"]

    def accepted(value: Column) -> Column:
        return F.when(reason["why"].isNull(), value)

    return F.struct(
        accepted(kind).alias("kind"),
        accepted(F.get(n, 0)).alias("sub_id"),
        accepted(F.get(n, 1)).alias("trial"),
        accepted(F.get(n, 3)).alias("position"),
        accepted(F.when(kind != "still", F.get(n, 4))).alias("command"),
        accepted(F.when(kind == "still", F.get(n, 4)).when(kind == "cmd", F.get(n, 5))).alias("frame"),
        accepted(k["stream"]).alias("stream"),
        accepted(F.when(kind == "utterance", F.get(n, 5))).alias("mic"),
        reason["why"].alias("reason"),
    )


def parse_entry(name: Column) -> Column:
    """struct(kind, sub_id, trial, position, command, frame, stream, mic, reason); reason is null when accepted.

    ``root/trial_T/streamdir/a_b_c….ext``. Reasons are looked for in this order:
    unrecognised_path, not_an_integer, unrecognised_fields, stream_dir_disagrees,
    trial_dir_disagrees. Each step is evaluated once per name.
    """
    return tx.let(
        F.split(name, "/"),
        lambda parts: tx.let(
            _file_parts(parts),
            lambda f: tx.let(
                F.transform(f["texts"], _int),
                lambda n: tx.let(
                    _sorted_out(f, n),
                    lambda k: tx.let(F.struct(_reason(f, n, k).alias("why")), lambda reason: _key(n, k, reason)),
                ),
            ),
        ),
    )


def keyed_entries(entries: DataFrame, name: str = "name") -> DataFrame:
    """Add the key columns and ``reason``.

    The key comes out of a generator, so a later filter on ``reason`` stays
    above it instead of parsing the name again where the entries are read.
    """
    return entries.select("*", F.inline(F.array(parse_entry(F.col(name)))))


def entry_problem() -> Column:
    """Why an entry is refused: a bad name, another subject's entry, bytes that do not fit; null if it is not."""
    return F.coalesce(
        "reason",
        F.when(F.col("sub_id") != F.col("subject"), "subject_disagrees"),
        pl.wrong_magic(F.col("kind"), F.col("bytes")),
    )


def entry_problems(keyed: DataFrame) -> DataFrame:
    """Refused entries of keyed(archive, subject, name, bytes, kind, …, reason)."""
    return keyed.select("archive", "name", entry_problem().alias("problem")).filter("problem is not null")


def group_kind() -> Column:
    return F.when(F.col("kind") == "utterance", "audio").otherwise(F.col("kind"))


def stream_name() -> Column:
    return _lookup(STREAMS, F.col("stream").cast("int"))


def group_name() -> Column:
    """``still/thermal/trial_1``; audio has no stream part."""
    return F.concat_ws("/", "relation", stream_name(), F.concat(F.lit("trial_"), F.col("trial").cast("string")))


def group_counts(keyed: DataFrame) -> DataFrame:
    """Per (archive, relation, stream, trial): rows and bytes. Bytes become a length before the shuffle."""
    sized = keyed.select(
        "archive", group_kind().alias("relation"), F.coalesce("stream", F.lit(0)).alias("stream"), "trial",
        F.length("bytes").cast("bigint").alias("size"),
    )
    return sized.groupBy("archive", "relation", "stream", "trial").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")
    )


def group_order(groups: DataFrame) -> DataFrame:
    """Group counts with their place, from 0, in the order of (archive, relation, stream, trial), columns of the key first."""
    keys = ["archive", "relation", "stream", "trial"]
    return ordering.numbered(groups, *keys, name="place").select("place", *keys, "rows", "bytes")


def manifest(groups: DataFrame, archives: DataFrame) -> DataFrame:
    """Per subject: rows, bytes and what each archive gave.

    archives(subject, split, archive, size, sha256); an archive of size 0 is
    named as empty. A subject has a fixed few archives and groups.
    """
    per_archive = (
        groups.withColumn("group", group_name())
        .groupBy("archive")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("bytes").alias("bytes"),
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("group", F.struct("rows", "bytes"))))).alias("groups"),
        )
    )
    entry = F.struct((F.col("size") == 0).alias("empty"), "size", "sha256", "groups")
    return (
        archives.join(per_archive, "archive", "left")
        .groupBy("subject", "split")
        .agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
            F.map_from_entries(F.collect_list(F.struct("archive", entry))).alias("archives"),
        )
    )


def manifest_totals(groups: DataFrame, archives: DataFrame) -> DataFrame:
    """Per subject: archives, empty archives, groups, rows, bytes; all partial sums."""
    per_archive = groups.groupBy("archive").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")
    )
    zero = F.lit(0).cast("bigint")
    return (
        archives.join(per_archive, "archive", "left")
        .groupBy("subject")
        .agg(
            F.count(F.lit(1)).alias("archives"),
            F.count_if(F.col("size") == 0).alias("empty"),
            F.coalesce(F.sum("groups"), zero).alias("groups"),
            F.coalesce(F.sum("rows"), zero).alias("rows"),
            F.coalesce(F.sum("bytes"), zero).alias("bytes"),
        )
    )


def media_path(extension: str) -> Column:
    """The entry's name rebuilt from its key."""
    session = F.when(F.col("kind") == "still", F.lit("1")).otherwise(F.lit("2"))
    last = F.when(F.col("kind") == "utterance", F.col("mic")).otherwise(F.col("stream"))
    return F.concat(
        F.concat_ws(
            "_", F.col("sub_id").cast("string"), F.col("trial").cast("string"), session,
            F.col("position").cast("string"), F.col("command").cast("string"), F.col("frame").cast("string"), last.cast("string"),
        ),
        F.lit(f".{extension}"),
    )


def _relation(keyed: DataFrame, kind: str, columns: list[tuple[str, str]], media: str, extension: str) -> DataFrame:
    """One media relation with its narrow integers; an out-of-range value is an error under ANSI."""
    narrow = [F.col(c).cast(t).alias(c) for c, t in columns]
    content = F.struct(F.col("bytes"), media_path(extension).alias("path")).alias(media)
    extra = [F.col(c) for c in ("split", "stream_name") if c in keyed.columns]
    return keyed.filter(F.col("kind") == kind).select(*extra, *narrow, content)


def still_relation(keyed: DataFrame, subject: str = "smallint") -> DataFrame:
    return _relation(keyed, "still", [("sub_id", subject), ("trial", "tinyint"), ("position", "tinyint"), ("frame", "int")], "image", "png")


def command_relation(keyed: DataFrame, subject: str = "smallint") -> DataFrame:
    return _relation(
        keyed, "cmd",
        [("sub_id", subject), ("trial", "tinyint"), ("position", "tinyint"), ("command", "smallint"), ("frame", "int")],
        "image", "png",
    )


def audio_relation(keyed: DataFrame, subject: str = "smallint") -> DataFrame:
    return _relation(
        keyed, "utterance",
        [("sub_id", subject), ("trial", "tinyint"), ("position", "tinyint"), ("command", "smallint"), ("mic", "tinyint")],
        "audio", "wav",
    )


# --- subjects --------------------------------------------------------------------


def subjects(raw: DataFrame) -> DataFrame:
    """The raw subjects table with the split names of a stage; an unknown one gives a null split."""
    return raw.select(
        F.col("Sub_ID").alias("sub_id"), _lookup(SUBJECT_SPLITS, F.col("Split")).alias("split"),
        F.col("Age").alias("age"), F.col("Gender").alias("gender"), F.col("Ethnicity").alias("ethnicity"),
    )


def subject_problems(raw: DataFrame) -> DataFrame:
    return raw.filter(_lookup(SUBJECT_SPLITS, F.col("Split")).isNull()).select(
        F.col("Sub_ID").cast("string").alias("subject"), F.concat(F.lit("unknown split "), F.coalesce("Split", F.lit(""))).alias("problem")
    )


def subject_accessories(raw: DataFrame) -> DataFrame:
    """One row per (subject, trial, accessory): two list columns unpivoted, then exploded."""
    trials = F.array(
        *[F.struct(F.lit(t).alias("trial"), tx.accessories(F.col(f"Acc_Trial_{t}")).alias("names")) for t in (1, 2)]
    )
    flat = raw.select(F.col("Sub_ID").alias("sub_id"), F.inline(trials))
    return flat.select("sub_id", "trial", F.explode("names").alias("accessory"))


def subject_split(archives: DataFrame, subject_table: DataFrame) -> DataFrame:
    """Archives with their subject's split; an unknown subject keeps a null split for the gate."""
    table = subject_table.select(F.col("sub_id").alias("subject"), "split")
    return archives.join(table, "subject", "left")


def subjects_per_split(subject_table: DataFrame) -> DataFrame:
    return subject_table.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def remaining(targets: DataFrame, manifests: DataFrame) -> DataFrame:
    """Targets without a manifest: what a resumed run still has to do."""
    return targets.join(manifests.select("subject").distinct(), "subject", "left_anti")


def resume_counts(targets: DataFrame, manifests: DataFrame) -> DataFrame:
    """One row: skipped and remaining."""
    done = manifests.select("subject").distinct().withColumn("_done", F.lit(True))
    flagged = targets.join(done, "subject", "left")
    return flagged.agg(
        F.count_if(F.col("_done").isNotNull()).alias("skipped"), F.count_if(F.col("_done").isNull()).alias("remaining")
    )
