"""Audit of published datasets: payload, declared features, local paths, trust.

Inputs are tables: values to look at (``asset_values``), the files a dataset
lists (``files(repo, path)``) and the features its card declares
(``features(repo, name, dtype)``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelmill.functions import payload as pl

FINDING = ["kind", "repo", "tbl", "col", "detail"]


# --- leaves of a table -----------------------------------------------------------


def _leaves(field_type: T.DataType, column: Column, path: str, wanted: type) -> list[tuple[str, Column]]:
    """(path, array-of-values column) of every leaf of one type, through structs, arrays and maps."""
    if isinstance(field_type, wanted):
        return [(path, F.array(column))]
    if isinstance(field_type, T.StructType):
        found = []
        for field in field_type.fields:
            found += _leaves(field.dataType, column[field.name], f"{path}.{field.name}", wanted)
        return found
    if isinstance(field_type, T.ArrayType):
        return _element_leaves(field_type.elementType, column, path, wanted)
    if isinstance(field_type, T.MapType):
        keys = _element_leaves(field_type.keyType, F.map_keys(column), f"{path}.key", wanted)
        return keys + _element_leaves(field_type.valueType, F.map_values(column), f"{path}.value", wanted)
    return []


def _element_leaves(element: T.DataType, column: Column, path: str, wanted: type) -> list[tuple[str, Column]]:
    if isinstance(element, wanted):
        return [(path, column)]
    if isinstance(element, T.StructType):
        found = []
        for field in element.fields:
            found += _element_leaves(field.dataType, _field_of_each(column, field.name), f"{path}.{field.name}", wanted)
        return found
    if isinstance(element, T.ArrayType):
        return _element_leaves(element.elementType, F.flatten(column), path, wanted)
    return []


def _field_of_each(column: Column, name: str) -> Column:
    return F.transform(column, lambda element: element[name])


def _named(path: str, values: Column, value_type: str) -> Column:
    held = F.coalesce(values, F.array().cast(f"array<{value_type}>"))
    return F.transform(held, lambda value: F.struct(F.lit(path).alias("col"), value.alias("value")))


def string_leaves(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Melt every string leaf: (keep…, col, value). Nested strings are not skipped."""
    return _melt(df, T.StringType, keep)


def binary_leaves(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Melt every top-level binary column: (keep…, col, value). Bytes inside a struct are media already."""
    return _melt(df, T.BinaryType, keep, nested=False)


def _melt(df: DataFrame, wanted: type, keep: Iterable[str], nested: bool = True) -> DataFrame:
    keep = list(keep)
    leaves: list[tuple[str, Column]] = []
    for field in df.schema.fields:
        if field.name in keep:
            continue
        if nested or isinstance(field.dataType, wanted):
            leaves += _leaves(field.dataType, F.col(f"`{field.name}`"), field.name, wanted)
    value_type = "binary" if wanted is T.BinaryType else "string"
    if not leaves:
        empty = F.array().cast(f"array<struct<col: string, value: {value_type}>>")
        return df.select(*keep, F.inline(empty))
    packed = [_named(path, values, value_type) for path, values in leaves]
    return df.select(*keep, F.inline(F.concat(*packed))).filter(F.col("value").isNotNull())


def first_values(values: DataFrame, keys: Iterable[str], order: str, sample_n: int) -> DataFrame:
    """The first ``sample_n`` values per column, the sampling form of the audit.

    Spark plans ``row_number() <= n`` as a group limit on both sides of the
    shuffle, so at most n rows per group and task are moved.
    """
    head = Window.partitionBy(*keys).orderBy(order)
    return values.withColumn("_n", F.row_number().over(head)).filter(F.col("_n") <= sample_n).drop("_n")


# --- findings --------------------------------------------------------------------


def payload_paths(asset_values: DataFrame) -> DataFrame:
    """asset_values(repo, tbl, col, pos, value) -> distinct payload paths with counts.

    (repo, tbl, col, path, n, first): repeats collapse map-side, so a path that
    a third of the rows share is one row before the file set is joined.
    """
    paths = asset_values.filter(pl.payload_path(F.col("value")))
    return paths.groupBy("repo", "tbl", "col", pl.dataset_path(F.col("value")).alias("path")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("pos", "value")).alias("first")
    )


def path_findings(asset_values: DataFrame, files: DataFrame) -> DataFrame:
    """Columns of paths: dangling when any path is not in the dataset, else payload beside the table.

    (kind, repo, tbl, col, paths, dangling, example)
    """
    listed = files.select("repo", "path").distinct().withColumn("listed", F.lit(True))
    checked = payload_paths(asset_values).join(listed, ["repo", "path"], "left")
    missing = F.col("listed").isNull()
    rolled = checked.groupBy("repo", "tbl", "col").agg(
        F.sum("n").alias("paths"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("dangling"),
        F.min("first").alias("_any"),
        F.min(F.when(missing, F.col("first"))).alias("_dangling"),
    )
    return rolled.select(
        F.when(F.col("dangling") > 0, "dangling_path").otherwise("payload_beside").alias("kind"),
        "repo",
        "tbl",
        "col",
        "paths",
        "dangling",
        F.coalesce("_dangling", "_any")["value"].alias("example"),
    )


def dangling_paths(asset_values: DataFrame, files: DataFrame) -> DataFrame:
    """Paths no file of the dataset answers to: (repo, tbl, col, path, n)."""
    listed = files.select("repo", "path")
    return payload_paths(asset_values).join(listed, ["repo", "path"], "left_anti").select("repo", "tbl", "col", "path", "n")


def bare_media(binary_values: DataFrame, features: DataFrame) -> DataFrame:
    """Bare binary columns holding media the card does not declare: (repo, tbl, col, media).

    binary_values(repo, tbl, col, pos, value); the first value with a media magic names the kind.
    """
    magic = pl.media_magic(F.substring("value", 1, 8))
    found = (
        binary_values.select("repo", "tbl", "col", "pos", magic.alias("media"))
        .filter("media is not null")
        .groupBy("repo", "tbl", "col")
        .agg(F.min(F.struct("pos", "media")).alias("first"))
        .select("repo", "tbl", "col", F.col("first.media").alias("media"))
    )
    declared = features.select("repo", F.col("name").alias("col"), "dtype")
    return (
        found.join(declared, ["repo", "col"], "left")
        .filter(~pl.media_dtype(F.coalesce("dtype", F.lit("unknown"))))
        .select("repo", "tbl", "col", "media")
    )


def carried_columns(columns: DataFrame) -> DataFrame:
    """Distinct columns over all tables of a dataset: columns(repo, tbl, col) -> (repo, col)."""
    return columns.select("repo", "col").distinct()


def undelivered_features(features: DataFrame, columns: DataFrame) -> DataFrame:
    """Declared features no table carries: (repo, name, dtype)."""
    delivered = carried_columns(columns).withColumnRenamed("col", "name")
    return features.select("repo", "name", "dtype").join(delivered, ["repo", "name"], "left_anti")


def no_parquet(files: DataFrame) -> DataFrame:
    """Datasets with no table at all: (repo, files). Absence is not a pass."""
    return (
        files.groupBy("repo")
        .agg(F.count(F.lit(1)).alias("files"), F.count_if(F.endswith("path", F.lit(".parquet"))).alias("parquets"))
        .filter("parquets = 0")
        .select("repo", "files")
    )


def findings(
    asset_values: DataFrame, binary_values: DataFrame, files: DataFrame, features: DataFrame, columns: DataFrame
) -> DataFrame:
    """All findings of the audit: (kind, repo, tbl, col, detail)."""
    paths = path_findings(asset_values, files)
    points = F.when(
        F.col("kind") == "dangling_path",
        F.concat(
            F.lit("points at "), F.col("dangling").cast("string"),
            F.lit(" file(s) the dataset does not contain, e.g. "), "example",
        ),
    ).otherwise(
        F.concat(
            F.lit("points at "), F.col("paths").cast("string"),
            F.lit(" file(s) shipped beside the parquet, e.g. "), "example",
        )
    )
    bare = bare_media(binary_values, features)
    undelivered = undelivered_features(features, columns)
    absent = no_parquet(files)
    parts = [
        absent.select(
            F.lit("no_parquet").alias("kind"), "repo", F.lit("(dataset)").alias("tbl"), F.lit("(none)").alias("col"),
            F.concat(F.lit("holds "), F.col("files").cast("string"), F.lit(" file(s) and no parquet")).alias("detail"),
        ),
        paths.select("kind", "repo", "tbl", "col", points.alias("detail")),
        bare.select(
            F.lit("bare_media").alias("kind"), "repo", "tbl", "col",
            F.concat(F.lit("holds "), "media", F.lit(" bytes as a bare binary")).alias("detail"),
        ),
        undelivered.select(
            F.lit("undelivered_feature").alias("kind"), "repo", F.lit("(card)").alias("tbl"), F.col("name").alias("col"),
            F.concat(F.lit("the card declares "), "name", F.lit(" as "), "dtype", F.lit(" and no table carries that column")).alias("detail"),
        ),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def rollup(datasets: DataFrame, files: DataFrame, found: DataFrame, trusted: DataFrame) -> DataFrame:
    """Per dataset: status, parquets, files, findings.

    datasets(repo, readable); the status is ok, refused, untrusted or
    unreadable, and only ok passes. ``trusted(repo)`` lists the trusted ones.
    """
    counted = files.groupBy("repo").agg(
        F.count_if(F.endswith("path", F.lit(".parquet"))).alias("parquets"), F.count(F.lit(1)).alias("files")
    )
    per_repo = found.groupBy("repo").agg(F.count(F.lit(1)).alias("findings"))
    flagged = trusted.select("repo").distinct().withColumn("_trusted", F.lit(True))
    zero = F.lit(0).cast("bigint")
    return (
        datasets.join(flagged, "repo", "left")
        .join(counted, "repo", "left")
        .join(per_repo, "repo", "left")
        .select(
            "repo",
            F.when(F.col("_trusted").isNull(), "untrusted")
            .when(~F.col("readable"), "unreadable")
            .when(F.col("findings") > 0, "refused")
            .otherwise("ok")
            .alias("status"),
            F.coalesce("parquets", zero).alias("parquets"),
            F.coalesce("files", zero).alias("files"),
            F.coalesce("findings", zero).alias("findings"),
        )
    )


def rollup_problems(rolled: DataFrame) -> DataFrame:
    return rolled.filter("status <> 'ok'").select(
        F.col("repo").alias("subject"), F.concat("repo", F.lit(": "), "status").alias("problem")
    )


# --- trust -----------------------------------------------------------------------


def trust_candidates(source: Column) -> Column:
    """Names a source is trusted under: itself and, for ``owner/name``, its owner."""
    trimmed = F.rtrim(source, F.lit("/"))
    parts = F.split(trimmed, "/")
    owner = F.get(parts, F.lit(0))
    owned = F.array(F.concat(F.lit("huggingface.co/"), owner), owner)
    return F.when(F.size(parts) == 2, F.concat(F.array(trimmed), owned)).otherwise(F.array(trimmed))


def trusted(sources: DataFrame, trust: DataFrame) -> DataFrame:
    """sources(source) a trust(object) row covers. Distinct sources, so a repeated one is joined once."""
    offered = sources.select("source").distinct().select("source", F.explode(trust_candidates(F.col("source"))).alias("object"))
    return offered.join(trust.select("object").distinct(), "object", "left_semi").select("source").distinct()


def untrusted(sources: DataFrame, trust: DataFrame) -> DataFrame:
    """The refused ones, each with the refusal that names it."""
    refused = sources.select("source").distinct().join(trusted(sources, trust), "source", "left_anti")
    return refused.select(
        "source", F.concat(F.lit("REFUSED: "), "source", F.lit(" is not a trusted data source")).alias("problem")
    )


# --- local paths -----------------------------------------------------------------


def local_path_columns(values: DataFrame) -> DataFrame:
    """Columns that name a local filesystem: values(file, col, pos, value) -> (file, col, first_pos)."""
    return (
        values.filter(pl.names_local_path(F.col("value"))).groupBy("file", "col").agg(F.min("pos").alias("first_pos"))
    )


def hit_lines(text: Column) -> Column:
    """1-based numbers of the lines naming a local path, without leaving the row."""
    numbered = F.transform(F.split(text, "\n"), lambda line, i: F.when(pl.names_local_path(line), i + 1))
    return F.filter(numbered, lambda n: n.isNotNull())


def local_path_hits(files: DataFrame) -> DataFrame:
    """Every offending line: files(path, text) -> (path, line)."""
    eligible = files.filter(pl.names_local_path(F.col("text")))
    return eligible.select("path", F.explode(hit_lines(F.col("text"))).alias("line"))


def first_hit_per_file(files: DataFrame) -> DataFrame:
    """The first offending line of each offending file: a projection, no shuffle."""
    eligible = files.filter(pl.names_local_path(F.col("text")))
    return eligible.select("path", F.array_min(hit_lines(F.col("text"))).alias("line")).filter("line is not null")


def forbidden_paths(files: DataFrame) -> DataFrame:
    return files.filter(pl.forbidden_marker(F.col("path"))).select("path")


def publication_problems(columns: DataFrame, paths: DataFrame, texts: DataFrame) -> DataFrame:
    """The three refusals before publication, as gate problems."""
    named = local_path_columns(columns).select(
        F.concat_ws(":", "file", "col").alias("subject"), F.lit("column names a local filesystem").alias("problem")
    )
    marked = forbidden_paths(paths).select(F.col("path").alias("subject"), F.lit("blocked marker in staged path").alias("problem"))
    lines = first_hit_per_file(texts.filter(pl.publishable_text(F.col("path")))).select(
        F.concat_ws(":", "path", F.col("line").cast("string")).alias("subject"),
        F.lit("staged file names a local filesystem").alias("problem"),
    )
    return named.unionByName(marked).unionByName(lines)
