"""Every row family behind one interface, and the way from a number of rows to a written stage.

A family names its stub, its templates, how many distinct programs each of them can
give, and how a job becomes a row. ``build`` does the rest for any of them, several
at once: capacity gate, allocation, seeds, rows, splits, and the four relations of
each split as one version.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.functions import programs as pg
from labelmill.operators import allocation, compose, controls, draws, gates, relations, splits
from labelmill.operators.families import blocks, calls, chores, controllers, methods, plans, settings

#: A template that can give more distinct programs than this is as good as endless.
MOST_SPACE = 10**15
#: Families made, or splits written, at a time.
AT_A_TIME = 4
T = TypeVar("T")
IN_FLIGHT = ["family", "template_id", "seed", "intent", "frame_id", "blocks", "rank1", "rank3", "rank5", "traces"]


def space(steps: Sequence[tuple], aside: Iterable[str] = ()) -> int:
    """How many different values the steps can draw, names ``aside`` (what only traces read) left out."""
    aside, total = set(aside), 1
    for name, kind, *args in steps:
        if name in aside or kind == "derive":
            continue
        if kind == "uniform":
            size = round(args[1] * 10 ** args[2]) - round(args[0] * 10 ** args[2]) + 1
        elif kind == "randint":
            size = args[1] - args[0] + 1
        elif kind == "choice":
            size = len(set(map(str, args[0])))
        elif kind == "coin":
            size = 2
        elif kind == "repeat":
            size = space(args[1], aside) ** (args[0] if isinstance(args[0], int) else 1)
        else:  # how many a choice among some, a sample or a shuffle gives depends on what was drawn: at least one
            size = 1
        total = min(total * size, MOST_SPACE)
    return total


@dataclass(frozen=True)
class Family:
    """One trait: templates with their spaces, and rows(jobs, inputs) with template_id, seed, intent, frame_id, three texts and traces."""

    name: str
    spaces: Callable[[Mapping[str, DataFrame]], dict[str, int]]
    rows: Callable[[DataFrame, Mapping[str, DataFrame]], DataFrame]
    needs: tuple[str, ...] = ()
    as_xml: bool = False
    called: bool = False  # blocks are call signatures


def _fixed(plans_of: Mapping[str, Sequence[tuple]], aside: Iterable[str] = ()) -> Callable[[Mapping[str, DataFrame]], dict[str, int]]:
    return lambda inputs: {template: space(steps, aside) for template, steps in plans_of.items()}


def _composed_spaces(inputs: Mapping[str, DataFrame]) -> dict[str, int]:
    one = {t: space(steps, ("lx", "ly", "at")) for t, steps in controllers.DRAWS.items()}
    return {f"compose_{i}": min(one[a] * one[b], MOST_SPACE) for i, (a, b) in enumerate(compose.PAIRS)}


def _translated(jobs: DataFrame, inputs: Mapping[str, DataFrame]) -> DataFrame:
    """Methods with the programs a translator gave for them, ``translated`` (template_id, seed, rank1, rank3, rank5)."""
    made = methods.rows(jobs, draws.counted)
    return made.join(inputs["translated"], ["template_id", "seed"])


def _behaviour_spaces(inputs: Mapping[str, DataFrame]) -> dict[str, int]:
    """A program's literals are redrawn: twenty for every behaviour without asking how many it has. The programs are a registry."""
    return {f"harness_{row['name']}": 20 for row in sorted(inputs["base"].select("name").distinct().collect())}


FAMILIES = {
    f.name: f
    for f in (
        Family("fbd", _fixed(chores.DRAWS), lambda jobs, inputs: chores.rows(jobs, draws.counted), as_xml=True),
        Family("react", _fixed(controllers.DRAWS, ("lx", "ly", "at")), lambda jobs, inputs: controllers.rows(jobs, draws.counted)),
        Family("harness", _behaviour_spaces, lambda jobs, inputs: blocks.rows(jobs, inputs["base"]), needs=("base",)),
        Family("compose", _composed_spaces, lambda jobs, inputs: controllers.composed_rows(jobs, draws.counted)),
        Family("plan", _fixed(plans.DRAWS), lambda jobs, inputs: plans.rows(jobs, inputs["canonical"], draws.counted), needs=("canonical",)),
        Family("godot", _fixed(calls.DRAWS), lambda jobs, inputs: calls.rows(jobs), called=True),
        Family("trainer", _fixed(settings.DRAWS), lambda jobs, inputs: settings.rows(jobs), called=True),
        Family("udon", _fixed({f"udon_{n}": steps for n, steps in methods.CONSTANTS.items()}), _translated, needs=("translated",)),
    )
}


def spaces(spark: SparkSession, family: str, inputs: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """(ord, template_id, space) of a family: its registry as a table."""
    held = FAMILIES[family].spaces(inputs or {})
    return spark.createDataFrame([(i, t, n) for i, (t, n) in enumerate(held.items())], "ord int, template_id string, space bigint")


def capacity(family: str, inputs: Mapping[str, DataFrame] | None = None) -> int:
    """How many rows a family can give without repeating a program."""
    return sum(FAMILIES[family].spaces(inputs or {}).values())


def jobs(spark: SparkSession, family: str, rows: int, inputs: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """(template_id, seed) of so many rows; refuses what the templates cannot give without repeating a program."""
    table = spaces(spark, family, inputs)
    gates.require_none(allocation.capacity_problem(table, rows), f"allocation of {family}")
    return allocation.jobs(allocation.seed_ranges(allocation.allocate(table, rows)))


def rows(jobs_of: DataFrame, family: str, inputs: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Jobs of a family -> in-flight rows, with the blocks its rank1 uses."""
    one, inputs = FAMILIES[family], inputs or {}
    missing = [n for n in one.needs if n not in inputs]
    if missing:
        raise ValueError(f"family {family} needs {', '.join(missing)}")
    made = one.rows(jobs_of, inputs)
    used = pg.xml_kinds(F.col("rank1")) if one.as_xml else pg.signatures(F.col("rank1")) if one.called else pg.block_kinds(F.col("rank1"))
    return made.withColumn("blocks", used).withColumn("family", F.lit(family)).select(*[F.col(c).cast("bigint").alias(c) if c in ("seed", "frame_id") else F.col(c) for c in IN_FLIGHT])


def lost(jobs_of: DataFrame, made: DataFrame, family: str) -> DataFrame:
    """Jobs that gave no row: (subject, problem). Rows are named by their seed, which is one row's in a stage."""
    return jobs_of.join(made.select("seed"), "seed", "left_anti").select(
        F.concat_ws("/", F.lit(family), "template_id", F.col("seed").cast("string")).alias("subject"), F.lit("no row for the job").alias("problem")
    )


def side_by_side(work: Callable[[str], T], names: Iterable[str]) -> list[T]:
    """``work`` of each name, several at a time: their jobs share the cluster, so that planning one leaves no core idle.

    Every one ends before the first failure, in the order of the names, is raised.
    """
    names = list(names)
    with ThreadPoolExecutor(max_workers=AT_A_TIME) as pool:
        begun = [pool.submit(inheritable_thread_target(work), name) for name in names]
    return [b.result() for b in begun]


def build(
    spark: SparkSession, out: str, wanted: Mapping[str, int], inputs: Mapping[str, DataFrame] | None = None, name: str = "corpus",
    holdout_templates: Iterable[str] = (), holdout_blocks: Iterable[str] = (), score: Callable[[DataFrame], DataFrame] = controls.wanted_scores,
) -> dict[str, dict[str, int]]:
    """So many rows of each family, as a stage below ``out``: rows per split and relation.

    Rows are made once and kept beside the stage while its splits are written.
    ``score`` maps the in-flight rows to their score relation; runs are external, the
    default says what the controls want. A job without a row, and any null, refuses.
    """
    from labelmill.sources import paths, stage

    pending = paths.scratch(spark)

    def make(family: str) -> DataFrame:
        asked = jobs(spark, family, wanted[family], inputs)
        rows(asked, family, inputs).write.parquet(f"{pending}/{family}")
        part = spark.read.parquet(f"{pending}/{family}")
        gates.require_none(lost(asked, part, family), f"rows of {family}")
        return part

    made = functools.reduce(DataFrame.unionByName, side_by_side(make, wanted))
    as_xml = F.col("family").isin(*[f.name for f in FAMILIES.values() if f.as_xml])
    assigned = splits.assign(made, holdout_templates, holdout_blocks)

    def commit(split: str) -> dict[str, int]:
        part = assigned.filter(F.col("split") == split).drop("split")
        written = stage.commit_split(spark, out, split, name, relations.root_rows(part), relations.candidate_rows(part, as_xml), score(part))
        return {relation: r["rows"] for relation, r in written.relations.items()}

    counts = dict(zip(stage.schemas.SPLIT_DIRS, side_by_side(commit, stage.schemas.SPLIT_DIRS)))
    paths.remove(spark, pending)
    return counts
