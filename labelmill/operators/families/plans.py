"""Planned goals: one canonical program per goal, its placeholder arguments filled per seed.

canonical(goal, text) is an input: the program planned with ``ARG_NAME`` for each argument.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.functions import programs as pg
from labelmill.functions import text as tx
from labelmill.operators import mutations
from labelmill.operators.draws import all_drawn, draw, drawn
from labelmill.operators.families.chores import WORDS

# Domain, goal, argument names and sentences of each goal.
GOALS = [
    ("repo_chores", "tests_pass", [], ["make the tests pass", "get the build green and the tests passing", "build then test"]),
    ("repo_chores", "tests_pass; git_commit {msg}", ["msg"], ["commit with the message {msg}", "make the tests pass and commit as {msg}", "build, test, then commit {msg}"]),
    ("repo_chores", "formatted", [], ["format the repository", "run the formatter", "make the sources formatted"]),
    ("file_layout", "configured {dir} {text}", ["dir", "text"], ["set up {dir} with a config saying {text} and check it", "make the directory {dir}, write {text} into its config, confirm the file", "configure {dir}: {text}"]),
    ("file_layout", "populated {dir} {text}", ["dir", "text"], ["put data {text} in {dir} and count the files there", "create {dir}, write {text} to its data file, count what is in it", "populate {dir} with {text} and report the file count"]),
    ("file_layout", "archived {dir} {text}", ["dir", "text"], ["populate {dir} with {text}, count it, and write a listing", "make {dir} with data {text}, then archive its listing", "archive the listing of {dir} after filling it with {text}"]),
    ("avatar_reactions", "greet", [], ["greet: face the stick, wave, hold two seconds, stop", "when triggered, wave for two seconds then idle", "a greeting sequence on the trigger"]),
    ("session_reactions", "acknowledge", [], ["acknowledge the speaker", "show you heard them", "a nod or a raised hand on the trigger"]),
    ("session_reactions", "decline", [], ["decline the request", "wave it off or shake your head", "a refusal gesture on the trigger"]),
    ("session_reactions", "take_seat", [], ["settle down and sit", "calm for two seconds, then sit", "take a seat once calm"]),
]
# plan arguments use the first twenty words
_WORDS = WORDS[:20]
_ARGUMENT_DRAWS = {
    "msg": [("msg_word", "choice", _WORDS), ("msg_n", "randint", 1, 99)],
    "dir": [("dir_word", "choice", _WORDS), ("dir_n", "randint", 1, 999)],
    "text": [("text_count", "randint", 1, 3), ("text", "repeat", "text_count", [("text_words", "choice", _WORDS)])],
}
DRAWS = {f"plan#{i}": [step for name in names for step in _ARGUMENT_DRAWS[name]] for i, (_, _, names, _) in enumerate(GOALS)}
TICKS = 24


def goal_dimension(spark) -> DataFrame:
    """(template_id ``plan#i``, goal, name, frames array): ten rows."""
    rows = [
        (f"plan#{i}", i, f"plan_{domain}_{goal.split(';')[-1].strip().split()[0]}", frames) for i, (domain, goal, _, frames) in enumerate(GOALS)
    ]
    return spark.createDataFrame(rows, "template_id string, goal int, name string, frames array<string>")


def trigger_trace():
    """One press on the second of 24 ticks."""
    ticks = F.transform(F.sequence(F.lit(0), F.lit(TICKS - 1)), lambda i: F.concat(F.lit('{"trigger": '), (i == 1).cast("string"), F.lit("}")))
    return F.concat(F.lit('{"dt": 0.125, "ticks": ['), F.array_join(ticks, ", "), F.lit("]}"))


def rows(jobs: DataFrame, canonical: DataFrame, drawing: Callable = draw) -> DataFrame:
    """jobs(template_id ``plan#i``, seed) with canonical(goal, text) -> rows."""
    known = jobs.join(F.broadcast(goal_dimension(jobs.sparkSession)), "template_id").withColumn("values", drawing(F.col("template_id"), F.col("seed"), DRAWS))
    v = F.col("values")
    args = {
        "msg": F.concat_ws("_", drawn(v, "msg_word"), drawn(v, "msg_n")),
        "dir": F.concat_ws("_", drawn(v, "dir_word"), drawn(v, "dir_n")),
        "text": F.array_join(all_drawn(v, "text_words"), "_"),
    }
    text = F.col("text")
    for name in ("msg", "dir", "text"):
        text = F.replace(text, F.lit(f"ARG_{name.upper()}"), args[name])
    params = F.create_map(*[part for name, value in args.items() for part in (F.lit(name), value)])
    filled = known.join(canonical, "goal").withColumn("rank1", text).withColumn("frame_id", F.col("seed") % F.size("frames"))
    reacts = pg.is_triggered(F.col("rank1"))
    return filled.select(
        F.col("name").alias("template_id"), "seed",
        tx.fill_placeholders(F.get("frames", F.col("frame_id").cast("int")), params).alias("intent"),
        "frame_id", "rank1",
        F.when(reacts, mutations.change_hold(F.col("rank1"))).otherwise(mutations.drop_last_step(F.col("rank1"))).alias("rank3"),
        mutations.refuse_kind(F.col("rank1")).alias("rank5"),
        F.when(reacts, F.array(trigger_trace())).otherwise(F.array().cast("array<string>")).alias("traces"),
    )


def unplanned(jobs: DataFrame, canonical: DataFrame) -> DataFrame:
    """Jobs that give no row: a template without a goal, a goal without a program. (subject, problem)"""
    subject = F.concat_ws("/", "template_id", F.col("seed").cast("string")).alias("subject")
    told = jobs.join(F.broadcast(goal_dimension(jobs.sparkSession)), "template_id", "left")
    aimless = told.filter("goal is null").select(subject, F.lit("no goal for the template").alias("problem"))
    return aimless.unionByName(told.filter("goal is not null").join(canonical.select("goal"), "goal", "left_anti").select(subject, F.lit("no program for the goal").alias("problem")))


def unmutated(made: DataFrame) -> DataFrame:
    """Rows no mutation changed: (subject, problem)."""
    return made.filter(F.col("rank1") == F.col("rank3")).select(
        F.concat_ws("/", "template_id", F.col("seed").cast("string")).alias("subject"), F.lit("no mutation found").alias("problem")
    )
