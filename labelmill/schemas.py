"""Explicit schemas of the stage relations.

A missing artefact is the empty string, never null; the writers refuse nulls.
"""

from __future__ import annotations

ROOT = """
    key string, task_type string, dimension string, input_column string,
    input_asset_kind string, intent string, template_id string, seed bigint,
    frame_id bigint, blocks string, traces array<string>, provenance string
"""

CANDIDATE_FIELDS = """
    candidate string, rank int, fbd_text string, fbd_xml string, plan_json string,
    result_json string, fbd_path string, fbd_sha string, provenance string
"""
CANDIDATES = f"row_key string, {CANDIDATE_FIELDS}"

SCORE_FIELDS = """
    candidate string, parses boolean, compiles boolean, runs boolean,
    effect_matches boolean, steps bigint, wall_ms bigint, refusal string
"""
SCORES = f"row_key string, {SCORE_FIELDS}"

JOINED = "key string, intent string, template_id string, seed bigint, traces array<string>, candidates array<struct<{}, scores: struct<{}>>>".format(
    ", ".join(p.strip().replace(" ", ": ", 1) for p in CANDIDATE_FIELDS.split(",")),
    ", ".join(p.strip().replace(" ", ": ", 1) for p in SCORE_FIELDS.split(",")),
)

MANIFEST = "family string"

TRACE_TICKS = "dt double, ticks array<map<string, string>>"
STEP = "kind string, path string, content string, command string, args array<string>, action string"
PLAN = f"steps array<struct<{', '.join(p.strip().replace(' ', ': ', 1) for p in STEP.split(', '))}>>"
RESULTS = "array<struct<ok: boolean, ret: string, command: string>>"

FINDING = "kind string, repo string, tbl string, col string, detail string"

SUBJECTS_CSV = """
    Sub_ID int, Split string, Age int, Gender string, Ethnicity string,
    Acc_Trial_1 string, Acc_Trial_2 string
"""

# The rank vocabulary, the split directories and the directories
# read back, which include the older name of the evaluation split.
RANKS = (("rank1", 1), ("rank3", 3), ("rank5", 5))
SPLIT_DIRS = {"train": "data", "test": "test/data", "evaluation": "evaluation/data"}
READ_SPLIT_DIRS = (
    ("train", "data"),
    ("test", "test/data"),
    ("evaluation", "evaluation/data"),
    ("evaluation", "holdout/data"),
)
DEFAULT_FAMILY = "fbd"

# Family -> (task_type, dimension, input_column, input_asset_kind).
STUBS = {
    "fbd": ("intent_to_fbd", "instruction_following", "input_intent", "text"),
    "react": ("intent_to_controller", "instruction_following", "input_intent", "text"),
    "harness": ("intent_to_block", "instruction_following", "input_intent", "text"),
    "compose": ("intent_to_composed_controller", "instruction_following", "input_intent", "text"),
    "plan": ("goal_to_plan", "instruction_following", "input_intent", "text"),
    "godot": ("intent_to_api_calls", "instruction_following", "input_intent", "text"),
    "trainer": ("intent_to_trainer_config", "instruction_following", "input_intent", "text"),
    "udon": ("udonsharp_to_fbd", "translation", "input_source", "text"),
}
