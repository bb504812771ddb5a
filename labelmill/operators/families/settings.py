"""Trainer configurations: a chain of calls, each setting one term of a task's configuration.

A template is a table entry: its draws, the value its hard negative gets wrong,
its calls, its sentences and what the configuration must read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions import text as tx
from labelmill.operators import mutations
from labelmill.operators.draws import as_params, draw, drawn, with_params
from labelmill.operators.families.controllers import _by_template
from labelmill.operators.families.frames import pick

ABSENT_SIGNATURE = "Reward.jump_height"
OBSERVED = ["base_lin_vel", "base_ang_vel", "projected_gravity", "joint_pos", "joint_vel"]


def _four(x: float) -> str:
    text = f"{x:.4f}".rstrip("0")
    return text + "0" if text.endswith(".") else text


def _reals(names: list[str], low: float, high: float, places: int) -> list[tuple]:
    return [(name, "uniform", low, high, places) for name in names]


def _either(name: str, of: str, yes: str, no: str) -> tuple:
    return (name, "derive", lambda v: yes if v[of][0] else no)


def _plus(of: str, by: float, places: int | None = None) -> tuple:
    return ("wrong", "derive", lambda v: v[of][0] + by if places is None else round(v[of][0] + by, places))


# Draws in order; ``wrong`` is what the hard negative puts in place
# of the value named by CHANGED.
DRAWS = {
    "trainer_actuator_pd": [
        ("kp", "choice", [20.0, 30.0, 40.0, 60.0, 80.0]), ("kd", "choice", [1.0, 1.5, 2.0, 3.0, 4.0]), ("lim", "choice", [25.0, 50.0, 88.0, 139.0]),
        _plus("kp", 10.0),
    ],
    "trainer_tracking": [
        *_reals(["wl", "wa"], 0.5, 4.0, 2), ("sl", "choice", [0.25, 0.5, 0.7071, 1.0]), ("sa", "choice", [0.25, 0.5, 0.7071, 1.0]), _plus("wl", 0.5, 2),
    ],
    "trainer_gait": [*_reals(["wa", "wc", "ws", "wp", "wl"], -1.0, 2.0, 2), *_reals(["hc", "hs"], 0.05, 0.2, 3), _plus("hc", 0.05, 3)],
    "trainer_regularisers": [
        *_reals(["wr", "wb", "wm", "wd", "wc"], -2.0, 0.0, 3), *_reals(["wu", "wp"], 0.2, 2.0, 2), ("su", "choice", [0.3, 0.4472, 0.6]), ("ft", "choice", [50.0, 100.0, 200.0]),
        _plus("wr", -0.25, 3),
    ],
    "trainer_rom": [*_reals(["w"], -2.0, -0.1, 2), _plus("w", -0.3, 2)],
    "trainer_observation_noise": [(f"n{i}", "choice", [0.0, 0.01, 0.02, 0.05, 0.1, 0.2]) for i in range(len(OBSERVED))],
    "trainer_terminations": [("deg", "choice", [45.0, 60.0, 70.0, 80.0, 90.0]), _plus("deg", 5.0)],
    "trainer_action": [
        ("scale", "choice", [0.25, 0.3, 0.4, 0.5, 0.75]), ("off", "choice", [True, False]), _either("flag", "off", "TRUE", "FALSE"), _either("json", "off", "true", "false"),
        _either("around", "off", "offset from the default pose", "absolute, no default offset"), _either("onoff", "off", "on", "off"),
        _either("pose", "off", "around the default pose", "with no offset"), _plus("scale", 0.1, 2),
    ],
    "trainer_command": [
        *_reals(["vx"], 0.5, 2.0, 2), *_reals(["vy"], 0.2, 1.0, 2), *_reals(["wz"], 0.3, 1.5, 2), ("back", "choice", [True, False]),
        ("low", "derive", lambda v: -v["vx"][0] if v["back"][0] else 0.0), ("vyn", "derive", lambda v: -v["vy"][0]), ("wzn", "derive", lambda v: -v["wz"][0]),
        _either("backward", "back", " and backward as far", ", never backward"), _either("or_back", "back", " or backward", ""), _plus("vx", 0.5, 2),
        ("wrong_low", "derive", lambda v: -v["wrong"][0] if v["back"][0] else 0.0),
    ],
    "trainer_sim_rate": [
        ("pair", "choice", [(0.005, 4), (0.005, 2), (0.004, 5), (0.002, 10), (0.01, 2)]), ("length", "choice", [10.0, 15.0, 20.0, 30.0]),
        ("ts", "derive", lambda v: _four(v["pair"][0][0])), ("dec", "derive", lambda v: v["pair"][0][1]), ("ms", "derive", lambda v: _four(v["pair"][0][0] * 1000)),
        ("hz", "derive", lambda v: _four(1.0 / (v["pair"][0][0] * v["pair"][0][1]))), _plus("dec", 1),
    ],
    "trainer_scene": [("n", "choice", [16, 64, 256, 512, 1024, 2048, 4096]), ("wrong", "derive", lambda v: v["n"][0] * 2)],
    "trainer_randomisation": [
        *_reals(["fmin"], 0.2, 0.6, 2), *_reals(["fmax"], 0.8, 1.5, 2), ("bias", "choice", [0.005, 0.01, 0.015, 0.02, 0.03]),
        *[(c, "choice", [0.01, 0.02, 0.025, 0.03, 0.05]) for c in ("cx", "cy", "cz")], ("biasn", "derive", lambda v: -v["bias"][0]), _plus("fmin", 0.1, 2),
    ],
    "trainer_push": [
        ("pair", "choice", [(1.0, 3.0), (2.0, 5.0), (0.5, 2.0), (3.0, 8.0)]), ("vel", "choice", [0.3, 0.5, 0.8, 1.0]),
        ("a", "derive", lambda v: v["pair"][0][0]), ("b", "derive", lambda v: v["pair"][0][1]), _plus("vel", 0.2, 2),
    ],
}
CHANGED = {
    "trainer_actuator_pd": "kp", "trainer_tracking": "wl", "trainer_gait": "hc", "trainer_regularisers": "wr", "trainer_rom": "w", "trainer_terminations": "deg",
    "trainer_action": "scale", "trainer_command": "vx", "trainer_sim_rate": "dec", "trainer_scene": "n", "trainer_randomisation": "fmin", "trainer_push": "vel",
}

# The calls of each template, (block name, signature, [(argument, drawn value)]).
CALLS = {
    "trainer_actuator_pd": [("a", "Actuator.pd", [("stiffness", "kp"), ("damping", "kd"), ("effort_limit", "lim")])],
    "trainer_tracking": [("a", "Reward.track_linear_velocity", [("weight", "wl"), ("std", "sl")]), ("b", "Reward.track_angular_velocity", [("weight", "wa"), ("std", "sa")])],
    "trainer_gait": [
        ("a", "Reward.air_time", [("weight", "wa")]), ("c", "Reward.foot_clearance", [("weight", "wc"), ("target_height", "hc")]),
        ("s", "Reward.foot_swing_height", [("weight", "ws"), ("target_height", "hs")]), ("p", "Reward.foot_slip", [("weight", "wp")]), ("l", "Reward.soft_landing", [("weight", "wl")]),
    ],
    "trainer_regularisers": [
        ("r", "Reward.action_rate_l2", [("weight", "wr")]), ("b", "Reward.body_ang_vel", [("weight", "wb")]), ("m", "Reward.angular_momentum", [("weight", "wm")]),
        ("d", "Reward.dof_pos_limits", [("weight", "wd")]), ("c", "Reward.self_collisions", [("weight", "wc"), ("force_threshold", "ft")]),
        ("u", "Reward.upright", [("weight", "wu"), ("std", "su")]), ("p", "Reward.pose", [("weight", "wp")]),
    ],
    "trainer_rom": [("r", "Reward.rom_penalty", [("weight", "w")]), ("c", "Metric.rom_clearance", []), ("m", "Metric.mean_action_acc", [])],
    "trainer_observation_noise": [
        *[(f"o{i}", f"Observation.{o}", [("noise", f"n{i}")]) for i, o in enumerate(OBSERVED)], ("a", "Observation.actions", []), ("c", "Observation.command", []),
    ],
    "trainer_terminations": [("t", "Termination.time_out", []), ("f", "Termination.fell_over", [("limit_deg", "deg")])],
    "trainer_action": [("a", "Action.joint_pos", [("scale", "scale"), ("use_default_offset", "flag")])],
    "trainer_command": [
        ("c", "Command.twist", [("lin_vel_x_min", "low"), ("lin_vel_x_max", "vx"), ("lin_vel_y_min", "vyn"), ("lin_vel_y_max", "vy"), ("ang_vel_z_min", "wzn"), ("ang_vel_z_max", "wz")]),
    ],
    "trainer_sim_rate": [("c", "Sim.control", [("timestep", "ts"), ("decimation", "dec")]), ("e", "Sim.episode", [("length_s", "length")])],
    "trainer_scene": [("s", "Scene.num_envs", [("n", "n")])],
    "trainer_randomisation": [
        ("f", "Event.foot_friction", [("min", "fmin"), ("max", "fmax")]), ("e", "Event.encoder_bias", [("min", "biasn"), ("max", "bias")]), ("c", "Event.base_com", [("x", "cx"), ("y", "cy"), ("z", "cz")]),
    ],
    "trainer_push": [("p", "Event.push_robot", [("interval_min_s", "a"), ("interval_max_s", "b"), ("vel", "vel")])],
}

# What the configuration must read back, (path, kind, value); the value is
# a member's name for ``member``, a drawn value's name for the other kinds.
EXPECTED = {
    "trainer_actuator_pd": [("actuators.pd.stiffness", "each", "kp"), ("actuators.pd.damping", "each", "kd"), ("actuators.pd.effort_limit", "each", "lim")],
    "trainer_tracking": [
        ("rewards.track_linear_velocity.weight", "close", "wl"), ("rewards.track_linear_velocity.std", "close", "sl"),
        ("rewards.track_angular_velocity.weight", "close", "wa"), ("rewards.track_angular_velocity.std", "close", "sa"),
    ],
    "trainer_gait": [
        ("rewards.air_time.weight", "close", "wa"), ("rewards.foot_clearance.weight", "close", "wc"), ("rewards.foot_clearance.target_height", "close", "hc"),
        ("rewards.foot_swing_height.weight", "close", "ws"), ("rewards.foot_swing_height.target_height", "close", "hs"),
        ("rewards.foot_slip.weight", "close", "wp"), ("rewards.soft_landing.weight", "close", "wl"),
    ],
    "trainer_regularisers": [
        ("rewards.action_rate_l2.weight", "close", "wr"), ("rewards.body_ang_vel.weight", "close", "wb"), ("rewards.angular_momentum.weight", "close", "wm"),
        ("rewards.dof_pos_limits.weight", "close", "wd"), ("rewards.self_collisions.weight", "close", "wc"),
        ("rewards.self_collisions.force_threshold", "close", "ft"), ("rewards.upright.weight", "close", "wu"), ("rewards.upright.std", "close", "su"),
        ("rewards.pose.weight", "close", "wp"),
    ],
    "trainer_rom": [("rewards.rom_penalty.weight", "close", "w"), ("metrics", "member", "rom_clearance"), ("metrics", "member", "mean_action_acc")],
    "trainer_observation_noise": [
        *[(f"observations.{o}.noise", "close", f"n{i}") for i, o in enumerate(OBSERVED)], ("observations", "member", "actions"), ("observations", "member", "command"),
    ],
    "trainer_terminations": [("terminations", "member", "time_out"), ("terminations.fell_over.limit_deg", "close", "deg")],
    "trainer_action": [("actions.joint_pos.scale", "close", "scale"), ("actions.joint_pos.use_default_offset", "equal", "json")],
    "trainer_command": [
        ("commands.twist.lin_vel_x[0]", "close", "low"), ("commands.twist.lin_vel_x[1]", "close", "vx"), ("commands.twist.lin_vel_y[0]", "close", "vyn"),
        ("commands.twist.lin_vel_y[1]", "close", "vy"), ("commands.twist.ang_vel_z[0]", "close", "wzn"), ("commands.twist.ang_vel_z[1]", "close", "wz"),
    ],
    "trainer_sim_rate": [
        ("sim.timestep", "close", "ts"), ("sim.decimation", "equal", "dec"), ("sim.control_hz", "close", "hz"), ("sim.episode_length_s", "close", "length"),
    ],
    "trainer_scene": [("scene.num_envs", "equal", "n")],
    "trainer_randomisation": [
        ("events.foot_friction.min", "close", "fmin"), ("events.foot_friction.max", "close", "fmax"), ("events.encoder_bias.min", "close", "biasn"),
        ("events.encoder_bias.max", "close", "bias"), ("events.base_com.x", "close", "cx"), ("events.base_com.y", "close", "cy"), ("events.base_com.z", "close", "cz"),
    ],
    "trainer_push": [
        ("events.push_robot.interval_min_s", "close", "a"), ("events.push_robot.interval_max_s", "close", "b"), ("events.push_robot.vel", "close", "vel"),
    ],
}

_NOISES = ", ".join(f"{o} {{n{i}}}" for i, o in enumerate(OBSERVED))

# The sentences of each template, in order.
SENTENCES = {
    "trainer_actuator_pd": [
        "drive every joint with a PD actuator of stiffness {kp}, damping {kd} and an effort limit of {lim} N m",
        "PD actuators: kp {kp}, kd {kd}, torque limit {lim}",
        "uniform PD gains {kp}/{kd} on all actuators, clamped at {lim} N m",
    ],
    "trainer_tracking": [
        "reward linear velocity tracking at weight {wl} with std {sl} and angular at {wa} with std {sa}",
        "track the twist command: linear weight {wl} (std {sl}), angular weight {wa} (std {sa})",
        "velocity tracking rewards: lin {wl}/{sl}, ang {wa}/{sa}",
    ],
    "trainer_gait": [
        "gait shaping: air time {wa}, foot clearance {wc} toward {hc} m, swing height {ws} toward {hs} m, slip {wp}, soft landing {wl}",
        "set the five foot rewards: air_time {wa}; clearance {wc} at {hc}; swing {ws} at {hs}; slip {wp}; landing {wl}",
        "feet: reward air time {wa}, clearance {wc} (target {hc}), swing height {ws} (target {hs}), penalise slip {wp}, soft landing {wl}",
    ],
    "trainer_regularisers": [
        "regularise: action rate {wr}, body angular velocity {wb}, angular momentum {wm}, joint limits {wd}, self-collision {wc} above {ft} N; upright {wu} (std {su}), pose {wp}",
        "penalties {wr} action rate, {wb} body ang vel, {wm} momentum, {wd} dof limits, {wc} self collisions at {ft} N; upright {wu}/{su}; pose {wp}",
        "the seven shaping terms: rate {wr}, ang vel {wb}, momentum {wm}, limits {wd}, collisions {wc} (threshold {ft}), upright {wu} std {su}, pose {wp}",
    ],
    "trainer_rom": [
        "penalise leaving the range-of-motion envelope at weight {w}, and log the ROM clearance and mean action acceleration",
        "rom_penalty {w}; keep the rom_clearance and mean_action_acc metrics",
        "the E.3 envelope: penalty weight {w}, clearance metric on, action acceleration metric on",
    ],
    "trainer_observation_noise": [
        f"observation noise: {_NOISES}; keep the last action and the command in the observation",
        f"set uniform noise on the actor observation: {_NOISES}; actions and command stay",
        f"noise per observation term ({_NOISES}) with the action and command terms present",
    ],
    "trainer_terminations": [
        "end an episode on time-out or when the torso tilts past {deg} degrees",
        "terminations: time_out, and fell_over at {deg} deg",
        "the robot has fallen at {deg} degrees of tilt; time-outs end episodes too",
    ],
    "trainer_action": [
        "joint position actions scaled by {scale}, {around}",
        "action scale {scale}, use_default_offset {onoff}",
        "the policy's outputs are joint targets at scale {scale} {pose}",
    ],
    "trainer_command": [
        "command forward speeds up to {vx} m/s{backward}, lateral to {vy}, turning to {wz} rad/s",
        "twist ranges: x [{low}, {vx}], y [{vyn}, {vy}], yaw [{wzn}, {wz}]",
        "sample velocity commands within {vx} m/s forward{or_back}, {vy} sideways and {wz} rad/s of yaw",
    ],
    "trainer_sim_rate": [
        "a {ms} ms physics step with decimation {dec} ({hz} Hz control) and {length} s episodes",
        "sim: timestep {ts}, decimation {dec}, episode length {length} s",
        "control at {hz} Hz from a {ts} s step over {dec} substeps; episodes last {length} seconds",
    ],
    "trainer_scene": ["simulate {n} environments in parallel", "num_envs {n}", "a scene of {n} robots"],
    "trainer_randomisation": [
        "randomise foot friction between {fmin} and {fmax}, encoder bias within {bias} rad, and the base centre of mass by up to ({cx}, {cy}, {cz}) m",
        "domain randomisation: friction [{fmin}, {fmax}], encoder bias +-{bias}, COM offsets {cx}/{cy}/{cz}",
        "at startup draw friction in [{fmin}, {fmax}], joint encoder bias in +-{bias}, and shift the base COM within +-({cx}, {cy}, {cz})",
    ],
    "trainer_push": [
        "shove the robot every {a} to {b} seconds with up to {vel} m/s of velocity",
        "push_robot: interval [{a}, {b}] s, velocity {vel}",
        "random pushes of {vel} m/s between {a} and {b} seconds apart",
    ],
}


def call_text(template: str) -> str:
    """The program of a template, values as placeholders: every call waits for the one before."""
    lines = [f"program {template.removeprefix('trainer_')}", "var done : BOOL"]
    before = None
    for name, signature, arguments in CALLS[template]:
        pins = [f"EN={before}.ENO"] if before else []
        pins.append(f'TARGET="{signature.split(".")[0].lower()}"')
        pins += [f'{argument}="{{{value}}}"' for argument, value in arguments]
        lines.append(f"{name} = CALL[{signature}]({', '.join(pins)})")
        before = name
    return "\n".join([*lines, f"done = {before}.ENO", ""])


def rows(jobs: DataFrame, drawing: Callable = draw) -> DataFrame:
    """jobs(template_id ``trainer_<name>``, seed) -> rows, with ``values`` holding the drawn constants."""
    made = jobs.withColumn("values", drawing(F.col("template_id"), F.col("seed"), DRAWS))
    params = F.col("params")
    told = pick(made.withColumn("params", as_params(F.col("values"))), SENTENCES, params)
    text = _by_template({t: F.lit(call_text(t)) for t in CALLS})
    wrong = F.try_element_at(params, F.lit("wrong"))
    off = {t: with_params(params, **{name: wrong}) for t, name in CHANGED.items()}
    off["trainer_command"] = with_params(params, vx=wrong, low=F.try_element_at(params, F.lit("wrong_low")))
    first = F.col("seed") % len(OBSERVED)
    off["trainer_observation_noise"] = with_params(
        params, **{f"n{i}": F.when(first == i, "0.3").otherwise(F.try_element_at(params, F.lit(f"n{i}"))) for i in range(len(OBSERVED))}
    )
    filled = told.withColumn("rank1", tx.fill_placeholders(text, params))
    return filled.select(
        "template_id", "seed", "intent", "frame_id", "rank1",
        tx.fill_placeholders(text, _by_template(off)).alias("rank3"),
        mutations.refuse_signature(F.col("rank1"), ABSENT_SIGNATURE).alias("rank5"),
        F.array().cast("array<string>").alias("traces"),
        "values",
    )


def expectations(made: DataFrame) -> DataFrame:
    """(template_id, seed, path, kind, expected) of each row, for ``expectations.config_readback``."""
    v = F.col("values")

    def value(kind: str, name: str) -> Column:
        return F.lit(name) if kind == "member" else drawn(v, name)

    wanted = _by_template(
        {
            t: F.array(*[F.struct(F.lit(f"$.{path}").alias("path"), F.lit(kind).alias("kind"), value(kind, name).alias("expected")) for path, kind, name in entries])
            for t, entries in EXPECTED.items()
        }
    )
    return made.select("template_id", "seed", F.inline(wanted))
