"""The generated rows in SQL: counted draws, filled texts, traces, returns."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from labelmill.operators import compose
from labelmill.operators.families import chores, controllers, frames, methods
from labelmill.plans import bindings as b


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def number(template: str, name: str, index: str = "0", seed: str = "seed") -> str:
    return f"('0x' || substr(md5(concat_ws('/', {seed}, {template}, {name}, {index})), 1, 15))::BIGINT"


def uniform(n: str, low: float, high: float, places: int) -> str:
    a, z = round(low * 10**places), round(high * 10**places)
    return f"(({a} + {n} % {z - a + 1})::DOUBLE / {10**places})"


def randint(n: str, low: int, high: int) -> str:
    return f"({low} + {n} % {high - low + 1})"


def choice(n: str, values: list) -> str:
    return f"([{', '.join(quoted(str(v)) for v in values)}])[{n} % {len(values)} + 1]"


def filled(text: str, /, **values: str) -> str:
    for name, value in values.items():
        text = f"replace({text}, '{{{name}}}', {value})"
    return text


def jobs(templates: list[str]) -> str:
    return f"jobs AS (SELECT o_orderkey AS seed, ([{', '.join(map(quoted, templates))}])[o_orderkey // 10 % {len(templates)} + 1] AS template_id FROM orders)"


SENTENCES = "sentences(template_id, place, sentence, k) AS (VALUES " + ", ".join(
    f"({quoted(t)}, {i}, {quoted(s)}, {len(ss)})" for t, ss in frames.FRAMES.items() for i, s in enumerate(ss)
) + ")"

# --- controllers ------------------------------------------------------------------------

_TEXTS = "texts(template_id, body) AS (VALUES " + ", ".join(f"({quoted(t)}, {quoted(text)})" for t, text in controllers.TEXTS.items()) + ")"

_T = "template_id"
_DRAWN = f"""constants AS (
  SELECT seed, template_id,
    CASE template_id WHEN 'walk_from_stick' THEN {uniform(number(_T, "'gain'"), 0.8, 1.5, 2)} WHEN 'speed_limited_run' THEN {uniform(number(_T, "'gain'"), 1.5, 3.0, 2)} END AS gain,
    CASE template_id WHEN 'walk_from_stick' THEN {uniform(number(_T, "'cap'"), 0.6, 2.0, 2)} WHEN 'speed_limited_run' THEN {uniform(number(_T, "'cap'"), 1.0, 2.5, 2)} END AS cap,
    CASE template_id WHEN 'tracker_lost_freezes' THEN {randint(number(_T, "'n'"), 2, 6)} WHEN 'button_sequence_then_idle' THEN {randint(number(_T, "'n'"), 3, 8)} END * 125 AS ms,
    CASE template_id WHEN 'button_sequence_then_idle' THEN {randint(number(_T, "'style'"), 1, 9)} END AS style
  FROM jobs)"""

_CONSTANTS = f"{jobs(list(controllers.TEXTS))}, {_DRAWN}"

_MADE = f"""{_DRAWN}, {SENTENCES}, {_TEXTS},
pins AS (
  SELECT *, CASE template_id WHEN 'walk_from_stick' THEN (round(gain * 100)::BIGINT + 50)::DOUBLE / 100 END AS wrong_gain,
    CASE template_id WHEN 'speed_limited_run' THEN (round(cap * 100)::BIGINT // 2)::DOUBLE / 100 END AS wrong_cap,
    CASE WHEN style < 9 THEN style + 1 ELSE style - 1 END AS wrong_style
  FROM constants),
candidates AS (
  SELECT p.*, body, r.rank,
    coalesce(CASE WHEN r.rank = 3 THEN wrong_gain END, gain)::VARCHAR AS g, coalesce(CASE WHEN r.rank = 3 THEN wrong_cap END, cap)::VARCHAR AS c,
    CASE WHEN r.rank = 5 AND template_id = 'walk_from_stick' THEN 'TRUE' ELSE '0.0' END AS mn,
    CASE WHEN r.rank = 3 THEN 'ly' ELSE 'lx' END AS x, CASE r.rank WHEN 3 THEN 'lx' WHEN 5 THEN 'lz' ELSE 'ly' END AS z,
    CASE r.rank WHEN 5 THEN 'TRUE' WHEN 3 THEN 'T#' || 2 * ms || 'ms' ELSE 'T#' || ms || 'ms' END AS pt,
    CASE WHEN r.rank = 3 THEN wrong_style ELSE style END AS k, CASE WHEN r.rank = 5 THEN 'style = press.Q' || chr(10) ELSE '' END AS tail,
    CASE WHEN r.rank = 5 THEN 'in' ELSE 'out' END AS decl
  FROM pins p JOIN texts USING (template_id), (VALUES (1), (3), (5)) r(rank)),
made AS (
  SELECT seed, template_id, rank, {filled("body", g="coalesce(g, '')", c="coalesce(c, '')", mn="mn", x="x", z="z", pt="coalesce(pt, '')", ms="coalesce(ms::VARCHAR, '')", k="coalesce(k::VARCHAR, '')", tail="tail", decl="decl")} AS text
  FROM candidates),
wide AS (SELECT seed, template_id, max(text) FILTER (rank = 1) AS rank1, max(text) FILTER (rank = 3) AS rank3, max(text) FILTER (rank = 5) AS rank5 FROM made GROUP BY ALL),
controller_rows AS (SELECT w.template_id, w.seed, {filled("sentence", gain="coalesce(gain::VARCHAR, '')", cap="coalesce(cap::VARCHAR, '')", ms="coalesce(ms::VARCHAR, '')", style="coalesce(style::VARCHAR, '')")} AS intent,
  place::BIGINT AS frame_id, rank1, rank3, rank5
FROM wide w JOIN constants c ON c.seed = w.seed AND c.template_id = w.template_id JOIN sentences s ON s.template_id = w.template_id AND w.seed % s.k = s.place)"""

_CONTROLLERS = f"WITH {jobs(list(controllers.TEXTS))}, {_MADE} SELECT * FROM controller_rows"

_STICK = f"CASE WHEN i = 0 THEN '{{0}}' ELSE {uniform(number(_T, quoted('{1}'), 'i + 12 * nth'), -1.0, 1.0, 3)}::VARCHAR END"
_TRACES = f"""WITH {_CONSTANTS},
kinds AS (
  SELECT seed, template_id, t.trace, CASE
      WHEN template_id IN ('face_the_stick', 'speed_limited_run') OR (template_id = 'walk_from_stick' AND t.trace < 2) THEN 'sweep'
      WHEN template_id = 'button_sequence_then_idle' AND t.trace < 2 THEN 'pulse' ELSE 'drop' END AS kind,
    CASE template_id WHEN 'tracker_lost_freezes' THEN {randint(number(_T, "'at'", "t.trace"), 2, 5)} WHEN 'walk_from_stick' THEN 6 ELSE 4 END AS lost
  FROM constants, (VALUES (0), (1), (2)) t(trace)),
ticks AS (
  SELECT seed, template_id, trace, trace AS nth, i, kind,
    CASE kind WHEN 'sweep' THEN {_STICK.format('1.0', 'lx')} ELSE '0.0' END AS lx, CASE kind WHEN 'sweep' THEN {_STICK.format('-1.0', 'ly')} ELSE '0.0' END AS ly,
    kind = 'pulse' AND i = 1 AS btn, kind <> 'drop' OR i < lost AS ok
  FROM kinds, (SELECT unnest(range(12)) AS i))
SELECT template_id, seed, trace::INT AS trace, '{{"dt": 0.125, "ticks": [' || string_agg('{{"lx": ' || lx || ', "ly": ' || ly || ', "btn": ' || btn || ', "tracker_ok": ' || ok || '}}', ', ' ORDER BY i) || ']}}' AS trace_json
FROM ticks GROUP BY ALL"""

_PAIRED = "pairs(pair, a_id, b_id) AS (VALUES " + ", ".join(f"({i}, {quoted(a)}, {quoted(z)})" for i, (a, z) in enumerate(compose.PAIRS)) + ")"
_LINES = ", ".join(f"string_split(rtrim({side}.{rank}, chr(10)), chr(10)) AS {side}{rank[-1]}" for side, rank in (("a", "rank1"), ("a", "rank3"), ("b", "rank1"), ("b", "rank5")))


#: Blocks and locals of the controllers.
OWN = "mx|mz|sp|fx|fz|nt|lost|press|hold|g|st|greeting"


def composed(merged: Callable[[str, str, str], str]) -> str:
    """Two controllers of one seed in one program; ``merged`` is the SQL that puts two lists of lines together."""
    return f"""WITH {_PAIRED}, asked AS (SELECT o_orderkey AS seed, o_orderkey // 10 % {len(compose.PAIRS)} AS pair FROM orders),
    jobs AS (SELECT seed, a_id AS template_id FROM asked JOIN pairs USING (pair) UNION ALL SELECT seed, b_id FROM asked JOIN pairs USING (pair)), {_MADE},
    met AS (SELECT a_id, b_id, a.seed, a.intent || '; and ' || b.intent AS intent, a.frame_id, {_LINES}
      FROM asked JOIN pairs USING (pair) JOIN controller_rows a ON a.template_id = a_id AND a.seed = asked.seed JOIN controller_rows b ON b.template_id = b_id AND b.seed = asked.seed)
    SELECT 'compose_' || a_id || '_' || b_id AS template_id, seed, intent, frame_id, {merged('a1', 'b1', OWN)} AS rank1, {merged('a3', 'b1', OWN)} AS rank3, {merged('a1', 'b5', OWN)} AS rank5 FROM met"""


# --- chores -------------------------------------------------------------------------------


def _printf(form: str, *values: str) -> str:
    """A text with %s places, the values SQL expressions."""
    parts = form.split("%s")
    return " || ".join(x for k, part in enumerate(parts) for x in ([quoted(part)] if part else []) + ([f"({values[k]})"] if k < len(parts) - 1 else []))


def _literal(n: str, text: str) -> str:
    return _printf(chores.IN_VARIABLE, n, text)


def _pin(name: str, source: str, output: str = "OUT") -> str:
    return _printf(chores.PIN, quoted(name), source, quoted(output))


def _block(n: str, kind: str, *pins: str) -> str:
    return _printf(chores.BLOCK, n, quoted(kind), " || ".join(f"({p})" for p in pins))


def _diagram(name: str, last: str, *parts: str) -> str:
    return _printf(chores.DIAGRAM, quoted(name), " || ".join(f"({p})" for p in parts), f"{last} + 1", last)


def _words(name: str, count: str) -> str:
    return f"list_aggregate(list_transform(range({count}), lambda i: {choice(number(_T, quoted(name + '_words'), 'i'), chores.WORDS)}), 'string_agg', ' ')"


def _named(prefix: str, index: str = "0") -> str:
    return f"{choice(number(_T, quoted(prefix + '_word'), index), chores.WORDS)} || '_' || {randint(number(_T, quoted(prefix + '_n'), index), 1, 999)}"


def _chain(files: str) -> str:
    each = (
        f"list_transform(range(len({files})), lambda i: {_literal('3 * i + 1', files + '[i + 1]')} || {_literal('3 * i + 2', quoted('x'))} || "
        + _block("3 * i + 3", "WRITE_FILE", "CASE WHEN i > 0 THEN " + _pin("EN", "3 * i", "ENO") + " ELSE '' END", _pin("PATH", "3 * i + 1"), _pin("TEXT", "3 * i + 2"))
        + ")"
    )
    at = f"3 * len({files})"
    run = _block(f"{at} + 3", "RUN", _pin("EN", at, "ENO"), _pin("CMD", f"{at} + 1"), _pin("ARGS", f"{at} + 2"))
    return _diagram(
        "write_then_count", f"({at} + 3)", f"array_to_string({each}, '')", _literal(f"{at} + 1", quoted("python")), _literal(f"{at} + 2", quoted(chores.COUNT_FILES)), run
    )


def _write(text: str, *cycle: str) -> list[str]:
    return [_literal("1", "path"), _literal("2", text), _block("3", "WRITE_FILE", *cycle, _pin("PATH", "1"), _pin("TEXT", "2"))]


def _read(path: str) -> list[str]:
    return [_literal("4", path), _block("5", "READ_FILE", _pin("EN", "3", "ENO"), _pin("PATH", "4"))]


def _run(n: str, kind: str = "RUN") -> list[str]:
    return [_literal("1", quoted("python")), _literal("2", f"'-c print(' || {n} || ')'"), _block("3", kind, _pin("CMD", "1"), _pin("ARGS", "2"))]


def _of(write: str, both: str, run: str, count: str) -> str:
    return f"CASE template_id WHEN 'write' THEN {write} WHEN 'write_then_read' THEN {both} WHEN 'run_print' THEN {run} ELSE {count} END"


_CHORES = f"""WITH {jobs(list(chores.DRAWS))}, {SENTENCES},
held AS (
  SELECT template_id, seed, {_named('path')} || '.txt' AS path, {_words('text', randint(number(_T, "'text_count'"), 1, 4))} AS text,
    {_words('wrong', randint(number(_T, "'wrong_count'"), 1, 4))} || ' x' AS wrong, {_named('other')} || '_other.txt' AS other,
    {randint(number(_T, "'n'"), 1000, 999999)} AS n, {randint(number(_T, "'k'"), 1, 4)} AS k,
    list_transform(range({randint(number(_T, "'k'"), 1, 4)}), lambda i: {_named('file', 'i')} || '_' || i || '.txt') AS files FROM jobs),
fewer AS (SELECT *, CASE WHEN k > 1 THEN files[1 : k - 1] ELSE [files[1] || '_x'] END AS less FROM held)
SELECT template_id, seed, {filled("sentence", path="path", text="text", n="n::VARCHAR", k="k::VARCHAR", names="array_to_string(files, ', ')")} AS intent, place::BIGINT AS frame_id,
  {_of(_diagram('write_file', '3', *_write('text')), _diagram('write_then_read', '5', *_write('text'), *_read('path')), _diagram('run_print', '3', *_run('n')), _chain('files'))} AS rank1,
  {_of(_diagram('write_file', '3', *_write('wrong')), _diagram('write_then_read', '5', *_write('text'), *_read('other')), _diagram('run_print', '3', *_run('(n + 1)')), _chain('less'))} AS rank3,
  {_of(_diagram('write_file', '3', _literal('1', 'path'), _block('3', 'WRITE_FILE', _pin('PATH', '1'))), _diagram('write_then_read', '5', *_write('text', _pin('EN', '5', 'ENO')), *_read('path')),
       _diagram('run_print', '3', *_run('n', 'EXEC')), "replace(" + _chain('files') + ", 'typeName=\"RUN\"', 'typeName=\"EXEC\"')")} AS rank5
FROM fewer JOIN (SELECT template_id AS t, place, sentence, k AS many FROM sentences) ON t = template_id AND seed % many = place"""

# --- methods ------------------------------------------------------------------------------

_CLASSES = [f"udon_{name}" for name in methods.SOURCES]
_MIX = f"seed * 1000 + CASE template_id {' '.join(f'WHEN {quoted(t)} THEN {zlib.crc32(t.encode()) % 997}' for t in _CLASSES)} END"


def _constant(name: str) -> str:
    """A constant's value where a method has one, as a number."""
    cases = []
    for method, steps in methods.CONSTANTS.items():
        for step in steps:
            if step[0] == name:
                made = randint if step[1] == "randint" else uniform
                cases.append(f"WHEN 'udon_{method}' THEN {made(number(_T, quoted(name), seed='mix'), *step[2:])}")
    return f"CASE template_id {' '.join(cases)} END AS {name}"


_REALS = {"pick": ["k"], "in_band": ["lo", "hi"], "speed_cap": ["g"], "weighted": ["w1", "w2"]}
_NAMES = ["k", "c", "lo", "hi", "g", "w1", "w2"]
_METHOD_ROWS = f"""WITH {jobs(_CLASSES)}, mixed AS (SELECT *, {_MIX} AS mix FROM jobs),
constants AS (SELECT *, {', '.join(map(_constant, _NAMES))} FROM mixed)"""
_PLAIN = {n: f"coalesce({n}::BIGINT::VARCHAR, '')" for n in ("k", "c", "lo", "hi")}
_PRINTED = {f"{n}f": f"coalesce({n}::DOUBLE::VARCHAR, '') || 'f'" for n in _NAMES}

_METHODS = f"""{_METHOD_ROWS},
sources(template_id, body) AS (VALUES {', '.join(f"('udon_{n}', {quoted(text)})" for n, text in methods.SOURCES.items())}),
told AS (SELECT template_id, seed, {filled("body", **_PRINTED, **_PLAIN)} AS intent, 'U' || substr(sha1(template_id || '/' || seed), 1, 10) AS class_name FROM constants JOIN sources USING (template_id))
SELECT template_id, seed, intent, class_name,
  replace({quoted(methods.HEAD)}, '{{cls}}', class_name) || array_to_string(list_transform(string_split(intent, chr(10)), lambda l: '    ' || l), chr(10)) || chr(10) || '}}' || chr(10) AS class_source
FROM told"""


def _input(name: str, kind: str) -> str:
    n = number(_T, quoted(f"in_{name}"), "pos", "mix")
    return {"int": randint(n, -9, 9), "float": uniform(n, -5.0, 5.0, 3), "bool": f"({n} % 2 = 0)"}[kind]


def _six(value: str) -> str:
    return f"printf('%.6f', ({value})::DOUBLE)"


_RET = {
    "scale_add": _six("a * k + b - c"), "blend": _six("a * (1.0::DOUBLE - t) + b * t"), "clamp_sum": _six("greatest(lo, least(a + b, hi))"), "pick": _six("CASE WHEN c1 THEN a * k ELSE b END"),
    "in_band": "((x >= lo AND x <= hi) OR y < lo)::VARCHAR", "branch_sum": _six("CASE WHEN a + b > a - b THEN (a + b) * k ELSE a - b END"), "speed_cap": _six("least(v * g, cap)"),
    "either": "((a OR b) AND NOT c1)::VARCHAR", "min_max": _six("greatest(least(a, b), c1)"), "compare_scale": "(a * k <> b AND a * k >= 0)::VARCHAR",
    "weighted": _six("CASE WHEN flip THEN a * w2 + b * (1.0::DOUBLE - w2) ELSE a * w1 + b * (1.0::DOUBLE - w1) END"),
}
_RETURNS = f"{_METHOD_ROWS}, ats AS (SELECT *, unnest(range(36)) AS pos FROM constants) " + " UNION ALL ".join(
    f"SELECT template_id, seed, (pos // 12)::INT AS trace, (pos % 12)::INT AS tick, {_RET[name]} AS ret FROM (SELECT *, "
    + ", ".join(f"{_input(p, kind)} AS {'c1' if p == 'c' else p}" for p, kind in parameters) + f" FROM ats WHERE template_id = 'udon_{name}')"
    for name, parameters in methods.PARAMETERS.items()
)

# --- literals redrawn ------------------------------------------------------------------------

_MIXED = f"(doc_id * 1000 + {zlib.crc32(b'ton') % 997})"


def _woven(text: str, pattern: str, token: str) -> str:
    return f"list_aggregate(list_transform(regexp_split_to_array({text}, '{pattern}'), lambda p, i: CASE WHEN i = 1 THEN p ELSE {token} || p END), 'string_agg', '')"


def _token(name: str, draw, *args) -> str:
    return f"({draw(number(quoted('literals'), quoted(name), 'i - 2', 'mix'), *args)})::VARCHAR"


# RE2 looks neither back nor ahead: a redrawn real is marked until the integers are done
_PERTURBED = f"""WITH {b.PROGRAMS_SQL}, p0 AS (SELECT doc_id, {_MIXED} AS mix, text, len(regexp_extract_all(text, 'T#\\d+ms')) AS times FROM programs),
p1 AS (SELECT *, {_woven('text', 'T#\\d+ms', "'T#' || " + _token('time', choice, [125, 250, 375, 500, 625, 750]) + " || 'ms'")} AS t1 FROM p0),
p2 AS (SELECT *, {_woven('t1', '=-?\\d+\\.\\d+', "'=~' || " + _token('real', uniform, 0.25, 3.0, 2))} AS t2 FROM p1),
p3 AS (SELECT *, {_woven('t2', '=-?\\d+', "'=' || " + _token('int', randint, -3, 9))} AS t3 FROM p2)
SELECT doc_id, replace(t3, '=~', '=') AS perturbed,
  CASE WHEN times = 0 THEN '300' ELSE {choice(number(quoted('literals'), quoted('time'), '(times - 1)', 'mix'), [125, 250, 375, 500, 625, 750])} END AS pt FROM p3"""

# --- seeds ------------------------------------------------------------------------------------

#: CRC-32 of a text as a fold over its bytes, the table made from the polynomial.
CRC_TABLE = """crc AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i)))"""


def crc32(text: str) -> str:
    """Expression over a text column, beside the one row of ``crc``."""
    h = f"hex(encode({text}))"
    octets = f"list_transform(range(len({h}) // 2), lambda i: ('0x' || substr({h}, 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295)"


ORACLES = {
    "generate_controllers": _CONTROLLERS,
    "controller_traces": _TRACES,
    "generate_chores": _CHORES,
    "generate_methods": _METHODS,
    "method_returns": _RETURNS,
    "perturb_literals": _PERTURBED,
    "seed_mix_crc32": f"WITH {CRC_TABLE} SELECT doc_id, doc_id * 1000 + {crc32('source')} % 997 AS mixed FROM documents, crc",
}
