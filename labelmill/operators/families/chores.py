"""Operating-system chores as XML diagrams: write, read back, print, count."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions import text as tx
from labelmill.operators.draws import all_drawn, draw, drawn
from labelmill.operators.families.controllers import _by_template
from labelmill.operators.families.frames import FRAMES, pick

# The words names and texts are drawn from, and the draws of each
# template.
WORDS = [
    "alder", "birch", "cedar", "dune", "ember", "fjord", "glade", "heath", "islet", "juniper", "kelp", "larch",
    "moss", "nettle", "orchid", "pine", "quartz", "reed", "sedge", "thistle", "umber", "vale", "willow", "yarrow",
    "zephyr",
]


def _name_draw(prefix: str) -> list[tuple]:
    return [(f"{prefix}_word", "choice", WORDS), (f"{prefix}_n", "randint", 1, 999)]


def _text_draw(prefix: str) -> list[tuple]:
    return [(f"{prefix}_count", "randint", 1, 4), (prefix, "repeat", f"{prefix}_count", [(f"{prefix}_words", "choice", WORDS)])]


DRAWS = {
    "write": [*_name_draw("path"), *_text_draw("text"), *_text_draw("wrong")],
    "write_then_read": [*_name_draw("path"), *_text_draw("text"), *_name_draw("other")],
    "run_print": [("n", "randint", 1000, 999999)],
    "write_then_count": [("k", "randint", 1, 4), ("files", "repeat", "k", _name_draw("file"))],
}

# The XML forms.
IN_VARIABLE = '      <inVariable localId="%s"><expression>\'%s\'</expression></inVariable>\n'
PIN = (
    '          <variable formalParameter="%s"><connectionPointIn>'
    '<connection refLocalId="%s" formalParameter="%s"/></connectionPointIn></variable>\n'
)
BLOCK = (
    '      <block localId="%s" typeName="%s">\n        <inputVariables>\n%s        </inputVariables>\n'
    '        <outputVariables>\n          <variable formalParameter="ENO"/>\n        </outputVariables>\n      </block>\n'
)
DIAGRAM = (
    '<pou name="%s" pouType="program">\n  <interface>\n    <localVars>\n'
    '      <variable name="done"><type><BOOL/></type></variable>\n    </localVars>\n  </interface>\n'
    "  <body>\n    <FBD>\n%s"
    '      <outVariable localId="%s"><connectionPointIn><connection refLocalId="%s" formalParameter="ENO"/></connectionPointIn>'
    "<expression>done</expression></outVariable>\n    </FBD>\n  </body>\n</pou>\n"
)
COUNT_FILES = '-c print(len(__import__("os").listdir(".")))'


def _variable(number, literal) -> Column:
    return F.format_string(IN_VARIABLE, _c(number), _c(literal))


def _pin(name: str, source, output: str = "OUT") -> Column:
    return F.format_string(PIN, F.lit(name), _c(source), F.lit(output))


def _block(number, kind: str, *pins: Column) -> Column:
    return F.format_string(BLOCK, _c(number), F.lit(kind), F.concat(*pins))


def _diagram(name: str, body: Column, last) -> Column:
    return F.format_string(DIAGRAM, F.lit(name), body, (_c(last).cast("int") + 1).cast("string"), _c(last))


def _c(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("string")


def _after(previous) -> Column:
    return _pin("EN", previous, "ENO")


def _write(path, text, cycle: Column | None = None) -> Column:
    """Two literals and the write block, numbered 1 to 3."""
    pins = ([cycle] if cycle is not None else []) + [_pin("PATH", 1), _pin("TEXT", 2)]
    return F.concat(_variable(1, path), _variable(2, text), _block(3, "WRITE_FILE", *pins))


def _read(path) -> Column:
    return F.concat(_variable(4, path), _block(5, "READ_FILE", _after(3), _pin("PATH", 4)))


def _run(argument: Column, kind: str = "RUN") -> Column:
    return F.concat(_variable(1, "python"), _variable(2, argument), _block(3, kind, _pin("CMD", 1), _pin("ARGS", 2)))


def _count(names: Column) -> Column:
    """A chain of writes, one per name, and the counting run; three numbers per block."""

    def one(name: Column, i: Column) -> Column:
        first = i * 3 + 1
        pins = F.concat(F.when(i > 0, _after(first - 1)).otherwise(""), _pin("PATH", first), _pin("TEXT", first + 1))
        return F.concat(_variable(first, name), _variable(first + 1, "x"), _block(first + 2, "WRITE_FILE", pins))

    at = F.size(names) * 3 + 1
    run = F.concat(
        _variable(at, "python"), _variable(at + 1, COUNT_FILES), _block(at + 2, "RUN", _after(at - 1), _pin("CMD", at), _pin("ARGS", at + 1))
    )
    return _diagram("write_then_count", F.concat(F.array_join(F.transform(names, one), ""), run), at + 2)


def rows(jobs: DataFrame, drawing: Callable = draw) -> DataFrame:
    """jobs(template_id, seed) -> chore rows; the three candidates are XML."""
    made = jobs.withColumn("values", drawing(F.col("template_id"), F.col("seed"), DRAWS))
    v = F.col("values")
    words = lambda name: F.array_join(all_drawn(v, f"{name}_words"), " ")
    name = lambda prefix: F.concat_ws("_", drawn(v, f"{prefix}_word"), drawn(v, f"{prefix}_n"))
    files = F.zip_with(all_drawn(v, "file_word"), all_drawn(v, "file_n"), lambda w, n: F.concat_ws("_", w, n))
    numbered = F.transform(files, lambda f, i: F.concat(f, F.lit("_"), i.cast("string"), F.lit(".txt")))
    held = made.select(
        "template_id", "seed", F.concat(name("path"), F.lit(".txt")).alias("path"), words("text").alias("text"),
        F.concat(words("wrong"), F.lit(" x")).alias("wrong"), F.concat(name("other"), F.lit("_other.txt")).alias("other"),
        drawn(v, "n").alias("n"), drawn(v, "k").alias("k"), numbered.alias("files"),
    )
    path, text, n, files = F.col("path"), F.col("text"), F.col("n"), F.col("files")

    def print_of(number: Column) -> Column:
        return F.concat(F.lit("-c print("), number.cast("string"), F.lit(")"))

    fewer = F.when(F.size(files) > 1, F.slice(files, F.lit(1), F.greatest(F.size(files) - 1, F.lit(1)))).otherwise(
        F.transform(files, lambda f: F.concat(f, F.lit("_x")))
    )
    whole = _count(files)
    rank1 = {
        "write": _diagram("write_file", _write(path, text), 3),
        "write_then_read": _diagram("write_then_read", F.concat(_write(path, text), _read(path)), 5),
        "run_print": _diagram("run_print", _run(print_of(n)), 3),
        "write_then_count": whole,
    }
    rank3 = {
        "write": _diagram("write_file", _write(path, F.col("wrong")), 3),
        "write_then_read": _diagram("write_then_read", F.concat(_write(path, text), _read(F.col("other"))), 5),
        "run_print": _diagram("run_print", _run(print_of(n.cast("int") + 1)), 3),
        "write_then_count": _count(fewer),
    }
    rank5 = {
        "write": _diagram("write_file", F.concat(_variable(1, path), _block(3, "WRITE_FILE", _pin("PATH", 1))), 3),
        "write_then_read": _diagram("write_then_read", F.concat(_write(path, text, _after(5)), _read(path)), 5),
        "run_print": _diagram("run_print", _run(print_of(n), "EXEC"), 3),
        "write_then_count": tx.replace_first(whole, 'typeName="RUN"', 'typeName="EXEC"'),
    }
    params = F.create_map(
        F.lit("path"), path, F.lit("text"), text, F.lit("n"), n, F.lit("k"), F.col("k"), F.lit("names"), F.array_join(files, ", ")
    )
    return pick(held, FRAMES, params).select(
        "template_id", "seed", "intent", "frame_id",
        _by_template(rank1).alias("rank1"), _by_template(rank3).alias("rank3"), _by_template(rank5).alias("rank5"),
        F.array().cast("array<string>").alias("traces"),
        "path", "text", "n", "k", "files",
    )
