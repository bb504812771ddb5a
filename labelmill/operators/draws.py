"""Seeded draws, in two modes that give the same map of values to the row builders.

``draw`` takes a row's constants from Python's generator seeded by the row, so a
corpus that was made that way can be made again. Only the drawing runs in Python,
Arrow-batched.

``counted`` draws by counting: a value's number is a hash of seed, template, name and
how often the name was drawn before, in built-in expressions. Nothing is carried from
one value to the next, no row leaves the JVM, and any engine that has the hash draws
the same values.

A plan is a list of steps:
  (name, "uniform", low, high, places)   a rounded real
  (name, "randint", low, high)           an integer, both ends included
  (name, "choice", [values])             one of the values
  (name, "coin")                         true or false
  (name, "choose", fn)                   one of the values fn(values) lists
  (name, "sample", [values], count)      a list of some of the values, each once
  (name, "shuffle", [values])            the list of the values in another order
  (name, "derive", fn, express)          fn(values) -> value, nothing drawn; express(first) the same as a column,
                                         where first(name) is the text of a name's first value (``counted`` only)
  (name, "repeat", count, [steps])       steps again and again; count is a number or an earlier name
Every name maps to the list of the values it took, as text.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelmill.functions import text as tx

VALUES = T.MapType(T.StringType(), T.ArrayType(T.StringType()))


def _run(rng: random.Random, steps: Sequence[tuple], values: dict[str, list]) -> None:
    for name, kind, *args in steps:
        if kind == "repeat":
            count = args[0] if isinstance(args[0], int) else values[args[0]][-1]
            for _ in range(count):
                _run(rng, args[1], values)
            continue
        if kind == "uniform":
            value = round(rng.uniform(args[0], args[1]), args[2])
        elif kind == "randint":
            value = rng.randint(args[0], args[1])
        elif kind == "choice":
            value = rng.choice(args[0])
        elif kind == "choose":
            value = rng.choice(args[0](values))
        elif kind == "sample":
            value = rng.sample(args[0], args[1])
        elif kind == "shuffle":
            value = list(args[0])
            rng.shuffle(value)
        elif kind == "coin":
            value = rng.random() < 0.5
        else:
            value = args[0](values)
        values.setdefault(name, []).append(value)


def draw_row(seed: int, steps: Sequence[tuple]) -> dict[str, list[str]]:
    values: dict[str, list] = {}
    _run(random.Random(seed), steps, values)
    return {name: [str(v) for v in drawn] for name, drawn in values.items()}


def draw(template: Column, seed: Column, plans: Mapping[str, Sequence[tuple]]) -> Column:
    """map<name, values> of each row, by its template's plan."""
    plans = dict(plans)

    def per_batch(templates: pd.Series, seeds: pd.Series) -> pd.Series:
        return pd.Series([draw_row(int(s), plans[t]) for t, s in zip(templates, seeds)])

    return F.pandas_udf(per_batch, VALUES)(template, seed)


def number(seed: Column, template: str | Column, name: str, index: Column) -> Column:
    """The number behind a drawn value, from 0 to below 2^60: the head of an MD5, as a bigint."""
    template = template if isinstance(template, Column) else F.lit(template)
    return _hashed(F.concat_ws("/", seed.cast("string"), template, F.lit(name), index.cast("string")))


def _hashed(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def one_of(n: Column, kind: str, *args) -> Column:
    """The value, as text, that a number stands for in a step of one value."""
    if kind == "uniform":
        low, high, scale = round(args[0] * 10 ** args[2]), round(args[1] * 10 ** args[2]), 10 ** args[2]
        return ((n % (high - low + 1) + low) / F.lit(float(scale))).cast("string")
    if kind == "randint":
        return (n % (args[1] - args[0] + 1) + args[0]).cast("string")
    if kind == "choice":
        return F.get(F.array(*[F.lit(str(v)) for v in args[0]]), (n % len(args[0])).cast("int"))
    if kind == "coin":
        return F.when(n % 2 == 0, "True").otherwise("False")
    raise NotImplementedError(f"no counted draw for {kind}")


def several(count: Column, seed: Column, template: str, name: str, start: int, *step) -> Column:
    """The values that a step draws for a name, ``count`` times on from the ``start``-th."""
    head = F.concat_ws("/", seed.cast("string"), F.lit(template), F.lit(name), F.lit(""))
    at = F.sequence(F.lit(start), count - 1 + start)
    each = tx.let(head, lambda h: F.transform(at, lambda i: one_of(_hashed(F.concat(h, i.cast("string"))), *step)))
    return F.when(count > 0, each).otherwise(F.array().cast("array<string>"))


def _counted(template: str, seed: Column, steps: Sequence[tuple]) -> Column:
    taken: dict[str, list[Column]] = {}
    before: dict[str, int | None] = {}

    def first(name: str) -> Column:
        return F.get(taken[name][0], 0)

    def add(name: str, value: Column, count: int | None) -> None:
        taken.setdefault(name, []).append(value)
        held = before.get(name, 0)
        before[name] = None if held is None or count is None else held + count

    for name, kind, *args in steps:
        if kind == "derive":
            if len(args) < 2:
                raise NotImplementedError(f"{template}: {name} has no column expression")
            add(name, F.array(args[1](first).cast("string")), 1)
        elif kind == "repeat":
            fixed = args[0] if isinstance(args[0], int) else None
            count = F.lit(fixed) if fixed is not None else first(args[0]).cast("int")
            for inner, *rest in args[1]:
                start = before.get(inner, 0)
                if start is None:
                    raise NotImplementedError(f"{template}: {inner} follows a number of values that is drawn")
                add(inner, several(count, seed, template, inner, start, *rest), fixed)
        else:
            add(name, F.array(one_of(number(seed, template, name, F.lit(before.get(name, 0))), kind, *args)), 1)
    entries = [part for name, parts in taken.items() for part in (F.lit(name), F.concat(*parts) if len(parts) > 1 else parts[0])]
    return F.create_map(*entries) if entries else F.create_map().cast("map<string,array<string>>")


def counted(template: Column, seed: Column, plans: Mapping[str, Sequence[tuple]]) -> Column:
    """map<name, values> of each row, by its template's plan, as ``draw`` gives it but with counted numbers."""
    result = None
    for name, steps in plans.items():
        value = _counted(name, seed, steps)
        result = F.when(template == name, value) if result is None else result.when(template == name, value)
    return result


def apart(drawing: Callable, template: Column, seed: Column, plans: Mapping[str, Sequence[tuple]], aside: Iterable[str], values: str = "values") -> Column:
    """What the texts are filled from: the values without those of the steps ``aside``, which only traces read.

    Counted values do not hang on one another. Drawn by themselves they leave the
    column ``values``, which holds all, undrawn where nothing reads the traces. The
    generator draws one after the other, so there it is that column.
    """
    aside = set(aside)
    return counted(template, seed, {t: [s for s in steps if s[0] not in aside] for t, steps in plans.items()}) if drawing is counted else F.col(values)


def drawn(values: Column, name: str) -> Column:
    """The first value of a name."""
    return F.get(F.try_element_at(values, F.lit(name)), 0)


def all_drawn(values: Column, name: str) -> Column:
    return F.coalesce(F.try_element_at(values, F.lit(name)), F.array().cast("array<string>"))


def as_params(values: Column) -> Column:
    """The first value of every name, the map frames and texts are filled from."""
    return F.transform_values(values, lambda _, v: F.get(v, 0))


def with_params(params: Column, **more: Column) -> Column:
    """Params with entries added or replaced."""
    added = F.create_map(*[part for name, value in more.items() for part in (F.lit(name), value.cast("string"))])
    kept = F.map_filter(params, lambda name, _: ~name.isin(list(more)))
    return F.map_concat(kept, added)
