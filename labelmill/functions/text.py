"""String expressions shared by the program, audit and generation jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it in ``body``, inside lambdas too."""
    return F.get(F.transform(F.array(value), body), 0)


def lines_of(text: Column) -> Column:
    """Lines split on ``\\n``; a trailing newline does not open another line."""
    return F.split(F.regexp_replace(text, r"\n\z", ""), "\n")


def has_match(text: Column, pattern: str) -> Column:
    return text.rlike(pattern)


def before_first(text: Column, pattern: str) -> Column:
    """What stands before the leftmost match; empty when nothing matches."""
    return F.regexp_extract(text, rf"(?s)\A(.*?)(?:{pattern})", 1)


def splice_first(text: Column, pattern: str, replacement: Column, group: int = 0) -> Column:
    """Replace the first match of ``pattern`` (or one group of it), and only that one.

    ``regexp_replace`` is global, so the text is cut at the match instead. With
    ``group`` > 0 the pattern's leading part, up to the group, is kept.
    """
    before = before_first(text, pattern)
    whole = F.regexp_extract(text, pattern, 0)
    if group:
        target = F.regexp_extract(text, pattern, group)
        lead = F.substring(whole, F.lit(1), F.instr(whole, target) - 1)
        start = F.length(before) + F.length(lead)
        width = F.length(target)
    else:
        start, width = F.length(before), F.length(whole)
    head = F.substring(text, F.lit(1), start)
    tail = F.substring(text, start + width + 1, F.length(text))
    return F.when(text.rlike(pattern), F.concat(head, replacement, tail)).otherwise(text)


def replace_first(text: Column, pattern: str, replacement: str) -> Column:
    """Replace the first match by fixed text; groups of ``pattern`` count from ``$2``."""
    return F.regexp_replace(text, rf"(?s)\A(.*?)(?:{pattern})", f"$1{replacement}")


def replace_first_literal(text: Column, old: Column, new: Column) -> Column:
    """Replace the first occurrence of a literal; unchanged when it is absent or empty."""
    at = F.instr(text, old)
    head = F.substring(text, F.lit(1), at - 1)
    tail = F.substring(text, at + F.length(old), F.length(text))
    return F.when((at > 0) & (F.length(old) > 0), F.concat(head, new, tail)).otherwise(text)


def placeholders(template: Column) -> Column:
    """The pieces of a template, those that stand for a ``{name}`` marked: what ``filled`` fills."""
    return F.split(F.regexp_replace(template, r"\{(\w+)\}", "\u0001\u0002$1\u0001"), "\u0001")


def filled(pieces: Column, params: Column) -> Column:
    """The text of ``placeholders`` with its names filled from a string map, as ``fill_placeholders`` does."""

    def joined(values: Column) -> Column:
        def fill(piece: Column) -> Column:
            name = F.substr(piece, F.lit(2))
            value = F.coalesce(F.try_element_at(values, name), F.concat(F.lit("{"), name, F.lit("}")))
            return F.when(F.startswith(piece, F.lit("\u0002")), value).otherwise(piece)

        return F.array_join(F.transform(pieces, fill), "")

    return let(params, joined)


def fill_placeholders(template: Column, params: Column) -> Column:
    """Fill ``{name}`` from a string map in one pass, so a value holding braces is kept as is.

    A name the map does not carry stays as ``{name}``; ``unfilled`` names it.
    """
    return filled(placeholders(template), params)


def unfilled(template: Column, params: Column) -> Column:
    """Placeholder names the map does not carry, sorted; empty when the frame can be filled."""
    wanted = F.regexp_extract_all(template, F.lit(r"\{(\w+)\}"), F.lit(1))
    return F.array_sort(F.array_except(wanted, F.map_keys(params)))


def csv_list(text: Column) -> Column:
    """``a,b,,`` -> [a, b]."""
    return F.filter(F.split(text, ","), lambda part: part != "")


def accessories(text: Column) -> Column:
    """``None`` -> [], else split on ``;``."""
    return F.when(text == "None", F.array().cast("array<string>")).otherwise(F.split(text, ";"))


def numbers_in(text: Column) -> Column:
    """Numbers in printed text; a digit glued to a letter belongs to a type name."""
    found = F.regexp_extract_all(
        F.coalesce(text, F.lit("")), F.lit(r"(?<![A-Za-z0-9_])-?\d+(?:\.\d+)?(?:e[-+]?\d+)?"), F.lit(0)
    )
    return F.transform(found, lambda n: n.cast("double"))


def bare_string(text: Column) -> Column:
    """A printed string name without its leading ``&`` and its quotes."""
    return F.btrim(F.ltrim(F.coalesce(text, F.lit("")), F.lit("&")), F.lit('"'))


def refusal_kind(reason: Column) -> Column:
    """A refusal's kind: what stands before the first colon."""
    return F.substring_index(reason, ":", 1)


def joined_set(values: Column) -> Column:
    """The canonical form of a set of names: distinct, sorted, comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(values)), ",")


def row_key(family: Column, template: Column, seed: Column) -> Column:
    return F.concat_ws("/", family, template, seed.cast("string"))


def key_template(key: Column) -> Column:
    return F.get(F.split(key, "/"), F.lit(1))


def key_seed(key: Column) -> Column:
    return F.get(F.split(key, "/"), F.lit(2)).cast("bigint")


def provenance(template: Column, seed: Column, family: Column | None = None) -> Column:
    parts = [F.lit("constructed")] + ([family] if family is not None else [])
    return F.concat_ws(":", *parts, template, F.lit("seed"), seed.cast("string"))


def short_id(text: Column, prefix: str = "U", digits: int = 10) -> Column:
    """A stable identifier: a letter and the head of the text's sha1."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(text), 1, digits))


def mixed_seed(seed: Column, name: Column) -> Column:
    """A per-name seed that does not depend on a salted hash."""
    return seed * 1000 + F.crc32(name) % 997


def one_of(column: Column, values: Iterable[str]) -> Column:
    """``isin`` that is false, not null, on an empty list and on null."""
    values = list(values)
    return F.coalesce(column.isin(values), F.lit(False)) if values else F.lit(False)


def overlaps(values: Column, wanted: Iterable[str]) -> Column:
    """Whether an array holds any wanted name; never null."""
    wanted = list(wanted)
    if not wanted:
        return F.lit(False)
    return F.coalesce(F.arrays_overlap(values, F.array(*[F.lit(w) for w in wanted])), F.lit(False))
