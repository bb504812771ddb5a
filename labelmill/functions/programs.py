"""Reading the program text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text form's line shapes. ``d`` keeps ``^`` after ``\n`` only.
KIND_LINE = r"(?md)^\w+ = ([A-Z_]+)[\[(]"
SIGNATURE = r"CALL\[([A-Za-z0-9_]+\.[A-Za-z0-9_]+)\]"
XML_KIND = r'typeName="([A-Z_]+)"'
BLOCK_LINE = r"^\w+ = [A-Z_]+[\[(]"


def signatures(text: Column) -> Column:
    """Signatures of the CALL blocks, in order, repeats kept."""
    return F.regexp_extract_all(text, F.lit(SIGNATURE), F.lit(1))


def block_kinds(text: Column) -> Column:
    """Kinds of the block lines, in order; a CALL counts by its signature, after the kinds."""
    kinds = F.regexp_extract_all(text, F.lit(KIND_LINE), F.lit(1))
    return F.concat(F.filter(kinds, lambda k: k != "CALL"), signatures(text))


def xml_kinds(xml: Column) -> Column:
    """Kinds an XML diagram names: a sorted set."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(xml, F.lit(XML_KIND), F.lit(1))))


def kind_source(text: Column, xml: Column) -> Column:
    """The text to read kinds from: the text form, else the XML with its kinds as block lines."""
    return F.when(text != "", text).otherwise(F.regexp_replace(xml, XML_KIND, "\n_ = $1("))


def line_class(line: Column) -> Column:
    """out, var, block, write or skip."""
    return (
        F.when(F.startswith(line, F.lit("program ")) | F.startswith(line, F.lit("in ")), "skip")
        .when(F.startswith(line, F.lit("out ")), "out")
        .when(F.startswith(line, F.lit("var ")), "var")
        .when(line.rlike(BLOCK_LINE), "block")
        .when(F.contains(line, F.lit(" = ")), "write")
        .otherwise("skip")
    )


def is_triggered(text: Column) -> Column:
    return F.contains(text, F.lit("in trigger : BOOL"))
