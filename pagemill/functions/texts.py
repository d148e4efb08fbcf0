"""Text, confidence and report expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from pagemill.functions.matching import shares

#: A recognised line: its text, its confidence from 0 to 1 and its corners.
LINES = "array<struct<text:string,confidence:double,bbox:array<array<double>>>>"


def is_blank(text: Column) -> Column:
    """True for null and for texts of white space (of any script) only."""
    return F.coalesce(text.rlike(r"(?U)^\s*$"), F.lit(True))


def page_text(lines: Column) -> Column:
    """The lines' texts, one below the other; a line without text is an empty line."""
    return F.coalesce(F.array_join(F.transform(lines, lambda x: F.coalesce(x["text"], F.lit(""))), "\n"), F.lit(""))


def page_confidence(lines: Column) -> Column:
    """Mean confidence in percent; means up to 1 are shares; without lines 0."""
    total = F.aggregate(lines, F.lit(0.0), lambda s, x: s + F.coalesce(x["confidence"], F.lit(0.0)))
    mean = F.try_divide(total, F.size(lines).cast("double"))
    return F.coalesce(F.when(mean <= 1, mean * 100).otherwise(mean), F.lit(0.0))


def confident_lines(lines: Column, least: float = 0.3) -> Column:
    """The lines that have text and at least that confidence."""
    return F.filter(lines, lambda x: (F.coalesce(x["text"], F.lit("")) != "") & (F.coalesce(x["confidence"], F.lit(0.0)) >= least))


def reading_order(lines: Column) -> Column:
    """Lines by the first corner's y, then x; equal ones stay in their order."""
    keyed = F.transform(lines, lambda x, i: F.struct(x["bbox"][0][1].alias("y"), x["bbox"][0][0].alias("x"), i.alias("i"), x.alias("line")))
    keyed = F.array_sort(keyed, lambda a, b: F.when((a["y"] < b["y"]) | ((a["y"] == b["y"]) & ((a["x"] < b["x"]) | ((a["x"] == b["x"]) & (a["i"] < b["i"])))), -1).otherwise(1))
    return F.transform(keyed, lambda k: k["line"])


@F.pandas_udf(DoubleType())
def matched_share(first: pd.Series, second: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two texts; null where one of them is."""
    there = first.notna() & second.notna()
    return pd.Series(shares(first[there].tolist(), second[there].tolist()), index=first.index[there], dtype=float).reindex(first.index)


def similarity(first: Column | str, second: Column | str) -> Column:
    """Ratcliff-Obershelp ratio of two texts; the order of the texts matters; null counts as empty.

    Pairs with an empty text, and short equal ones, are settled without Python. (Long equal texts
    can have a ratio below 1: from 200 characters on, frequent ones don't count as matches.)
    """
    a, b = (F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit("")) for x in (first, second))
    plain = F.when((a == b) & (F.length(a) < 200), 1.0).when((a == "") | (b == ""), 0.0)
    asked = lambda x: F.when(plain.isNull(), x)
    return F.coalesce(plain, matched_share(asked(a), asked(b)))


def gibibytes(usage: Column) -> Column:
    """The first figure of ``used / limit`` in GiB; 0 if it isn't in binary units."""
    first, pattern = F.trim(F.split(usage, "/")[0]), r"(?i)^([\d.]+)\s*([GMK]i)?B"
    number = F.regexp_extract(first, pattern, 1).try_cast("double")
    unit = F.lower(F.regexp_extract(first, pattern, 2))
    power = F.when(unit == "gi", 0).when(unit == "mi", 1).when(unit == "ki", 2).otherwise(3)
    return F.coalesce(number / F.pow(F.lit(1024.0), power), F.lit(0.0))


def percent(text: Column) -> Column:
    return F.coalesce(F.rtrim(F.regexp_replace(text, "%$", "")).try_cast("double"), F.lit(0.0))


def delta(old: Column, new: Column, places: Column | int = 2, unit: Column | str = "") -> Column:
    """How a report writes a change: a value with ``(no change)`` or ``(new)``, or both and the percentage."""
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    pattern = F.concat(F.lit("%."), as_column(places).cast("string"), F.lit("f"))
    number = lambda x: F.concat(F.call_function("format_string", pattern, x), as_column(unit))
    share = F.try_divide(new - old, F.abs(old)) * 100
    change = F.concat(number(old), F.lit(" → "), number(new), F.lit(" ("), F.when(share >= 0, "+").otherwise(""), F.format_string("%.1f", share), F.lit("%)"))
    return F.when((old == 0) & (new == 0), F.concat(number(new), F.lit(" (no change)"))).when(old == 0, F.concat(number(new), F.lit(" (new)"))).otherwise(change)


def is_not_found(message: Column) -> Column:
    return F.coalesce(F.lower(message).contains("not found") | message.contains("404"), F.lit(False))
