"""Metadata kept as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

KIND = "map<string,variant>"


def merged(old: Column, new: Column) -> Column:
    """Top-level merge of two JSON objects: ``new`` wins, nulls stay, nested objects aren't merged."""
    a, b = (F.coalesce(F.from_json(x, KIND), F.from_json(F.lit("{}"), KIND)) for x in (old, new))
    # bound once: inside a lambda's body a text would be parsed again for each key
    bound = F.array(F.struct(a.alias("a"), b.alias("b"), F.map_keys(b).alias("keys")))
    join = lambda x: F.map_concat(F.map_filter(x["a"], lambda k, _: ~F.array_contains(x["keys"], k)), x["b"])
    return F.to_json(F.transform(bound, join)[0])


def json_text(rows: DataFrame, name: str) -> Column:
    """A column as JSON text: texts stay as they are, anything else is written with its null fields."""
    column = F.col(name)
    if isinstance(rows.schema[name].dataType, StringType):
        return column
    return F.to_json(column, {"ignoreNullFields": "false"})
