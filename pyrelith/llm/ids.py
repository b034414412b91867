"""Ids of any type for operators that work on numbers: numbered in their order, and named again in the result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyrelith.operators.ordering import numbered
from pyrelith.runtime import Scratch, column


def as_numbers(id_col: str, *tables: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """The tables with whole numbers as ids, and ``(id_number, id_name)``; as they are, and None, if their ids are whole numbers.

    Distinct ids of all tables are numbered in their own order, so smaller ids have smaller numbers. A null id has no number.
    """
    if all(isinstance(t.schema[id_col].dataType, T.IntegralType) for t in tables):
        return list(tables), None
    scratch = Scratch(tables[0].sparkSession, "id-numbers")
    ids = tables[0].select(column(id_col).alias("id_name"))
    for t in tables[1:]:
        ids = ids.unionByName(t.select(column(id_col).alias("id_name")))
    names = scratch.table(numbered(ids.where("id_name is not null").distinct(), ["id_name"], "id_number"), "names")
    return [t.join(names, t[id_col] == names["id_name"], "left").withColumn(id_col, F.col("id_number")).drop("id_number", "id_name") for t in tables], names


def named(out: DataFrame, names: DataFrame | None, *cols: str) -> DataFrame:
    """A result with its numbers in ``cols`` replaced by the ids they stand for."""
    if names is None:
        return out
    order = out.columns
    for c in cols:
        out = out.join(names, out[c] == names["id_number"], "left").withColumn(c, F.col("id_name")).drop("id_number", "id_name")
    return out.select(*order)
