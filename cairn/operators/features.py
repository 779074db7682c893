"""Feature encoding from a declared schema.

A schema maps a feature name to its type and source column: ``continuous`` (the default) is a
double, ``indicator`` is 1 where the column equals ``value``, and ``categorical`` gives one 0/1
column per listed value, named ``feature_value`` in lower case. Values not listed are the
baseline: they leave every column at 0.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn import fixed


def feature_columns(schema: dict = fixed.FEATURES, ignore: Iterable[str] = (),
                    other: bool = False) -> dict[str, tuple[str, object]]:
    """Feature column -> (source column, rule), in schema order."""
    out: dict[str, tuple[str, object]] = {}
    for feature, spec in schema.items():
        if feature in ignore:
            continue
        kind = spec.get("type", "continuous")
        if kind == "continuous":
            out[feature] = (spec["column"], None)
        elif kind == "indicator":
            out[feature] = (spec["column"], [spec["value"]])
        elif kind == "categorical":
            for value in spec["values"]:
                out[f"{feature}_{value.lower()}"] = (spec["column"], [value])
            if other:
                out[f"{feature}_other"] = (spec["column"], ("not in", spec["values"]))
        else:
            raise ValueError(f"unknown feature type {kind!r}")
    return out


def _encode(source: Column, rule) -> Column:
    if rule is None:
        return source.cast("double")
    if isinstance(rule, tuple):
        return F.coalesce((~source.isin(rule[1])).cast("int"), F.lit(1))
    return F.coalesce((source == rule[0]).cast("int"), F.lit(0))


def feature_matrix(df: DataFrame, schema: dict = fixed.FEATURES, keys: Iterable[str] = (),
                   ignore: Iterable[str] = (), other: bool = False) -> DataFrame:
    """Key columns and one numeric column per feature: a single projection, no join."""
    return df.select(*keys, *[
        _encode(F.col(source), rule).alias(name)
        for name, (source, rule) in feature_columns(schema, ignore, other).items()])


def overlay(matrix: DataFrame, record: dict, schema: dict = fixed.FEATURES,
            ignore: Iterable[str] = ()) -> DataFrame:
    """Set features of every row from one record of constants; ignored features stay."""
    return matrix.withColumns({
        name: _encode(F.lit(record[source]), rule)
        for name, (source, rule) in feature_columns(schema, ignore).items()})


def is_complete(schema: dict = fixed.FEATURES) -> Column:
    """Whether a row of a feature matrix has a value for each continuous feature."""
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n, (_, rule) in
                                       feature_columns(schema).items() if rule is None], F.lit(True))


def filled_rows(matrix: DataFrame, schema: dict = fixed.FEATURES, flag: str = "_complete") -> DataFrame:
    """All rows, with zeros for missing values and a flag that tells which rows had all of theirs."""
    return matrix.withColumn(flag, is_complete(schema)).withColumns({
        n: F.coalesce(n, F.lit(0.0)) for n, (_, rule) in feature_columns(schema).items() if rule is None})


def complete_rows(matrix: DataFrame, schema: dict = fixed.FEATURES) -> DataFrame:
    """Rows of a feature matrix without a missing value; only continuous features can miss one.

    One test per column: a single test over all of them makes the optimizer derive every
    combination of renamed columns.
    """
    names = [n for n, (_, rule) in feature_columns(schema).items() if rule is None]
    return matrix.where(reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names],
                               F.lit(True)))


def label(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")
