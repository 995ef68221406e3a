"""Projections and row filters."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_except(df: DataFrame, cols: list[str]) -> DataFrame:
    """All columns but the named ones."""
    return df.select(*[c for c in df.columns if c not in set(cols)])


def select_by_type(df: DataFrame, types: list[str]) -> DataFrame:
    """The columns of the given types, in table order."""
    return df.select(*[name for name, kind in df.dtypes if kind in types])


def select_all_but_last(df: DataFrame) -> DataFrame:
    """All columns but the last, where the last is an id or a label."""
    return df.select(*df.columns[:-1])


def where_equal(df: DataFrame, col: str, value, negate: bool = False) -> DataFrame:
    return df.filter(F.col(col) != value) if negate else df.filter(F.col(col) == value)


def active_in(df: DataFrame, first: str, last: str, point) -> DataFrame:
    """Rows whose span from ``first`` to ``last`` contains the point."""
    return df.filter(F.lit(point).between(F.col(first), F.col(last)))


def where_in(df: DataFrame, col: str, values: list, negate: bool = False) -> DataFrame:
    member = F.col(col).isin(values)
    return df.filter(~member) if negate else df.filter(member)


def has_text(col: str) -> Column:
    """True for a flag that is set: neither null nor blank."""
    return F.col(col).isNotNull() & (F.trim(F.col(col)) != "")


def where_flags(df: DataFrame, cols: list[str], mode: str = "all") -> DataFrame:
    """Rows with all of the flag columns set, or with any of them set."""
    return df.filter(reduce(and_ if mode == "all" else or_, [has_text(c) for c in cols]))


def where_sign(df: DataFrame, col: str, sign: int) -> DataFrame:
    """Rows on one side of zero: ``sign`` -1 for below, 1 for above, 0 for zero itself."""
    c = F.col(col)
    return df.filter({-1: c < 0, 0: c == 0, 1: c > 0}[sign])


def where_year(df: DataFrame, col: str, year: int) -> DataFrame:
    """Rows of one year, put as a range or a prefix so that the scan can skip the others."""
    c = F.col(col)
    if dict(df.dtypes)[col] == "string":
        return df.filter(F.startswith(c, F.lit(f"{year:04d}")))
    return df.filter((c >= F.lit(date(year, 1, 1))) & (c < F.lit(date(year + 1, 1, 1))))


def where_like(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return df.filter(F.col(col).like(pattern))


def case_column(df: DataFrame, name: str, cases: list[tuple[Column, object]], default) -> DataFrame:
    """A column that takes the value of the first condition that holds."""
    (condition, value), *others = cases
    column = F.when(condition, F.lit(value))
    for condition, value in others:
        column = column.when(condition, F.lit(value))
    return df.withColumn(name, column.otherwise(F.lit(default)))
