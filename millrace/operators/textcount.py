"""Word, line and character counts. All are partially summed before their one shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import characters, tokens


def lines_of(df: DataFrame, col: str) -> DataFrame:
    """The lines of a text column, one a row, in the column ``value``."""
    return df.select(F.explode(F.split(F.col(col), "\n")).alias("value"))


def _count(items: DataFrame, col: str) -> DataFrame:
    return items.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def word_count(lines: DataFrame, mode: str = "space", col: str = "value") -> DataFrame:
    """Words and how often they occur, in one of the three dialects."""
    words = lines.select(F.explode(tokens(col, mode)).alias("word"))
    return _count(words if mode == "space" else words.filter(F.col("word") != ""), "word")


def line_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """Each distinct line and how often it occurs."""
    return _count(lines.select(F.col(col).alias("line")), "line")


def char_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """Characters and how often they occur, spaces left out."""
    found = lines.select(F.explode(characters(col)).alias("character"))
    return _count(found.filter(F.col("character") != ""), "character")


def sum_counts(pairs: DataFrame, key: str, count: str | Column) -> DataFrame:
    """Add up counts that were made elsewhere, skipping those that are not whole numbers."""
    number = (F.col(count) if isinstance(count, str) else count).cast("string").try_cast("bigint")
    valid = pairs.select(F.col(key), number.alias("_n")).filter(F.col("_n").isNotNull())
    return valid.groupBy(key).agg(F.sum("_n").alias("n"))


def parse_pairs(lines: DataFrame, col: str = "value") -> DataFrame:
    """Word and count from ``word<TAB>count`` lines; the first tab parts them."""
    halves = F.split(F.col(col), "\t", 2)
    return lines.select(F.get(halves, F.lit(0)).alias("word"), F.get(halves, F.lit(1)).alias("count"))
