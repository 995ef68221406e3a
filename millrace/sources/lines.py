"""Text without delimiters: fixed-width records and match reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import cut

FieldSpec = tuple[str, int, int, str]


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row a line, in the column ``value``."""
    return spark.read.text(path)


def read_fixed_width(spark: SparkSession, path: str | list[str], spec: list[FieldSpec]) -> DataFrame:
    """Typed columns from (name, start, length, type) positions, starts counted from 1.

    A blank field, one the line is too short for, and one that does not read as
    its type are all null.
    """
    return read_lines(spark, path).select(
        *[
            (cut("value", start, length) if kind == "string" else cut("value", start, length).try_cast(kind)).alias(name)
            for name, start, length, kind in spec
        ]
    )


# What parts the two sides of a match report, and artist from title.
_UNEQUAL = "  !=  "
_DASH = "  -  "


def parse_match_log(lines: DataFrame, prefix: str = "ERROR: ", column: str = "value") -> DataFrame:
    """The song and the track named by each report line that starts with ``prefix``.

    A line reads ``prefix<song track> artist  -  title  !=  artist  -  title`` with ids
    of 18 characters. The first mark on each side counts; later ones belong to the
    title. Lines with the prefix that do not have this form are left out.
    """
    report = F.substr(F.col(column), F.lit(len(prefix) + 1))
    sides = F.split(F.substr(report, F.lit(41)), _UNEQUAL, 2)
    return (
        lines.filter(F.startswith(F.col(column), F.lit(prefix)))
        .select(
            F.substring(report, 2, 18).alias("song_id"),
            F.substring(report, 21, 18).alias("track_id"),
            F.split(F.get(sides, F.lit(0)), _DASH, 2).alias("song"),
            F.split(F.get(sides, F.lit(1)), _DASH, 2).alias("track"),
        )
        .filter((F.size("song") == 2) & (F.size("track") == 2))
        .select(
            "song_id",
            F.get("song", F.lit(0)).alias("song_artist"),
            F.get("song", F.lit(1)).alias("song_title"),
            "track_id",
            F.get("track", F.lit(0)).alias("track_artist"),
            F.get("track", F.lit(1)).alias("track_title"),
        )
    )
