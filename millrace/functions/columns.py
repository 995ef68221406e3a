"""Column expressions: cleaning, dates, scaling, hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: ColumnLike) -> Column:
    """Trimmed text, with the empty string read as missing."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def cut(c: ColumnLike, start: int, length: int) -> Column:
    """The trimmed field at a 1-based position of a fixed-width line."""
    return clean(F.substring(_col(c), start, length))


def strip_quotes(c: ColumnLike, length: int = 18) -> Column:
    """The id inside one pair of quotes: ``length`` characters from the second on."""
    return F.substring(_col(c), 2, length)


def year_of(c: ColumnLike) -> Column:
    """The year of a date string that starts with it, as yyyyMMdd and yyyy-MM-dd do."""
    return F.substring(_col(c).cast("string"), 1, 4).try_cast("int")


def parse_date(c: ColumnLike) -> Column:
    """Date from either yyyyMMdd or yyyy-MM-dd; null for anything else."""
    text = F.trim(_col(c).cast("string"))
    return F.coalesce(
        F.try_to_date(text, "yyyyMMdd"), F.try_to_date(text, "yyyy-MM-dd")
    )


def tenths(c: ColumnLike) -> Column:
    """Whole units from a value stored in tenths."""
    return _col(c) / F.lit(10.0)


def opposite_signs(a: ColumnLike, b: ColumnLike) -> Column:
    """True where the two numbers lie on different sides of zero."""
    return _col(a) * _col(b) < 0


def is_missing(df: DataFrame, name: str) -> Column:
    """True for null, for the empty string and for NaN, by the column's type."""
    c = F.col(name)
    kind = dict(df.dtypes)[name]
    if kind == "string":
        return c.isNull() | (F.trim(c) == "")
    if kind in ("double", "float"):
        return c.isNull() | F.isnan(c)
    return c.isNull()


# Sampling by hash: whether a row is drawn depends on its business key alone, so a
# recomputed partition, another cluster size or another engine draws the same rows.


def key_hash(key: ColumnLike | list[ColumnLike], seed: int | str) -> Column:
    """Hex digest of the seed and the key columns; nulls and colons within them don't make keys alike."""
    keys = key if isinstance(key, list) else [key]
    escape = lambda c: F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\:"))
    parts = [F.coalesce(escape(_col(k).cast("string")), F.lit("\\0")) for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def hash_threshold(fraction: float) -> str:
    """Eight hex digits below which a share ``fraction`` of all hashes falls."""
    return format(int(fraction * 2**32), "08x")


def hash_below(key: ColumnLike | list[ColumnLike], seed: int | str, fraction: float) -> Column:
    """True for about ``fraction`` of the keys, always for the same ones."""
    if fraction >= 1:
        return F.lit(True)
    return F.substring(key_hash(key, seed), 1, 8) < F.lit(hash_threshold(fraction))


def hash_fraction(key: ColumnLike | list[ColumnLike], seed: int | str) -> Column:
    """Repeatable number in [0, 1) per key."""
    digits = F.substring(key_hash(key, seed), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(2**32))
