"""Repeatable splits and class balancing, drawn by the hash of a unique business key.

Each purpose should use its own seed: two draws with one seed and one key are the
same draw.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import hash_below, key_hash
from millrace.lineage import materialise
from millrace.operators.filters import case_column
from millrace.operators.joins import key_table, union_all
from millrace.operators.ordered import number_rows


def split(df: DataFrame, key: str | list[str], fractions: list[float], seed: int | str, name: str = "part") -> DataFrame:
    """Number of the part (from 0) each row falls into, the parts sized by ``fractions``."""
    total, upto = sum(fractions), 0.0
    part = None
    for i, fraction in enumerate(fractions[:-1]):
        upto += fraction / total
        below = hash_below(key, seed, upto)
        part = F.when(below, i) if part is None else part.when(below, i)
    last = F.lit(len(fractions) - 1)
    return df.withColumn(name, last if part is None else part.otherwise(last))


def stratified_sample(df: DataFrame, label: str, fractions: dict, key: str, seed: int | str, name: str = "sampled") -> DataFrame:
    """Flag about the given share of each class; the rows not flagged are the complement."""
    drawn = F.lit(False)
    for value, fraction in fractions.items():
        drawn = F.when(F.col(label) == value, hash_below(key, seed, fraction)).otherwise(drawn)
    return df.withColumn(name, drawn)


def stratified_split_exact(df: DataFrame, label: str, frac: float, key: str, seed: int | str, name: str = "split") -> DataFrame:
    """Mark floor(frac * size) rows of each class as train and the others as test.

    The rows of a class are taken in the order of their hashes. Counts per class and
    16-bit hash prefix tell the prefix at which the class reaches its share; rows
    before it are train, rows after it test, and only the rows that carry that very
    prefix, one in 65536, are sorted. The table itself is not shuffled.
    """
    hashed = df.withColumn("_hash", key_hash(key, seed)).withColumn("_prefix", F.substring("_hash", 1, 4))
    counts = materialise(
        hashed.groupBy(F.col(label).alias("_label"), "_prefix").agg(F.count(F.lit(1)).alias("_n")), "prefixes"
    )
    by_prefix = Window.partitionBy("_label").orderBy("_prefix")  # at most 65536 rows a class
    sized = counts.groupBy("_label").agg(
        F.floor(F.sum("_n") * F.lit(Decimal(str(frac)))).cast("bigint").alias("_want")
    )
    reached = (
        counts.withColumn("_upto", F.sum("_n").over(by_prefix))
        .alias("c")
        .join(sized.alias("s"), F.col("c._label").eqNullSafe(F.col("s._label")))
        .filter((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.col("_want")))
        .select("c._label", F.col("_prefix").alias("_cut"), (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_take"))
    )
    cuts = materialise(reached, "cuts")  # one row a class
    placed = hashed.join(cuts, hashed[label].eqNullSafe(cuts["_label"]), "left")
    train, test = F.lit("train"), F.lit("test")
    # a class whose share rounds to no row at all has no cut
    clear = placed.filter(F.col("_cut").isNull() | (F.col("_prefix") != F.col("_cut"))).withColumn(
        name, F.when(F.col("_prefix") < F.col("_cut"), train).otherwise(test)
    )
    row = F.row_number().over(Window.partitionBy(label).orderBy("_hash", key))
    edge = (
        placed.filter(F.col("_prefix") == F.col("_cut"))
        .withColumn("_row", row)
        .withColumn(name, F.when(F.col("_row") <= F.col("_take"), train).otherwise(test))
    )
    return union_all([part.select(*df.columns, name) for part in (clear, edge)])


def split_per_key(df: DataFrame, key: str, frac: float, row_key: str, seed: int | str, name: str = "split") -> DataFrame:
    """Mark floor(frac * size) rows of each key, but at least one, as train and the others as test.

    For millions of keys of any size: the rows are numbered within their key in the order of
    their hashes, with a hot key cut into slabs, and compared with the key's quota. Every key
    has training rows, so none has to be dropped from the test part afterwards.
    """
    hashed = df.withColumn("_hash", key_hash(row_key, seed))
    numbered = number_rows(hashed, [F.col("_hash"), F.col(row_key)], "_row", [key])
    share = F.floor(F.count(F.lit(1)) * F.lit(Decimal(str(frac)))).cast("bigint")
    quota = df.groupBy(F.col(key).alias("_key")).agg(F.greatest(share, F.lit(1)).alias("_quota"))
    placed = numbered.join(materialise(quota, "quota"), F.col(key).eqNullSafe(F.col("_key")))
    return placed.select(*df.columns, F.when(F.col("_row") <= F.col("_quota"), "train").otherwise("test").alias(name))


def downsample(df: DataFrame, label: str, majority, ratio: float, key: str, seed: int | str) -> DataFrame:
    """Thin the majority class to about ``ratio`` times the size of all other rows, those without a label included."""
    is_major = F.col(label).eqNullSafe(F.lit(majority))
    n_major, n_minor = df.agg(F.count_if(is_major), F.count_if(~is_major)).first()
    if not n_major:
        return df
    return df.filter(~is_major | hash_below(key, seed, ratio * n_minor / n_major))


def oversample(df: DataFrame, label: str, minority, n: int, p: float, key: str, seed: int | str) -> DataFrame:
    """Each minority row as often as ``n`` draws exceed ``p``: n * (1 - p) times on average, maybe never.

    All other rows stay once. ``copy`` numbers the draw each row comes from.
    """
    draws = F.filter(F.sequence(F.lit(1), F.lit(n)), lambda i: ~hash_below([F.col(key), i], seed, p))
    copies = F.when(F.col(label) == minority, draws).otherwise(F.array(F.lit(1)))
    return df.withColumn("copy", F.explode(copies))


def class_weights(df: DataFrame, label: str, mapping: dict, default: float = 1.0, name: str = "weight") -> DataFrame:
    """A weight column by class."""
    return case_column(df, name, [(F.col(label) == value, weight) for value, weight in mapping.items()], default)


def uncovered(test: DataFrame, train: DataFrame, on: str) -> DataFrame:
    """How many rows and keys of the test part have no row in the training part."""
    left_out = test.join(key_table(train, [on]), on, "left_anti")
    return left_out.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(on).alias("n_keys"))
