"""Row numbers and running sums over a whole ordered table, without one global window.

The rows are range-partitioned by the order, into as many slabs as their size calls
for, and written. Each slab then adds up by
itself, and takes over the sum of the slabs before it; those sums are one row per
slab and group. A group of any size is cut into slabs along the order, so a hot
group never lands in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.lineage import materialise


def running_sums(
    df: DataFrame, order: list[Column], sums: dict[str, Column], within: list[str] | None = None
) -> DataFrame:
    """Add, per row, the sum of each expression over the rows up to and including it.

    ``order`` must be total within each group (``within``) for a repeatable answer.
    """
    groups = within or []
    ranged = materialise(
        df.repartitionByRange(*[F.col(g) for g in groups], *order).withColumn("_slab", F.spark_partition_id()),
        "ranged",
    )
    totals = ranged.groupBy(*groups, "_slab").agg(
        *[F.sum(expr).alias(f"_of_{name}") for name, expr in sums.items()]
    )
    # at most one row per slab and group: a few slabs for a hot group, one for others
    before = Window.partitionBy(*groups).orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(
        totals.select(
            *[F.col(g).alias(f"_at_{g}") for g in groups],
            F.col("_slab").alias("_at_slab"),
            *[F.coalesce(F.sum(f"_of_{name}").over(before), F.lit(0)).alias(f"_of_{name}") for name in sums],
        ),
        "offsets",
    )
    so_far = Window.partitionBy(*groups, "_slab").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("_slab") == F.col("_at_slab")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_at_{g}"))
    return (
        ranged.withColumns({f"_in_{name}": F.sum(expr).over(so_far) for name, expr in sums.items()})
        .join(offsets, same)
        .withColumns({name: F.col(f"_in_{name}") + F.col(f"_of_{name}") for name in sums})
        .select(*df.columns, *sums)
    )


def following(df: DataFrame, col: str, within: list[str], name: str) -> DataFrame:
    """Add the next greater value of ``col`` in each row's group; null for the last one.

    ``col`` must be distinct within a group. Each slab looks at its own rows, and its last row of a
    group takes the first one of the slabs behind it.
    """
    ranged = materialise(
        df.repartitionByRange(*[F.col(g) for g in within], F.col(col)).withColumn("_slab", F.spark_partition_id()), "ranged"
    )
    firsts = ranged.groupBy(*within, "_slab").agg(F.min(col).alias("_first"))
    behind = Window.partitionBy(*within).orderBy("_slab")  # a few slabs for a hot group, one for others
    next_slab = materialise(
        firsts.select(
            *[F.col(g).alias(f"_at_{g}") for g in within], F.col("_slab").alias("_at_slab"), F.lead("_first").over(behind).alias("_behind")
        ),
        "firsts",
    )
    same = F.col("_slab") == F.col("_at_slab")
    for g in within:
        same = same & F.col(g).eqNullSafe(F.col(f"_at_{g}"))
    own = F.lead(col).over(Window.partitionBy(*within, "_slab").orderBy(col))
    met = ranged.withColumn("_own", own).join(next_slab, same)
    return met.select(*df.columns, F.coalesce("_own", "_behind").alias(name))


def number_rows(df: DataFrame, order: list[Column], name: str = "row", within: list[str] | None = None) -> DataFrame:
    """Consecutive numbers from 1 in the given total order, over the table or per group."""
    return running_sums(df, order, {name: F.lit(1)}, within)


def value_steps(df: DataFrame, col: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """Per distinct non-null value: how many rows hold it (``n``) and how many hold it or less (``upto``).

    ``extra`` adds further per-value sums, each with its running total as ``<name>_upto``.
    """
    extra = extra or {}
    counts = (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(e).alias(name) for name, e in extra.items()])
    )
    sums = {"upto": F.col("n")} | {f"{name}_upto": F.col(name) for name in extra}
    return running_sums(counts, [F.col(col).asc()], sums)
