"""Dense core of a user-item table, by peeling.

The first round needs all rows: each pair of a user and an item is written with its number of
rows and with how many rows its user and its item have. From then on the work follows what
falls out. A round removes the keys whose counts have become too small; the pairs of these keys
are read from an adjacency table, of which only the buckets with removed keys are opened; and
the counts of the keys on the other side are lowered by what they lose. The table of lowered
counts has just the keys that ever lost a row.

The adjacency is written once for each side, without the pairs that the first round took out,
in buckets by hash of the key and in several parts for each bucket, so that a hot key isn't
one file. Written tables cut the lineage of every round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.lineage import materialise, scratch_path
from millrace.operators.joins import union_all

BUCKETS = 256
BUCKET_ROWS = 1 << 14  # pairs of a bucket, as long as fewer buckets will do
PART_ROWS = 1 << 22  # pairs of a file


def kcore(
    df: DataFrame, user: str, item: str, min_items: int, min_users: int, rounds: int | None = None, distinct: bool = False
) -> DataFrame:
    """Rows of users with more than ``min_items`` rows and items with more than ``min_users``.

    Both tests of a round look at the same table; rounds go on until nothing changes,
    or for a given number of ``rounds``. Rows without a user or an item count in the first
    round and go in it. The rows themselves are filtered from ``df`` in the end, so read
    ``df`` from storage rather than from a long computation. ``distinct`` says that no pair of a
    user and an item has two rows, as in a table grouped by both.
    """
    if rounds == 0:
        return df
    peeled = _Peeling(df, user, item, min_items, min_users, rounds, distinct)
    kept = materialise(peeled.kept(), "core")
    left = df.join(kept.where("_is_user").select(user), user, "left_semi")
    return left.join(kept.where("NOT _is_user").select(item), item, "left_semi").select(*df.columns)


def kcore_rounds(
    df: DataFrame, user: str, item: str, min_items: int, min_users: int, rounds: int | None = None, distinct: bool = False
) -> DataFrame:
    """(round, n_users, n_items): what each round removes, as long as it removes anything."""
    gone = _Peeling(df, user, item, min_items, min_users, rounds, distinct).gone()
    each = [F.count_if(side).alias(name) for name, side in (("n_users", F.col("_is_user")), ("n_items", ~F.col("_is_user")))]
    return gone.groupBy("round").agg(*each)


class _Peeling:
    """Users and items removed round by round. Tables of keys have one of both, and ``_is_user`` to tell which."""

    def __init__(
        self, df: DataFrame, user: str, item: str, min_items: int, min_users: int, rounds: int | None, distinct: bool = False
    ):
        self.user, self.item, self.spark = user, item, df.sparkSession
        self.kinds = dict(df.dtypes)
        self.least = F.when(F.col("_is_user"), F.lit(min_items)).otherwise(F.lit(min_users))
        one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
        both = F.array(self._entry(True, one, none), self._entry(False, one, none))
        counts = self._total(df.select(F.inline(both)).where(F.col(user).isNotNull() | F.col(item).isNotNull()))
        self.counts = materialise(counts.drop("base"), "counts")  # the rows each key has at first
        self.lowered: list[DataFrame] = []  # of each round but the last: what the keys that are left have lost so far
        if rounds != 1:
            self._first(df, distinct)
            self._others(rounds)

    def _entry(self, is_user: bool, n: Column, base: Column) -> Column:
        fields = [F.lit(is_user).alias("_is_user")]
        for name in (self.user, self.item):
            key = F.col(name) if (name == self.user) == is_user else F.lit(None).cast(self.kinds[name])
            fields.append(key.alias(name))
        return F.struct(*fields, n.alias("n"), base.alias("base"))

    def _total(self, entries: DataFrame) -> DataFrame:
        """Per key the sum of ``n``, and the rows it had at first."""
        return entries.groupBy("_is_user", self.user, self.item).agg(F.sum("n").alias("n"), F.max("base").alias("base"))

    def _of(self, table: DataFrame, is_user: bool, *columns: str) -> DataFrame:
        return table.where(F.col("_is_user") == is_user).select(self.user if is_user else self.item, *columns)

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _first(self, df: DataFrame, distinct: bool) -> None:
        """Remove the keys that are too small at first, and write the adjacency of what is left."""
        if distinct:
            pairs = df.select(self.user, self.item, F.lit(1).cast("long").alias("n"))
        else:
            pairs = df.groupBy(self.user, self.item).agg(F.count(F.lit(1)).alias("n"))
        bases = {True: "_user_rows", False: "_item_rows"}
        for is_user, name in bases.items():  # a null key meets no count
            own = self._of(self.counts.withColumn("_stays", F.col("n") > self.least), is_user, "n", "_stays")
            own = own.withColumnsRenamed({"n": name, "_stays": f"{name}_stay"})
            pairs = pairs.join(own, self.user if is_user else self.item, "left")
        pairs = materialise(pairs, "pairs")
        stays = {u: F.coalesce(F.col(f"{name}_stay"), F.lit(False)) for u, name in bases.items()}
        lost = pairs.where(stays[True] != stays[False])
        entry = F.when(stays[True], self._entry(True, F.col("n"), F.col(bases[True])))
        entry = entry.otherwise(self._entry(False, F.col("n"), F.col(bases[False])))
        self.lowered.append(materialise(self._total(lost.select(F.inline(F.array(entry)))), "lowered"))
        left = pairs.where(stays[True] & stays[False])
        n = left.count()
        self.buckets = max(1, min(BUCKETS, n // BUCKET_ROWS))
        parts = max(1, n // (self.buckets * PART_ROWS))
        self.pairs = {}
        for is_user, key in ((True, self.user), (False, self.item)):
            other = self.item if is_user else self.user
            rows = left.select(key, other, "n", F.col(bases[not is_user]).alias("base"), self._bucket(key).alias("_bucket"))
            path = scratch_path(self.spark, "adjacency")
            dealt = rows.repartition("_bucket", F.pmod(F.xxhash64(other), F.lit(parts)))
            dealt.write.partitionBy("_bucket").parquet(path)
            self.pairs[is_user] = self.spark.read.schema(rows.schema).parquet(path)

    def _small(self, round_: int) -> DataFrame:
        """The keys that a round removes."""
        if round_ == 1:
            return self.counts.where(F.col("n") <= self.least).drop("n")
        return self.lowered[round_ - 2].where(F.col("base") - F.col("n") <= self.least).drop("n", "base")

    def gone(self) -> DataFrame:
        """All removed keys, with the round."""
        rounds = range(1, len(self.lowered) + 2)
        return union_all([self._small(r).withColumn("round", F.lit(r)) for r in rounds])

    def kept(self) -> DataFrame:
        """The keys that are left, and the rows they had at first."""
        kept = self.counts.where(F.col("n") > self.least)
        if not self.lowered:
            return kept
        sides = []
        for is_user, key in ((True, self.user), (False, self.item)):
            later = union_all([self._of(self._small(r + 2), is_user) for r in range(len(self.lowered))])
            own = kept.where(F.col("_is_user") == is_user)
            sides.append(own.join(later, key, "left_anti").select(*kept.columns))
        return union_all(sides)

    def _others(self, rounds: int | None) -> None:
        done = 1
        while rounds is None or done < rounds:
            done += 1
            small = self._small(done)
            at = F.when(F.col("_is_user"), self._bucket(self.user)).otherwise(self._bucket(self.item))
            found = small.select("_is_user", at.alias("bucket")).distinct().collect()  # two for each bucket at most
            if done == rounds or not found:
                break
            losses = []
            for is_user, key in ((True, self.user), (False, self.item)):
                opened = [r.bucket for r in found if r._is_user == is_user]
                if not opened:
                    continue
                other = self.item if is_user else self.user
                met = self.pairs[is_user].where(F.col("_bucket").isin(opened)).join(self._of(small, is_user), key)
                # Keys that went in this round or before it, the first one apart, lose nothing.
                later = union_all([self._of(self._small(r), not is_user) for r in range(2, done + 1)])
                met = met.join(later, other, "left_anti")
                losses.append(met.select(F.inline(F.array(self._entry(not is_user, F.col("n"), F.col("base"))))))
            left = self.lowered[-1].where(F.col("base") - F.col("n") > self.least)
            self.lowered.append(materialise(self._total(union_all([left, *losses])), "lowered"))


def retention(before: DataFrame, after: DataFrame, user: str, item: str) -> DataFrame:
    """Rows, users and items before and after a filter, and the shares kept."""
    measures = {
        "rows": F.count(F.lit(1)),
        "users": F.count_distinct(user),
        "items": F.count_distinct(item),
    }
    tables = {"before": before, "after": after}
    sizes = {when: df.agg(*[m.alias(k) for k, m in measures.items()]) for when, df in tables.items()}
    long = {
        when: df.select(F.inline(F.array(*[F.struct(F.lit(k).alias("measure"), F.col(k).alias(when)) for k in measures])))
        for when, df in sizes.items()
    }
    return long["before"].join(long["after"], "measure").withColumn("kept", F.try_divide("after", "before"))


def kcore_retention(
    df: DataFrame, user: str, item: str, min_items: int, min_users: int, distinct: bool = False
) -> DataFrame:
    """``retention`` of the stable ``kcore``, from the counts that peeling leaves: its rows are not put together.

    All keys that are left have rows in the core, as many as they had less what they have lost.
    """
    peeled = _Peeling(df, user, item, min_items, min_users, None, distinct)
    sides = {"users": F.count_if("_is_user"), "items": F.count_if(~F.col("_is_user"))}
    had = F.sum(F.when(F.col("_is_user"), F.col("n")))

    def sizes(table: DataFrame, when: str, measures: dict[str, Column]) -> DataFrame:
        entries = []
        for k in measures:
            values = [(F.coalesce(k, F.lit(0)) if w == when else F.lit(0)).cast("bigint").alias(w) for w in ("before", "after")]
            entries.append(F.struct(F.lit(k).alias("measure"), *values))
        return table.agg(*[m.alias(k) for k, m in measures.items()]).select(F.inline(F.array(*entries)))

    parts = [
        sizes(peeled.counts, "before", sides),
        sizes(df, "before", {"rows": F.count(F.lit(1))}),
        sizes(peeled.kept(), "after", sides | {"rows": had}),
        sizes(peeled.lowered[-1], "after", {"rows": -had}),
    ]
    total = union_all(parts).groupBy("measure").agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
    return total.withColumn("kept", F.try_divide("after", "before"))
