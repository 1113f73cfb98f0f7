"""Place of a row within its group, without a task that sorts a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termpulse.session import stage


def placed(df: DataFrame, keys: list[str], order: list[str], name: str = "place", descending: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... within the rows of equal ``keys``, by ``order`` (nulls first).

    Rows are dealt by ranges of (keys, order), so a group of any size spreads over many tasks; a row's place is that within
    its range plus the number of the group's rows in earlier ranges. ``order`` should tell all rows apart: rows that
    it does not tell apart stay in one range and get their places in no fixed order. ``df`` is sampled and read again, so
    stage it first if it is costly. Columns in ``descending`` are taken from the largest.
    """
    spark = df.sparkSession
    taken = {c.lower() for c in df.columns}

    def free(base: str) -> str:
        while base in taken:
            base = f"_{base}"
        return base

    part, at, first, n, base = map(free, ("range_part", "range_at", "range_first", "range_n", "range_base"))
    by = [F.col(f"`{c}`").desc() if c in descending else F.col(f"`{c}`").asc_nulls_first() for c in (*keys, *order)]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(tasks, *by).sortWithinPartitions(*by)
    rows = stage(dealt.withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id()}), "ranged")
    own = [F.col(f"`{c}`") for c in keys]
    ends = rows.groupBy(part, *own).agg(F.min(at).alias(first), F.count("*").alias(n))
    earlier = Window.partitionBy(*own).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # one row for a range and a group that it holds
    bases = ends.withColumn(base, F.coalesce(F.sum(n).over(earlier), F.lit(0))).drop(n)
    bases = bases.select(F.col(part).alias(f"{part}_b"), *[F.col(f"`{c}`").alias(f"{k}_{base}") for k, c in enumerate(keys)], first, base)
    same = rows[part] == bases[f"{part}_b"]
    for k, c in enumerate(keys):
        same = same & rows[c].eqNullSafe(bases[f"{k}_{base}"])
    found = rows.join(bases, same)
    place = (F.col(at) - F.col(first) + F.col(base)).cast("long")
    return found.select(*[rows[f"`{c}`"] for c in df.columns], place.alias(name))
