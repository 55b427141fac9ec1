"""Order-dependent operators over the events of a user.

A user may own a large share of all rows, so no step sorts or collects a whole user. The
events are cut into short *slabs* of time; a user's slab is the unit that is sorted. What must
cross a slab edge (counts, first and last events) is summarised to one row per slab and
carried along the slabs, whose number is bounded by the time span, not by the row count.

Keys must not be null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Short, since it bounds the rows that one task sorts for one user: at most 60,000 distinct
# times at millisecond resolution. For users with few events the width makes no difference.
SLAB = "1 minute"


def with_slab(df: DataFrame, column: str = "time", slab: str = SLAB) -> DataFrame:
    return df.selectExpr("*", f"window({column}, '{slab}').start AS slab")


def numbered(df: DataFrame, keys: list[str], order: list[str], slab: str = SLAB) -> DataFrame:
    """Add ``ordinal``: 1, 2, ... within ``keys`` by ``order``, whose first column is a time."""
    rows = with_slab(df, order[0], slab)
    before = Window.partitionBy(*keys).orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*keys, "slab")
        .agg(F.count("*").alias("rows"))
        .select(*keys, "slab", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    local = F.row_number().over(Window.partitionBy(*keys, "slab").orderBy(*order))
    return (
        rows.withColumn("ordinal", local)
        .join(offsets, [*keys, "slab"])
        .withColumn("ordinal", F.col("ordinal") + F.col("offset"))
        .drop("slab", "offset")
    )


def listed(df: DataFrame, keys: list[str], order: list[str], item: str, name: str, slab: str = SLAB) -> DataFrame:
    """One row per ``keys``: ``n`` int, the number of rows, and ``name``, the texts ``item`` that are not
    null by ``order``, whose first column is a time, divided by commas. Slabs are sorted and joined
    each by itself; only their texts, no larger than the list, meet in the row of the key."""
    entries = F.array_sort(F.collect_list(F.struct(*order, F.col(item).alias("_item"))))
    items = F.filter(F.transform(entries, lambda e: e["_item"]), lambda i: i.isNotNull())
    slabs = with_slab(df, order[0], slab).groupBy(*keys, "slab").agg(F.count("*").alias("n"), items.alias("items"))
    texts = slabs.select(*keys, "slab", "n", F.when(F.size("items") > 0, F.array_join("items", ",")).alias("text"))
    parts = F.array_sort(F.collect_list(F.struct("slab", "text")))
    joined = F.array_join(F.transform(parts, lambda p: p["text"]), ",")
    return texts.groupBy(*keys).agg(F.sum("n").cast("int").alias("n"), joined.alias(name))


def with_next(df: DataFrame, keys: list[str], order: list[str], slab: str = SLAB) -> DataFrame:
    """Add ``next``: the ``order`` columns of the following row of the same ``keys``, as a
    struct; null on the last row."""
    entry = F.struct(*order)
    rows = with_slab(df, order[0], slab)
    following = F.lead("first").over(Window.partitionBy(*keys).orderBy("slab"))
    heads = (
        rows.groupBy(*keys, "slab")
        .agg(F.min(entry).alias("first"))
        .select(*keys, "slab", following.alias("later"))
    )
    local = F.lead(entry).over(Window.partitionBy(*keys, "slab").orderBy(*order))
    return (
        rows.withColumn("next", local)
        .join(heads, [*keys, "slab"])
        .withColumn("next", F.coalesce("next", "later"))
        .drop("slab", "later")
    )
