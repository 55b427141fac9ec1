"""Sums of doubles that depend on neither the order of the rows nor their partitioning.

Doubles added one by one are rounded at every step, so their sum changes with the order. Here a value is
cut into four whole numbers of 24 bits, on a grid that all values of its magnitude share (its ``bin``).
Sums of whole numbers are exact, at every stage of an aggregation, and only the last step rounds.

Rows are grouped by ``bin`` besides their keys: one or two bins for usual prices, 83 at most. A group
can have 5e11 rows before a sum of longs overflows, which Spark reports as an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24
BIN = "bin"
PARTS = ["part_0", "part_1", "part_2", "part_3"]
# The sum of what is infinite or not a number, which has no parts.
BEYOND = "beyond"
SUMS = [*PARTS, BEYOND]
# Values below 2 ** -936 share this bin, of which the last part ends at 2 ** -1032.
LOWEST_BIN = -40


def split(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``bin``, the parts and ``beyond`` of a double column; null counts as 0. A double
    of 53 bits fits the four parts of its bin. Only values below 1e-281 may have bits under the
    grid, which are cut off."""
    value = F.col(column)
    outside = F.isnan(value) | (F.abs(value) == math.inf)
    magnitude = F.floor(F.log2(F.abs("_left")) / BITS)
    rows = rows.withColumns(
        {
            "_left": F.when(outside | value.isNull(), 0.0).otherwise(value),
            BEYOND: F.when(outside, value).otherwise(0.0),
        }
    )
    rows = rows.withColumn(BIN, F.when(F.col("_left") == 0, 0).otherwise(F.greatest(magnitude, F.lit(LOWEST_BIN))).cast("int"))
    rows = rows.withColumn("_left", F.col("_left") / _power(F.col(BIN)))
    for part in PARTS:
        rows = rows.withColumn(part, F.col("_left").cast("long"))
        rows = rows.withColumn("_left", (F.col("_left") - F.col(part)) * F.lit(2.0**BITS))
    return rows.drop("_left")


def sums() -> dict[str, Column]:
    return {name: F.sum(name) for name in SUMS}


def added_up(rows: DataFrame, keys: list[str], name: str, counts: Iterable[str] = ()) -> DataFrame:
    """Per ``keys``: the sum, as a double ``name``, of rows with parts or sums of parts, and the sums
    of ``counts``."""
    counts = list(counts)
    by_bin = rows.groupBy(*keys, BIN).agg(*[F.sum(c).alias(c) for c in [*SUMS, *counts]])
    return by_bin.groupBy(*keys).agg(_total().alias(name), *[F.sum(c).alias(c) for c in counts])


def _power(grid: Column) -> Column:
    return F.pow(F.lit(2.0), grid * BITS)


def _total() -> Column:
    """The sum over one row per bin. The terms are doubles without rounding; what their sum loses is
    carried along, so the result is rounded once."""
    bins = F.sort_array(F.collect_list(F.struct(BIN, *PARTS)))

    def terms(item: Column) -> Column:
        out = []
        for k, part in enumerate(PARTS):
            upper = F.shiftright(item[part], BITS)
            lower = item[part] - F.shiftleft(upper, BITS)
            scale = _power(item[BIN] - k)
            out += [upper.cast("double") * F.lit(2.0**BITS) * scale, lower.cast("double") * scale]
        return F.array(*out)

    def add(acc: Column, term: Column) -> Column:
        total = acc["total"] + term
        taken = total - acc["total"]
        lost = (acc["total"] - (total - taken)) + (term - taken)
        return F.struct(total.alias("total"), (acc["lost"] + lost).alias("lost"))

    def end(acc: Column) -> Column:
        return F.when(F.isnan(acc["lost"]), acc["total"]).otherwise(acc["total"] + acc["lost"])

    start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("lost"))
    return F.aggregate(F.flatten(F.transform(bins, terms)), start, add, end) + F.sum(BEYOND)
