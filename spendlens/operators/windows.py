"""Reporting windows: which ``[lower, upper]`` intervals a run covers, and the assignment of
rows to them. All windows of a run are computed in one pass over the data."""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.functions.parsing import ntz_literal

EPOCH = datetime(1970, 1, 1)
MICROSECOND = timedelta(microseconds=1)

# A table of days, or of pieces and their windows, above this many rows is not broadcast.
BROADCAST_ROWS = 100_000


def start_of_day(day: date | datetime) -> datetime:
    return datetime.combine(day.date() if isinstance(day, datetime) else day, time())


@dataclass(frozen=True)
class Windows:
    """A set of windows. ``closed="both"`` includes both edges, so that an event exactly on
    the edge of two adjacent windows counts in both; ``closed="left"`` excludes the upper."""

    bounds: tuple[tuple[datetime, datetime], ...]
    closed: str = "both"

    def __post_init__(self) -> None:
        if not self.bounds:
            raise ValueError("at least one window is needed")
        if self.closed not in ("both", "left"):
            raise ValueError("closed must be 'both' or 'left'")
        for lower, upper in self.bounds:
            if lower > upper:
                raise ValueError(f"window ends before it starts: {lower} > {upper}")
        object.__setattr__(self, "bounds", tuple(sorted(set(self.bounds))))

    @classmethod
    def of(cls, bounds: Iterable[tuple[datetime, datetime]], closed: str = "both") -> Windows:
        return cls(tuple(bounds), closed)

    @classmethod
    def single(cls, lower: datetime, upper: datetime, closed: str = "both") -> Windows:
        return cls(((lower, upper),), closed)

    @classmethod
    def every(cls, start: datetime, width: timedelta, count: int, closed: str = "both") -> Windows:
        """``count`` adjacent windows of one width."""
        return cls(tuple((start + i * width, start + (i + 1) * width) for i in range(count)), closed)

    @classmethod
    def daily(cls, run_day: date, days: int = 1, closed: str = "both") -> Windows:
        """The ``days`` whole days before ``run_day``; by default yesterday, the nightly run."""
        upper = start_of_day(run_day)
        return cls.every(upper - timedelta(days=days), timedelta(days=1), days, closed)

    @classmethod
    def backfill(cls, any_day: date, days: int = 7, closed: str = "both") -> Windows:
        """The first ``days`` days of the month of ``any_day``, one window each."""
        return cls.every(start_of_day(any_day.replace(day=1)), timedelta(days=1), days, closed)

    @property
    def first(self) -> datetime:
        return self.bounds[0][0]

    @property
    def last(self) -> datetime:
        return max(upper for _, upper in self.bounds)

    @property
    def step(self) -> timedelta | None:
        """The common width if the windows are adjacent and equally wide."""
        width = self.bounds[0][1] - self.bounds[0][0]
        adjacent = all(a[1] == b[0] for a, b in zip(self.bounds, self.bounds[1:]))
        equal = all(upper - lower == width for lower, upper in self.bounds)
        return width if adjacent and equal and width > timedelta(0) else None

    def array(self) -> Column:
        """The windows as an array literal of ``struct<lower, upper>``."""
        structs = ", ".join(
            f"named_struct('lower', TIMESTAMP_NTZ'{lower}', 'upper', TIMESTAMP_NTZ'{upper}')"
            for lower, upper in self.bounds
        )
        return F.expr(f"array({structs})")

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.range(1).select(F.inline(self.array()))

    def cover(self, df: DataFrame, column: str = "time") -> DataFrame:
        """Rows between the first and the last edge. Plain comparisons with literals, so they
        are pushed to the scan; a ``day`` partition column, where there is one, is pruned."""
        moment = F.col(column)
        df = df.filter((moment >= ntz_literal(self.first)) & self._before(moment, ntz_literal(self.last)))
        if "day" in df.columns:
            days = [F.lit(edge.date().isoformat()).cast("date") for edge in (self.first, self.last)]
            df = df.filter(F.col("day").between(*days))
        return df

    def assign(self, df: DataFrame, column: str = "time") -> DataFrame:
        """Add ``lower`` and ``upper``; one output row per window that contains the row."""
        covered = self.cover(df, column)
        if len(self.bounds) == 1:
            lower, upper = self.bounds[0]
            return covered.withColumns({"lower": ntz_literal(lower), "upper": ntz_literal(upper)})
        if self.step is not None:
            return self._assign_adjacent(covered, column, self.step)
        return self._assign_listed(covered, column)

    def _before(self, moment: Column, upper: Column) -> Column:
        return moment <= upper if self.closed == "both" else moment < upper

    def _assign_adjacent(self, df: DataFrame, column: str, step: timedelta) -> DataFrame:
        """Adjacent windows: the window is arithmetic on the time, no join is needed."""
        width = f"'{step // MICROSECOND} microseconds'"
        offset = f"'{((self.first - EPOCH) % step) // MICROSECOND} microseconds'"
        interval = f"make_dt_interval(0, 0, 0, {step // MICROSECOND} / 1000000BD)"
        df = df.selectExpr("*", f"window({column}, {width}, {width}, {offset}).start AS _start")
        if self.closed == "both":
            lower = f"explode(IF({column} = _start, array(_start - {interval}, _start), array(_start)))"
        else:
            lower = "_start"
        df = df.selectExpr("*", f"{lower} AS lower").drop("_start")
        df = df.filter(F.col("lower").between(ntz_literal(self.first), ntz_literal(self.bounds[-1][0])))
        # A join on upper would add this filter, and keep Spark from sharing the scan with uses
        # that do not join.
        return df.selectExpr("*", f"lower + {interval} AS upper").filter("upper IS NOT NULL")

    def _assign_listed(self, df: DataFrame, column: str) -> DataFrame:
        return self.expand(self.locate(df, column))

    @property
    def listed(self) -> bool:
        """Whether a row may lie in windows that arithmetic on its time cannot tell."""
        return len(self.bounds) > 1 and self.step is None

    def edges(self) -> list[datetime]:
        return sorted({edge for bounds in self.bounds for edge in bounds})

    def locate(self, df: DataFrame, column: str = "time") -> DataFrame:
        """Add ``piece``, the number of the elementary interval that holds the row: 2k is the edge k
        itself, 2k + 1 the open interval after it. However many windows overlap, a row has one
        piece. It is found among the edges of its own day, a table of one row per day."""
        by_day = defaultdict(list)
        for edge in self.edges():
            by_day[edge.date()].append(edge)
        start, rows, before = self.first.date(), [], 0
        for n in range((self.last.date() - start).days + 1):
            day = start + timedelta(days=n)
            rows.append((day, before, by_day.get(day, [])))
            before += len(rows[-1][2])
        kinds = "_day date, _before int, _edges array<timestamp_ntz>"
        days = df.sparkSession.createDataFrame(rows, kinds)
        days = F.broadcast(days) if len(rows) <= BROADCAST_ROWS else days
        passed = f"_before + size(filter(_edges, e -> e <= {column}))"
        piece = f"2 * ({passed}) - IF(array_contains(_edges, {column}), 2, 1) AS piece"
        covered = self.cover(df, column).withColumn("_day", F.col(column).cast("date"))
        return covered.join(days, "_day").selectExpr(*[f"`{c}`" for c in df.columns], piece)

    def members(self, spark: SparkSession) -> tuple[DataFrame, int]:
        """(piece, lower, upper): the pieces that each window consists of, and their number."""
        edges = self.edges()
        rows, count = [], 0
        for lower, upper in self.bounds:
            first, last = 2 * bisect_left(edges, lower), 2 * bisect_left(edges, upper)
            last -= self.closed == "left"
            if first <= last:
                rows.append((lower, upper, first, last))
                count += last - first + 1
        frame = spark.createDataFrame(rows, "lower timestamp_ntz, upper timestamp_ntz, _first int, _last int")
        return frame.selectExpr("explode(sequence(_first, _last)) AS piece", "lower", "upper"), count

    def expand(self, df: DataFrame) -> DataFrame:
        """From ``piece`` to ``lower`` and ``upper``: one output row per window that the piece is in."""
        table, count = self.members(df.sparkSession)
        return df.join(F.broadcast(table) if count <= BROADCAST_ROWS else table, "piece").drop("piece")


def contained_in(df: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows of a table of results whose whole window lies in ``[start, end]``."""
    edges = (ntz_literal(start), ntz_literal(end))
    return df.filter(F.col("lower").between(*edges) & F.col("upper").between(*edges))
