"""Result tables: written by key, so that a re-run replaces its rows, and read back by window.

Metric rows live in ``<root>/metric_values``, the per-user tables beside it. All are partitioned
by window and run: the files of a run do not grow in number with the tenants or metrics, which
are sorted columns. A run adds its files to any number of tables and then publishes them all at
once, by one small file under ``<root>/_published`` that gives the run its place in a sequence.
Readers look at that sequence first: they see all tables of a run or none, and for each key the
rows of the last published run that has it. What a run leaves behind that ended before is never
read. Runs may write at the same time; the sequence, not a clock, decides between them.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.operators.windows import contained_in
from spendlens.schema import KEY

# Sortable and exact to the microsecond, so window edges can be compared as partition values.
EDGE_FORMAT = "yyyyMMddHHmmssSSSSSS"


def _edge(column: str) -> Column:
    return F.date_format(column, EDGE_FORMAT)


def _edge_text(moment: datetime) -> str:
    return moment.strftime("%Y%m%d%H%M%S%f")


def _strings(*columns: str) -> dict[str, Column]:
    """Partition values of digits would be read back as numbers; a letter keeps them text."""
    return {f"{c}_edge": F.concat(F.lit("t"), _edge(c)) for c in columns}


def _key(table: DataFrame) -> list[str]:
    return [*KEY, "metric"] if "metric" in table.columns else KEY


PUBLISHED = "_published"
PUBLISHED_SCHEMA = "sequence long, run string, label string, tables array<string>"
SCRATCH = "_scratch"
# Attempts to get a place in the sequence, each lost to another run that got it first.
PUBLISH_ATTEMPTS = 100


@dataclass(frozen=True)
class Store:
    """``upto`` pins a reader to the runs up to that place in the sequence; see ``snapshot``."""

    root: str
    upto: int | None = None

    def begin(self, label: str | None = None) -> Run:
        """A run, whose tables nobody sees before it is published. A ``label`` says what it did."""
        return Run(self, label)

    def write(self, df: DataFrame, table: str, keys: DataFrame | None = None) -> None:
        """A run of one table."""
        run = self.begin()
        run.write(df, table, keys)
        run.publish(df.sparkSession)

    def published(self, spark: SparkSession) -> list[Row]:
        """(sequence, run, label, tables) of all published runs in order: one small file each."""
        folder = _path(spark, f"{self.root}/{PUBLISHED}")
        if not folder.getFileSystem(_conf(spark)).exists(folder):
            return []
        notes = spark.read.schema(PUBLISHED_SCHEMA).json(f"{self.root}/{PUBLISHED}").collect()
        return sorted((r for r in notes if self.upto is None or r.sequence <= self.upto), key=lambda r: r.sequence)

    def snapshot(self, spark: SparkSession) -> Store:
        """The store as it is now: tables read one after the other belong together."""
        runs = self.published(spark)
        return Store(self.root, runs[-1].sequence if runs else 0)

    def compact(self, spark: SparkSession, table: str, target: Store) -> None:
        """Write the current rows of a table to another store, without what runs have replaced."""
        target.write(self.read(spark, table), table)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return self._current(spark, table, spark.read.parquet(f"{self.root}/{table}"))

    def within(self, spark: SparkSession, table: str, start: datetime, end: datetime) -> DataFrame:
        """Rows whose window lies in ``[start, end]``; other windows are pruned unread."""
        return self._current(spark, table, _within(spark.read.parquet(f"{self.root}/{table}"), start, end))

    def metric(self, spark: SparkSession, name: str, start: datetime, end: datetime) -> DataFrame:
        """The stored values of one metric for the windows inside ``[start, end]``."""
        return lookup(self.within(spark, "metric_values", start, end), name, start, end)

    def rows(self, spark: SparkSession, table: str, schema: str) -> DataFrame:
        """The rows of all published runs of a table of ``Run.append``, with their ``_sequence``. The schema
        is given, as runs may have had no rows, or none may have been published."""
        if not any(table in r.tables for r in self.published(spark)):
            return spark.createDataFrame([], f"{schema}, _sequence long")
        stored = spark.read.schema(f"{schema}, run string").parquet(f"{self.root}/{table}")
        return stored.join(self._order(spark, table), "run").drop("run")

    def _order(self, spark: SparkSession, table: str) -> DataFrame:
        runs = [(r.sequence, r.run) for r in self.published(spark) if table in r.tables]
        return spark.createDataFrame(runs, "_sequence long, run string")

    def _current(self, spark: SparkSession, table: str, stored: DataFrame) -> DataFrame:
        """The rows of the last published run of each key. The runs are listed by the driver, one
        short row each, and joined as a table, whose size Spark knows."""
        stored, key = stored.join(self._order(spark, table), "run"), _key(stored)
        newest = stored.groupBy(*key).agg(F.max("_sequence").alias("_sequence"))
        return _without_markers(stored.join(newest, [*key, "_sequence"], "left_semi").drop("_sequence"))


@dataclass(frozen=True)
class Run:
    """Tables that are written one by one and published together. If it ends before, readers stay
    on what was there."""

    store: Store
    label: str | None = None
    name: str = field(default_factory=lambda: f"r{uuid.uuid4().hex}")
    tables: dict[str, None] = field(default_factory=dict)

    def write(self, df: DataFrame, table: str, keys: DataFrame | None = None) -> None:
        """Replace the rows of every key found in ``df``; other keys are left alone. ``keys``
        lists the keys of the run: one that has no rows (any more) gets a marker row without
        key values beyond these, which replaces what an earlier run left there and which
        readers skip.

        Rows are spread by window before writing. ``rebalance`` lets adaptive execution join
        small windows in a task and cut one with very many rows into several tasks and files."""
        df = df.withColumn("_marker", F.lit(False))
        if keys is not None:
            marked = keys.select(*KEY).withColumn("_marker", F.lit(True))
            df = df.unionByName(marked, allowMissingColumns=True)
        by = ["lower_edge", "upper_edge", "run"]
        keyed = df.withColumns({**_strings("lower", "upper"), "run": F.lit(self.name)})
        order = [*by, *[c for c in _key(df) if c not in ("lower", "upper")]]
        (
            keyed.hint("rebalance", F.col("lower_edge"), F.col("upper_edge"))
            .sortWithinPartitions(*order)
            .write.mode("append")
            .partitionBy(*by)
            .parquet(f"{self.store.root}/{table}")
        )
        self.tables[table] = None

    def append(self, df: DataFrame, table: str) -> None:
        """Add rows without window to a table whose runs add up; see ``Store.rows``."""
        df.withColumn("run", F.lit(self.name)).write.mode("append").partitionBy("run").parquet(f"{self.store.root}/{table}")
        self.tables[table] = None

    def scratch(self, df: DataFrame, name: str) -> DataFrame:
        """A frame written beside the tables and read back: for what several steps of the run share. It
        goes when the run is published."""
        path = f"{self.store.root}/{SCRATCH}/{self.name}/{name}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def own(self, spark: SparkSession, table: str, start: datetime, end: datetime) -> DataFrame:
        """The rows that this run has written, for its later steps."""
        stored = spark.read.parquet(f"{self.store.root}/{table}")
        return _without_markers(_within(stored, start, end).filter(F.col("run") == self.name))

    def publish(self, spark: SparkSession) -> int:
        """Make all tables visible at once, and return the place of the run in the sequence. The note
        is written under a name of its own and renamed, which fails if that place is taken."""
        jvm = spark.sparkContext._jvm
        folder = f"{self.store.root}/{PUBLISHED}"
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, folder).toUri(), _conf(spark))
        no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        for _ in range(PUBLISH_ATTEMPTS):
            runs = Store(self.store.root).published(spark)
            sequence = runs[-1].sequence + 1 if runs else 1
            note = json.dumps({"sequence": sequence, "run": self.name, "label": self.label, "tables": list(self.tables)})
            # Names that start with an underscore are no data to Spark's readers.
            draft = _path(spark, f"{folder}/_{self.name}")
            out = draft.getFileSystem(_conf(spark)).create(draft, True)
            out.write(note.encode())
            out.close()
            try:
                files.rename(draft, _path(spark, f"{folder}/{sequence:012d}.json"), no_options)
                shared = _path(spark, f"{self.store.root}/{SCRATCH}/{self.name}")
                shared.getFileSystem(_conf(spark)).delete(shared, True)
                return sequence
            except Py4JJavaError as error:
                if "FileAlreadyExists" not in error.java_exception.toString():
                    raise
        raise RuntimeError(f"{self.name} found no free place in the sequence of {self.store.root}")


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _conf(spark: SparkSession):
    return spark.sparkContext._jsc.hadoopConfiguration()


def _within(stored: DataFrame, start: datetime, end: datetime) -> DataFrame:
    edges = [f"t{_edge_text(m)}" for m in (start, end)]
    return stored.filter(F.col("lower_edge").between(*edges) & F.col("upper_edge").between(*edges))


def _without_markers(stored: DataFrame) -> DataFrame:
    return stored.filter(~F.col("_marker")).drop("_marker", "run", "lower_edge", "upper_edge")


def lookup(values: DataFrame, name: str, start: datetime, end: datetime) -> DataFrame:
    return contained_in(values.filter(F.col("metric") == name), start, end)


def lookup_sum(values: DataFrame, name: str, start: datetime, end: datetime) -> DataFrame:
    """A stored metric added up over all windows inside ``[start, end]``."""
    return (
        lookup(values, name, start, end)
        .groupBy("company", "app", "metric", "grain", "platform", "payment_system")
        .agg(F.sum("value").alias("value"), F.count("*").alias("windows"))
    )


def metric_documents(values: DataFrame) -> DataFrame:
    """The nested form: one row per metric and window with ``result`` and, in name order, the
    platforms with their payment systems. Arrays hold one item per configured value.
    ``measured`` and ``users`` carry the sums and counts behind a ratio."""
    systems = F.sort_array(
        F.collect_list(
            F.when(
                F.col("grain") == "system",
                F.struct(
                    F.col("payment_system").alias("system"),
                    F.col("value").alias("res"),
                    F.col("numerator").alias("measured"),
                    F.col("denominator").alias("users"),
                ),
            )
        )
    )
    own = {
        name: F.max(F.when(F.col("grain") != "system", F.col(column)))
        for name, column in (("res", "value"), ("measured", "numerator"), ("users", "denominator"))
    }
    by_platform = values.groupBy(*KEY, "metric", "platform").agg(
        *[column.alias(name) for name, column in own.items()], systems.alias("payment_systems")
    )
    platform = F.struct("platform", "res", "measured", "users", "payment_systems")
    total = F.col("platform").isNull()
    return by_platform.groupBy(*KEY, "metric").agg(
        F.max(F.when(total, F.col("res"))).alias("result"),
        F.max(F.when(total, F.col("measured"))).alias("measured"),
        F.max(F.when(total, F.col("users"))).alias("users"),
        F.sort_array(F.collect_list(F.when(~total, platform))).alias("platforms"),
    )


def save_events(df: DataFrame, path: str) -> None:
    """Write a normalised purchase or session table, partitioned by tenant and day."""
    (
        df.withColumn("day", F.col("time").cast("date"))
        .hint("rebalance", F.col("company"), F.col("app"), F.col("day"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("company", "app", "day")
        .parquet(path)
    )


def load_events(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back a table of ``save_events``; windows prune its ``day`` partitions."""
    with_day = T.StructType([*schema.fields, T.StructField("day", T.DateType())])
    return spark.read.schema(with_day).parquet(path)
