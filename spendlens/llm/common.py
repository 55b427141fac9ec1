"""Tables in the shared folder, connected components and column helpers of the operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a local one only where it is unset, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="spendlens-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read again: cuts the lineage and survives the
    loss of executors."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/spendlens/{name}-{uuid.uuid4().hex}"
    schema = frame.schema
    frame.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def packed_columns(frame: DataFrame, without: Iterable[str] = ()) -> Column:
    """The columns of a frame as one, `_row`, so that none can clash with derived ones."""
    return F.struct(*[F.col(f"`{c}`") for c in frame.columns if c not in without]).alias("_row")


def id_hash_mod(column: str, n: int) -> Column:
    """crc32 of the number's text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n


def components(edges: DataFrame) -> DataFrame:
    """The connected components of edges (a long, b long): one row (id, component) per end of an
    edge, where component is the smallest id reachable.

    Alternates two contractions until nothing changes: each vertex hands its larger neighbours,
    then its smaller ones, the smallest vertex that it knows. Both are a grouped minimum, combined
    before the shuffle, and a join that adaptive execution can split, so hubs do no harm."""
    current = stored(_directed(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "edges")
    mark = _fingerprint(current)
    while mark[0]:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_directed(_hand_over(both, F.col("v") > F.col("u"))), "large-star")
        current = stored(_directed(_hand_over(large, F.lit(True), smallest_too=True)), "small-star")
        after = _fingerprint(current)
        if after == mark:
            break
        mark = after
    roots = current.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    own = current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return roots.unionByName(own)


def _directed(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller end, without loops."""
    return (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u <> v")
        .distinct()
    )


def _hand_over(edges: DataFrame, which: Column, smallest_too: bool = False) -> DataFrame:
    smallest = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    handed = edges.filter(which).join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return handed.union(smallest.select("u", F.col("m").alias("v"))) if smallest_too else handed


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
    return row[0], row[1] or 0


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in the Python workers of the session, once per context."""
    context = spark.sparkContext
    if getattr(context, "_spendlens_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="spendlens-")) / "spendlens_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._spendlens_shipped = True
