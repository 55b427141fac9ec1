"""Raw documents of many tenants, one collection (a folder) per tenant and type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.functions.parsing import path_safe
from spendlens.operators.tenants import Tenants
from spendlens.schema import TENANT

# A catalogue of up to this many tenants also prunes the files that are read.
PRUNED_TENANTS = 1_000


def collection_name(company: Column, kind: str, app: Column) -> Column:
    """Fixed form: company, type and app, with spaces as underscores."""
    return F.concat_ws("_", path_safe(company), F.lit(kind), path_safe(app))


def read_collections(
    spark: SparkSession, root: str, kind: str, schema: T.StructType, tenants: Tenants, fmt: str = "json"
) -> DataFrame:
    """The documents of all collections ``<root>/{company}_{kind}_{app}`` of the known tenants, in one
    scan, with the columns ``company`` and ``app``. The tenant comes from the folder of the file, by
    the catalogue, since names may hold underscores themselves. Folders of unknown tenants are left
    out; with few known ones, their files are not even opened. There must be one collection of the
    kind at least. The result goes to ``normalize_purchases`` or ``normalize_sessions``."""
    folder = F.url_decode(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    rows = spark.read.format(fmt).schema(schema).load(f"{root}/*_{kind}_*")
    names = tenants.frame.select(*TENANT, collection_name(F.col("company"), kind, F.col("app")).alias("_collection"))
    if tenants.small:
        few = [r[0] for r in names.select("_collection").take(PRUNED_TENANTS + 1)]
        if len(few) <= PRUNED_TENANTS:
            rows = rows.filter(folder.isin(few))
        names = F.broadcast(names)
    named = rows.select(*schema.fieldNames(), folder.alias("_collection"))
    return named.join(names, "_collection").drop("_collection")
