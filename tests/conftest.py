import sys
from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from spendlens.operators.tenants import Tenants  # noqa: E402
from spendlens.schema import PURCHASES, SESSIONS  # noqa: E402
from spendlens.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
GOLDEN = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "spendlens-tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def local_table(spark, rows, schema):
    """A small table held by the driver as one local relation."""
    columns = list(zip(*rows)) or [[] for _ in schema.fields]
    arrays = [pa.array(list(c), to_arrow_type(f.dataType)) for c, f in zip(columns, schema.fields)]
    return spark.createDataFrame(pa.table(arrays, names=schema.fieldNames()), schema)


def at(text):
    return datetime.fromisoformat(text)


def make_purchases(spark, rows):
    """rows: (id, user, time, platform, payment system[, price])"""
    data = [
        ("c", "a", r[0], r[1], float(r[5]) if len(r) > 5 else 1.0, at(r[2]) if isinstance(r[2], str) else r[2], r[3], r[4])
        for r in rows
    ]
    return local_table(spark, data, PURCHASES)


def make_sessions(spark, rows):
    """rows: (id, user, time, platform)"""
    data = [("c", "a", r[0], r[1], at(r[2]) if isinstance(r[2], str) else r[2], r[3]) for r in rows]
    return local_table(spark, data, SESSIONS)


def make_tenants(spark, platforms=("Android", "iOS"), systems=(1, 2)):
    schema = T._parse_datatype_string("company string, app string, platforms array<string>, payment_systems array<int>")
    frame = local_table(spark, [("c", "a", list(platforms), list(systems))], schema)
    return Tenants.of(frame)


def shown(df):
    """Rows as sorted text; the last digits of a sum of doubles depend on the order of its rows."""
    columns = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in sorted(df.dtypes)]
    return sorted(map(str, df.select(*columns).collect()))


def cells(values):
    """(metric, platform, payment system) -> value"""
    return {(r.metric, r.platform, r.payment_system): r.value for r in values.collect()}
