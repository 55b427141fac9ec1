"""Column names and table schemas shared by the whole package.

All times are ``TIMESTAMP_NTZ`` holding UTC wall-clock time. Nothing in the package
depends on the session time zone, and comparisons with literals reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import types as T

TENANT = ["company", "app"]
WINDOW = ["lower", "upper"]
KEY = TENANT + WINDOW
USER_KEY = KEY + ["user_id"]
GRAIN_KEY = KEY + ["platform", "payment_system"]

# Raw documents are read as text throughout: numbers and nested documents keep the form in
# which they were written, and the column expressions in functions.parsing coerce them.
RAW_PURCHASES = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("userId", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("paymentSystem", T.StringType()),
        T.StructField("time", T.StringType()),
        T.StructField("device", T.StringType()),
    ]
)

RAW_SESSIONS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("userId", T.StringType()),
        T.StructField("startTime", T.StringType()),
        T.StructField("device", T.StringType()),
    ]
)

RAW_PROFILES = T.StructType(
    [
        T.StructField("userId", T.StringType()),
        T.StructField(
            "purchases",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("time", T.DoubleType()),
                        T.StructField("platform", T.StringType()),
                        T.StructField("paymentSystem", T.DoubleType()),
                    ]
                )
            ),
        ),
        T.StructField(
            "sessions",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("startTime", T.DoubleType()),
                        T.StructField("platform", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

RAW_COMPANIES = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("apps", T.ArrayType(T.StringType())),
    ]
)

RAW_APP_SETTINGS = T.StructType(
    [
        T.StructField("company", T.StringType()),
        T.StructField("app", T.StringType()),
        T.StructField("appType", T.ArrayType(T.StringType())),
        T.StructField("paymentSystems", T.ArrayType(T.IntegerType())),
    ]
)

PURCHASES = T.StructType(
    [
        T.StructField("company", T.StringType()),
        T.StructField("app", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("platform", T.StringType()),
        T.StructField("payment_system", T.IntegerType()),
    ]
)

SESSIONS = T.StructType(
    [
        T.StructField("company", T.StringType()),
        T.StructField("app", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("platform", T.StringType()),
    ]
)

METRIC_VALUES = T.StructType(
    [
        T.StructField("company", T.StringType()),
        T.StructField("app", T.StringType()),
        T.StructField("lower", T.TimestampNTZType()),
        T.StructField("upper", T.TimestampNTZType()),
        T.StructField("metric", T.StringType()),
        T.StructField("grain", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("payment_system", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("numerator", T.DoubleType()),
        T.StructField("denominator", T.DoubleType()),
    ]
)
