"""The tenant catalogue: one row per company and app, with the platforms and payment systems
that are configured for it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.operators.windows import Windows
from spendlens.schema import TENANT

# The catalogue is broadcast up to this many rows and this many configured values; a larger
# one is joined with a shuffle, where adaptive execution splits a tenant that is too large.
BROADCAST_ROWS = 20_000
BROADCAST_VALUES = 200_000


def build_catalogue(companies: DataFrame, settings: DataFrame) -> DataFrame:
    """Companies with their app lists, joined to the settings of each app. An app without settings,
    or with null ones, has empty lists: its reports show the total only. Of several settings of one
    app the greatest count, by platforms, then by payment systems."""
    apps = companies.select(F.col("name").alias("company"), F.explode("apps").alias("app")).distinct()
    configured = settings.groupBy(*TENANT).agg(F.max(F.struct("appType", "paymentSystems")).alias("set"))
    known = apps.join(configured, TENANT, "left").select(
        *TENANT,
        F.array_distinct("set.appType").alias("platforms"),
        F.array_distinct("set.paymentSystems").alias("payment_systems"),
    )
    return _without_nulls(known)


def _without_nulls(catalogue: DataFrame) -> DataFrame:
    lists = ("platforms", "payment_systems")
    return catalogue.withColumns({c: F.coalesce(F.array_compact(c), F.array()) for c in lists})


@dataclass(frozen=True)
class Tenants:
    """``frame`` has the columns company, app, platforms, payment_systems; unique by tenant."""

    frame: DataFrame
    small: bool

    @classmethod
    def of(cls, frame: DataFrame) -> Tenants:
        """Measure the catalogue (reading no more than the limit) and keep what was found."""
        frame = _without_nulls(frame.select(*TENANT, "platforms", "payment_systems"))
        values = F.size("platforms") + F.size("payment_systems")
        sizes = [row.n for row in frame.select(values.alias("n")).take(BROADCAST_ROWS + 1)]
        small = len(sizes) <= BROADCAST_ROWS and sum(sizes) <= BROADCAST_VALUES
        return cls(frame, small)

    def join(self, df: DataFrame, how: str = "inner") -> DataFrame:
        """Join with the catalogue, which is broadcast only where it was measured. Otherwise the
        key is packed into one column, so that later steps keyed by company and app do not
        inherit the partitioning of the join: they bring an exchange, and adaptive execution can
        split a large tenant here."""
        if self.small:
            return df.join(F.broadcast(self.frame), TENANT, how)
        packed = F.struct(*TENANT)
        catalogue = self.frame.withColumn("_tenant", packed).drop(*TENANT)
        return df.withColumn("_tenant", packed).join(catalogue, "_tenant", how).drop("_tenant")

    def known(self, df: DataFrame) -> DataFrame:
        return self.join(df, "left_semi")

    def keys(self, windows: Windows) -> DataFrame:
        return self.frame.select(*TENANT, F.inline(windows.array()))

    def flag(self, df: DataFrame) -> DataFrame:
        """Keep rows of known tenants and add ``on_platform`` (and ``on_system`` for rows with a
        payment system): is the value configured for the tenant?"""
        flagged = self.join(df).withColumn(
            "on_platform", F.coalesce(F.array_contains("platforms", F.col("platform")), F.lit(False))
        )
        if "payment_system" in df.columns:
            flagged = flagged.withColumn(
                "on_system",
                F.coalesce(F.array_contains("payment_systems", F.col("payment_system")), F.lit(False)),
            )
        return flagged.drop("platforms", "payment_systems")

    def configured(self, df: DataFrame) -> DataFrame:
        """Only rows on a configured platform and, where they have one, payment system."""
        flagged = self.flag(df)
        flags = [c for c in ("on_platform", "on_system") if c in flagged.columns]
        for flag in flags:
            flagged = flagged.filter(flag)
        return flagged.drop(*flags)

    def grid(self, windows: Windows) -> DataFrame:
        """Every cell that a report must show, for zero filling: per tenant and window the
        total, each platform, and each payment system on each platform."""
        cells = F.flatten(
            F.transform(
                "platforms",
                lambda p: F.concat(
                    F.array(F.struct(p.alias("platform"), F.lit(None).cast("int").alias("payment_system"))),
                    F.transform(
                        "payment_systems",
                        lambda y: F.struct(p.alias("platform"), y.alias("payment_system")),
                    ),
                ),
            )
        )
        total = F.array(
            F.struct(
                F.lit(None).cast("string").alias("platform"), F.lit(None).cast("int").alias("payment_system")
            )
        )
        return (
            self.frame.select("*", F.inline(windows.array()))
            .withColumn("cell", F.explode(F.concat(total, cells)))
            .select(*TENANT, "lower", "upper", "cell.platform", "cell.payment_system")
        )
