"""Data-quality gates.

A gate is a DataFrame of violations. Reported, it is a query result; enforced, it
raises before anything is written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wattloom.operators import conform
from wattloom.operators.rollup import duplicate_keys

# Rows of one complete year per building, by layer.
YEAR_EXPECTATION = {
    "bronze": 35_040,
    "silver_15min": 35_040,
    "silver_hourly": 8_760,
    "silver_buildings": 1,
    "gold_daily": 365,
    "gold_monthly": 12,
    "gold_investigation": 12,
    "gold_accounts": 1,
}


class GateFailed(Exception):
    """A gate found violating rows; nothing was written."""


@dataclass(frozen=True)
class Gate:
    name: str
    violations: DataFrame

    def enforce(self) -> None:
        """Raise if there is any violating row. Stops at the first few found."""
        found = self.violations.limit(3).collect()
        if found:
            raise GateFailed(f"{self.name}: " + "; ".join(str(r.asDict()) for r in found))


@dataclass(frozen=True)
class Check:
    """A gate on single rows: those that fulfil ``violated`` must not be there."""

    name: str
    violated: Column


class Counted:
    """Row checks counted by the job that writes the rows, in place of a pass of their own.

    Put them on the rows as they are written. A lost executor may then count a row twice,
    never miss one, and the gate only asks whether there is any.
    """

    def __init__(self, checks: Sequence[Check]):
        self.checks = list(checks)
        self.observation = Observation() if self.checks else None

    def over(self, df: DataFrame) -> DataFrame:
        if self.observation is None:
            return df
        counts = [F.count_if(c.violated).alias(f"c{i}") for i, c in enumerate(self.checks)]
        return df.observe(self.observation, *counts)

    def enforce(self) -> None:
        """Raise if the finished job counted any violating row."""
        if self.observation is None:
            return
        found = self.observation.get
        # Spark leaves the counts out where it knows without a job that there are no rows.
        counts = {c.name: found.get(f"c{i}", 0) for i, c in enumerate(self.checks)}
        failed = [f"{name}: {n} rows" for name, n in counts.items() if n]
        if failed:
            raise GateFailed("; ".join(failed))


def exists_probe(df: DataFrame) -> bool:
    """Is there any row at all?"""
    return not df.isEmpty()


def probe_report(probes: dict[str, DataFrame]) -> DataFrame:
    """Whether each probe finds any row, as one plan that stops at the first hit."""
    flags = [
        df.limit(1)
        .agg((F.count("*") > 0).alias("found"))
        .select(F.lit(name).alias("probe"), "found")
        for name, df in probes.items()
    ]
    return reduce(DataFrame.unionByName, flags)


def _violated(df: DataFrame, check: Check) -> Gate:
    return Gate(check.name, df.filter(check.violated))


def no_rescued() -> Check:
    return Check("rescued rows", F.col("_rescued_data").isNotNull())


def whole_hours(intervals: int = 4) -> Check:
    return Check("incomplete hours", F.col("interval_count") != intervals)


def whole_days(hours: int = 24) -> Check:
    return Check("incomplete days", F.col("hours_present") != hours)


def rescued(bronze: DataFrame) -> Gate:
    return _violated(bronze, no_rescued())


def duplicates(df: DataFrame, keys: list[str]) -> Gate:
    return Gate("duplicate keys", duplicate_keys(df, keys))


def hours_complete(hourly: DataFrame, intervals: int = 4) -> Gate:
    return _violated(hourly, whole_hours(intervals))


def days_complete(daily: DataFrame, hours: int = 24) -> Gate:
    return _violated(daily, whole_days(hours))


def onboarding(candidates: DataFrame) -> Gate:
    return Gate("buildings without metadata or weather", conform.unmapped_buildings(candidates))


def weather_complete(located_hours: DataFrame, weather: DataFrame) -> Gate:
    """Hours that find no weather, and weather stamps that would fan rows out.

    Comparing row counts alone would let one lost and one doubled row cancel out.
    """
    lost = (
        conform.unmatched_weather(located_hours, weather)
        .groupBy("county_code", "source_hour_end")
        .agg(F.count("*").alias("rows"))
        .withColumn("problem", F.lit("hour without weather"))
    )
    doubled = (
        weather.groupBy("county_code", F.col("weather_timestamp").alias("source_hour_end"))
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") > 1)
        .withColumn("problem", F.lit("repeated weather stamp"))
    )
    return Gate("weather coverage", lost.unionByName(doubled))


def layer_check(
    counts: DataFrame, buildings: DataFrame, per_building: dict[str, int] | None = None
) -> DataFrame:
    """Actual against expected rows per layer, with PASS or FAIL.

    ``buildings`` has one row per building; the expectation of a layer is that
    count times its rows per building.
    """
    expected = counts.sparkSession.createDataFrame(
        list((per_building or YEAR_EXPECTATION).items()), "layer string, per_building bigint"
    )
    n = buildings.agg(F.count("*").alias("n")).scalar()
    return (
        F.broadcast(expected)
        .join(counts, "layer", "left")
        .select(
            "layer",
            F.coalesce("rows", F.lit(0)).alias("actual_rows"),
            (F.col("per_building") * n).alias("expected_rows"),
        )
        .withColumn(
            "status",
            F.when(F.col("actual_rows") == F.col("expected_rows"), F.lit("PASS")).otherwise(
                F.lit("FAIL")
            ),
        )
    )


def layers_complete(
    counts: DataFrame, buildings: DataFrame, per_building: dict[str, int] | None = None
) -> Gate:
    report = layer_check(counts, buildings, per_building)
    return Gate("layer counts", report.filter(F.col("status") != "PASS"))


def same_counts(published: DataFrame, layers: DataFrame) -> DataFrame:
    """Published against stored row counts per dataset, with PASS or FAIL."""
    return (
        layers.withColumnRenamed("rows", "expected_rows")
        .join(published.withColumnRenamed("rows", "actual_rows"), "layer", "left")
        .select(
            "layer",
            F.coalesce("actual_rows", F.lit(0)).alias("actual_rows"),
            "expected_rows",
        )
        .withColumn(
            "status",
            F.when(F.col("actual_rows") == F.col("expected_rows"), F.lit("PASS")).otherwise(
                F.lit("FAIL")
            ),
        )
    )


def not_current(served: DataFrame, metadata: DataFrame, key: str = "snapshot_id") -> Gate:
    """Served rows whose creation stamp is not the published snapshot's."""
    stamps = metadata.select(key, F.col("created_at_utc").alias("published_at_utc"))
    joined = served.join(stamps, key, "left")
    stale = ~F.col("created_at_utc").eqNullSafe(F.col("published_at_utc"))
    return Gate("stale answers", joined.filter(stale))


def compare_tolerance(
    actual: DataFrame, expected: DataFrame, keys: list[str], tolerances: dict[str, float]
) -> DataFrame:
    """Per key and measure: actual, expected, and whether they are close enough.

    A null is close only to a null.
    """
    left = actual.select(*keys, *[F.col(m).alias(f"a_{m}") for m in tolerances])
    right = expected.select(*keys, *[F.col(m).alias(f"e_{m}") for m in tolerances])
    pairs = [
        F.struct(
            F.lit(m).alias("measure"),
            F.col(f"a_{m}").cast("double").alias("actual"),
            F.col(f"e_{m}").cast("double").alias("expected"),
            F.lit(tol).alias("tolerance"),
        )
        for m, tol in tolerances.items()
    ]
    rows = left.join(right, keys, "full_outer").select(
        *keys, F.inline(F.array(*pairs))
    )
    near = F.abs(F.col("actual") - F.col("expected")) <= F.col("tolerance")
    return rows.withColumn(
        "within",
        F.coalesce(near, F.col("actual").isNull() & F.col("expected").isNull()),
    ).drop("tolerance")
