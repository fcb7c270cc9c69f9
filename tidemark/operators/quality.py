"""Checks on landed rows: the wire contract, landing health and value mixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schemas import EVENT_FIELDS, EXPECTED_MIX, READING_ID_RANGE, SEVERITIES, SPIKE_RATE, TEMPERATURE_RANGE


def _violations(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One pass over ``rows``; a rule that evaluates to NULL counts as broken."""
    broken = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()]
    counted = rows.agg(F.count(F.lit(1)).alias("rows_checked"), *broken)
    return counted.unpivot("rows_checked", list(rules), "rule", "violations").select(
        "rule", "rows_checked", "violations"
    )


def telemetry_contract(readings: DataFrame) -> DataFrame:
    """Violations per rule of the telemetry message contract."""
    return _violations(
        readings,
        {
            "temperature_in_range": F.col("temperature").between(*TEMPERATURE_RANGE),
            "reading_id_in_range": F.col("reading_id").between(*READING_ID_RANGE),
            "event_time_present": F.col("event_time").isNotNull(),
            "device_id_present": F.col("device_id").isNotNull(),
        },
    )


def event_contract(events: DataFrame) -> DataFrame:
    """Violations per rule of the sparse-union contract of events."""

    def carries(present: bool, kind: str) -> Column:
        holds = F.lit(True)
        for column in EVENT_FIELDS[kind]:
            holds = holds & (F.col(column).isNotNull() if present else F.col(column).isNull())
        return holds

    rules = {
        "event_type_known": F.col("event_type").isin(*EVENT_FIELDS),
        "severity_known": F.col("severity").isin(*SEVERITIES),
    }
    for kind in EVENT_FIELDS:
        is_kind = F.col("event_type") == kind
        rules[f"{kind}_fields_present"] = ~is_kind | carries(True, kind)
        rules[f"{kind}_fields_exclusive"] = is_kind | carries(False, kind)
    return _violations(events, rules)


def landing_health(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """The symptoms of a broken landing as one row.

    ``timestamps_lost``: every event_time is NULL, so the wire format differs.
    ``dimension_missing``: no reading found its device, so the dimension was empty.
    ``windows_missing``: readings exist but no window has been written.
    """
    some = F.col("readings") > 0
    return (
        silver.agg(
            F.count(F.lit(1)).alias("readings"),
            F.count_if(F.col("event_time").isNull()).alias("null_event_time"),
            F.count_if(F.col("temp_threshold").isNull()).alias("null_threshold"),
        )
        .withColumn("windows", gold.agg(F.count(F.lit(1))).scalar())
        .withColumn("timestamps_lost", some & (F.col("null_event_time") == F.col("readings")))
        .withColumn("dimension_missing", some & (F.col("null_threshold") == F.col("readings")))
        .withColumn("windows_missing", some & (F.col("windows") == 0))
    )


def unmatched_devices(readings: DataFrame, dim: DataFrame) -> DataFrame:
    """Devices that send readings but are not in the dimension, with their reading counts."""
    counts = readings.groupBy("device_id").agg(F.count(F.lit(1)).alias("readings"))
    return counts.join(dim.select("device_id"), "device_id", "left_anti")


def device_coverage(readings: DataFrame, dim: DataFrame) -> DataFrame:
    """Every device on either side, with its dimension row and its reading count."""
    counts = readings.groupBy("device_id").agg(F.count(F.lit(1)).alias("readings"))
    return dim.join(counts, "device_id", "full").withColumn(
        "readings", F.coalesce("readings", F.lit(0).cast("bigint"))
    )


def type_mix(events: DataFrame) -> DataFrame:
    """Share of each event type."""
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.round(F.lit(100.0) * F.col("n") / total, 2))


def rate_profile(silver: DataFrame) -> DataFrame:
    """Anomaly and vibration-spike rates per threshold, to set against the expected rates."""
    return silver.groupBy("temp_threshold").agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_if("anomaly_flag").alias("anomalies"),
        F.count_if("vibration_spike").alias("spikes"),
    )



# ---- measured against expected ----

# The Chebyshev fit of the complementary error function in Numerical Recipes, good to 1.2e-7 of its value.
ERFC = (
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
)


def erfc(x: Column) -> Column:
    """Complementary error function of a number that is not negative."""
    t = 1.0 / (1.0 + 0.5 * x)
    series = F.lit(ERFC[-1])
    for c in reversed(ERFC[:-1]):
        series = series * t + c
    return t * F.exp(-x * x + series)


def two_sided(deviations: Column) -> Column:
    """How probable it is that a normal number is at least so many deviations off."""
    return erfc(F.abs(deviations) / F.sqrt(F.lit(2.0)))


def chi_square_tail(statistic: Column, freedom: int) -> Column:
    """How probable a chi-square number of ``freedom`` degrees is to be at least ``statistic``."""
    half = statistic / 2.0
    if freedom % 2:
        tail, term = erfc(F.sqrt(half)), F.sqrt(half) * F.exp(-half) / F.lit(0.886226925452758)
        orders = [k - 0.5 for k in range(1, (freedom + 1) // 2)]
    else:
        tail, term = F.exp(-half), half * F.exp(-half)
        orders = [float(k) for k in range(1, freedom // 2)]
    for order in orders:
        tail, term = tail + term, term * half / (order + 1.0)
    return tail


def type_mix_fit(events: DataFrame, expected: dict[str, float] | None = None) -> DataFrame:
    """One row: how far the mix of event types is from the expected one, and how probable that is by chance.

    ``n``, ``unexpected`` (events of no expected type), ``chi_square`` over the expected types and its ``p_value``. Any
    unexpected event makes the probability 0. One aggregate; without events there is nothing to refuse.
    """
    expected = expected or EXPECTED_MIX
    counts = {kind: F.count_if(F.col("event_type") == kind).cast("double") for kind in expected}
    known = F.count_if(F.coalesce(F.col("event_type").isin(*expected), F.lit(False)))
    n = F.count(F.lit(1))
    off = sum(((counts[k] - known * F.lit(share)) ** 2 / (known * F.lit(share)) for k, share in expected.items()), F.lit(0.0))
    found = events.agg(n.alias("n"), (n - known).alias("unexpected"), F.when(known > 0, off).otherwise(0.0).alias("chi_square"))
    tail = chi_square_tail(F.col("chi_square"), len(expected) - 1)
    return found.withColumn("p_value", F.when(F.col("unexpected") > 0, 0.0).otherwise(tail))


def rate_fit(silver: DataFrame) -> DataFrame:
    """Anomalies and spikes per threshold beside what uniform temperatures and the spike rate lead to.

    A row per threshold and rate: ``n`` readings that have the flag, ``hits``, the ``expected`` share, by how many
    ``deviations`` of a binomial number the hits are off, and the ``p_value`` of that (normal approximation). A share
    of 0 or 1 leaves no room: any other count is impossible.
    """
    low, high = TEMPERATURE_RANGE
    over = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.lit(high) - F.col("temp_threshold")) / F.lit(high - low)))
    counted = silver.where("temp_threshold IS NOT NULL").groupBy("temp_threshold").agg(
        F.count("anomaly_flag").alias("n_anomaly"), F.count_if("anomaly_flag").alias("hits_anomaly"),
        F.count("vibration_spike").alias("n_spike"), F.count_if("vibration_spike").alias("hits_spike"),
    )
    rates = F.array(*[
        F.struct(F.lit(name).alias("rate"), F.col(f"n_{name}").alias("n"), F.col(f"hits_{name}").alias("hits"), share.alias("expected"))
        for name, share in (("anomaly", over), ("spike", F.lit(SPIKE_RATE)))
    ])
    rows = counted.select("temp_threshold", F.inline(rates))
    wanted, spread = F.col("n") * F.col("expected"), F.col("n") * F.col("expected") * (1.0 - F.col("expected"))
    rows = rows.withColumn("deviations", F.when(spread > 0, (F.col("hits") - wanted) / F.sqrt(spread)))
    sure = F.when(F.col("hits") == wanted, 1.0).otherwise(0.0)
    return rows.withColumn("p_value", F.when(F.col("deviations").isNull(), sure).otherwise(two_sided(F.col("deviations"))))
