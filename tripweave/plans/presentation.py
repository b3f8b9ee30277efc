"""Reading order of the reports, and the two look-ups readers run most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sort order of each report.
READING_ORDER = {
    "gold_daily_kpis": ("pickup_date",),
    "gold_peak_hours_analysis": ("is_weekend", "pickup_hour"),
    "gold_route_performance": ("trip_count",),
    "gold_customer_segments": ("total_revenue",),
    "gold_revenue_breakdown": ("pickup_date", "time_of_day", "payment_type_name"),
}
LARGEST_FIRST = ("gold_route_performance", "gold_customer_segments")


def in_reading_order(df: DataFrame, dataset: str) -> DataFrame:
    """``df`` sorted the way ``dataset`` is read; other datasets stay as they are."""
    if dataset not in READING_ORDER:
        return df
    ascending = dataset not in LARGEST_FIRST
    return df.orderBy(*READING_ORDER[dataset], ascending=ascending)


def latest_days(kpis: DataFrame, days: int = 7) -> DataFrame:
    """The last ``days`` rows by pickup date, latest first."""
    return kpis.orderBy(F.desc("pickup_date")).limit(days)


def quality_trend(pass_rates: DataFrame) -> DataFrame:
    """Pass rates and drops, latest check first."""
    columns = ("date", "pass_rate_percentage", "records_dropped")
    return pass_rates.select(*columns).orderBy(F.desc("date"))
