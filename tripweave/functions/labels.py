"""Code tables and bands turned into readable labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label of each code; every other code, and NULL, is "Unknown".
PAYMENT_LABELS = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute"}
RATE_LABELS = {
    1: "Standard",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated",
    6: "Group Ride",
}
UNKNOWN = "Unknown"

# First hour, first hour after, label; any other hour is "Night".
DAY_PARTS = ((6, 12, "Morning"), (12, 18, "Afternoon"), (18, 22, "Evening"))

# Upper bound in miles (exclusive) and label.
ROUTE_LENGTHS = ((2, "Short Distance"), (5, "Medium Distance"), (10, "Long Distance"))

# Sunday and Saturday, counted from Sunday = 1.
WEEKEND_DAYS = (1, 7)


def first_match(cases: Sequence[tuple[Column, str]], default: str) -> Column:
    """Label of the first case that holds; a NULL condition does not hold."""
    (condition, label), *rest = cases
    chain = F.when(condition, F.lit(label))
    for condition, label in rest:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(default))


def code_label(code: str, labels: dict[int, str]) -> Column:
    """Label of a code column."""
    cases = " ".join(f"WHEN {key} THEN '{text}'" for key, text in labels.items())
    return F.expr(f"CASE {code} {cases} ELSE '{UNKNOWN}' END")


def day_part(hour: str) -> Column:
    bands = [((F.col(hour) >= lo) & (F.col(hour) < hi), text) for lo, hi, text in DAY_PARTS]
    return first_match(bands, "Night")


def route_length(miles: str) -> Column:
    bands = [(F.col(miles) < top, text) for top, text in ROUTE_LENGTHS]
    return first_match(bands, "Extra Long Distance")


def spending_segment(spend: str, tip_pct: str, trips: str) -> Column:
    """Premium, High Value, Budget or Standard, in this order of precedence."""
    spend_col = F.col(spend)
    return first_match(
        [
            ((spend_col > 30) & (F.col(tip_pct) > 15), "Premium"),
            ((spend_col > 20) & (F.col(trips) > 100), "High Value"),
            (spend_col < 10, "Budget"),
        ],
        "Standard",
    )


def holds(condition: Column) -> Column:
    """``condition`` as a plain boolean: NULL counts as false."""
    return F.coalesce(condition, F.lit(False))
