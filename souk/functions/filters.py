"""The filters shared by all dashboard queries."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.times import at

# fixed values: day counts of the dashboard's date presets
PRESET_DAYS = {"Last 7d": 7, "Last 30d": 30, "Last 90d": 90}
CUSTOM_PRESET = "Custom"


def dashboard_filter(
    orders: DataFrame,
    *,
    city: str | None = None,
    category: str | None = None,
    date_from: str | date | None = None,
    date_to: str | date | None = None,
    inclusive_end: bool = False,
    ts: str = "timestamp",
) -> DataFrame:
    """Keep the rows that meet all given conditions; None and "" mean "not given".

    ``date_to`` is compared with midnight, so the rows of that day are outside unless
    ``inclusive_end`` is set.
    """
    wanted: list[Column] = []
    if city:
        wanted.append(F.col("city") == city)
    if category:
        wanted.append(F.col("category") == category)
    if date_from:
        wanted.append(F.col(ts) >= at(orders, ts, str(date_from)))
    if date_to:
        end = at(orders, ts, str(date_to))
        wanted.append(
            F.col(ts) < end + F.expr("INTERVAL 1 DAY") if inclusive_end else F.col(ts) <= end
        )
    return orders.filter(reduce(Column.__and__, wanted)) if wanted else orders


def date_preset(
    preset: str | None,
    *,
    as_of: date | None = None,
    custom: tuple[str | None, str | None] = (None, None),
) -> dict[str, str | None]:
    """The ``date_from`` / ``date_to`` arguments behind a preset button."""
    if not preset:
        return {"date_from": None, "date_to": None}
    if preset == CUSTOM_PRESET:
        if not all(custom):
            raise ValueError("a custom range needs both ends")
        return {"date_from": custom[0], "date_to": custom[1]}
    today = as_of or datetime.now(timezone.utc).date()
    start = today - timedelta(days=PRESET_DAYS[preset])
    return {"date_from": start.isoformat(), "date_to": today.isoformat()}


def not_cancelled(orders: DataFrame, status: str = "order_status") -> DataFrame:
    """Drop cancelled orders; a NULL status is dropped too, as in SQL's NOT IN."""
    return orders.filter(~F.col(status).isin("cancelled"))


def name_contains(df: DataFrame, column: str, text: str) -> DataFrame:
    """Case-insensitive substring match."""
    return df.filter(F.lower(F.col(column)).contains(text.lower()))
