"""Scalar expressions: predicates, labels, bands, durations and ratios.

Everything here is a built-in Spark expression, so it stays in generated code
and its predicates reach the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0


@dataclass(frozen=True)
class StatusRules:
    """Which order statuses count as excluded and which as delivered."""

    excluded: tuple[str, ...] = ("canceled", "unavailable")
    delivered: str = "delivered"


DEFAULT_RULES = StatusRules()


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- predicates -----------------------------------------------------------


def is_eligible(rules: StatusRules = DEFAULT_RULES, status: Column | str = "order_status") -> Column:
    return ~_col(status).isin(*rules.excluded)


def is_delivered(
    rules: StatusRules = DEFAULT_RULES,
    status: Column | str = "order_status",
    delivered_at: Column | str = "order_delivered_customer_date",
) -> Column:
    return (_col(status) == rules.delivered) & _col(delivered_at).isNotNull()


def is_late(
    delivered_at: Column | str = "order_delivered_customer_date",
    promised_at: Column | str = "order_estimated_delivery_date",
) -> Column:
    """NULL when either timestamp is missing."""
    return _col(delivered_at) > _col(promised_at)


def same_state_flag(left: Column | str, right: Column | str) -> Column:
    """'yes' on equality; a missing state counts as 'no'."""
    return F.when(_col(left) == _col(right), "yes").otherwise("no")


# --- arithmetic -----------------------------------------------------------


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL for a zero denominator."""
    bottom = denominator.cast("double")
    return numerator.cast("double") / F.when(bottom != 0, bottom)


def percent(numerator: Column, denominator: Column) -> Column:
    bottom = denominator.cast("double")
    return F.lit(100.0) * numerator.cast("double") / F.when(bottom != 0, bottom)


def mean(value: Column | str) -> Column:
    """Average as exact sum over count: decimal input gives the same double
    whatever the order of addition."""
    value = _col(value)
    return ratio(F.sum(value), F.count(value))


def mean_where(value: Column | str, condition: Column) -> Column:
    return mean(F.when(condition, _col(value)))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def money(value: Column, digits: int = 2) -> Column:
    """Half-up rounding in decimal arithmetic, reported as double."""
    return F.round(value, digits).cast("double")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Fractional days from ``start`` to ``end``."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)).cast("double") / F.lit(MICROS_PER_DAY)


def nan_to_null(value: Column | str) -> Column:
    value = _col(value)
    return F.when(~F.isnan(value), value)


def blank_to_null(value: Column | str) -> Column:
    value = _col(value)
    return F.when(value != "", value)


# --- calendar -------------------------------------------------------------


def month_start(ts: Column | str) -> Column:
    return F.trunc(_col(ts).cast("date"), "month")


def iso_weekday(ts: Column | str) -> Column:
    """1 = Monday … 7 = Sunday."""
    return (F.weekday(_col(ts).cast("date")) + 1).cast("int")


def day_name(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "EEEE")


def calendar_columns(ts: Column | str) -> dict[str, Column]:
    ts = _col(ts)
    return {
        "purchase_year": F.year(ts),
        "purchase_month": F.month(ts),
        "purchase_year_month": month_start(ts),
        "purchase_day_of_week": day_name(ts),
        "purchase_hour": F.hour(ts),
    }


def duration_columns(purchased: Column | str, delivered: Column | str, promised: Column | str) -> dict[str, Column]:
    delay = days_between(promised, delivered)
    return {
        "delivery_days": days_between(purchased, delivered),
        "estimated_delivery_days": days_between(purchased, promised),
        "delivery_delay_days": delay,
        "is_late_delivery": delay > 0,
    }


# --- labels and bands -----------------------------------------------------


def category_label(
    english: Column | str = "product_category_name_english",
    native: Column | str = "product_category_name",
) -> Column:
    return F.coalesce(_col(english), _col(native), F.lit("unknown"))


def delivery_status(rules: StatusRules = DEFAULT_RULES) -> Column:
    return F.when(is_delivered(rules), F.when(is_late(), "late").otherwise("on_time_or_early"))


def ladder(value: Column, edges: Sequence[float], labels: Sequence[object]) -> Column:
    """Right-closed bands: first label for ``value <= edges[0]``, last above all.
    NULL stays NULL."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    out = F.when(value <= F.lit(edges[0]), F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:]):
        out = out.when(value <= F.lit(edge), F.lit(label))
    return out.when(value.isNotNull(), F.lit(labels[-1]))


DELAY_EDGES = (0.0, 3.0, 7.0)
# Fixed label sets of the two reports that band the delivery delay.
DELAY_LABELS_SQL = ("on_time_or_early", "1_to_3_days_late", "4_to_7_days_late", "more_than_7_days_late")
DELAY_LABELS_CHART = ("On time/early", "1–3 days late", "4–7 days late", ">7 days late")
INSTALLMENT_EDGES = (1, 3, 6, 12)
INSTALLMENT_LABELS = ("1", "2-3", "4-6", "7-12", "13+")


def delay_band(delay_days: Column | str, labels: Sequence[str] = DELAY_LABELS_SQL) -> Column:
    return ladder(_col(delay_days), DELAY_EDGES, labels)


def delay_band_order(delay_days: Column | str) -> Column:
    return ladder(_col(delay_days), DELAY_EDGES, (0, 1, 2, 3))


def punctuality(delay_days: Column | str) -> Column:
    """More than a day early, within the last day before the promise, or late."""
    value = _col(delay_days)
    return F.when(value < -1, "early").when(value <= 0, "on_time").when(value > 0, "late")


def installment_band(installments: Column | str) -> Column:
    value = _col(installments)
    return F.coalesce(ladder(value, INSTALLMENT_EDGES, INSTALLMENT_LABELS), F.lit(INSTALLMENT_LABELS[-1]))


def customer_type(order_count: Column | str) -> Column:
    return F.when(_col(order_count) > 1, "Repeat").otherwise("One-time")


def risk_label(probability: Column | str, threshold: float) -> Column:
    p = _col(probability)
    return F.when(p >= threshold, "HIGH").when(p >= threshold / 2, "MEDIUM").otherwise("LOW")


def zip_region(prefix: Column | str) -> Column:
    return F.floor(_col(prefix) / 1000).cast("int")


def equal_width_bucket(value: Column | str, low: float, high: float, buckets: int) -> Column:
    """0 below ``low``, ``buckets + 1`` from ``high`` on."""
    return F.width_bucket(_col(value).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(buckets)).cast("int")
