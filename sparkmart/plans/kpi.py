"""Month-over-month KPI cards and formatted measures."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkmart.functions.numbers import compact_text, fixed, percent_text, ratio
from sparkmart.plans.measures import in_window, measure, payment_measure

MONEY = "R$ "


@dataclass(frozen=True)
class Card:
    """How one KPI is compared with its previous month.

    ``eligible``: ``positive`` months or ``any`` month with a value. ``change``: ``percent``,
    ``percent_abs`` (against the size of the previous value), ``points`` (percentage points) or
    ``score``. ``good``: the direction that counts as better, or ``neutral``. ``label``: ``money0``,
    ``money1``, ``count``, ``percent``, ``one`` or ``two`` decimals.
    """

    name: str
    eligible: str
    change: str
    good: str
    label: str


# One line per KPI of the report.
SALES_CARDS = (
    Card("total_revenue", "positive", "percent", "up", "money0"),
    Card("total_orders", "positive", "percent", "up", "count"),
    Card("avg_order_value", "positive", "percent", "up", "money1"),
    Card("avg_item_price", "positive", "percent", "up", "money1"),
    Card("avg_freight_value", "positive", "percent", "down", "money1"),
    Card("total_items_sold", "positive", "percent", "up", "count"),
    Card("freight_share", "any", "points", "down", "percent"),
    Card("on_time_delivery_rate", "any", "points", "up", "percent"),
    Card("avg_delivery_days", "positive", "percent", "down", "one"),
    Card("avg_sla_variance_days", "any", "percent_abs", "down", "one"),
    Card("avg_approval_hours", "positive", "percent", "down", "one"),
    Card("avg_last_mile_days", "positive", "percent", "down", "one"),
    Card("avg_review_score", "any", "score", "up", "two"),
    Card("unique_customers", "positive", "percent", "up", "count"),
    Card("review_submission_rate", "any", "points", "up", "percent"),
)
PAYMENT_CARDS = (
    Card("avg_credit_card_installments", "positive", "percent", "neutral", "one"),
    Card("credit_card_share", "any", "points", "up", "percent"),
)

_TEXT = {
    "money0": lambda c: compact_text(c, MONEY, 0),
    "money1": lambda c: compact_text(c, MONEY, 1),
    "count": lambda c: compact_text(c, "", 0),
    "percent": percent_text,
    "one": lambda c: fixed(c, 1),
    "two": lambda c: fixed(c, 2),
}


def _pick(cards: Sequence[Card], attribute: str, choices: dict[str, Column]) -> Column:
    """The expression that belongs to the card named in column ``kpi``."""
    result: Column | None = None
    for value, expression in choices.items():
        names = [c.name for c in cards if getattr(c, attribute) == value]
        if names:
            test = F.col("kpi").isin(names)
            result = F.when(test, expression) if result is None else result.when(test, expression)
    return result


def monthly_values(monthly: DataFrame, cards: Sequence[Card]) -> DataFrame:
    """Month table turned to one row per (KPI, eligible month)."""
    lines = [F.struct(F.lit(c.name).alias("kpi"), F.col(c.name).cast("double").alias("value")) for c in cards]
    long = monthly.select("year_month_key", "month_year_short", F.inline(F.array(*lines)))
    floor = [c.name for c in cards if c.eligible == "positive"]
    return long.where(F.col("value").isNotNull() & (~F.col("kpi").isin(floor) | (F.col("value") > 0)))


def compare_months(values: DataFrame, cards: Sequence[Card]) -> DataFrame:
    """One row per KPI: last eligible month against the one before it."""
    newest = Window.partitionBy("kpi").orderBy(F.desc("year_month_key"))
    ranked = values.select(
        "kpi",
        F.col("month_year_short").alias("cm_month"),
        F.col("value").alias("cm_value"),
        F.lead("month_year_short").over(newest).alias("pm_month"),
        F.lead("value").over(newest).alias("pm_value"),
        F.row_number().over(newest).alias("_rank"),
    ).where("_rank = 1")

    cm, pm = F.col("cm_value"), F.coalesce("pm_value", F.lit(0.0))
    rounded = F.round(cm, 3) - F.round(pm, 3)
    delta = _pick(cards, "change", {
        "percent": ratio(cm - pm, F.col("pm_value")),
        "percent_abs": ratio(cm - pm, F.abs("pm_value")),
        "points": rounded,
        "score": cm - pm,
    })
    moved = _pick(cards, "change", {
        "percent": cm - pm, "percent_abs": cm - pm, "points": rounded, "score": cm - pm,
    })
    size = F.coalesce(
        _pick(cards, "change", {
            "percent": percent_text(F.abs("delta")),
            "percent_abs": percent_text(F.abs("delta")),
            "points": F.concat(fixed(F.abs("delta") * 100, 1), F.lit(" pp")),
            "score": F.concat(fixed(F.abs("delta"), 2), F.lit(" pt")),
        }),
        F.lit(""),
    )

    def sentiment(better: str, worse: str) -> Column:
        return F.when(cm - pm > 0, better).when(cm - pm < 0, worse).otherwise("neutral")

    compared = ranked.withColumn("delta", delta).withColumn(
        "direction", F.when(moved > 0, F.lit("up")).otherwise(F.lit("down"))
    )
    arrow = F.when(F.col("direction") == "up", F.lit("▲ ")).otherwise(F.lit("▼ "))

    def month_label(month: str, value: str) -> Column:
        formatted = _pick(cards, "label", {name: make(F.col(value)) for name, make in _TEXT.items()})
        return F.concat(F.col(month), F.lit(" · "), formatted)

    return compared.select(
        "kpi", "cm_month", "cm_value", "pm_month", "pm_value", "delta", "direction",
        _pick(cards, "good", {
            "up": sentiment("good", "bad"), "down": sentiment("bad", "good"), "neutral": F.lit("neutral"),
        }).alias("sentiment"),
        month_label("cm_month", "cm_value").alias("cm_label"),
        month_label("pm_month", "pm_value").alias("pm_label"),
        F.concat(arrow, size).alias("badge"),
    )


def kpi_cards(
    sales: DataFrame,
    payments: DataFrame,
    dim_date: DataFrame,
    window: tuple[int, int] = (201701, 201808),
) -> DataFrame:
    """One row per KPI over the purchase months of the window."""
    month = ["year_month_key", "month_year_short"]
    by_sales = measure(in_window(sales, dim_date, *window), [c.name for c in SALES_CARDS], month)
    by_payment = payment_measure(in_window(payments, dim_date, *window), [c.name for c in PAYMENT_CARDS], month)
    values = monthly_values(by_sales, SALES_CARDS).unionByName(monthly_values(by_payment, PAYMENT_CARDS))
    return compare_months(values, (*SALES_CARDS, *PAYMENT_CARDS))


def formatted_measures(totals: DataFrame) -> DataFrame:
    """Text forms of the seven headline measures, next to whatever they are grouped by."""
    money = ("total_revenue", "avg_order_value", "avg_item_price", "avg_freight_value")
    counts = ("total_orders", "total_items_sold", "unique_customers")
    texts = [compact_text(F.col(c).cast("double"), MONEY, 1).alias(f"{c}_formatted") for c in money]
    texts += [compact_text(F.col(c).cast("double"), "", 0).alias(f"{c}_formatted") for c in counts]
    rest = [c for c in totals.columns if c not in (*money, *counts)]
    return totals.select(*rest, *texts)
