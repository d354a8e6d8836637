"""Business rules as Column functions over plain tables of values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------------------
# Results must carry exactly these labels and limits.
# ---------------------------------------------------------------------------

REGION_STATES = {
    "Southeast": ("SP", "RJ", "MG", "ES"),
    "South": ("PR", "SC", "RS"),
    "Central-West": ("MT", "MS", "GO", "DF"),
    "Northeast": ("BA", "PE", "CE", "MA", "PI", "RN", "PB", "SE", "AL"),
}
REGION_ELSE = "North"

# Sellers are grouped more coarsely than customers.
SELLER_REGIONS = ("Southeast", "South")
SELLER_REGION_ELSE = "Other"

# Upper limits, exclusive, in grams. A missing weight falls through.
SIZE_LIMITS = ((500, "Small"), (2000, "Medium"), (10000, "Large"))
SIZE_ELSE = "Extra Large"

# Lower limits, inclusive, in money. Missing revenue falls through.
SELLER_TIERS = ((100000, "Platinum"), (50000, "Gold"), (10000, "Silver"))
SELLER_TIER_ELSE = "Bronze"

CATEGORY_TIERS = (
    (1000000, "Tier 1 (Top)"),
    (100000, "Tier 2 (High)"),
    (10000, "Tier 3 (Medium)"),
)
CATEGORY_TIER_ELSE = "Tier 4 (Low)"

PAYMENT_LABELS = {
    "credit_card": "Credit Card",
    "boleto": "Boleto Bancario",
    "voucher": "Voucher",
    "debit_card": "Debit Card",
}

STATUS_LABELS = {
    "delivered": "Delivered",
    "shipped": "Shipped",
    "processing": "Processing",
    "canceled": "Canceled",
}
STATUS_CATEGORIES = {
    "Completed": ("delivered",),
    "In Progress": ("shipped", "processing", "invoiced", "approved", "created"),
    "Failed": ("canceled", "unavailable"),
}
STATUS_CATEGORY_ELSE = "Other"
TERMINAL_STATUSES = ("delivered", "canceled", "unavailable")

SENTIMENT_POSITIVE_FROM = 4
SENTIMENT_NEUTRAL = 3

WEEKEND_DAYS = (1, 7)  # 1 is Sunday

# ---------------------------------------------------------------------------


def _first_match(branches: Sequence[tuple[Column, object]], default: Column) -> Column:
    """First branch whose condition is true wins; unknown conditions do not match."""
    pairs = iter(branches)
    condition, value = next(pairs)
    chain = F.when(condition, value)
    for condition, value in pairs:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def _group_of(column: Column, groups: Mapping[str, Sequence[str]], default: str) -> Column:
    return _first_match(
        [(column.isin(*members), label) for label, members in groups.items()],
        F.lit(default),
    )


def _label_of(column: Column, labels: Mapping[str, str]) -> Column:
    """Known codes by table, others with a capital first letter."""
    return _first_match(
        [(column == code, label) for code, label in labels.items()], F.initcap(column)
    )


def region(state: Column) -> Column:
    return _group_of(state, REGION_STATES, REGION_ELSE)


def seller_region(state: Column) -> Column:
    coarse = {name: REGION_STATES[name] for name in SELLER_REGIONS}
    return _group_of(state, coarse, SELLER_REGION_ELSE)


def size_tier(weight_grams: Column) -> Column:
    return _first_match(
        [(weight_grams < limit, label) for limit, label in SIZE_LIMITS], F.lit(SIZE_ELSE)
    )


def _tier(amount: Column, tiers: Sequence[tuple[int, str]], default: str) -> Column:
    return _first_match([(amount >= floor, label) for floor, label in tiers], F.lit(default))


def seller_tier(revenue: Column) -> Column:
    return _tier(revenue, SELLER_TIERS, SELLER_TIER_ELSE)


def category_tier(revenue: Column) -> Column:
    return _tier(revenue, CATEGORY_TIERS, CATEGORY_TIER_ELSE)


def payment_label(payment_type: Column) -> Column:
    return _label_of(payment_type, PAYMENT_LABELS)


def status_label(status: Column) -> Column:
    return _label_of(status, STATUS_LABELS)


def status_category(status: Column) -> Column:
    return _group_of(status, STATUS_CATEGORIES, STATUS_CATEGORY_ELSE)


def is_terminal(status: Column) -> Column:
    return F.coalesce(status.isin(*TERMINAL_STATUSES), F.lit(False))


def sentiment(score: Column) -> Column:
    return _first_match(
        [
            (score.isNull(), "unknown"),
            (score >= SENTIMENT_POSITIVE_FROM, "positive"),
            (score == SENTIMENT_NEUTRAL, "neutral"),
        ],
        F.lit("negative"),
    )


def is_weekend(day: Column) -> Column:
    return F.coalesce(F.dayofweek(day).isin(*WEEKEND_DAYS), F.lit(False))
