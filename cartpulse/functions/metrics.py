"""Scores, ratios and rounding."""

from fractions import Fraction

from pyspark.sql import Column, functions as F

from cartpulse.schema import (
    CART_WEIGHT,
    EVENT_TYPES,
    PURCHASE_WEIGHT,
    UNUSUAL_LIFT,
    VIEW_WEIGHT,
)


def round_exact(value: Column, digits: int) -> Column:
    """Round a double half-to-even on its exact binary value.

    ``bround`` decides ties on the shortest decimal text, so 2.675 (which is
    stored a little below) would go the wrong way. ``format_number`` decides on
    the stored value. Below the last kept digit it has nothing to keep and drops
    the tie, so that range is decided by a comparison.
    """
    unit, half = 10.0**-digits, 0.5 * 10.0**-digits
    size = F.abs(value)
    stored_half_is_above = Fraction(half) > Fraction(1, 2 * 10**digits)
    reaches = size >= half if stored_half_is_above else size > half
    pattern = "0." + "0" * digits
    return (
        F.when(size < unit, F.when(reaches, F.signum(value) * unit).otherwise(0.0))
        .otherwise(F.call_function("format_number", value, F.lit(pattern)).try_cast("double"))
    )


def trend_score(views: Column, carts: Column, purchases: Column) -> Column:
    return VIEW_WEIGHT * views + CART_WEIGHT * carts + PURCHASE_WEIGHT * purchases


def stage_counts(event_type: Column) -> list[Column]:
    """One conditional count per event type; removals are counted but never scored."""
    names = ("views", "carts", "removals", "purchases")
    return [F.count_if(event_type == kind).alias(name) for kind, name in zip(EVENT_TYPES, names)]


def historical_dropoff(entered: Column, continued: Column) -> Column:
    """1 - continued/entered; may be negative, null when nobody entered."""
    return F.when(entered > 0, 1 - continued / entered)


def current_dropoff(entered: Column, continued: Column) -> Column:
    """As the historical one, but never below zero and rounded to 4 places."""
    return F.when(
        entered > 0, round_exact(F.greatest(F.lit(0.0), 1 - continued / entered), 4)
    )


def activity_lift(current: Column, normal: Column) -> Column:
    return F.when(normal > 0, round_exact(current / normal, 3))


def is_unusual(current: Column, normal: Column, threshold: float = UNUSUAL_LIFT) -> Column:
    """Judged on unrounded values; reaching the threshold is enough."""
    return F.coalesce((normal > 0) & (current >= threshold * normal), F.lit(False))


def larger_loss(view_to_cart: Column, cart_to_purchase: Column) -> Column:
    """Name of the larger drop-off; a missing one loses against a known one."""
    return (
        F.when(view_to_cart.isNull() & cart_to_purchase.isNull(), F.lit(None).cast("string"))
        .when(view_to_cart.isNull() | (cart_to_purchase > view_to_cart), "cart_to_purchase")
        .when(cart_to_purchase.isNull() | (view_to_cart > cart_to_purchase), "view_to_cart")
        .otherwise("equal")
    )
