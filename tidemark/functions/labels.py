"""Labels of subscription-level spans."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def level_category(current: Column, following: Column) -> Column:
    """What became of a span: stayed, upgraded or downgraded."""
    # The four labels.
    return (
        F.when((current == "free") & (following == "paid"), "Free then Paid")
        .when((current == "paid") & (following == "free"), "Paid then Free")
        .when((current == "free") & following.isNull(), "Free Only")
        .when((current == "paid") & following.isNull(), "Paid Only")
    )


def changed(current: Column, previous: Column) -> Column:
    """1 where two known values differ, else 0."""
    return F.when(current != previous, 1).otherwise(0)
