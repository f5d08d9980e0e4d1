"""The two click-through ratios."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def click_ratio(clicks: Column, views: Column) -> Column:
    """clicks / views, 0.0 without views. DOUBLE, so large counts stay exact."""
    return F.when(views > 0, clicks.cast("double") / views).otherwise(F.lit(0.0))


def smoothed_ratio(clicks: Column, views: Column) -> Column:
    """clicks / (views + 1)."""
    return clicks.cast("double") / (views + 1)
