"""Date builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import strip


def parse_us_date(c: Column) -> Column:
    """month/day/year text; anything else is NULL."""
    return F.try_to_timestamp(F.nullif(strip(c), F.lit("")), F.lit("M/d/yyyy")).cast("date")


def created_date(implemented: Column, initiated: Column, acquisition: Column) -> Column:
    """First known date."""
    return F.coalesce(implemented, initiated, acquisition)


def retired_flag(raw: Column, parsed: bool = True) -> Column:
    """D3: date parsed, or merely a non-NULL cell."""
    return parse_us_date(raw).isNotNull() if parsed else raw.isNotNull()


def lifecycle_days(created: Column, retired: Column) -> Column:
    """Whole days, NULL unless both dates are known."""
    return F.datediff(retired, created)
