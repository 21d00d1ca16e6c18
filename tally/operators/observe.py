"""Observation points: named row counts that also fix where filters run."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def observe_rows(df: DataFrame, name: str, *metrics: Column) -> DataFrame:
    """Record the row count (and ``metrics``) of ``df`` as observed metrics.

    The metrics are named ``<name>_<id>`` and reach query listeners and the
    event log. Catalyst moves no predicate across an observation point, so a
    filter applied after this runs on ``df``'s computed columns, once per
    row. Use it where a filter refers to expensive derived columns (the rule
    CASE, parsed dates and amounts): pushed below their projection, the
    filter would get a copy of each expression for every reference and
    evaluate them all again. Cheap filters (dates, flags) belong before it,
    so that they still reach the scan.
    """
    return df.observe(f"{name}_{uuid.uuid4().hex[:12]}", F.count(F.lit(1)).alias("rows"), *metrics)
