"""Severity of a batch metric against its two thresholds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def classify_severity(value: Column, warn: float, page: float, higher_is_worse: bool) -> Column:
    """PAGE, WARN or OK, both bounds inclusive; an undefined metric is OK."""

    def reached(bound: float) -> Column:
        return value >= bound if higher_is_worse else value <= bound

    return F.when(reached(page), "PAGE").when(reached(warn), "WARN").otherwise("OK")
