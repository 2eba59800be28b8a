"""Conformed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.schemas import TABLES, conform

# The four sources and how they match and deliver.
SOURCES = [
    ("aecb", "UAE Credit Bureau", "DETERMINISTIC", "ASYNC_FILE"),
    ("fraud", "Fraud Detection Provider", "DETERMINISTIC", "SYNC_API"),
    ("aml", "AML / PEP Screening", "PROBABILISTIC", "ASYNC_WEBHOOK"),
    ("internal", "Internal Customer Profile", "DETERMINISTIC", "CDC"),
]


def dim_source(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SOURCES, TABLES["mart.dim_source"])


def dim_customer(raw: DataFrame) -> DataFrame:
    return conform(raw, "mart.dim_customer")


def dim_product(raw: DataFrame) -> DataFrame:
    return conform(raw, "mart.dim_product")


def loan_terms(raw: DataFrame) -> DataFrame:
    return conform(raw, "mart.dim_loan_terms")


def dim_date(bounds: DataFrame) -> DataFrame:
    """Calendar of every day between ``first_day`` and ``last_day`` of a one-row frame."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date_key"))
    return conform(
        days.select(
            "date_key",
            F.date_format("date_key", "EEEE").alias("day_of_week"),
            F.date_format("date_key", "MMMM").alias("month_name"),
            F.month("date_key").alias("month_number"),
            F.concat(F.lit("Q"), F.quarter("date_key").cast("string")).alias("quarter"),
            F.year("date_key").alias("year"),
            (F.last_day("date_key") == F.col("date_key")).alias("is_month_end"),
        ),
        "mart.dim_date",
    )
