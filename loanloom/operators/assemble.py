"""One row per application out of three independently answering vendors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.operators.keys import HOT_ROWS, splittable
from loanloom.schemas import conform
from loanloom.sizing import fits_broadcast, small_side

KEY = "application_id"

# Columns each vendor contributes, as target name -> name in its conformed table.
CONTRIBUTIONS = {
    "aecb": {
        "aecb_score": "aecb_score",
        "aecb_band": "aecb_band",
        "total_outstanding": "total_outstanding",
        "aecb_identity_status": "identity_validation_status",
        "emirates_id": "emirates_id",
        "dob": "dob",
        "aecb_report_date": "aecb_report_date",
    },
    "fraud": {
        "fraud_score": "fraud_score",
        "risk_band": "risk_band",
        "fraud_identity_status": "identity_validation_status",
        "fraud_scored_at": "fraud_scored_at",
    },
    "aml": {
        "aml_status": "aml_status",
        "pep_flag": "pep_flag",
        "match_score": "match_score",
        "aml_match_decision": "match_decision",
        "aml_screened_at": "aml_screened_at",
    },
}
SOURCES = tuple(CONTRIBUTIONS)
# One slot column per vendor; a hot application is spread over their values.
SLOTS = {source: f"slot_{source}" for source in SOURCES}
_KEYS = [KEY, *SLOTS.values()]


def pending_sources(answered: dict[str, Column]) -> Column:
    """The vendors that have not answered, in a fixed order."""
    return F.array_compact(F.array(*[F.when(~flag, F.lit(source)) for source, flag in answered.items()]))


def _contribution(conformed: DataFrame, source: str) -> DataFrame:
    return conformed.select(
        KEY,
        F.col("internal_uuid").alias(f"{source}_uuid"),
        (F.col("batch_date")).alias(f"{source}_batch"),
        F.lit(True).alias(f"has_{source}"),
        F.xxhash64(*conformed.columns).alias("row_hash"),
        *[F.col(column).alias(target) for target, column in CONTRIBUTIONS[source].items()],
    )


def _pieces(source: str, hot_rows: int) -> Column:
    """Into how many slots a vendor's answers to an application are split."""
    return F.greatest(F.ceil(F.col(f"rows_{source}") / hot_rows), F.lit(1)).cast("int")


def _slotted(side: DataFrame, source: str, hot: DataFrame) -> DataFrame:
    """Rows of a vendor in their own slot, repeated for every slot of the others.

    For all but hot applications there is one slot, and one row stays one row.
    """
    tagged = side.join(F.broadcast(hot), KEY, "left")
    pieces = {s: F.coalesce(f"pieces_{s}", F.lit(1)) for s in SOURCES}
    placed = tagged.withColumn(SLOTS[source], F.pmod(F.col("row_hash"), pieces[source]).cast("int"))
    for other in SOURCES:
        if other != source:
            placed = placed.withColumn(SLOTS[other], F.explode(F.sequence(F.lit(0), pieces[other] - 1)))
    return placed.select(*_KEYS, *[c for c in side.columns if c not in (KEY, "row_hash")])


def assemble_application_request(
    bureau: DataFrame, fraud: DataFrame, aml: DataFrame, as_of: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Full outer join of the vendors on the application, for the run's applications.

    An application belongs to the run if any of its vendor rows does. Answers
    given twice fan out, and rows without an application id stay single: both as
    in a plain full outer join followed by an OR over the three batch dates.

    That plain form joins all history before it filters, and a full outer join
    cannot split a hot key. So the run's applications are taken from the run's
    partitions first. While they fit a broadcast they pick their rows out of the
    history without a shuffle of it; else the rows meet them in one shuffle, on
    whose partitioning they are picked and joined. Each vendor's rows are joined to
    the applications from the left, so one that did not answer leaves NULLs; and an
    application with very many answers is cut into slots, each vendor's rows spread
    over its own slots and repeated over the others'.
    """
    day = F.lit(as_of).cast("date")
    tables = dict(zip(SOURCES, (bureau, fraud, aml)))
    sides = {source: _contribution(df, source) for source, df in tables.items()}

    of_the_day = reduce(
        DataFrame.unionByName,
        [df.filter((F.col("batch_date") == day) & F.col(KEY).isNotNull()).select(KEY) for df in tables.values()],
    )
    day_keys = small_side(of_the_day.distinct().withColumnRenamed(KEY, "day_key"))
    few = fits_broadcast(day_keys)

    def of_run(rows: DataFrame) -> DataFrame:
        return rows.join(day_keys, splittable(F.col(KEY), F.col("day_key")), "left_semi") if few else rows

    answers = reduce(
        DataFrame.unionByName,
        [
            df.filter(F.col(KEY).isNotNull()).select(KEY, F.lit(s).alias("source"), (F.col("batch_date") == day).alias("of_day"))
            for s, df in tables.items()
        ],
    )
    # The counts say themselves which applications are of the run: nothing is sorted and joined for
    # them, unless a broadcast spares the shuffle of the history's keys.
    spine = (
        of_run(answers)
        .groupBy(KEY)
        .agg(*[F.count_if(F.col("source") == s).alias(f"rows_{s}") for s in SOURCES], F.bool_or("of_day").alias("of_day"))
        .filter("of_day")
        .drop("of_day")
    )
    # A hot application has over ``hot_rows`` rows: few enough of them to broadcast.
    hot = spine.filter(F.greatest(*[F.col(f"rows_{s}") for s in SOURCES]) > hot_rows).select(
        KEY, *[_pieces(s, hot_rows).alias(f"pieces_{s}") for s in SOURCES]
    )
    spread = spine
    for s in SOURCES:
        spread = spread.withColumn(SLOTS[s], F.explode(F.sequence(F.lit(0), _pieces(s, hot_rows) - 1)))
    spread = spread.select(*_KEYS)

    joined = spread
    for source, side in sides.items():
        placed = _slotted(of_run(side.filter(F.col(KEY).isNotNull())), source, hot)
        if not few:
            # Rows of other runs end here, in a join that can split a hot key of theirs.
            placed = placed.join(spread, _KEYS, "left_semi")
        joined = joined.join(placed, _KEYS, "left")
    # A slot of a hot application may be empty though the vendor answered: nothing is joined there.
    joined = joined.join(F.broadcast(hot), KEY, "left")
    for s in SOURCES:
        joined = joined.filter(F.col(f"has_{s}").isNotNull() | (F.coalesce(f"pieces_{s}", F.lit(1)) == 1))
    joined = joined.drop(*SLOTS.values(), *[f"pieces_{s}" for s in SOURCES])
    # Some vendor row of this very combination must be of the run.
    joined = joined.filter(
        reduce(lambda a, b: a | b, [F.coalesce(F.col(f"{s}_batch") == day, F.lit(False)) for s in SOURCES])
    )

    unkeyed = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            side.filter(F.col(KEY).isNull() & (F.col(f"{s}_batch") == day)).drop("row_hash")
            for s, side in sides.items()
        ],
    )
    rows = joined.unionByName(unkeyed)

    # A row without an application id cannot be told to answer any application.
    answered = {s: F.coalesce(f"has_{s}", F.lit(False)) & F.col(KEY).isNotNull() for s in SOURCES}
    return conform(
        rows.withColumns(
            {
                "internal_uuid": F.coalesce(*[F.col(f"{s}_uuid") for s in SOURCES]),
                "application_date": F.to_date(F.coalesce("aecb_report_date", "fraud_scored_at", "aml_screened_at")),
                "pending_sources": pending_sources(answered),
                "batch_date": day,
            }
        ),
        "silver.lending_application_request",
    )
