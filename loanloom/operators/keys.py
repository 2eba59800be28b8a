"""Per-key reductions and lookups that survive a hot key.

None of them opens a window over raw rows: a group is reduced by an aggregate
with a map-side part, so no task ever holds all rows of one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROW = "__row"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is greatest by ``order``."""
    return _pick(df, keys, F.max_by, order)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is least by ``order``."""
    return _pick(df, keys, F.min_by, order)


def in_force(rows: DataFrame, key: str, as_of: str) -> DataFrame:
    """The one row of each key that holds on a day.

    A row holds from ``valid_from`` to ``valid_to``, both included; a missing column or value
    is an open end. Of several, the one that began last counts (then the greatest by its other
    columns), so a key never has two.
    """
    day = F.lit(as_of).cast("date")
    open_end = F.lit(None).cast("date")
    since, until = (F.col(c).cast("date") if c in rows.columns else open_end for c in ("valid_from", "valid_to"))
    live = rows.withColumns({"__since": since, "__until": until}).filter(
        (F.col("__since").isNull() | (F.col("__since") <= day)) & (F.col("__until").isNull() | (F.col("__until") >= day))
    )
    rest = [c for c in rows.columns if c != key]
    return latest_per_key(live.drop("__until"), [key], ["__since", *rest]).drop("__since")


def _pick(df: DataFrame, keys: Sequence[str], pick, order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias(_ROW))
    return chosen.select(*keys, f"{_ROW}.*").select(*df.columns)


# A key with more rows than this is hot. It bounds the hot keys themselves: a
# table of 10^12 rows has at most 10^6 of them, so their list may be broadcast.
HOT_ROWS = 1_000_000


def _filler(*salt: Column) -> Column:
    """A key no real key equals, spread over many values."""
    return F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*salt), F.lit(4096)).cast("string"))


def with_duplicate_count(df: DataFrame, key: str, name: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add how many rows share the row's key (rows without a key count as one group).

    Rows are counted per key map-side first. The counts of hot keys are
    broadcast, so their rows take no part in the shuffle join that follows:
    there they carry a filler key, spread evenly.
    """
    repeats = (
        df.groupBy(F.col(key).cast("string").alias("__key"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") > 1)
    )
    hot = repeats.filter(F.col("__n") > hot_rows).select(
        F.col("__key").alias("__hot_key"), F.col("__n").alias("__hot_n")
    )
    usual = repeats.filter(F.col("__n") <= hot_rows)
    text = F.col(key).cast("string")
    tagged = df.join(F.broadcast(hot), text.eqNullSafe(F.col("__hot_key")), "left")
    other = F.when(F.col("__hot_n").isNull(), text).otherwise(_filler(*[F.col(c) for c in df.columns]))
    return tagged.join(usual, other.eqNullSafe(F.col("__key")), "left").select(
        *df.columns, F.coalesce("__hot_n", "__n", F.lit(1).cast("bigint")).alias(name)
    )


def spread_nulls(key: Column, *salt: Column) -> Column:
    """A left-join key under which rows without a key never match nor pile up."""
    return F.coalesce(key, _filler(*salt))


def lookup(df: DataFrame, side: DataFrame, key: str, salt: Sequence[str]) -> DataFrame:
    """Left join of a side that has one row per key; rows without a key stay, unmatched."""
    renamed = side.withColumnRenamed(key, "__key")
    spread = spread_nulls(F.col(key), *[F.col(c) for c in salt])
    return df.join(renamed, splittable(spread, F.col("__key")), "left").drop("__key")


def splittable(left: Column, right: Column) -> Column:
    """Equality of a key that may be hot on the left with one that is unique on the right.

    AQE splits a hot key only if both sides come straight out of a shuffle. A
    right side that was aggregated by the key is partitioned by it already and
    would skip that shuffle; null-safe equality compares derived keys, for which
    the old partitioning does not do. A NULL on both sides must not occur.
    """
    return left.eqNullSafe(right)
