"""Mixing: columns of clashing names, and very many rows without an id."""

from pyspark.sql import functions as F

from loanloom.llm import mixing

CLASHING = ("rows", "target", "draw", "b", "s", "bucket", "offset", "inner", "queued", "source_size", "copies", "taken", "words", "a.b")


def small(spark):
    rows = [(i if i % 7 else None, "ab"[i % 2] if i % 5 else None, i % 13) for i in range(400)]
    return spark.createDataFrame(rows, "doc_id long, source string, size long")


def test_extra_columns_change_nothing_and_stay(spark):
    plain = small(spark)
    wide = plain.select("*", *[F.lit(f"x-{c}").alias(c) for c in CLASHING])
    names = ("doc_id", "source", "size", "source_size", "target", "taken")
    want = sorted(map(tuple, mixing.mix(plain).select(*names).collect()), key=str)
    mixed = mixing.mix(wide)
    assert sorted(map(tuple, mixed.select(*names).collect()), key=str) == want
    kept = [c for c in CLASHING if c not in ("target", "queued", "source_size", "copies", "taken")]
    assert mixed.select(*[F.col(f"`{c}`") for c in kept]).distinct().collect() == [tuple(f"x-{c}" for c in kept)]
    assert len(mixed.columns) == len(set(mixed.columns))


def test_rows_without_an_id_spread_over_the_queue(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 64)
    docs = spark.range(6400).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.lit(1).cast("long").alias("size"))
    queued, _ = mixing.virtual_times(docs)
    assert queued.select("queued").distinct().count() == 6400
    drawn = [p for p in queued.inputFiles() if "mix-sizes" in p]
    draws = spark.read.parquet(*drawn).select("__mix_draw")
    in_bucket = draws.groupBy(F.substring("__mix_draw", 1, 2)).count().agg(F.max("count")).first()[0]
    assert draws.distinct().count() == 6400 and in_bucket < 64


def test_reruns_agree_without_ids(spark):
    docs = small(spark).withColumn("doc_id", F.lit(None).cast("long"))
    once, again = (sorted(map(tuple, mixing.mix(docs).select("source", "size", "taken").collect()), key=str) for _ in range(2))
    assert once == again
