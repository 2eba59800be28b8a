"""The training sample when most rows are copies."""

from collections import Counter

from pyspark.sql import functions as F

from loanloom.llm import language


def labelled(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").repartition(5)


def test_copies_count_once(spark):
    rows = [("en", f"copied {c}") for c in range(6) for _ in range(800)] + [("en", f"english text {i}") for i in range(40)]
    rows += [("de", "nur ein Text")] * 700 + [("fr", f"texte {i}") for i in range(9)] + [("it", "uno"), ("it", "12 34"), (None, "x"), ("es", None)]
    got = language.training_sample(labelled(spark, rows), rows=40, windows=1)
    assert Counter(lang for lang, _ in got) == {"en": 10, "de": 1, "fr": 9, "it": 1}
    assert got == language.training_sample(labelled(spark, rows[::-1]), rows=40, windows=1)


def test_smallest_hashes_are_taken(spark):
    docs = labelled(spark, [("en", f"text {i}") for i in range(3000)] + [("de", f"wort {i}") for i in range(7)])
    got = language.training_sample(docs, rows=100, windows=1)
    want = docs.filter("lang = 'en'").orderBy(F.xxhash64("text")).limit(50).collect()
    assert {t for lang, t in got if lang == "en"} == {r.text for r in want} and len(got) == 57


def test_more_languages_than_rows(spark):
    docs = labelled(spark, [(f"l{i}", f"text {i} {k}") for i in range(60) for k in range(20)])
    got = language.training_sample(docs, rows=20, windows=1)
    assert len(got) == 60 and {lang for lang, _ in got} == {f"l{i}" for i in range(60)}
