"""A corpus pipeline of five stages, each one operator of ``loanloom.llm``.

Every stage works on all rows its predecessor kept, and returns the columns of
``documents`` (names that start with two underscores are reserved); the last
returns where each document stands in the token files. An empty table passes
through all stages, rows without an id too.

Stages that work in Python send it a row's key and text in small batches, and get
the keys of the rows that go; the rows themselves stay in the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.llm import decontaminate, language, mixing, near_duplicates, tokens
from loanloom.llm.queries import table, tokenizer_path
from loanloom.llm.shared import small_batches, stored, with_row_key

#: No SQL can express the classifier and the tokenizer.
ORACLE_SQL = None

#: A text whose best language gets less than this on average is no running text.
LEAST_SCORE = 0.34
#: Keys of dropped rows that are broadcast at most (about 200 bytes each).
BROADCAST_ROWS = 200_000
KEY = ["__file", "__row"]


def without(keyed: DataFrame, dropped: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of the rows whose keys are not dropped; few dropped keys are broadcast."""
    with small_batches(keyed.sparkSession):
        dropped = stored(dropped.select(*KEY), "dropped")
    side = F.broadcast(dropped) if dropped.count() <= BROADCAST_ROWS else dropped
    return keyed.join(side, KEY, "left_anti").select(*columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that are null, have no letter or resemble no learned language go.

    The network learns from the labelled rows of the same table; without any,
    only the first two rules apply.
    """
    keyed = with_row_key(docs)
    network = language.train(language.training_sample(docs))
    if network is None:
        dropped = keyed.filter(~F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    else:
        dropped = language.identify(keyed, network, KEY, prefix="__").filter(F.col("__score") < LEAST_SCORE)
    return without(keyed, dropped, docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id."""
    keyed = with_row_key(docs)
    with small_batches(spark):
        found = stored(near_duplicates.near_duplicates(keyed, ["doc_id", *KEY]), "near-duplicates")
    found = found.filter("__group IS NOT NULL")
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", *KEY)
    first = stored(found.groupBy("__group").agg(F.min(order).alias("first")), "first")
    return without(keyed, found.withColumn("own", order).join(first, "__group").filter("own <> first"), docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go; the others stay as they are."""
    keyed = with_row_key(docs)
    found = decontaminate.decontaminate(keyed, table(spark, sf_dir, "benchmark"), KEY, prefix="__")
    return without(keyed, found.filter("__n_hit > 0"), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    keyed = with_row_key(docs)
    slim = keyed.select("doc_id", "source", *KEY, mixing.size_of(F.col("text")).alias("size"))
    taken = mixing.mix(slim).filter("copies > 0").select(*KEY, F.col("copies").cast("int").alias("__copies"))
    # Always by a shuffle: whether the keys would fit a broadcast depends on the size.
    joined = keyed.join(taken.hint("merge"), KEY)
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).select(*docs.columns)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; one row per document with its place in them."""
    with small_batches(spark):
        return tokens.read_back(tokens.write_ids(docs, tokenizer_path()))


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "".join(c if c.isalnum() else "-" for c in name))
    return STAGES[-1][1](spark, docs, sf_dir)
