"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.llm import decontaminate, embeddings, language, licenses, main_text, mixing, near_duplicates, ngrams, oracles, pii, ranked_search, resampling, tokens, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op2_warc": oracles.WARC,
    "op5_embeddings": oracles.EMBEDDINGS,
    "op7_near_duplicates": oracles.NEAR_DUPLICATES,
    "op8_mix": oracles.MIX,
    "op10_decontaminate": oracles.DECONTAMINATE,
    "op12_search": oracles.SEARCH,
}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents"), ["doc_id"]))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public tokenizer file lies on this and every other machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op3_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.score_texts(table(spark, sf_dir, "documents"), language.fold("doc_id", 7) == 2)


@query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents"), ["doc_id"]))


@query
def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.link(table(spark, sf_dir, "embeddings"))


@query
def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.read_back(tokens.write_ids(table(spark, sf_dir, "documents"), tokenizer_path()))


@query
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"])
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return found.select("doc_id", "component_id", kept.alias("kept"))


@query
def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(mixing.sized(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_held_out(table(spark, sf_dir, "documents"))


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.decontaminate(docs, benchmark, ["doc_id"]))


@query
def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


@query
def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.build_index(table(spark, sf_dir, "documents"))
    return ranked_search.search(index, table(spark, sf_dir, "benchmark"), "item_id")


@query
def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
