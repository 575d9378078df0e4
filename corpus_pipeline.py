"""From raw documents to shuffled shards: language, near duplicates, benchmark passages, mixture, shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the ``docs`` of the next one.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subrev.llm import decontaminate, jaccard_join, language_id, mixing, sharding
from subrev.llm.common import Scratch, fresh, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go; they have no language, or would have none if any language was learnt."""
    model = language_id.fit(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    lang, score = fresh("predicted", docs.columns), fresh("certainty", docs.columns)
    known = language_id.identify(docs, model, lang, score)
    return known.where(F.col(lang) != language_id.UNDEFINED).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 Jaccard similarity of five-word shingles stays, the one of the least id."""
    return jaccard_join.one_of_each(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more are words of benchmark windows go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: the words taken, in whole documents."""
    return mixing.take_documents(docs)


def shuffle_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and place in it."""
    return sharding.shard_documents(docs, shards=sharding.SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shuffle_into_shards),
]

#: The learnt languages, the shuffles and the seeded hashes have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(name, stage(spark, docs, sf_dir))
    return docs
