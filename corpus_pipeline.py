"""The corpus pipeline: five stages over ``documents``, each writing Parquet that the next one reads.

Every stage takes documents with any further columns, whatever their names, keeps all columns, and works on whole texts
of any length. Nulls may stand in any column, rows may repeat, and tables may be empty: an empty ``documents`` gives an
empty result, an empty ``labels`` or ``benchmark`` drops nothing. The stages with Python send rows to it in small batches, which
is a setting of the session (``small_batches``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from exhibita.llm import decontaminate, mixing, sharding, simhash, toxicity
from exhibita.llm.common import small_batches, table, written

#: Toxicity and the Poisson table are fitted models, so SQL does not express the whole run; tests hold the
#: stages against brute force instead.
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier predicts to be toxic.

    Null and empty texts score as the bias does and stay, unless nearly all labels are toxic. Repeated rows fare alike;
    labels without an id or a value, and those of held-out ids, are not learnt from. Without labels nothing is dropped.
    """
    small_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.classify(docs, model).where("predicted = 0").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate component, the one with the smallest id.

    Null and empty texts are copies of one another. Of repeated rows one stays; where different texts share the smallest
    id, the one with the lowest hash stays. Rows without an id stay, all of them.
    """
    small_batches(spark)
    return simhash.keep_one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of a benchmark item.

    Null and empty texts have no words and stay. Repeated rows fare alike. Items without an id or a text count nothing.
    """
    small_batches(spark)
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document by its Poisson count, in globally shuffled order.

    Rows with one id, null included, get one count each; a null source is a source of its own. Rows that tie in the
    order come in any order.
    """
    return mixing.replicate(docs, mixing.WEIGHTS).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds row number, position, shard and slot.

    Rows without an id come first; rows with one id are ordered by all their values, equal rows get a place each.
    Columns with one of the four names are replaced.
    """
    return sharding.shards(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("simhash_dedup", near_dedup),
    ("decontamination", drop_benchmark),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
