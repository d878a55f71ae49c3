"""Places where users plug in their own functions: document filters, indexing and extraction."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.names import spare
from . import resume

#: What an indexing function gives for each anchor.
SELECTED = "anchor_id string, label string, type string, start int, end int"


def filter_documents(docs: DataFrame, predicate: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """Documents that a predicate over the columns keeps; without one all of them."""
    return docs if predicate is None else docs.where(F.coalesce(predicate(docs), F.lit(False)))


def filter_callable(docs: DataFrame, keep: Callable[[dict, dict], bool], submission: list[str], document: list[str]) -> DataFrame:
    """Documents that a Python function of (submission, document) keeps; it runs on Arrow batches."""

    @F.pandas_udf("boolean")
    def judge(subs: pd.DataFrame, docs: pd.DataFrame) -> pd.Series:
        return pd.Series([bool(keep(s, d)) for s, d in zip(subs.to_dict("records"), docs.to_dict("records"), strict=True)])

    return docs.where(judge(F.struct(*submission), F.struct(*document)))


def _digest(*parts: Column) -> Column:
    """A digest of texts that tells nulls and boundaries apart."""
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.lit("="), F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]), 256)


def prompt_digest(prompt: str) -> str:
    """The hex SHA-256 of a prompt."""
    return hashlib.sha256(prompt.encode()).hexdigest()


def index_items(views: DataFrame, prompt: str, select: Callable[[str, str], list[dict]], item: str = "item_id", store: str | None = None) -> DataFrame:
    """Anchors that ``select(prompt, view)`` picks in each item's view, with the prompt's fingerprint.

    Item ids keep the type that they have in ``views``, and the name ``item``; a null view is empty. With ``store``, a
    folder that all machines share, the result of each call is kept there under the item, its view and the prompt: calls
    that have ended are never made again, whatever becomes of the job, and repeated rows are one call. See ``resume``.
    """
    values = T.StructType.fromDDL(SELECTED)
    sha256 = prompt_digest(prompt)
    if store is None:
        schema = T.StructType([T.StructField(item, views.schema[item].dataType), *values])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = [{item: i, **a} for i, v in zip(batch[item], batch["text"], strict=True) for a in select(prompt, v or "")]
                yield pd.DataFrame(rows, columns=schema.names)

        return views.select(item, "text").mapInPandas(run, schema).withColumn("prompt_sha256", F.lit(sha256))

    folder, key = f"{store.rstrip('/')}/index-{sha256}", _digest(F.col(item).cast("string"), F.col("text"))
    todo = views.select(key.alias("key"), F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["key"])
    todo = todo.join(resume.kept(views.sparkSession, folder, values).where("mark").select("key"), "key", "left_anti")

    def calls(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, Iterator[pd.DataFrame]]]:
        for batch in batches:
            for own, view in zip(batch["key"], batch["text"], strict=True):
                yield own, ([{c: a.get(c) for c in values.names} for a in select(p, view)] for p in (prompt,))

    keep = resume.each_call(folder, values, calls)
    todo.mapInPandas(keep, "key string").write.format("noop").mode("overwrite").save()
    found = resume.kept(views.sparkSession, folder, values).where("NOT mark").select("key", "value.*")
    return views.select(item, key.alias("key")).join(found, "key").drop("key").withColumn("prompt_sha256", F.lit(sha256))


def extract_items(
    snippets: DataFrame, prompt: str, extract: Callable[[str, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, item: str = "item_id", order: list[str] | None = None, store: str | None = None
) -> DataFrame:
    """What ``extract(prompt, snippets)`` makes of each item's snippets, which it gets as a stream of frames in ``order``.

    It may give its rows as a stream too, so an item with any number of snippets takes the memory of one batch; a function
    that wants them at once can ``pd.concat`` the stream. With ``store`` results are kept as in ``index_items``, under the
    item, its snippets and the prompt.
    """
    order = [c for c in order or () if c != item]
    values, session = T.StructType.fromDDL(schema), snippets.sparkSession
    arrow = to_arrow_schema(values)

    if store is None:
        # a window moves nothing where an item's snippets are together already, as those of a join by item are
        (place,) = spare(snippets, "_place")
        if order:
            numbered = snippets.withColumn(place, F.row_number().over(Window.partitionBy(item).orderBy(*order)))
            snippets = numbered.where(F.col(place) > 0).drop(place)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for made in extract(prompt, (b.to_pandas() for b in batches)):
                yield pa.RecordBatch.from_pandas(made[arrow.names], arrow, preserve_index=False)

        return snippets.groupBy(item).applyInArrow(run, values)

    folder = f"{store.rstrip('/')}/extract-{prompt_digest(prompt)}"
    own_item, own_key = spare(snippets, "_item", "_key")
    whole = F.struct(*snippets.columns)
    # equal for equal snippets in whatever order they come
    sums = snippets.groupBy(item).agg(F.count("*").alias("n"), F.sum(F.xxhash64(whole).cast("decimal(38,0)")).alias("a"), F.sum(F.crc32(F.to_json(whole).cast("binary"))).alias("b"))
    keys = sums.select(F.col(item).alias(own_item), _digest(*[F.col(c).cast("string") for c in (item, "n", "a", "b")]).alias(own_key))
    todo = keys.join(resume.kept(session, folder, values).where("mark").select(F.col("key").alias(own_key)), own_key, "left_anti")
    rows = snippets.join(todo, snippets[item].eqNullSafe(todo[own_item])).drop(own_item)
    rows = rows.repartition(own_key).sortWithinPartitions(own_key, *order)

    def calls(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, Iterator[pd.DataFrame]]]:
        parts = (x for batch in batches for x in batch.groupby(own_key, sort=False))
        for own, group in itertools.groupby(parts, key=lambda x: x[0]):
            yield own, extract(prompt, (part.drop(columns=own_key) for _, part in group))

    keep = resume.each_call(folder, values, calls)
    rows.mapInPandas(keep, "key string").write.format("noop").mode("overwrite").save()
    found = resume.kept(session, folder, values).where("NOT mark")
    return found.join(keys.select(F.col(own_key).alias("key")), "key", "left_semi").select("value.*")
