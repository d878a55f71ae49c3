"""Mixing sources to target weights by Poisson replication, in DataFrame functions alone.

Each source gets a mean repetition rate, its share of the target over its share of the bytes. A document's count
is the inverse of the Poisson distribution with that mean at a hash of seed and document id, so it can be worked
out again for any document alone. Rows are exploded by their counts and ordered by another hash over range
partitions: a global shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, spare, table, without, written

SEED = 42
#: Sources whose rates are broadcast; beyond that the rates are joined like any table.
BROADCAST_SOURCES = 10_000
#: A mean above this is the sum of several independent counts with smaller means.
MEAN = 16
#: Terms of the distribution function. Beyond these lies less than 1e-40 of a Poisson with mean ``MEAN``.
TERMS = 100
#: Elements of an array that a row makes at once, however often it is drawn or repeated.
AT_ONCE = 4096
COLUMNS = ("replica", "shuffle_key")
#: Target weights of the registered query; sources without an entry weigh 1.
WEIGHTS = {"src0": 3.0, "src1": 2.0, "src2": 0.5}


def _bits(*parts: Column) -> Column:
    """52 bits of the MD5 of the parts, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 13), 16, 10).cast("long")


def rates(docs: DataFrame, weights: dict[str, float], default: float = 1.0, source: str = "source", text: str = "text") -> DataFrame:
    """``(source, rate)``: the mean number of copies of each source's documents.

    Copies keep the total of bytes as it is, in expectation. A null source is a source of its own with the
    default weight; a source whose texts are all empty or null counts one byte a row.
    """
    size = F.coalesce(F.length(named(text).cast("binary")), F.lit(0)).cast("long") + 1
    sizes = written(docs.groupBy(named(source).alias("_source")).agg(F.sum(size).alias("_bytes")))
    weight = F.lit(float(default))
    for name, value in weights.items():
        weight = F.when(F.col("_source") == name, F.lit(float(value))).otherwise(weight)
    sizes = sizes.withColumn("_weight", weight)
    everything, weighed = sizes.agg(F.sum("_bytes"), F.sum("_weight")).first()
    if not everything or not weighed:
        return sizes.select("_source", F.lit(0.0).alias("_rate"))
    share = F.greatest("_weight", F.lit(0.0)) / F.lit(float(weighed))
    return sizes.select("_source", (share * F.lit(float(everything)) / F.col("_bytes")).alias("_rate"))


def replicate(
    docs: DataFrame,
    weights: dict[str, float],
    default: float = 1.0,
    seed: int = SEED,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``docs`` with each row repeated by its Poisson count, in shuffled order, with ``replica`` (from 1) and
    ``shuffle_key``.

    Rows with equal keys get equal counts and equal shuffle keys (a null key counts as the empty string); rows that tie
    in shuffle key and replica come in any order. Sources with weight 0 get no copies. Texts of any length are repeated
    whole, null and empty ones too. An empty table stays empty; input columns with one of the two names are replaced,
    all others may have any name.
    """
    base = without(docs, *COLUMNS)
    own_source, rate, parts, below, count, begin = spare(base, "_source", "_rate", "_parts", "_below", "_count", "_begin")
    table_of_rates = rates(base, weights, default, source, text).select(
        F.col("_source").alias(own_source), F.col("_rate").alias(rate), F.greatest(F.lit(1), F.ceil(F.col("_rate") / MEAN)).cast("int").alias(parts)
    )
    mean = f"({rate} / {parts})"
    step = f"named_struct('p', s.p * {mean} / k, 'c', concat(s.c, array(element_at(s.c, -1) + s.p * {mean} / k)))"
    first = f"named_struct('p', exp(-{rate} / {parts}), 'c', array(exp(-{rate} / {parts})))"
    table_of_rates = table_of_rates.withColumn(
        below, F.expr(f"aggregate(sequence(1, {TERMS}), {first}, (s, k) -> {step}, s -> s.c)")
    )
    if table_of_rates.count() <= BROADCAST_SOURCES:
        table_of_rates = F.broadcast(table_of_rates)
    rated = base.join(table_of_rates, named(source).eqNullSafe(F.col(own_source)))
    name = F.coalesce(named(key).cast("string"), F.lit(""))

    def drawn(j: Column) -> Column:
        u = (_bits(F.lit(str(seed)), F.lit("count"), j.cast("string"), name) + 0.5) / float(1 << 52)
        # a bound variable, or the hash would be taken for every term
        return F.transform(F.array(u), lambda v: F.size(F.filter(below, lambda c: c < v)))[0]

    def some(from_: Column) -> Column:
        js = F.sequence(from_, F.least(F.col(parts), from_ + (AT_ONCE - 1)))
        return F.aggregate(js, F.lit(0), lambda s, j: s + drawn(j))

    # a large mean is the sum of many draws, taken some at a time
    counts = F.aggregate(F.sequence(F.lit(1), F.col(parts), F.lit(AT_ONCE)), F.lit(0), lambda s, at: s + some(at))
    counted = rated.withColumn(count, counts).where(F.col(count) > 0)
    spread = counted.select(*map(named, base.columns), count, F.explode(F.sequence(F.lit(1), F.col(count), F.lit(AT_ONCE))).alias(begin))
    copies = F.sequence(F.col(begin), F.least(F.col(count), F.col(begin) + (AT_ONCE - 1)))
    copies = spread.select(*map(named, base.columns), F.explode(copies).alias("replica"))
    order = _bits(F.lit(str(seed)), F.lit("order"), F.col("replica").cast("string"), name)
    shuffled = copies.withColumn("shuffle_key", order)
    return shuffled.repartitionByRange("shuffle_key", "replica").sortWithinPartitions("shuffle_key", "replica")


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    """Every copy of every document under the registered weights, with a digest of its text."""
    mixed = replicate(table(spark, sf_dir, "documents"), WEIGHTS)
    return mixed.select("doc_id", "source", "replica", "shuffle_key", F.md5(F.col("text").cast("binary")).alias("text_md5"))


ORACLE = """
WITH s AS (
  SELECT source, sum(octet_length(encode(coalesce(text, ''))) + 1) AS bytes,
         CASE source WHEN 'src0' THEN 3.0 WHEN 'src1' THEN 2.0 WHEN 'src2' THEN 0.5 ELSE 1.0 END::DOUBLE AS weight
  FROM documents GROUP BY source
), r AS (
  SELECT source, (weight / (SELECT sum(weight) FROM s)) * (SELECT sum(bytes) FROM s)::DOUBLE / bytes::DOUBLE AS rate FROM s
), parts AS (
  SELECT source, rate, greatest(1, ceil(rate / 16))::INT AS parts FROM r
), cdf AS (
  SELECT source, k, sum(exp(-rate / parts + k * ln(rate / parts) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS c
  FROM parts, range(0, 101) AS t(k)
), draws AS (
  SELECT d.doc_id, d.source, d.text, j,
         (('0x' || substr(md5('42:count:' || j || ':' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source, unnest(range(1, p.parts + 1)) AS t(j)
), counts AS (
  SELECT doc_id, draws.source, text, CAST(count(*) FILTER (c < u) AS INT) AS n
  FROM draws JOIN cdf ON draws.source IS NOT DISTINCT FROM cdf.source GROUP BY ALL
)
SELECT doc_id, source, CAST(replica AS INT) AS replica,
       ('0x' || substr(md5('42:order:' || replica || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT AS shuffle_key,
       md5(text) AS text_md5
FROM counts, unnest(range(1, n + 1)) AS t(replica)
"""
