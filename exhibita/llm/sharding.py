"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered by key over range partitions (a count for each partition, no single-task window). A Feistel
network over Z_a x Z_b with a * b just above the row count permutes the numbers; a number that lands beyond the
count walks on along its cycle until it is inside. Shard and slot of any row number can be computed alone.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import named, spare, table, without, written

ROUNDS = 6
SHARDS = 8
SEED = 42
#: Fixed odd multiplier and increment of the round function, modulo 2 ** 31.
MULTIPLIER, INCREMENT = 1103515245, 12345
COLUMNS = ("row_number", "position", "shard", "slot")


def sides(n: int) -> tuple[int, int]:
    """``a`` and ``b`` with ``a * b >= n``, as near to each other as can be."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = (x % (1 << 31) + key) % (1 << 31)
    x = (x * MULTIPLIER + INCREMENT) % (1 << 31)
    x = x ^ (x >> 15)
    x = (x * MULTIPLIER + INCREMENT) % (1 << 31)
    return x ^ (x >> 13)


def permute(x: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """The permutation of 0 .. n - 1 at ``x``."""
    a, b = sides(n)

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v // b, v % b
        for r in range(ROUNDS):
            key = (seed * 7919 + r * 104729) % (1 << 31)
            if r % 2:
                right = (right + _mix(left, key)) % b
            else:
                left = (left + _mix(right, key)) % a
        return left * b + right

    out = once(np.asarray(x, np.int64))
    while len(out) and (beyond := np.flatnonzero(out >= n)).size:
        out[beyond] = once(out[beyond])
    return out


def numbered(df: DataFrame, key: str) -> DataFrame:
    """``df`` with ``row_number``, 0-based by ``key`` (nulls first), gapless over all rows.

    Rows with equal keys are ordered by all their values; rows that are equal in all of them are interchangeable.
    The last sort column spreads one very frequent key over several partitions.
    """
    base = without(df, *COLUMNS)
    values = [named(c) for c in base.columns]
    part, own, begin = spare(base, "_part", "_local", "_start")
    order = [named(key).asc_nulls_first(), F.xxhash64(*values), F.monotonically_increasing_id()]
    local = F.monotonically_increasing_id()
    mask = (1 << 33) - 1
    dealt = base.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = written(dealt.select(*values, F.spark_partition_id().alias(part), local.bitwiseAND(F.lit(mask)).alias(own)))
    # one small row for each partition, whatever the number of rows
    counts = dealt.groupBy(part).agg(F.count("*").alias("n")).orderBy(part).collect()
    starts, total = {}, 0
    for row in counts:
        starts[row[part]] = total
        total += row["n"]
    schema = T.StructType([T.StructField(part, T.IntegerType()), T.StructField(begin, T.LongType())])
    start = df.sparkSession.createDataFrame(list(starts.items()), schema)
    out = dealt.join(F.broadcast(start), part).withColumn("row_number", F.col(begin) + F.col(own))
    return out.select(*values, "row_number").withMetadata("row_number", {"rows": total})


def shards(df: DataFrame, key: str = "doc_id", n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` with ``row_number``, ``position``, ``shard`` and ``slot``.

    ``position`` is the row's place in the shuffled order; ``shard = position % n_shards`` and ``slot = position //
    n_shards``, so shard sizes differ by one row at most and slots have no gaps. Null keys come first, repeated
    rows get a place each, texts of any length go along whole, an empty table stays empty, and input columns with one
    of the four names are replaced.
    """
    out = numbered(df, key)
    total = out.schema["row_number"].metadata["rows"]

    @F.pandas_udf(T.LongType())
    def place(x: pd.Series) -> pd.Series:
        return pd.Series(permute(x.to_numpy(np.int64), total, seed))

    out = out.withColumn("position", place("row_number"))
    return out.withColumn("shard", (F.col("position") % n_shards).cast("int")).withColumn(
        "slot", F.expr(f"position div {n_shards}")
    )


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; law ``rows``: counts at most one apart."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.length(F.col("text").cast("binary")), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return shards(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _rounds_sql(rows: str) -> str:
    """DuckDB SQL: ``rows`` (with v, a and b) after one pass of the network."""
    m, steps = 1 << 31, f"SELECT * EXCLUDE (v), v // b AS x, v % b AS y FROM ({rows})"
    for r in range(ROUNDS):
        key, (own, other, side) = (SEED * 7919 + r * 104729) % m, (("y", "x", "b"), ("x", "y", "a"))[r % 2 == 0]
        steps = f"SELECT *, (({other} % {m} + {key}) % {m} * {MULTIPLIER} + {INCREMENT}) % {m} AS t FROM ({steps})"
        steps = f"SELECT * REPLACE ((xor(t, t >> 15) * {MULTIPLIER} + {INCREMENT}) % {m} AS t) FROM ({steps})"
        steps = f"SELECT * EXCLUDE (t) REPLACE (({own} + xor(t, t >> 13)) % {side} AS {own}) FROM ({steps})"
    return f"SELECT * EXCLUDE (x, y), x * b + y AS v FROM ({steps})"


#: Document ids tell all rows apart here, so they alone make the order.
ORACLE = f"""
WITH RECURSIVE size AS (SELECT count(*) AS n, CAST(floor(sqrt(count(*) - 1)) AS BIGINT) + 1 AS a FROM documents
), sides AS (SELECT n, a, CAST(ceil(n / a) AS BIGINT) AS b FROM size
), numbered AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS row FROM documents
), walk AS (
  SELECT row, 0 AS pass, row AS v FROM numbered
  UNION ALL SELECT row, pass + 1, v FROM ({_rounds_sql("SELECT row, pass, v, a, b FROM walk, sides WHERE pass = 0 OR v >= n")})
), crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs
), bytes AS (
  SELECT row, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS data FROM numbered
), sums AS (
  SELECT row, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], data), lambda c, x: xor(c >> 8, crcs[(xor(c, x) & 255) + 1])), CAST(4294967295 AS BIGINT)) AS text_crc32 FROM bytes, crc_table
)
SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
       CAST(v % {SHARDS} AS INT) AS shard, CAST(v // {SHARDS} AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard
FROM numbered JOIN sums USING (row) JOIN (SELECT row, v FROM walk, sides WHERE pass > 0 AND v < n) USING (row)
"""
