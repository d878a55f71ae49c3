"""Benchmark decontamination: find and remove passages of test sets in training documents.

The n-gram windows of a block of test items form a hash set that is broadcast; every task scans the word
windows of its own documents against it. Nothing is shuffled. A block is bounded by ``BLOCK_BYTES`` of item
text. A larger benchmark is scanned in blocks, one after the other, each over all documents: a block's hits are
written, by the digest of the text that has them, before the next block is built, so driver and executors hold one
block at a time. In the end each document gets the hits of its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_blocks, named, with_made, without

#: Words in a window.
WINDOW = 10
#: Item text that one broadcast hash set may come from.
BLOCK_BYTES = 4 << 20
#: Bytes of words in the parts of long items.
PART_BYTES = 64 << 10
#: Bytes of hits that are broadcast to the documents at most, where there are several blocks.
BROADCAST_BYTES = 32 << 20
#: Bytes of a document that are held as a list of words at once.
PIECE = 1 << 20

#: A-Z become a-z; every ASCII byte that is no letter and no digit becomes a space; other bytes stay.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

COLUMNS = ("n_words", "hit_spans", "hit_items")


def words(text: bytes | None) -> list[bytes]:
    """The words ``[0-9a-z]`` and non-ASCII of a UTF-8 text, A-Z lower-cased; none for null."""
    return text.translate(_FOLD).split() if text else []


class Windows:
    """The exact windows of some items, as keys of word numbers."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.by_length: dict[int, dict[bytes, tuple[str, ...]]] = {}
        number = self.vocabulary
        for item, text in items:
            ids = np.array([number.setdefault(w, len(number) + 1) for w in words(text)], np.int32)
            if not len(ids):
                continue
            n = min(window, len(ids))
            found = self.by_length.setdefault(n, {})
            for key in {ids[i : i + n].tobytes() for i in range(len(ids) - n + 1)}:
                found[key] = (*found.get(key, ()), item)

    def numbers(self, text: bytes | None) -> np.ndarray:
        """The word numbers of a text; 0 stands for a word that no item has."""
        if not text:
            return np.zeros(0, np.int32)
        folded, get, start, parts = text.translate(_FOLD), self.vocabulary.get, 0, []
        while start < len(folded):
            cut = folded.find(b" ", start + PIECE)
            cut = len(folded) if cut < 0 else cut
            parts.append(np.array([get(w, 0) for w in folded[start:cut].split()], np.int32))
            start = cut
        return np.concatenate(parts)

    def scan(self, ids: np.ndarray, covered: np.ndarray) -> set[str]:
        """Marks the words inside occurrences in ``covered`` and returns the items that occur."""
        items: set[str] = set()
        total = np.concatenate(([0], np.cumsum(ids > 0)))
        for n, keys in self.by_length.items():
            if total[-1] < n:
                continue
            for i in np.flatnonzero(total[n:] - total[:-n] == n):
                hit = keys.get(ids[i : i + n].tobytes())
                if hit:
                    covered[i : i + n] = True
                    items.update(hit)
        return items


def count_words(text: bytes | None) -> int:
    """The number of a text's words, a piece of it at a time."""
    if not text:
        return 0
    folded, start, n = text.translate(_FOLD), 0, 0
    while start < len(folded):
        cut = folded.find(b" ", start + PIECE)
        cut = len(folded) if cut < 0 else cut
        n += len(folded[start:cut].split())
        start = cut
    return n


def parts(text: bytes, window: int, size: int) -> Iterator[bytes]:
    """A text as parts of about ``size`` bytes of words, which together have its windows and no others.

    Neighbouring parts share ``window - 1`` words. A part has ``window`` words at least, or is all that there is.
    """
    folded, start, carry, whole = text.translate(_FOLD), 0, [], True
    while start < len(folded):
        cut = folded.find(b" ", start + size)
        cut = len(folded) if cut < 0 else cut
        fresh = folded[start:cut].split()
        carry, start = carry + fresh, cut
        if fresh and len(carry) >= window:
            yield b" ".join(carry)
            carry, whole = carry[len(carry) - window + 1 :] if window > 1 else [], False
    if whole and carry:
        yield b" ".join(carry)


def _blocks(items: DataFrame, n: int, window: int) -> Iterator[Windows]:
    """The windows of items ``(item, text)`` as hash sets of ``BLOCK_BYTES`` of item text at most; one set, empty or not, where ``n`` is 1.

    The items are read once, in ``n`` portions. A long one comes in parts, so it may span blocks; only a single word of
    more bytes makes a block larger.
    """

    limit = PART_BYTES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text"), strict=True):
                for part in parts(text.as_py(), window, limit):
                    yield pa.RecordBatch.from_arrays([pa.array([item], pa.string()), pa.array([part], pa.binary())], names=["item", "text"])

    rows, size = [], 0
    portions = items if n == 1 else items.mapInArrow(cut, "item string, text binary").repartition(n)
    for r in portions.toLocalIterator():
        text = bytes(r["text"])
        if n > 1 and rows and size + len(text) > BLOCK_BYTES:
            yield Windows(rows, window)
            rows, size = [], 0
        rows.append((r["item"], text))
        size += len(text)
    if rows or n == 1:
        yield Windows(rows, window)


def _edges(covered: np.ndarray) -> list[int]:
    """Starts and ends of the runs of marked words, alternating."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
    return edge.tolist()


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` and ``hit_items``.

    ``hit_spans`` alternates starts and ends (word numbers, half open) of the maximal runs of words that lie in
    an occurrence of a window; ``hit_items`` are the items with occurring windows, sorted as strings. Null and
    empty texts have no words and no hits, nor do items without an id or a text; an empty benchmark hits nothing, an
    empty table stays empty. Repeated rows are judged each on its own, texts of any length whole. Input columns with
    one of the three new names are replaced, all others may have any name. ``keep`` limits them.
    """
    base = without(docs, *COLUMNS)
    kept = [c for c in base.columns if keep is None or c in keep]
    spark, body = docs.sparkSession, named(text).cast("binary")
    # a text that is kept goes to Python once
    once = text in kept and isinstance(base.schema[text].dataType, (T.StringType, T.BinaryType))
    items = benchmark.select(named(item).cast("string").alias("item"), named(item_text).cast("binary").alias("text"))
    items = items.where("item IS NOT NULL AND length(text) > 0")
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // BLOCK_BYTES))
    new = dict(zip(COLUMNS, (T.LongType(), T.ArrayType(T.IntegerType()), T.ArrayType(T.StringType())), strict=True))
    if n == 1:
        shared = spark.sparkContext.broadcast(next(_blocks(items, 1, window)))
        return with_made(base, kept, [text if once else body], new, lambda: lambda texts: _scan(shared.value, texts))

    def scan(shared) -> DataFrame:
        rows = base.select(body.alias("text")).where("text IS NOT NULL").select("text", F.md5("text").alias("digest"))
        found = with_made(rows, ["digest"], [F.col("text")], new, lambda: lambda texts: _scan(shared.value, texts))
        return found.where(F.size("hit_spans") > 0).select("digest", "hit_spans", "hit_items").distinct()

    hits = in_blocks(spark, _blocks(items, n, window), scan)
    # a text has one row for each block at most
    hits = hits.groupBy("digest").agg(F.collect_set("hit_spans").alias("spans"), F.flatten(F.collect_set("hit_items")).alias("items"))
    size = hits.agg(F.coalesce(F.sum(F.length(F.to_json(F.struct("spans", "items"))) + 50), F.lit(0))).first()[0]
    hits = F.broadcast(hits) if size <= BROADCAST_BYTES else hits
    inner = base.select(*(named(c).alias(f"k{i}") for i, c in enumerate(kept)), *([] if once else [body.alias("text")]), F.md5(body).alias("digest"))
    inner = inner.join(hits, "digest", "left")

    def gather(texts: pa.Array, spans: pa.Array, items: pa.Array) -> list[list]:
        made: list[list] = [[], [], []]
        for data, own, known in zip(texts.cast(pa.large_binary()), spans, items, strict=True):
            total = count_words(data.as_py())
            covered = np.zeros(total if own.is_valid else 0, bool)
            for edges in own.as_py() or ():
                for a, b in zip(edges[::2], edges[1::2], strict=True):
                    covered[a:b] = True
            for column, value in zip(made, (total, _edges(covered), sorted(set(known.as_py() or ()))), strict=True):
                column.append(value)
        return made

    found = with_made(inner, [f"k{i}" for i in range(len(kept))], [f"k{kept.index(text)}" if once else F.col("text"), F.col("spans"), F.col("items")], new, lambda: gather)
    return found.toDF(*kept, *COLUMNS)


def _scan(windows: Windows, texts: pa.Array) -> list[list]:
    made: list[list] = [[], [], []]
    for data in texts.cast(pa.large_binary()):
        ids = windows.numbers(data.as_py())
        covered = np.zeros(len(ids), bool)
        items = sorted(windows.scan(ids, covered))
        for column, value in zip(made, (len(ids), _edges(covered), items), strict=True):
            column.append(value)
    return made


def digest(found: DataFrame) -> DataFrame:
    """The columns of the op4 contract from ``find_contamination``'s result."""
    pairs = F.expr("aggregate(sequence(0, greatest(size(hit_spans) - 2, 0), 2), 0L, (s, i) -> s + try_element_at(hit_spans, i + 2) - try_element_at(hit_spans, i + 1))")
    n_hit = F.when(F.size("hit_spans") == 0, F.lit(0).cast("long")).otherwise(pairs)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` less the documents with any word in an occurrence of a benchmark window; columns unchanged."""
    found = find_contamination(docs, benchmark, **options)
    return found.where(F.size("hit_spans") == 0).select(*map(named, without(docs, *COLUMNS).columns))


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the hit words cut out of ``text``; the bytes between the words of a run go with them."""
    found = find_contamination(docs, benchmark, text=text, **options)

    @F.pandas_udf(T.StringType())
    def cut(texts, spans):
        import pandas as pd

        return pd.Series([None if t is None else cut_words(t, s) for t, s in zip(texts, spans, strict=True)])

    clean = F.when(F.size("hit_spans") == 0, named(text)).otherwise(cut(named(text), F.col("hit_spans")))
    return found.withColumn(text, clean).drop(*COLUMNS)


def cut_words(text: str, spans) -> str:
    """``text`` without the words of ``spans`` (starts and ends of word runs, alternating)."""
    import re

    data = text.encode()
    at = [m.span() for m in re.finditer(rb"[^ ]+", data.translate(_FOLD))]
    out, last = [], 0
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        out.append(data[last : at[a][0]])
        last = at[b - 1][1]
    return b"".join([*out, data[last:]]).decode()


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a 10-word window of a benchmark item."""
    from .common import table

    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return digest(found)


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), item_windows AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(10, len(words)) AS n,
         array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS gram
  FROM b, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS u(i) WHERE len(words) > 0
), lengths AS (SELECT DISTINCT n FROM item_windows
), doc_windows AS (
  SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS gram
  FROM w, lengths, unnest(range(1, len(words) - n + 2)) AS u(i)
), hits AS (
  SELECT d.doc_id, d.i, d.n, b.item FROM doc_windows d JOIN item_windows b ON d.n = b.n AND d.gram = b.gram
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
