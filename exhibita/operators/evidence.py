"""Snippets around selected anchors, their exchange formats, and checks between stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import let
from ..functions.names import spare

#: Characters of context on either side.
BANDWIDTH = 400
ANCHOR_JSON = "anchors array<map<string, string>>"
ANCHOR_TSV = "item_id string, anchor_id string, anchor_type string, start int, end int, label string"
SNIPPET_FIELDS = ("item_id", "anchor_id", "label", "type", "start", "end", "snippet", "snippet_start", "snippet_end")


def offset(anchor: Column, name: str) -> Column:
    """An anchor's offset: 0 where it has none, numeric text is read, a null or anything else is an error."""
    number = F.trim(anchor[name]).try_cast("int")
    wrong = F.raise_error(F.concat(F.lit(f"{name} is no offset: "), F.coalesce(anchor[name], F.lit("null")))).cast("int")
    return F.when(~F.map_contains_key(anchor, name), 0).otherwise(F.coalesce(number, wrong))


def read_anchor_json(docs: DataFrame, item: str = "item_id", text: str = "json") -> DataFrame:
    """Selected anchors from JSON texts ``{"anchors": [...]}``; a text without any is an error."""
    parsed = F.from_json(text, ANCHOR_JSON)["anchors"]
    none = F.raise_error(F.concat(F.lit("no anchors in "), F.col(item).cast("string"))).cast("array<map<string,string>>")
    rows = docs.select(item, F.explode(F.when(F.coalesce(F.size(parsed), F.lit(0)) > 0, parsed).otherwise(none)).alias("a"))
    a = F.col("a")
    named = [a[c].alias(c) for c in ("anchor_id", "label", "type")]
    return rows.select(item, *named, offset(a, "start").alias("start"), offset(a, "end").alias("end"))


#: Texts of more than ``2 ** PIECE_BITS`` characters are cut into pieces of so many, so that no window is counted out from
#: the text's beginning.
PIECE_BITS = 10
#: Anchors of one item are nested by this many characters of its text.
STRETCH = 1 << 22


def windows_of(text: Column, spans: Column, bandwidth: int = BANDWIDTH) -> Column:
    """For each of an array of structs with ``start`` and ``end``: ``(span, snippet_start, snippet_end, snippet)``.

    The text is cut into pieces once, and each window is taken from those that it lies in, so that the work grows with
    the text and the windows and not with their product.
    """
    many = 1 << PIECE_BITS

    def cut(pieces: Column, w: Column) -> Column:
        a, size = w["snippet_start"], w["snippet_end"] - w["snippet_start"]
        first, last = F.shiftright(a, PIECE_BITS), F.shiftright(w["snippet_end"] - 1, PIECE_BITS)
        own = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
        whole = F.substring(text, a + 1, size)
        return F.when(size <= 0, "").when(F.size(pieces) == 0, whole).otherwise(F.substring(own, a.bitwiseAND(many - 1) + 1, size))

    def placed(size: Column) -> Column:
        at = lambda s: F.struct(s.alias("span"), F.greatest(F.lit(0), s["start"] - bandwidth).alias("snippet_start"), F.least(size, s["end"] + bandwidth).alias("snippet_end"))
        return F.transform(spans, at)

    def windows(pieces: Column) -> Column:
        own = let(F.length(text), placed)
        return F.transform(own, lambda w: F.struct(*[w[c].alias(c) for c in ("span", "snippet_start", "snippet_end")], cut(pieces, w).alias("snippet")))

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{many}}}"), F.lit(0))
    return let(F.when(F.length(text) > many, pieces).otherwise(F.array().cast("array<string>")), windows)


def one_text(texts: DataFrame, key: list[str], order: list[str] | None = None) -> DataFrame:
    """``(*key, text)`` with one text for each key: where a key repeats the last by ``order``.

    Without an order texts that repeat must be equal; an item with two different texts is an error that names it.
    """
    if order:
        text = F.max_by("text", F.struct(*order))
    else:
        wrong = F.raise_error(F.concat(F.lit("two different texts of item "), F.concat_ws(", ", *[F.col(k).cast("string") for k in key]))).cast("string")
        text = F.when(F.min("text") == F.max("text"), F.max("text")).when(F.max("text").isNotNull(), wrong)
    return texts.groupBy(*key).agg(text.alias("text"))


def snippets(selected: DataFrame, texts: DataFrame, item: str | list[str] = "item_id", bandwidth: int = BANDWIDTH, order: list[str] | None = None) -> DataFrame:
    """``selected`` (anchors with start and end) with the text around each: an inner join on the item.

    Every selected anchor gives one snippet, however often its item stands among the texts: of repeated items the last
    text by ``order`` counts, see ``one_text``. ``item`` may be several columns, such as the id of a text's row. A window
    that starts beyond the text is empty; null texts and null items have none. An item's anchors are nested before the
    join, so that its text is joined and read once for each ``STRETCH`` of it.
    """
    key = [item] if isinstance(item, str) else list(item)
    made = ("snippet_start", "snippet_end", "snippet")
    rest = [c for c in selected.columns if c not in key and c not in made]
    stretch, spans, own, window = spare(selected, "_stretch", "_spans", "_text", "_window")
    nested = selected.groupBy(*key, F.floor(F.col("start") / STRETCH).alias(stretch)).agg(F.collect_list(F.struct(*rest)).alias(spans)).drop(stretch)
    text = one_text(texts, key, order).select(*key, F.col("text").alias(own)).where(F.col(own).isNotNull())
    rows = nested.join(text, key).select(*key, F.explode(windows_of(F.col(own), F.col(spans), bandwidth)).alias(window))
    return rows.select(*key, *[F.col(window)["span"][c].alias(c) for c in rest], *[F.col(window)[c].alias(c) for c in made])


def to_json_lines(found: DataFrame) -> DataFrame:
    """One JSON text for each snippet, fields in fixed order, nulls shown."""
    return found.select(F.to_json(F.struct(*SNIPPET_FIELDS), {"ignoreNullFields": "false"}).alias("value"))


def write_anchor_tsv(found: DataFrame, path: str, item: str = "item_id") -> None:
    """Anchors as tab-separated files with a header, written where they are made: in the order of ``found``.

    ``anchors`` gives an item's anchors together and in order, so they stand so in the files, items in the order in which
    their texts are read. Nothing is sampled, sorted or shuffled, and each text is worked out once.
    """
    columns = [F.col(item).alias("item_id"), "anchor_id", "anchor_type", "start", "end", F.col("anchor_type").alias("label")]
    found.select(*columns).write.option("sep", "\t").option("header", True).csv(path)


def read_anchor_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Anchors from such files."""
    return spark.read.schema(ANCHOR_TSV).option("sep", "\t").option("header", True).csv(path)


def view_with_fallback(items: DataFrame, new: DataFrame, old: DataFrame, item: str = "item_id", strict: bool = True) -> DataFrame:
    """``items`` with ``text`` from ``new``, else from ``old``; an item in neither is an error, or null if not strict."""
    first, second = spare(items, "_new", "_old")
    rows = items.join(new.select(item, F.col("text").alias(first)), item, "left").join(old.select(item, F.col("text").alias(second)), item, "left")
    text = F.coalesce(first, second)
    if strict:
        text = F.coalesce(text, F.raise_error(F.concat(F.lit("no view of item "), F.col(item).cast("string"))))
    return rows.withColumn("text", text).drop(first, second)


def missing(expected: DataFrame, present: DataFrame, item: str = "item_id") -> DataFrame:
    """The expected items that are not present."""
    return expected.select(item).distinct().join(present.select(item), item, "left_anti")


def require(expected: DataFrame, present: DataFrame, stage: str, item: str = "item_id") -> DataFrame:
    """``present``, after making sure that no expected item is missing from it."""
    lost = missing(expected, present, item).limit(5).collect()
    if lost:
        raise ValueError(f"{stage}: missing items, among them {[r[0] for r in lost]}")
    return present


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df``, after making sure that it has rows."""
    if df.isEmpty():
        raise ValueError(f"{what}: no rows")
    return df
