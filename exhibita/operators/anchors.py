"""Anchors: numbered tables, bullets and sentences of a text with exact code-point spans.

Everything is worked out inside the row: a text becomes an array of blocks, a block an array of pieces, and offsets are
running sums over those arrays. Nothing is shuffled and no key is needed, so repeated or missing item ids do no harm,
and the place of an anchor in the exploded array is its number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import let
from ..functions.names import spare
from ..functions.text import ABBREVIATIONS, SENTENCE_END, SPACE, TABLE, is_blank, is_bullet, strip
from .evidence import STRETCH, one_text, windows_of

#: A block that is one sentence of more characters is cut once.
LONG = 400
#: A sentence of fewer characters joins the one before.
SHORT = 10
#: Characters at a piece's end that tell whether it ends in an abbreviation; a longer word is none.
TAIL = max(map(len, ABBREVIATIONS)) + 4
#: The columns of ``units``, besides the item.
UNIT = ("seg", "block", "kind", "start", "end", "block_text")


def _at(values: Column, index: Column) -> Column:
    """The element at a 0-based index, null beyond the end."""
    return F.get(values, index)


def running(lengths: Column) -> Column:
    """For each element of an array of ints the sum of those before it.

    The array is cut into as many parts as each part has elements, so that no long array is grown element by element.
    """

    def grown(start: Column, values: Column) -> Column:
        return F.aggregate(values, F.array(start), lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x)))

    def by_parts(values: Column) -> Column:
        step = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(values)))).cast("int")
        part = lambda k: F.slice(values, k * step + 1, step)
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / step).cast("int")), part)
        total = lambda p: F.aggregate(p, F.lit(0), lambda s, x: s + x)

        def joined(ps: Column) -> Column:
            begin = F.slice(grown(F.lit(0), F.transform(ps, total)), 1, F.size(ps))
            return F.flatten(F.zip_with(ps, begin, lambda p, s: F.slice(grown(s, p), 1, F.size(p))))

        return F.when(F.size(values) == 0, F.array().cast("array<int>")).otherwise(let(parts, joined))

    return let(lengths, by_parts)


def _left(text: Column, pattern: str) -> Column:
    """Number of leading characters that match a class; most texts have none, which their first character tells."""
    some = F.substring(text, 1, 1).rlike(f"(?U){pattern}")
    return F.when(some, F.length(text) - F.length(F.regexp_replace(text, rf"(?U)^{pattern}+", ""))).otherwise(0)


def _right(text: Column) -> Column:
    """Number of white-space characters at the end; most texts have none, which their last character tells."""
    some = F.substring(text, -1, 1).rlike(f"(?U){SPACE}")
    return F.when(some, F.length(text) - F.length(F.regexp_replace(text, rf"(?U){SPACE}+$", ""))).otherwise(0)


def segments_of(text: Column) -> Column:
    """A text as an array of strings: what lies between fenced tables, empty or not, and at odd places the tables."""
    between, tables = F.split(text, TABLE, -1), F.regexp_extract_all(text, F.lit(TABLE), F.lit(0))
    pairs = F.arrays_zip(between.alias("b"), tables.alias("t"))
    both = F.flatten(F.transform(pairs, lambda p: F.array(p["b"], p["t"])))
    return F.filter(both, lambda x: x.isNotNull())


def blocks_of(text: Column) -> Column:
    """A text as an array of structs ``UNIT``: tables, and the blocks between them that are not blank.

    ``kind`` is ``table``, ``bullet`` for a block of which two lines or more, and more than half, are list items, or
    ``sentence``.
    """

    def parts(segment: Column, k: Column) -> Column:
        cut = F.when(k % 2 == 1, F.array(segment)).otherwise(F.split(segment, "\n\n", -1))

        def each(ps: Column) -> Column:
            gap = lambda i: F.when(i < F.size(ps) - 1, 2).otherwise(0)
            return F.transform(ps, lambda p, i: F.struct(k.alias("seg"), i.alias("block"), p.alias("part"), (F.length(p) + gap(i)).alias("size")))

        return let(cut, each)

    def unit(p: Column, start: Column) -> Column:
        bare = F.regexp_replace(p["part"], "^\n+|\n+$", "")
        lead, lines = _left(p["part"], "\n"), F.split(bare, "\n")
        items = F.size(F.filter(lines, is_bullet))
        kind = F.when(p["seg"] % 2 == 1, "table").when((items >= 2) & (items * 2 > F.size(lines)), "bullet").otherwise("sentence")
        values = (p["seg"], p["block"], kind, start + lead, start + lead + F.length(bare), bare)
        return F.struct(*[v.alias(n) for v, n in zip(values, UNIT, strict=True)])

    def placed(ps: Column) -> Column:
        whole = F.zip_with(ps, running(F.transform(ps, lambda p: p["size"])), unit)
        return F.filter(whole, lambda u: ~is_blank(u["block_text"]))

    return let(F.flatten(F.transform(segments_of(text), parts)), placed)


def pieces_of(unit: Column) -> Column:
    """A unit as an array of structs ``(start, text)``, cut at every place where an anchor may begin.

    Prose is cut at every possible sentence end, and its pieces make it up again; lists are cut into lines; a table
    is one piece.
    """
    kind, text = unit["kind"], unit["block_text"]
    cut = F.when(kind == "table", F.array(text)).when(kind == "bullet", F.split(text, "\n")).otherwise(F.split(text, SENTENCE_END, -1))
    gap = (kind == "bullet").cast("int")

    def placed(ps: Column) -> Column:
        begin = running(F.transform(ps, lambda p: F.length(p) + gap))
        return F.zip_with(ps, begin, lambda p, s: F.struct((unit["start"] + s).alias("start"), p.alias("text")))

    return let(cut, placed)


def last_word(text: Column) -> Column:
    """The last word, lower-cased, without the marks that end a sentence."""
    return F.lower(F.regexp_replace(F.regexp_extract(text, rf"(?U)([^\s\x1c-\x1f]+){SPACE}*$", 1), r"[.!?]+$", ""))


def _groups(values: Column, begins: Callable[[Column, Column], Column], make: Callable[[Column, Column], Column]) -> Column:
    """Neighbours taken together from each element that begins a group: ``make(first index, last index)``.

    Elements before the first that begins one are a group too.
    """
    at = F.filter(F.transform(values, lambda x, i: F.when((i == 0) | begins(x, i), i)), lambda i: i.isNotNull())
    last = lambda own, k: F.coalesce(_at(own, k + 1), F.size(values)) - 1
    return let(at, lambda own: F.transform(own, lambda i, k: make(i, last(own, k))))


def sentences_of(unit: Column) -> Column:
    """A unit's pieces joined into sentences and list items: structs ``(start, end, size)``.

    A sentence does not end after an abbreviation, and the white space before it is not part of it. A list item has
    the lines up to the next one; lines before the first item stand together. ``size`` counts a sentence's characters
    without white space at either end.
    """
    prose = unit["kind"] == "sentence"

    def joined(ps: Column) -> Column:
        def begins(p: Column, i: Column) -> Column:
            # a piece before another ends in one mark, right after a letter or digit
            ended = last_word(F.substring(_at(ps, i - 1)["text"], -TAIL, TAIL))
            return F.when(unit["kind"] == "bullet", is_bullet(p["text"])).otherwise(~ended.isin(*ABBREVIATIONS))

        def make(i: Column, j: Column) -> Column:
            first, last = _at(ps, i), _at(ps, j)
            lead = F.when(prose, _left(first["text"], SPACE)).otherwise(0)
            start = first["start"] + F.when(i > 0, lead).otherwise(0)
            end = last["start"] + F.length(last["text"])
            size = end - _right(last["text"]) - first["start"] - lead
            return F.struct(start.alias("start"), end.alias("end"), size.alias("size"))

        return _groups(ps, begins, make)

    return let(pieces_of(unit), joined)


def _halves(text: Column, start: Column) -> Column:
    """The spans of a long block's two halves, cut at the first mark with white space after it; null for others."""

    def spans(halves: Column) -> Column:
        lead, whole = _left(text, SPACE), F.length(strip(text))
        span = lambda a, b: F.struct(a.alias("start"), b.alias("end"), (b - a).alias("size"))
        both = F.array(
            span(start + lead, start + F.length(_at(halves, F.lit(0)))),
            span(start + lead + whole - F.length(strip(_at(halves, F.lit(1)))), start + lead + whole),
        )
        return F.when(F.size(halves) > 1, F.filter(both, lambda x: x["end"] > x["start"]))

    return let(F.split(text, rf"(?U)(?<=[.!?]){SPACE}+", 2), spans)


def cut_of(unit: Column) -> Column:
    """A unit's sentences, where the one sentence of a long block is replaced by its halves."""

    def cut(sents: Column) -> Column:
        alone = (unit["kind"] == "sentence") & (F.size(sents) == 1) & (sents[0]["end"] - sents[0]["start"] > LONG)
        return F.when(alone, F.coalesce(_halves(unit["block_text"], unit["start"]), sents)).otherwise(sents)

    return let(sentences_of(unit), cut)


def spans_of(unit: Column) -> Column:
    """A unit's anchors ``(start, end)``: a sentence of fewer than ``SHORT`` stripped characters joins the one before."""

    def merged(sents: Column) -> Column:
        begins = lambda s, i: (unit["kind"] != "sentence") | (s["size"] >= SHORT)
        make = lambda i, j: F.struct(_at(sents, i)["start"].alias("start"), _at(sents, j)["end"].alias("end"))
        return _groups(sents, begins, make)

    return let(cut_of(unit), merged)


def anchors_of(text: Column) -> Column:
    """A text's anchors in order: structs ``(kind, start, end)``."""
    one = lambda u: F.transform(spans_of(u), lambda s: F.struct(u["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return F.flatten(F.transform(blocks_of(text), one))


def label(number: Column) -> Column:
    """A0001 and so on, from 0-based numbers."""
    return F.format_string("A%04d", number + 1)


# ---- rows ----


def segments(texts: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """``(item, seg, seg_start, is_table, seg_text)``: fenced tables and what lies between them, empty ones too."""
    found = let(segments_of(F.col(text)), lambda ss: F.zip_with(ss, running(F.transform(ss, F.length)), lambda s, at: F.struct(at.alias("at"), s.alias("text"))))
    rows = texts.select(item, F.posexplode(found).alias("seg", "s"))
    return rows.select(item, "seg", F.col("s.at").alias("seg_start"), (F.col("seg") % 2 == 1).alias("is_table"), F.col("s.text").alias("seg_text"))


def table_spans(texts: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """``(item, start, end)`` of the fenced tables."""
    end = (F.col("seg_start") + F.length("seg_text")).alias("end")
    return segments(texts, item, text).where("is_table").select(item, F.col("seg_start").alias("start"), end)


def units(texts: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """``(item, seg, block, kind, start, end, block_text)``, a row for each table and block, see ``blocks_of``."""
    return texts.select(item, F.explode(blocks_of(F.col(text))).alias("u")).select(item, *[f"u.{c}" for c in UNIT])


def _exploded(found: DataFrame, of: Callable[[Column], Column], item: str, number: str) -> DataFrame:
    rows = found.select(item, F.struct(*UNIT).alias("u")).select(item, "u.seg", "u.block", "u.kind", F.posexplode(of(F.col("u"))).alias(number, "x"))
    return rows.select(item, "seg", "block", "kind", number, "x.*")


def pieces(found: DataFrame, item: str = "item_id") -> DataFrame:
    """``units`` as rows ``(item, seg, block, kind, piece, start, text)``, see ``pieces_of``."""
    return _exploded(found, pieces_of, item, "piece")


def sentences(found: DataFrame, item: str = "item_id") -> DataFrame:
    """``units`` as rows ``(item, seg, block, kind, sentence, start, end, size)``, see ``sentences_of``."""
    return _exploded(found, sentences_of, item, "sentence")


def long_blocks(found: DataFrame, item: str = "item_id") -> DataFrame:
    """The same with long blocks cut in two, see ``cut_of``."""
    return _exploded(found, cut_of, item, "sentence")


def merged(found: DataFrame, item: str = "item_id") -> DataFrame:
    """``units`` as rows ``(item, seg, block, kind, sentence, start, end)``, short sentences joined, see ``spans_of``."""
    return _exploded(found, spans_of, item, "sentence")


def anchors(texts: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """``(item, anchor_id, anchor_type, start, end)`` of every text, numbered from A0001 in each row of ``texts``.

    Null, empty and blank texts have none. Rows with one item id are texts of their own.
    """
    rows = texts.select(item, F.posexplode(anchors_of(F.col(text))).alias("n", "a"))
    return rows.select(item, label(F.col("n")).alias("anchor_id"), F.col("a.kind").alias("anchor_type"), "a.start", "a.end")


def annotated(texts: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """``(item, text)``: each text's anchors in order, each under its ``[[Annnn]]``; texts without anchors go."""
    whole = F.col(text)
    block = lambda a: F.substring(whole, a["start"] + 1, a["end"] - a["start"])
    part = lambda a, n: F.concat(F.lit("[["), label(n), F.lit("]]\n"), block(a), F.lit("\n"))
    # exploded, not filtered: a filter would work the anchors out once more
    view = let(anchors_of(whole), lambda found: F.when(F.size(found) > 0, F.array(F.array_join(F.transform(found, part), "\n"))))
    return texts.select(item, F.explode(view).alias("text"))


def violations(snippets: DataFrame, texts: DataFrame, item: str = "item_id", order: list[str] | None = None) -> DataFrame:
    """Rows ``(item, anchor_id, problem)`` for spans out of bounds or order, overlaps, and texts that differ.

    ``snippets`` has ``start``, ``end``, ``snippet``, ``snippet_start`` and ``snippet_end``. A null offset is out of
    bounds and overlaps nothing, a null snippet differs. Items without a text have no rows; of repeated items the last text by ``order``
    counts, see ``one_text``. An item's spans are nested by stretches of its text, which is joined and read once for each;
    what comes before a stretch is the end of the last span of the stretch before, so only stretches are ordered.
    """
    stretch, spans, own, before, found = spare(snippets, "_stretch", "_spans", "_text", "_before", "_found")
    fields = F.struct("start", "end", "anchor_id", "snippet", "snippet_start", "snippet_end")
    nested = snippets.groupBy(item, F.floor(F.col("start") / STRETCH).alias(stretch)).agg(F.array_sort(F.collect_list(fields)).alias(spans))
    ends = lambda s: F.when(s["start"].isNotNull(), s["end"])
    last = F.lag(ends(F.element_at(spans, -1))).over(Window.partitionBy(item).orderBy(stretch))
    text = one_text(texts, [item], order).select(item, F.col("text").alias(own)).where(F.col(own).isNotNull())
    rows = nested.withColumn(before, last).join(text, item)

    def placed(s: Column, i: Column) -> Column:
        earlier = F.when(i > 0, ends(F.get(spans, i - 1))).otherwise(F.col(before))
        return F.struct(s["snippet_start"].alias("start"), s["snippet_end"].alias("end"), s.alias("row"), earlier.alias("before"))

    def problem(w: Column) -> Column:
        s = w["span"]["row"]
        inside = (s["start"] >= 0) & (s["start"] <= s["end"]) & (s["end"] <= F.length(own))
        real = (w["snippet_start"] == s["snippet_start"]) & (w["snippet_end"] == s["snippet_end"]) & (w["snippet"] == s["snippet"])
        kinds = F.array(
            F.when(~F.coalesce(inside, F.lit(False)), "bounds"), F.when(w["span"]["before"] > s["start"], "overlap"), F.when(~F.coalesce(real, F.lit(False)), "text")
        )
        return F.transform(F.filter(kinds, lambda k: k.isNotNull()), lambda k: F.struct(s["anchor_id"].alias("anchor_id"), k.alias("problem")))

    windows = windows_of(F.col(own), F.transform(spans, placed), 0)
    rows = rows.select(item, F.explode(F.flatten(F.transform(windows, problem))).alias(found))
    return rows.select(item, F.col(found)["anchor_id"].alias("anchor_id"), F.col(found)["problem"].alias("problem"))
