"""Registered queries over texts: canonical text, tables, anchors, snippets and hooks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import anchors as A
from ..operators import evidence, hooks
from ..sources.html import fenced_text, page_text, with_parts
from ..sources.tables import read_canonical, read_prompt_views, table, work_dir, write_views
from . import inputs
from .inputs import LISTS, PROSE, TABLES

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


# ---- DuckDB: pieces of the oracles ----
_BULLET = r"'^\s*(?:[-•]|\([A-Za-z0-9]+\))\s+'"
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_BLANKS = r"regexp_replace({}, '[ \t]{{2,}}', ' ', 'g')"
_CLEAN = r"regexp_replace(replace({}, chr(13), ''), '\n{{3,}}', chr(10) || chr(10), 'g')"


def _reflow(p: str) -> str:
    lines = f"string_split({p}, chr(10))"
    kept = _STRIP.format(f"array_to_string(list_transform({lines}, lambda x: {_STRIP.format(_BLANKS.format('x'))}), chr(10))")
    flat = _BLANKS.format(f"array_to_string(list_filter(list_transform({lines}, lambda x: {_STRIP.format('x')}), lambda x: x <> ''), ' ')")
    return f"CASE WHEN len(list_filter({lines}, lambda x: regexp_matches(x, {_BULLET}))) > 0 THEN {kept} ELSE {flat} END"


def _paragraphs(text: str) -> str:
    return f"array_to_string(list_filter(list_transform(string_split({_CLEAN.format(text)}, chr(10) || chr(10)), lambda p: {_reflow('p')}), lambda q: q <> ''), chr(10) || chr(10))"


def _bullets(text: str) -> str:
    line = f"CASE WHEN regexp_matches(x, {_BULLET}) THEN '- ' || regexp_replace(x, {_BULLET}, '') ELSE {_BLANKS.format('x')} END"
    return rf"array_to_string(list_transform(string_split({text}, chr(10)), lambda x: {line}), chr(10))"


_TEXT_OF_PAGE = r"""regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html,
  '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<!doctype[^>]*>', '<x>', 'g'), '(?:<[^>]*>)+', chr(10), 'g'),
  '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '^\n+|\n+$', '', 'g')"""

_SENTENCES = "WITH " + PROSE + r""", blk AS (
  SELECT item_id, i - 1 AS block, parts[i] AS part,
         coalesce(sum(length(parts[i]) + 2) OVER (PARTITION BY item_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM (SELECT item_id, string_split(text, chr(10) || chr(10)) AS parts FROM prose), unnest(range(1, len(parts) + 1)) AS t(i)
), blocks AS (
  SELECT item_id, CAST(block AS INT) AS block, CAST(off + length(part) - length(ltrim(part, chr(10))) AS INT) AS start,
         CAST(off + length(rtrim(part, chr(10))) AS INT) AS "end", trim(part, chr(10)) AS block_text
  FROM blk WHERE regexp_replace(part, '\s', '', 'g') <> ''
), cut AS (
  SELECT item_id, block, start, i - 1 AS piece, p[i] AS piece_text FROM (
    SELECT *, string_split(regexp_replace(regexp_replace(block_text, '([A-Za-z0-9]{2}[.!?])(\s+[A-Za-z])', '\1' || chr(30) || '\2', 'g'),
      '([A-Za-z0-9]{2}[.!?])(\s+[A-Za-z])', '\1' || chr(30) || '\2', 'g'), chr(30)) AS p FROM blocks), unnest(range(1, len(p) + 1)) AS t(i)
), pieces AS (
  SELECT item_id, block, CAST(piece AS INT) AS piece, piece_text,
         CAST(start + coalesce(sum(length(piece_text)) OVER (PARTITION BY item_id, block ORDER BY piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS piece_start,
         lag(lower(regexp_replace(regexp_extract(piece_text, '(\S+)\s*$', 1), '[.!?]+$', ''))) OVER (PARTITION BY item_id, block ORDER BY piece) AS ended
  FROM cut
), marked AS (
  SELECT *, CASE WHEN piece = 0 OR ended NOT IN (""" + ", ".join(f"'{w}'" for w in T.ABBREVIATIONS) + r""") THEN 1 ELSE 0 END AS begins FROM pieces
), summed AS (
  SELECT *, sum(begins) OVER (PARTITION BY item_id, block ORDER BY piece) AS sentence FROM marked
), sents AS (
  SELECT item_id, block, CAST(sentence AS INT) AS sentence,
         min(piece_start + CASE WHEN begins = 1 AND piece > 0 THEN length(piece_text) - length(regexp_replace(piece_text, '^\s+', '')) ELSE 0 END) AS start,
         max(piece_start + length(piece_text))::INT AS "end"
  FROM summed GROUP BY ALL
), counted AS (
  SELECT *, count(*) OVER (PARTITION BY item_id, block) = 1 AND "end" - start > 400 AS is_long FROM sents
), halves AS (
  SELECT b.item_id, b.block, b.start, b."end", block_text, length(block_text) - length(regexp_replace(block_text, '^\s+', '')) AS lead,
         length(regexp_extract(block_text, '(?s)^(.*?[.!?])\s+', 1)) AS n1, length(regexp_extract(block_text, '(?s)^.*?[.!?]\s+', 0)) AS n0
  FROM blocks b SEMI JOIN (SELECT * FROM counted WHERE is_long) c ON b.item_id = c.item_id AND b.block = c.block
), long_ AS (
  SELECT item_id, block, 0 AS sentence, start, "end" FROM halves WHERE n0 = 0
  UNION ALL SELECT item_id, block, 0, start + lead, start + n1 FROM halves WHERE n0 > 0 AND n1 > lead
  UNION ALL SELECT item_id, block, 1, start + n0, start + length(regexp_replace(block_text, '\s+$', '')) FROM halves WHERE n0 > 0 AND length(regexp_replace(block_text, '\s+$', '')) > n0
), split_ AS (
  SELECT item_id, block, sentence, start, "end" FROM counted WHERE NOT is_long UNION ALL SELECT * FROM long_
), owned AS (
  SELECT s.*, CASE WHEN row_number() OVER (PARTITION BY s.item_id, s.block ORDER BY sentence) = 1
    OR length(regexp_replace(substring(text, s.start + 1, s."end" - s.start), '^\s+|\s+$', '', 'g')) >= 10 THEN 1 ELSE 0 END AS own
  FROM split_ s JOIN prose USING (item_id)
), grouped AS (
  SELECT *, sum(own) OVER (PARTITION BY item_id, block ORDER BY sentence) AS g FROM owned
), merged AS (
  SELECT item_id, block, CAST(g AS INT) AS sentence, CAST(min(start) AS INT) AS start, CAST(max("end") AS INT) AS "end" FROM grouped GROUP BY item_id, block, g
), anchors AS (
  SELECT item_id, printf('A%04d', row_number() OVER (PARTITION BY item_id ORDER BY start)) AS anchor_id, 'sentence' AS anchor_type, start, "end" FROM merged
)"""
_SNIPPETS = _SENTENCES + """, snippets AS (
  SELECT item_id, anchor_id, anchor_type AS label, anchor_type AS type, start, "end", substring(text, greatest(0, start - 400) + 1, least(length(text), "end" + 400) - greatest(0, start - 400)) AS snippet,
         greatest(0, start - 400) AS snippet_start, CAST(least(length(text), "end" + 400) AS INT) AS snippet_end
  FROM anchors JOIN prose USING (item_id))"""


def _md5(column, name: str):
    return F.md5((F.col(column) if isinstance(column, str) else column).cast("binary")).alias(name)


# ---- canonical text ----


#: DuckDB: the text before and after the place where some pages have a table; the further references stand in the headline.
_RICH = (
    "rich AS (SELECT page_id, page_id % 4 = 1 AS tabled, "
    + ", ".join(
        f"replace({_TEXT_OF_PAGE.replace('html', own, 1)}, '&eacute;&#8212;&#x41;&nbsp;x&hellip;', 'é—A' || chr(160) || 'x…') AS {name}"
        for name, own in (
            ("front", "CASE WHEN page_id % 3 = 0 THEN replace(parts[1], '</h1>', ' &eacute;&#8212;&#x41;&nbsp;x&hellip;</h1>') ELSE parts[1] END"),
            ("back", "parts[2]"),
            ("whole", "CASE WHEN page_id % 3 = 0 THEN replace(html, '</h1>', ' &eacute;&#8212;&#x41;&nbsp;x&hellip;</h1>') ELSE html END"),
        )
    )
    + " FROM (SELECT page_id, html, string_split(html, '</article>') AS parts FROM pages))"
)


@query(
    "html_to_text",
    f"""WITH {_RICH} SELECT page_id, CASE WHEN tabled THEN front || chr(10) || chr(10) || {inputs.RICH_TABLE.format(gap='  ')} || chr(10) || chr(10) || back ELSE whole END AS text FROM rich""",
)
def html_to_text(spark, sf_dir):
    """Text nodes of pages, some with tables and all kinds of references."""
    return page_text(inputs.rich_pages(spark, sf_dir))


_CANONICAL = f"""WITH {_RICH} SELECT page_id, CASE WHEN tabled
  THEN {_bullets(_paragraphs('front'))} || chr(10) || chr(10) || {inputs.RICH_TABLE.format(gap=' ')} || chr(10) || chr(10) || {_bullets(_paragraphs('back'))}
  ELSE {_bullets(_paragraphs('whole'))} END AS text FROM rich"""


def _canonical(spark, sf_dir):
    return page_text(inputs.rich_pages(spark, sf_dir)).select("page_id", T.canonical(F.col("text")).alias("text"))


@query("canonical_text", _CANONICAL)
def canonical_text(spark, sf_dir):
    """Canonical text of pages, some with tables and all kinds of references."""
    return _canonical(spark, sf_dir)


@query("canonical_views", f"SELECT page_id AS item_id, text, text AS prompt_view FROM ({_CANONICAL})")
def canonical_views(spark, sf_dir):
    """Canonical texts of a run written, and read back with their prompt views."""
    path = work_dir(spark)
    write_views(_canonical(spark, sf_dir).withColumnRenamed("page_id", "item_id"), path, "r1")
    write_views(spark.createDataFrame([(-1, "other")], "item_id long, text string"), path, "r2")
    return read_canonical(spark, path, "r1").join(read_prompt_views(spark, path, "r1"), "item_id")


@query("newline_cleanup", f"WITH {LISTS} SELECT item_id, {_CLEAN.format('text')} AS text FROM lists")
def newline_cleanup(spark, sf_dir):
    """Texts without carriage returns and long runs of newlines."""
    return inputs.lists(spark, sf_dir).select("item_id", T.newline_cleanup(F.col("text")).alias("text"))


@query("paragraph_reflow", f"WITH {PROSE} SELECT item_id, {_paragraphs('text')} AS text FROM prose")
def paragraph_reflow(spark, sf_dir):
    """Paragraphs each on a line."""
    return inputs.prose(spark, sf_dir).select("item_id", T.paragraph_reflow(F.col("text")).alias("text"))


@query("list_paragraphs", f"WITH {LISTS} SELECT item_id, {_paragraphs('text')} AS text FROM lists")
def list_paragraphs(spark, sf_dir):
    """Paragraphs that are lists keep their lines."""
    return inputs.lists(spark, sf_dir).select("item_id", T.paragraph_reflow(F.col("text")).alias("text"))


@query("bullet_normalize", f"WITH {LISTS} SELECT item_id, {_bullets('replace(text, chr(13), chr(32))')} AS text FROM lists")
def bullet_normalize(spark, sf_dir):
    """List markers made alike."""
    return inputs.lists(spark, sf_dir).select("item_id", T.bullet_normalize(F.replace("text", F.lit("\r"), F.lit(" "))).alias("text"))


@query("blank_collapse", f"WITH {LISTS} SELECT item_id, {_BLANKS.format('text')} AS text FROM lists")
def blank_collapse(spark, sf_dir):
    """Runs of blanks and tabs as one blank."""
    return inputs.lists(spark, sf_dir).select("item_id", T.blank_collapse(F.col("text")).alias("text"))


def _fenced(spark, sf_dir):
    pages = with_parts(inputs.tables_html(spark, sf_dir))
    return pages.select("item_id", fenced_text(F.col("parts")).alias("text"))


@query("table_markdown", f"WITH {TABLES} SELECT item_id, table_text FROM markdown")
def table_markdown(spark, sf_dir):
    """Tables of pages as Markdown."""
    return _fenced(spark, sf_dir).select("item_id", F.regexp_extract("text", r"(?s)\[\[TABLE\]\]\n(.*?)\n\[\[/TABLE\]\]", 1).alias("table_text"))


@query(
    "table_spans",
    f"""WITH {TABLES} SELECT item_id, CAST(length('Page ' || item_id) + 2 AS INT) AS start,
CAST(length('Page ' || item_id) + 2 + 21 + length({_BLANKS.format('table_text')}) AS INT) AS "end" FROM markdown""",
)
def table_spans(spark, sf_dir):
    """Spans of tables in canonical text."""
    texts = _fenced(spark, sf_dir).select("item_id", T.canonical(F.col("text")).alias("text"))
    return A.table_spans(texts)


@query(
    "ascii_table",
    """SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '[[TABLE]]' || chr(10) || c_name || chr(10) || c_mktsegment || chr(10) || '[[/TABLE]]' END AS text FROM customer""",
)
def ascii_table(spark, sf_dir):
    """Tables without rows, some without any text."""
    html = F.expr("if(c_custkey % 5 = 0, '<table> <b></b></table>', concat('<table>', c_name, '\\n  <b> ', c_mktsegment, '</b></table>'))")
    pages = table(spark, sf_dir, "customer").select("c_custkey", html.alias("html"))
    return with_parts(pages).select("c_custkey", T.strip(fenced_text(F.col("parts"))).alias("text"))


# ---- anchors ----


def _blocks(spark, sf_dir):
    return A.units(inputs.prose(spark, sf_dir))


@query("blocks", _SENTENCES + ' SELECT item_id, block, start, "end", md5(block_text) AS block_md5 FROM blocks')
def blocks(spark, sf_dir):
    """Blocks between blank lines."""
    return _blocks(spark, sf_dir).select("item_id", "block", "start", "end", _md5("block_text", "block_md5"))


@query("block_offsets", _SENTENCES + ' SELECT item_id, block, start, "end", substring(text, start + 1, "end" - start) = block_text AS same FROM blocks JOIN prose USING (item_id)')
def block_offsets(spark, sf_dir):
    """Blocks held against the text at their spans."""
    rows = _blocks(spark, sf_dir).join(inputs.prose(spark, sf_dir), "item_id")
    same = F.substring("text", F.col("start") + 1, F.col("end") - F.col("start")) == F.col("block_text")
    return rows.select("item_id", "block", "start", "end", same.alias("same"))


@query("sentence_split", _SENTENCES + " SELECT item_id, block, piece, piece_start, md5(piece_text) AS piece_md5 FROM pieces")
def sentence_split(spark, sf_dir):
    """Texts cut at every possible sentence end."""
    return A.pieces(_blocks(spark, sf_dir)).select("item_id", "block", "piece", F.col("start").alias("piece_start"), _md5("text", "piece_md5"))


@query("sentence_abbrev", _SENTENCES + ' SELECT item_id, block, sentence, start, "end" FROM sents')
def sentence_abbrev(spark, sf_dir):
    """Sentences that abbreviations do not end."""
    return A.sentences(_blocks(spark, sf_dir)).select("item_id", "block", (F.col("sentence") + 1).alias("sentence"), "start", "end")


@query("long_block_split", _SENTENCES + ' SELECT item_id, block, start, "end" FROM split_')
def long_block_split(spark, sf_dir):
    """Long blocks of one sentence cut in two."""
    return A.long_blocks(_blocks(spark, sf_dir)).select("item_id", "block", "start", "end")


@query("fragment_merge", _SENTENCES + ' SELECT item_id, block, sentence, start, "end" FROM merged')
def fragment_merge(spark, sf_dir):
    """Short sentences joined with the ones before."""
    return A.merged(_blocks(spark, sf_dir)).select("item_id", "block", (F.col("sentence") + 1).alias("sentence"), "start", "end")


_LIST_TEXT = f"WITH {LISTS}, canon AS (SELECT item_id, {_bullets(_paragraphs('text'))} AS text FROM lists)"


@query(
    "bullet_anchors",
    _LIST_TEXT
    + r""", blk AS (
  SELECT item_id, i AS block, parts[i] AS part, coalesce(sum(length(parts[i]) + 2) OVER (PARTITION BY item_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM (SELECT item_id, string_split(text, chr(10) || chr(10)) AS parts FROM canon), unnest(range(1, len(parts) + 1)) AS t(i)
), ln AS (
  SELECT item_id, block, i AS line, lines[i] AS line_text, off + coalesce(sum(length(lines[i]) + 1) OVER (PARTITION BY item_id, block ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s,
         CASE WHEN regexp_matches(lines[i], '^\s*(?:[-•]|\([A-Za-z0-9]+\))\s+') THEN 1 ELSE 0 END AS b
  FROM (SELECT *, string_split(part, chr(10)) AS lines FROM blk), unnest(range(1, len(lines) + 1)) AS t(i)
), fl AS (
  SELECT *, sum(b) OVER (PARTITION BY item_id, block) AS nb, count(*) OVER (PARTITION BY item_id, block) AS nl, sum(b) OVER (PARTITION BY item_id, block ORDER BY line) AS g FROM ln
)
SELECT item_id, CAST(min(s) AS INT) AS start, CAST(max(s + length(line_text)) AS INT) AS "end" FROM fl WHERE nb >= 2 AND nb * 2 > nl GROUP BY item_id, block, g""",
)
def bullet_anchors(spark, sf_dir):
    """Bullets of list blocks."""
    texts = inputs.lists(spark, sf_dir).select("item_id", T.canonical(F.col("text")).alias("text"))
    return A.sentences(A.units(texts).where("kind = 'bullet'")).select("item_id", "start", "end")


@query("anchors", _SENTENCES + " SELECT * FROM anchors")
def anchors(spark, sf_dir):
    """Numbered anchors with their spans."""
    return A.anchors(inputs.prose(spark, sf_dir))


@query("anchor_ids", _SENTENCES + " SELECT item_id, count(*) AS n, min(anchor_id) AS first_id, max(anchor_id) AS last_id FROM anchors GROUP BY 1")
def anchor_ids(spark, sf_dir):
    """First and last number of each item's anchors."""
    return A.anchors(inputs.prose(spark, sf_dir)).groupBy("item_id").agg(F.count("*").alias("n"), F.min("anchor_id").alias("first_id"), F.max("anchor_id").alias("last_id"))


@query("anchor_tsv", _SENTENCES + ' SELECT CAST(item_id AS VARCHAR) AS item_id, anchor_id, anchor_type, start, "end", anchor_type AS label FROM anchors')
def anchor_tsv(spark, sf_dir):
    """Anchors written as tab-separated files and read back."""
    path = work_dir(spark)
    evidence.write_anchor_tsv(A.anchors(inputs.prose(spark, sf_dir)), path)
    return evidence.read_anchor_tsv(spark, path)


@query(
    "annotated_view",
    _SENTENCES
    + """ SELECT item_id, md5(string_agg('[[' || anchor_id || ']]' || chr(10) || substring(text, start + 1, "end" - start) || chr(10), chr(10) ORDER BY start)) AS text_md5
FROM anchors JOIN prose USING (item_id) GROUP BY item_id""",
)
def annotated_view(spark, sf_dir):
    """Texts with the number above each anchor."""
    return A.annotated(inputs.prose(spark, sf_dir)).select("item_id", _md5("text", "text_md5"))


# ---- snippets and hooks ----


def _snippets(spark, sf_dir):
    texts = inputs.prose(spark, sf_dir)
    chosen = A.anchors(texts).select("item_id", "anchor_id", F.col("anchor_type").alias("label"), F.col("anchor_type").alias("type"), "start", "end")
    return evidence.snippets(chosen, texts)


@query("snippets", _SNIPPETS + ' SELECT item_id, anchor_id, label, type, start, "end", snippet, snippet_start, snippet_end FROM snippets')
def snippets(spark, sf_dir):
    """Anchors with 400 characters on either side."""
    return _snippets(spark, sf_dir).select(*evidence.SNIPPET_FIELDS)


@query(
    "snippet_json",
    _SNIPPETS
    + """ SELECT '{"item_id":' || item_id || ',"anchor_id":"' || anchor_id || '","label":"sentence","type":"sentence","start":' || start || ',"end":' || "end" || ',"snippet":'
|| to_json(snippet) || ',"snippet_start":' || snippet_start || ',"snippet_end":' || snippet_end || '}' AS value FROM snippets""",
)
def snippet_json(spark, sf_dir):
    """Snippets as JSON lines."""
    return evidence.to_json_lines(_snippets(spark, sf_dir))


@query("span_check", _SNIPPETS + """ SELECT item_id, anchor_id, 'text' AS problem FROM snippets WHERE start % 10 = 3
UNION ALL SELECT item_id, anchor_id, 'bounds' FROM snippets WHERE start % 10 = 4""")
def span_check(spark, sf_dir):
    """What is wrong with snippets of which some were changed."""
    texts = inputs.prose(spark, sf_dir)
    rows = _snippets(spark, sf_dir).withColumn("snippet", F.when(F.col("start") % 10 == 3, "changed").otherwise(F.col("snippet")))
    rows = rows.withColumn("end", F.when(F.col("start") % 10 == 4, F.col("start") - 1).otherwise(F.col("end")))
    return A.violations(rows, texts)


_WORD = "Inc."


@query(
    "index_hook",
    f"""WITH {PROSE} SELECT item_id || '_01' AS item_id, 'A0001' AS anchor_id, 'hit' AS label, 'sentence' AS type, CAST(position('{_WORD}' IN text) - 1 AS INT) AS start,
CAST(position('{_WORD}' IN text) - 1 + {len(_WORD)} AS INT) AS "end", sha256('{_WORD}') AS prompt_sha256 FROM prose WHERE contains(text, '{_WORD}')""",
)
def index_hook(spark, sf_dir):
    """Anchors that a plugged-in keyword search picks."""

    def select(prompt, view):
        at = view.find(prompt)
        return [] if at < 0 else [{"anchor_id": "A0001", "label": "hit", "type": "sentence", "start": at, "end": at + len(prompt)}]

    views = inputs.prose(spark, sf_dir).withColumn("item_id", F.concat("item_id", F.lit("_01")))
    return hooks.index_items(views, _WORD, select, store=work_dir(spark))


@query("extract_hook", _SNIPPETS + " SELECT item_id, count(*) AS n, CAST(sum(length(snippet)) AS BIGINT) AS chars FROM snippets GROUP BY 1")
def extract_hook(spark, sf_dir):
    """What a plugged-in function makes of each item's snippets."""
    import pandas as pd

    def extract(prompt, frames):
        item, n, chars = None, 0, 0
        for rows in frames:
            item, n, chars = rows["item_id"].iloc[0], n + len(rows), chars + int(rows["snippet"].str.len().sum())
        yield pd.DataFrame({"item_id": [item], "n": [n], "chars": [chars]})

    found = _snippets(spark, sf_dir).select("item_id", "start", "snippet")
    return hooks.extract_items(found, "count", extract, "item_id long, n long, chars long", order=["start"])
