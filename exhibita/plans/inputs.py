"""Filings, lists and prose that the registered queries derive from the given tables, in Spark and in DuckDB.

The DuckDB side has the same rows as plain columns: it never takes a filing apart.
"""

from __future__ import annotations

import io
import tarfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import file_system, spread, table, work_dir

#: Both dialects: the fields that each document has in its filing.
_FIELDS = """
  doc_id, text, {div} AS sub, CAST(doc_id % 4 AS INT) AS pos,
  CASE WHEN doc_id % 13 <> 0 THEN concat('EX-', 1 + doc_id % 12, '.', doc_id % 3) END AS type,
  CASE WHEN doc_id % 6 = 0 THEN NULL WHEN doc_id % 97 = 5 THEN 'x1' ELSE CAST(4 - doc_id % 4 AS {text}) END AS sequence,
  CASE WHEN doc_id % 8 <> 3 THEN concat('d', doc_id, '.htm') END AS filename,
  CASE WHEN doc_id % 10 <> 7 THEN concat('{nl}', coalesce(text, ''), '{nl}') END AS content
"""
_SUB = """
  concat(lpad(CAST({acc} AS {text}), 10, '0'), '-20-', lpad(CAST({acc} % 1000 AS {text}), 6, '0')) AS own_accession,
  CASE WHEN sub % 7 <> 0 THEN CAST(1000 + sub AS {text}) END AS cik,
  concat('202001', lpad(CAST(1 + sub % 28 AS {text}), 2, '0')) AS filing_date
"""
_ACC = "(sub - CASE WHEN sub % 17 = 3 THEN 1 ELSE 0 END)"

#: DuckDB: ``filed`` has the documents with their fields, ``subs`` a row for each submission.
FILED = (
    "filed AS (SELECT "
    + _FIELDS.format(div="doc_id // 4", text="VARCHAR", nl="' || chr(10) || '")
    + " FROM documents), subs AS (SELECT sub, "
    + _SUB.format(acc=_ACC, text="VARCHAR")
    + ", CASE WHEN sub % 5 <> 0 THEN own_accession END AS accession, CASE WHEN sub % 11 <> 0 THEN '10-K' ELSE first_type END AS form_type"
    + " FROM (SELECT sub, min_by(type, pos) FILTER (type IS NOT NULL) AS first_type FROM filed GROUP BY sub))"
)


def filed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the fields that they get in their filings."""
    fields = _FIELDS.format(div="doc_id div 4", text="STRING", nl="\\n")
    rows = table(spark, sf_dir, "documents")
    return rows.selectExpr(*[x.strip() for x in _split(fields)])


def _split(fields: str) -> list[str]:
    out, depth, last = [], 0, 0
    for k, c in enumerate(fields):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(fields[last:k])
            last = k + 1
    return [*out, fields[last:]]


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(tarball, member_pos, member_name, text)``: four documents to a submission, in SGML."""
    one = lambda tag, value: F.when(F.col(value).isNotNull(), F.concat(F.lit(f"<{tag}>"), F.col(value), F.lit("\n"))).otherwise("")
    text = F.when(F.col("content").isNotNull(), F.concat(F.lit("<TEXT>"), "content", F.lit("</TEXT>\n"))).otherwise("")
    section = F.concat(F.lit("\n"), one("TYPE", "type"), one("SEQUENCE", "sequence"), one("FILENAME", "filename"), text)
    rows = filed(spark, sf_dir).select("sub", "pos", section.alias("section"))
    # four documents to a group
    subs = rows.groupBy("sub").agg(F.array_sort(F.collect_list(F.struct("pos", "section"))).alias("parts"))
    subs = subs.selectExpr("*", *[x.strip() for x in _split(_SUB.format(acc=_ACC, text="STRING"))])
    head = F.concat(
        F.lit("<SUBMISSION>\n"),
        F.expr("if(sub % 5 <> 0, concat('<ACCESSION-NUMBER>', own_accession, '\\n'), '')"),
        F.expr("if(cik IS NOT NULL, concat('<CIK>', cik, '  \\n'), '')"),
        F.expr("if(sub % 11 <> 0, '<TYPE> 10-K\\n', '')"),
        F.expr("concat('<FILING-DATE>', filing_date, '\\n')"),
    )
    body = F.array_join("parts.section", "</DOCUMENT>\n<DOCUMENT>")
    tail = F.expr("if(sub % 9 = 0, '', '</DOCUMENT>\\n')")
    return subs.select(
        F.concat(F.lit("archive-"), F.expr("sub div 16")).alias("tarball"),
        F.col("sub").alias("member_pos"),
        F.concat(F.lit("f/"), F.translate("own_accession", "-", ""), F.lit(".nc")).alias("member_name"),
        F.concat(head, F.lit("<DOCUMENT>"), body, tail).alias("text"),
    )


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(tarball, content)``: the submissions in gzipped archives of sixteen, with other members between them."""

    def pack(group: pa.Table) -> pa.Table:
        rows = sorted(zip(*(group[c].to_pylist() for c in ("member_pos", "member_name", "text")), strict=True))
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w:gz", compresslevel=1) as archive:
            folder = tarfile.TarInfo("f.nc")
            folder.type = tarfile.DIRTYPE
            archive.addfile(folder)
            for pos, name, text in rows:
                for own, data in ((name if pos % 2 else name.upper(), text.encode()), (f"{name}.txt", b"other")):
                    info = tarfile.TarInfo(own)
                    info.size = len(data)
                    archive.addfile(info, io.BytesIO(data))
        return pa.table({"tarball": group["tarball"][:1], "content": pa.array([out.getvalue()], pa.binary())})

    return submissions(spark, sf_dir).groupBy("tarball").applyInArrow(pack, "tarball string, content binary")


def packed_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder of those archives as files ``archive-N.tar.gz``, written by the tasks that pack them."""
    path = work_dir(spark)

    def write(batches):
        for batch in batches:
            for name, content in zip(batch.column("tarball").to_pylist(), batch.column("content"), strict=True):
                files, folder = file_system(path)
                files.create_dir(folder, recursive=True)
                part = f"{folder}/.{name}.{uuid.uuid4().hex}"
                with files.open_output_stream(part) as out:
                    out.write(content.as_buffer())
                files.move(part, f"{folder}/{name}.tar.gz")
            yield pa.RecordBatch.from_arrays([batch.column("tarball")], names=["tarball"])

    # every archive is written before any is read
    packed(spark, sf_dir).mapInArrow(write, "tarball string").write.format("noop").mode("overwrite").save()
    return path


#: Prose with blank lines, abbreviations and long sentences; the same expression in both dialects.
_PROSE = """CASE doc_id % 4 WHEN 0 THEN replace(text, {nl}, {nl2}) WHEN 1 THEN replace(text, ', ', ' Inc. ')
  WHEN 2 THEN replace(replace(text, '. ', ' '), {dot}, ' ') ELSE text END"""
PROSE = "prose AS (SELECT doc_id AS item_id, " + _PROSE.format(nl="chr(10)", nl2="chr(10) || chr(10)", dot="'.' || chr(10)") + " AS text FROM documents)"


def prose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item_id, text)``."""
    text = _PROSE.format(nl="'\\n'", nl2="'\\n\\n'", dot="'.\\n'")
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).selectExpr("doc_id AS item_id", f"{text} AS text")


_LINE = """concat(CASE turn % 5 WHEN 0 THEN '(a)  ' WHEN 1 THEN '-   ' WHEN 2 THEN concat('  ', chr(8226), ' ') WHEN 3 THEN '(iv) ' ELSE '' END, coalesce(text, ''),
  CASE WHEN turn % 3 = 0 THEN concat('  ', chr(9), 'end ') ELSE chr(13) END)"""
LISTS = (
    "lists AS (SELECT item_id, CASE WHEN item_id % 3 = 0 THEN array_to_string(l, chr(10) || chr(10) || chr(10) || chr(10)) ELSE array_to_string(l, chr(10)) END AS text"
    " FROM (SELECT conv_id AS item_id, list(" + _LINE + " ORDER BY turn) AS l FROM conversations GROUP BY conv_id))"
)


def lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item_id, text)``: conversations folded into lists, with carriage returns, tabs and runs of blanks."""
    line = F.expr(_LINE.replace("chr(8226)", "'•'"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", line.alias("line")).alias("s"))
    rows = rows.groupBy(F.col("conv_id").alias("item_id")).agg(F.array_sort(F.collect_list("s")).alias("s"))
    joined = F.when(F.col("item_id") % 3 == 0, F.array_join("s.line", "\n\n\n\n")).otherwise(F.array_join("s.line", "\n"))
    return rows.select("item_id", joined.alias("text"))


def tables_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item_id, html)``: a page for each customer segment and nation, with a ragged table of its customers' key figures.

    A page holds at most ten rows.
    """
    rows = table(spark, sf_dir, "customer").select(
        F.expr("c_custkey div 10").alias("item_id"),
        F.struct(
            "c_custkey",
            F.concat(
                F.lit("<tr><td>"), F.col("c_name"), F.lit("</td><td> "), F.col("c_mktsegment"), F.lit(" </td>"),
                F.expr("if(c_custkey % 3 = 0, '', concat('<td>n', c_nationkey, '</td>'))"), F.lit("</tr>"),
            ).alias("row"),
        ).alias("s"),
    )
    rows = rows.groupBy("item_id").agg(F.array_sort(F.collect_list("s")).alias("s"))
    page = F.concat(F.lit("<html><body><p>Page "), "item_id", F.lit("</p>\n<table>"), F.array_join("s.row", "\n"), F.lit("</table>\n<p>End.</p></body></html>"))
    return rows.select("item_id", page.alias("html"))


#: DuckDB: the Markdown of those tables straight from the rows.
TABLES = """tables AS (
  SELECT c_custkey // 10 AS item_id, max(CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 3 END) AS width,
         list('| ' || c_name || ' | ' || c_mktsegment || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ' | n' || c_nationkey END ORDER BY c_custkey) AS rows,
         list(c_custkey % 3 = 0 ORDER BY c_custkey) AS short FROM customer GROUP BY 1
), markdown AS (
  SELECT item_id, array_to_string(list_concat([padded[1]], [CASE width WHEN 3 THEN '| --- | --- | --- |' ELSE '| --- | --- |' END], padded[2:]), chr(10)) AS table_text
  FROM (SELECT item_id, width, list_transform(range(1, len(rows) + 1), lambda i: rows[i] || CASE WHEN width = 3 AND short[i] THEN ' |  |' ELSE ' |' END) AS padded FROM tables)
)"""


#: Both dialects: pages of which some have further references in their headline, and some a table at the article's end.
_RICH = """replace(CASE WHEN page_id % 3 = 0 THEN replace(html, '</h1>', ' &eacute;&#8212;&#x41;&nbsp;x&hellip;</h1>') ELSE html END, '</article>',
  CASE WHEN page_id % 4 = 1 THEN concat('<table><tr><th>No.</th><td> p&amp;q </td></tr>{nl}<tr><td>', page_id, '</td></tr></table></article>') ELSE '</article>' END)"""


def rich_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, html)``."""
    return spread(table(spark, sf_dir, "pages").select("page_id", "html")).selectExpr("page_id", _RICH.format(nl="\\n") + " AS html")


#: DuckDB: the table's Markdown, never taken from the page.
RICH_TABLE = "'[[TABLE]]' || chr(10) || '| No. | p&q |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || page_id || ' |{gap}|' || chr(10) || '[[/TABLE]]'"
