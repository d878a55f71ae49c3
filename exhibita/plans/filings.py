"""Registered queries over filings: archives, headers, documents, lists, items and run records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import html_wrap, safe_item_id
from ..operators import checks, evidence, hooks, runs
from ..sources import submissions as S
from ..sources.archives import expanded, read_members
from ..sources.tables import read_exhibits, table, work_dir, write_exhibits
from . import inputs
from .inputs import FILED

QUERIES: dict = {}
ORACLES: dict = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _md5(column: str, name: str):
    return F.md5(F.col(column).cast("binary")).alias(name)


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the parsed submissions, with header fields and the submission's number."""
    subs = S.with_header(inputs.submissions(spark, sf_dir)).withColumnRenamed("member_pos", "sub")
    return S.documents(subs)


#: DuckDB: documents joined with their submissions, only submissions with a header accession.
_BOTH = "WITH " + FILED + ", both_ AS (SELECT f.*, s.accession, s.own_accession, s.cik, s.form_type, s.filing_date FROM filed f JOIN subs s USING (sub))"
_MEMBER = """
  SELECT s.sub, 'archive-' || (s.sub // 16) AS tarball, 'f/' || replace(own_accession, '-', '') || '.nc' AS member_name,
    '<SUBMISSION>' || chr(10) || CASE WHEN s.sub % 5 <> 0 THEN '<ACCESSION-NUMBER>' || own_accession || chr(10) ELSE '' END
    || CASE WHEN cik IS NOT NULL THEN '<CIK>' || cik || '  ' || chr(10) ELSE '' END || CASE WHEN s.sub % 11 <> 0 THEN '<TYPE> 10-K' || chr(10) ELSE '' END
    || '<FILING-DATE>' || filing_date || chr(10) || '<DOCUMENT>'
    || string_agg(chr(10) || CASE WHEN type IS NOT NULL THEN '<TYPE>' || type || chr(10) ELSE '' END
       || CASE WHEN sequence IS NOT NULL THEN '<SEQUENCE>' || sequence || chr(10) ELSE '' END || CASE WHEN filename IS NOT NULL THEN '<FILENAME>' || filename || chr(10) ELSE '' END
       || CASE WHEN content IS NOT NULL THEN '<TEXT>' || content || '</TEXT>' || chr(10) ELSE '' END, '</DOCUMENT>' || chr(10) || '<DOCUMENT>' ORDER BY pos)
    || CASE WHEN s.sub % 9 = 0 THEN '' ELSE '</DOCUMENT>' || chr(10) END AS text
  FROM filed f JOIN subs s USING (sub) GROUP BY ALL
"""


@query("WITH " + FILED + ", m AS (" + _MEMBER.replace("GROUP BY ALL", "GROUP BY s.sub, own_accession, cik, filing_date") + """)
SELECT tarball, CAST(2 * row_number() OVER (PARTITION BY tarball ORDER BY sub) - 1 AS INT) AS member_pos,
       CASE WHEN sub % 2 = 1 THEN member_name ELSE upper(member_name) END AS member_name, md5(text) AS content_md5 FROM m""")
def archive_scan(spark, sf_dir):
    """Members of gzipped archive files, folders and other files left out."""
    found = read_members(spark, [inputs.packed_files(spark, sf_dir)])
    name = F.regexp_extract("tarball", "(archive-\\d+)[.]tar[.]gz$", 1)
    return found.select(name.alias("tarball"), "member_pos", "member_name", F.md5("content").alias("content_md5"))


@query("WITH " + FILED + """ SELECT replace(own_accession, '-', '') AS accession, 'archive-' || max(sub // 16) AS tarball FROM subs GROUP BY 1""")
def archive_order(spark, sf_dir):
    """The archive that each accession is first read from, where the archives are given in reverse."""
    number = lambda path: int(path.rsplit("-", 1)[1].split(".")[0])
    files = [f for _, f in expanded(spark, [inputs.packed_files(spark, sf_dir)])]
    given = read_members(spark, sorted(files, key=number, reverse=True))
    rows = given.withColumn("accession", F.regexp_extract(F.lower("member_name"), "f/(.*)[.]nc", 1)).drop("content")
    rows = rows.withColumn("tarball", F.regexp_extract("tarball", "(archive-\\d+)[.]tar[.]gz$", 1))
    return S.first_per_key(rows, "accession", list(S.READ_ORDER)).select("accession", "tarball")


@query("SELECT doc_id, md5(coalesce(text, '') || 'z') AS text_md5 FROM documents")
def decode_lossy(spark, sf_dir):
    """Texts with bytes that are no UTF-8 put between them and a last letter."""
    content = F.concat(F.coalesce("text", F.lit("")).cast("binary"), F.lit(bytearray(b"\xff\xc3\xfe")), F.lit(bytearray(b"z")))
    rows = table(spark, sf_dir, "documents").select("doc_id", content.alias("content"))
    return S.decode_lossy(rows).select("doc_id", _md5("text", "text_md5"))


@query("WITH " + FILED + " SELECT own_accession AS accession FROM filed JOIN subs USING (sub) WHERE pos = 0")
def accession_list(spark, sf_dir):
    """Accessions from lines of which three in four are blank."""
    rows = inputs.filed(spark, sf_dir).selectExpr("*", *[x.strip() for x in inputs._split(inputs._SUB.format(acc=inputs._ACC, text="STRING"))])
    lines = rows.select(F.expr("CASE pos WHEN 0 THEN concat(' \\t', own_accession, chr(160)) WHEN 1 THEN '   ' ELSE '' END").alias("value"))
    return S.accession_list(lines).select("accession")


@query("SELECT doc_id % 100 AS item_id, max(doc_id) AS ord, md5(arg_max(coalesce(text, ''), doc_id)) AS html_md5 FROM documents GROUP BY 1")
def exhibit_last_wins(spark, sf_dir):
    """Of repeated items the last one's HTML."""
    rows = table(spark, sf_dir, "documents").select((F.col("doc_id") % 100).alias("item_id"), F.col("doc_id").alias("ord"), F.coalesce("text", F.lit("")).alias("html"))
    return S.last_per_key(rows, "item_id", ["ord"]).select("item_id", "ord", _md5("html", "html_md5"))


@query("SELECT page_id AS item_id, md5(html) AS html_md5, length(html) AS n FROM pages")
def exhibit_scan(spark, sf_dir):
    """Exhibits written for a run, each twice, and read back."""
    path = work_dir(spark)
    pages = table(spark, sf_dir, "pages")
    first = pages.select(F.lit("r1").alias("run_id"), F.col("page_id").alias("item_id"), F.lit(1).alias("order"), F.lit("old").alias("html"))
    last = pages.select(F.lit("r1").alias("run_id"), F.col("page_id").alias("item_id"), F.lit(2).alias("order"), "html")
    write_exhibits(first.union(last), path)
    write_exhibits(first.withColumn("run_id", F.lit("r2")), path)
    return read_exhibits(spark, path, "r1").select("item_id", _md5("html", "html_md5"), F.length("html").cast("long").alias("n"))


@query("""SELECT d.doc_id AS item_id, md5(CASE WHEN l.doc_id IS NOT NULL THEN d.text WHEN d.doc_id % 2 = 0 THEN 'old ' || d.text END) AS text_md5
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)""")
def view_fallback(spark, sf_dir):
    """Views of the labelled documents from the new place, of even ones from the old."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), "text")
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("item_id")).distinct()
    old = docs.where("item_id % 2 = 0").select("item_id", F.concat(F.lit("old "), "text").alias("text"))
    found = evidence.view_with_fallback(docs.select("item_id"), docs.join(labelled, "item_id", "left_semi"), old, strict=False)
    return found.select("item_id", _md5("text", "text_md5"))


def _anchor_json(spark, sf_dir):
    one = "named_struct('anchor_id', 'A0001', 'label', source, 'type', 'sentence', 'start', doc_id % 50, 'end', doc_id % 50 + 100)"
    docs = table(spark, sf_dir, "documents")
    text = F.concat(F.lit('{"anchors":['), F.expr(f"to_json({one})"), F.lit(',{"anchor_id":"A0002","label":"x","type":"table","end":"'), (F.col("doc_id") % 9).cast("string"), F.lit('"}]}'))
    return evidence.read_anchor_json(docs.select(F.col("doc_id").alias("item_id"), text.alias("json")))


_ANCHOR_JSON = """SELECT doc_id AS item_id, 'A0001' AS anchor_id, source AS label, 'sentence' AS type, CAST(doc_id % 50 AS INT) AS start, CAST(doc_id % 50 + 100 AS INT) AS "end" FROM documents
UNION ALL SELECT doc_id, 'A0002', 'x', 'table', 0, CAST(doc_id % 9 AS INT) FROM documents"""


@query(_ANCHOR_JSON)
def anchor_json(spark, sf_dir):
    """Selected anchors read from JSON."""
    return _anchor_json(spark, sf_dir)


@query("SELECT item_id, anchor_id, start, \"end\" FROM (" + _ANCHOR_JSON + ") WHERE anchor_id = 'A0002'")
def offset_coerce(spark, sf_dir):
    """Offsets that are missing or text."""
    return _anchor_json(spark, sf_dir).where("anchor_id = 'A0002'").select("item_id", "anchor_id", "start", "end")


@query("SELECT item_id, md5(text) AS md5, sha256(text) AS sha256 FROM benchmark")
def prompt_sha256(spark, sf_dir):
    """Fingerprints of texts."""
    return runs.fingerprints(table(spark, sf_dir, "benchmark"), "text").select("item_id", _md5("text", "md5"), "sha256")


@query("WITH " + FILED + " SELECT sub, accession, cik, form_type, filing_date FROM subs")
def sgml_header(spark, sf_dir):
    """Header fields of submissions, null where absent; the form type may come from a document."""
    found = S.with_header(inputs.submissions(spark, sf_dir))
    return found.select(F.col("member_pos").alias("sub"), "accession", "cik", "form_type", "filing_date")


@query("WITH " + FILED + " SELECT sub, pos, type IS NOT NULL AS typed FROM filed")
def sgml_documents(spark, sf_dir):
    """Documents of submissions by position; the last one may lack its end tag."""
    return _parsed(spark, sf_dir).select("sub", "pos", F.col("type").isNotNull().alias("typed"))


@query("WITH " + FILED + " SELECT sub, pos, type, sequence, filename FROM filed")
def sgml_doc_fields(spark, sf_dir):
    """Fields of documents, null where absent."""
    return _parsed(spark, sf_dir).select("sub", "pos", "type", "sequence", "filename")


@query("WITH " + FILED + " SELECT sub, pos, md5(content) AS content_md5, length(content) AS n FROM filed")
def sgml_body(spark, sf_dir):
    """Bodies of documents."""
    return _parsed(spark, sf_dir).select("sub", "pos", _md5("content", "content_md5"), F.length("content").cast("long").alias("n"))


@query("WITH " + FILED + """ SELECT sub, coalesce(accession, CASE WHEN sub % 2 = 0 THEN own_accession END) AS resolved FROM subs
WHERE coalesce(accession, CASE WHEN sub % 2 = 0 THEN own_accession END) IS NOT NULL""")
def accession_resolve(spark, sf_dir):
    """The header's accession, else the one that the member's name was matched with; submissions with neither go."""
    found = S.with_header(inputs.submissions(spark, sf_dir)).select(F.col("member_pos").alias("sub"), "accession", "member_name")
    found = found.withColumn("matched", F.when(F.col("sub") % 2 == 0, _accession()))
    return S.resolve_accessions(found).select("sub", F.col("accession").alias("resolved"))


@query("""SELECT 'd' AS kind, doc_id AS id, md5('<html><body><pre>' || coalesce(text, '') || '</pre></body></html>') AS html_md5 FROM documents
UNION ALL SELECT 'p', page_id, md5(html) FROM pages""")
def html_wrap_bodies(spark, sf_dir):
    """Bodies as HTML: texts get wrapped, pages stay."""
    docs = table(spark, sf_dir, "documents").select(F.lit("d").alias("kind"), F.col("doc_id").alias("id"), "text")
    pages = table(spark, sf_dir, "pages").select(F.lit("p").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    return docs.union(pages).select("kind", "id", F.md5(html_wrap(F.col("text")).cast("binary")).alias("html_md5"))


QUERIES["html_wrap"] = QUERIES.pop("html_wrap_bodies")
ORACLES["html_wrap"] = ORACLES.pop("html_wrap_bodies")

#: Kept documents: those with a type that is not EX-1...
_KEPT = _BOTH + """, kept AS (SELECT *, CAST(row_number() OVER (PARTITION BY sub ORDER BY pos) AS INT) AS ordinal FROM both_ WHERE type IS NOT NULL AND NOT starts_with(type, 'EX-1')),
named AS (SELECT * EXCLUDE (sequence, filename), coalesce(sequence, lpad(CAST(ordinal AS VARCHAR), 2, '0')) AS sequence,
  coalesce(filename, 'EX-10-' || coalesce(sequence, lpad(CAST(ordinal AS VARCHAR), 2, '0')) || '.html') AS filename,
  own_accession || '_' || coalesce(sequence, lpad(CAST(ordinal AS VARCHAR), 2, '0')) AS item_id FROM kept)"""


def _accession():
    """The accession of a submission from its name, for those without one in the header."""
    name = F.regexp_extract("member_name", "f/(\\d{10})20(\\d{6})", 1)
    return F.concat(name, F.lit("-20-"), F.regexp_extract("member_name", "f/(\\d{10})20(\\d{6})", 2))


def _nested(spark, sf_dir):
    """Submissions with their kept documents as an array."""
    subs = S.with_header(inputs.submissions(spark, sf_dir)).withColumnRenamed("member_pos", "sub")
    subs = subs.withColumn("accession", F.coalesce("accession", _accession()))
    return S.with_documents(subs, lambda d: ~S.doc_type_matches(d["type"], ["ex-1"]) & d["type"].isNotNull(), content=False)


def _items(spark, sf_dir):
    return S.flat(_nested(spark, sf_dir))


@query(_KEPT + " SELECT sub, pos, ordinal FROM kept")
def kept_ordinal(spark, sf_dir):
    """Numbers of the kept documents."""
    return _items(spark, sf_dir).select("sub", "pos", "ordinal")


@query(_KEPT + " SELECT sub, pos, type FROM kept")
def doc_filter(spark, sf_dir):
    """Documents that a column predicate keeps."""
    keep = lambda d: ~S.doc_type_matches(d["type"], ["ex-1"]) & d["type"].isNotNull()
    return hooks.filter_documents(_parsed(spark, sf_dir).drop("content"), keep).select("sub", "pos", "type")


@query(_BOTH + " SELECT sub, pos FROM both_ WHERE cik IS NOT NULL AND starts_with(type, 'EX-1')")
def filter_udf(spark, sf_dir):
    """Documents that a Python function keeps."""
    keep = lambda sub, doc: bool(sub["cik"]) and (doc["type"] or "").startswith("EX-1")
    return hooks.filter_callable(_parsed(spark, sf_dir).drop("content"), keep, ["cik", "form_type"], ["type", "sequence"]).select("sub", "pos")


@query(_KEPT + " SELECT sub, pos, sequence, filename FROM named")
def seq_defaults(spark, sf_dir):
    """Default sequences and file names."""
    return _items(spark, sf_dir).select("sub", "pos", "sequence", "filename")


@query("SELECT s_suppkey, regexp_replace(s_name || '/' || s_nationkey, '[^A-Za-z0-9._-]+', '_', 'g') || '_' || CASE WHEN s_suppkey % 3 = 0 THEN 'doc' || lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0') ELSE regexp_replace(s_suppkey || ' é(' || s_nationkey, '[^A-Za-z0-9._-]+', '_', 'g') END AS item_id FROM supplier")
def safe_item_ids(spark, sf_dir):
    """Item ids from names with other characters, and from blank sequences."""
    rows = table(spark, sf_dir, "supplier").withColumn("acc", F.expr("concat(s_name, '/', s_nationkey)"))
    rows = rows.withColumn("seq", F.expr("if(s_suppkey % 3 = 0, '', concat(s_suppkey, ' é(', s_nationkey))"))
    return rows.select("s_suppkey", safe_item_id(F.col("acc"), F.col("seq"), F.expr("CAST(s_suppkey % 100 AS INT)")).alias("item_id"))


QUERIES["safe_item_id"] = QUERIES.pop("safe_item_ids")
ORACLES["safe_item_id"] = ORACLES.pop("safe_item_ids")


@query("WITH " + FILED + """, l AS (SELECT DISTINCT CASE WHEN sub % 10 = 4 THEN left(own_accession, 10) ELSE own_accession END AS accession, CASE WHEN sub % 10 = 4 THEN 0 ELSE 1 END AS kind FROM subs WHERE sub % 5 = 4)
SELECT sub, CASE WHEN min(kind) = 0 THEN min(l.accession) FILTER (kind = 0) ELSE min(l.accession) END AS matched FROM subs JOIN l ON contains(replace(own_accession, '-', ''), replace(l.accession, '-', '')) GROUP BY sub""")
def accession_match(spark, sf_dir):
    """Members whose names hold a listed accession, with the first in the list that matches."""
    subs = inputs.submissions(spark, sf_dir).select(F.col("member_pos").alias("sub"), "member_name")
    rows = subs.where("sub % 5 = 4").withColumn("own", _accession())
    listed = rows.select(F.expr("if(sub % 10 = 4, left(own, 10), own)").alias("accession"), F.expr("if(sub % 10 = 4, 0, 1)").alias("kind")).distinct()
    ranked = listed.select(F.expr("concat(kind, accession)").alias("list_pos"), "accession")
    return S.match_accessions(subs, ranked).select("sub", "matched")


@query("""SELECT 'e' AS kind, event_id AS id FROM events WHERE event_type ILIKE 'c%' OR contains(lower(event_type), 'ie')
UNION ALL SELECT 'p', p_partkey FROM part WHERE p_type ILIKE 'econ%' OR p_type ILIKE 'promo%' OR contains(lower(p_type), 'steel')""")
def doc_type_match(spark, sf_dir):
    """Types by prefix or part, in any case."""
    events = table(spark, sf_dir, "events").where(S.doc_type_matches(F.col("event_type"), ["C"], "IE"))
    parts = table(spark, sf_dir, "part").where(S.doc_type_matches(F.col("p_type"), ["econ", "PROMO"], "Steel"))
    return events.select(F.lit("e").alias("kind"), F.col("event_id").alias("id")).union(parts.select(F.lit("p").alias("kind"), F.col("p_partkey").alias("id")))


@query("SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def missing_upstream(spark, sf_dir):
    """Documents without a label."""
    return evidence.missing(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT p.page_id, p.url, md5(p.html) AS html_md5 FROM pages p JOIN documents d ON d.doc_id = p.page_id")
def items_with_html(spark, sf_dir):
    """Items joined with their pages."""
    items = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"))
    return items.join(table(spark, sf_dir, "pages"), "page_id").select("page_id", "url", _md5("html", "html_md5"))


_PRIMARY = _KEPT + """, p AS (SELECT *, row_number() OVER (PARTITION BY sub ORDER BY CASE WHEN whole THEN n END NULLS FIRST, ordinal) = 1 AS "primary"
  FROM (SELECT *, TRY_CAST(sequence AS BIGINT) AS n, bool_and(TRY_CAST(sequence AS BIGINT) IS NOT NULL) OVER (PARTITION BY sub) AS whole FROM named))"""


@query(_PRIMARY + ' SELECT sub, pos, sequence, "primary" FROM p')
def primary_document(spark, sf_dir):
    """The document with the lowest sequence of each submission."""
    return _items(spark, sf_dir).select("sub", "pos", "sequence", "primary")


@query(_KEPT + " SELECT own_accession AS accession, min(sub) AS sub FROM named GROUP BY 1")
def dedup_first(spark, sf_dir):
    """The first submission of each accession."""
    return S.first_per_key(_items(spark, sf_dir).select("accession", "sub", "pos"), "accession", ["sub", "pos"]).select("accession", "sub")


@query(_KEPT + " SELECT item_id, arg_max(sub, sub * 10 + pos) AS sub, arg_max(pos, sub * 10 + pos) AS pos FROM named GROUP BY 1")
def items_dedup_last(spark, sf_dir):
    """The last row of each repeated item."""
    return S.last_per_key(_items(spark, sf_dir).select("item_id", "sub", "pos"), "item_id", ["sub", "pos"])


@query(_PRIMARY + """ SELECT sub, string_agg(ordinal || ':' || item_id || ':' || filename || CASE WHEN "primary" THEN '*' ELSE '' END, ' ' ORDER BY ordinal) AS documents FROM p GROUP BY sub""")
def nest_documents(spark, sf_dir):
    """Documents nested in their submissions, in order."""
    found = _nested(spark, sf_dir)
    one = lambda d: F.concat(d["ordinal"].cast("string"), F.lit(":"), d["item_id"], F.lit(":"), d["filename"], F.when(d["primary"], "*").otherwise(""))
    return found.select("sub", F.array_join(F.transform("documents", one), " ").alias("documents"))


@query(_KEPT + " SELECT sub, item_id, sequence, filename FROM named")
def flatten_items(spark, sf_dir):
    """Items from nested submissions."""
    return S.flat(_nested(spark, sf_dir)).select("sub", "item_id", "sequence", "filename")


@query(_KEPT + " SELECT DISTINCT own_accession AS accession FROM named")
def distinct_accessions(spark, sf_dir):
    """Distinct accessions in order."""
    return _items(spark, sf_dir).select("accession").distinct().orderBy("accession")


@query(_KEPT + " SELECT filing_date, count(*) AS n_items, count(DISTINCT own_accession) AS n_accessions FROM named GROUP BY 1")
def stage_counts(spark, sf_dir):
    """Counts of items and accessions by filing date."""
    return _items(spark, sf_dir).groupBy("filing_date").agg(F.count("*").alias("n_items"), F.countDistinct("accession").alias("n_accessions"))


@query(_KEPT + """, l AS (SELECT own_accession, item_id, arg_max(filename, sub * 10 + pos) AS f FROM named GROUP BY 1, 2)
SELECT own_accession AS accession, string_agg(item_id || '=' || f, ',' ORDER BY item_id) AS items FROM l GROUP BY 1""")
def item_map(spark, sf_dir):
    """Each accession's map from item to file name, written out."""
    rows = _items(spark, sf_dir).withColumn("order", F.col("sub") * 10 + F.col("pos"))
    found = runs.item_map(rows, "filename")
    text = F.transform(F.array_sort(F.map_entries("items")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.select("accession", F.array_join(text, ",").alias("items"))


@query(_KEPT + """ SELECT 'run-1' AS run_id, own_accession AS accession, count(*) AS n_items, 'a.tar,b.tar' AS tarballs, 'm:f' AS doc_filter FROM named GROUP BY 2""")
def run_record(spark, sf_dir):
    """A run's record, written and read back."""
    path, items = work_dir(spark), _items(spark, sf_dir).select("accession", "item_id")
    record = runs.run_record("run-1", items.select("accession").distinct(), items, ["a.tar", "b.tar"], {"doc_filter": "m:f"})
    runs.append_run(record, path)
    runs.append_run(record.withColumn("run_id", F.lit("run-2")), path)
    found = runs.read_run(spark, path, "run-1")
    return found.select(F.col("run_id").cast("string").alias("run_id"), "accession", "n_items", F.array_join("tarballs", ",").alias("tarballs"), F.col("filters")["doc_filter"].alias("doc_filter"))


@query("""SELECT 'r' || doc_id % 10 AS run_id, 'k' || doc_id % 7 AS key, arg_max(v, s) AS value FROM (
SELECT doc_id, source AS v, doc_id AS s FROM documents UNION ALL SELECT doc_id, 'q' || quality, doc_id + 100000000 FROM labels) GROUP BY 1, 2""")
def run_merge(spark, sf_dir):
    """Run properties after two merges into a store that is then compacted."""
    keys = ["concat('r', doc_id % 10) AS run_id", "concat('k', doc_id % 7) AS key"]
    first = table(spark, sf_dir, "documents").selectExpr(*keys, "source AS value", "doc_id AS seq")
    second = table(spark, sf_dir, "labels").selectExpr(*keys, "concat('q', quality) AS value", "doc_id + 100000000 AS seq")
    store = runs.Properties(spark, work_dir(spark))
    store.merge(first)
    store.merge(second)
    store.compact()
    return store.read()


@query(_KEPT + """, n AS (SELECT count(DISTINCT sub) AS subs, count(*) AS items, count(*) FILTER (cik IS NULL) AS bare FROM named)
SELECT 'run-1' AS run_id, key, CAST(value AS VARCHAR) AS value FROM (SELECT 'items.n_rows' AS key, items AS value FROM n UNION ALL SELECT 'items.n_bare', bare FROM n
UNION ALL SELECT 'submissions.n_rows', subs FROM n UNION ALL SELECT 'submissions.n_items', items FROM n UNION ALL SELECT 'views.n_rows', 0)""")
def stage_report(spark, sf_dir):
    """Counts of three stages of a run, each taken in the pass that wrote it and kept with the run's properties."""
    path, store = work_dir(spark), runs.Properties(spark, work_dir(spark))
    nested = _nested(spark, sf_dir)
    store.report("run-1", "submissions", checks.write_stage(nested, f"{path}/submissions", "submissions", {"n_items": F.sum(F.size("documents"))}))
    items = S.flat(spark.read.parquet(f"{path}/submissions"))
    bare = F.count_if(F.col("cik").isNull())
    store.report("run-1", "items", checks.write_stage(items, f"{path}/items", "items", {"n_bare": bare}))
    none = spark.read.parquet(f"{path}/items").where("item_id IS NULL")
    store.report("run-1", "views", checks.write_stage(none, f"{path}/views", "views", may_be_empty=True))
    return store.read("run-1")


@query("SELECT l.doc_id, l.quality, d.source, md5(coalesce(d.text, '')) AS text_md5 FROM labels l JOIN documents d USING (doc_id) WHERE d.source <> 'web'")
def required_join(spark, sf_dir):
    """Labels with their documents; a label without one would be an error, whatever is selected afterwards."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = checks.join_required(table(spark, sf_dir, "labels").select("doc_id", "quality"), docs, "doc_id", "labels")
    return found.where("source <> 'web'").select("doc_id", "quality", "source", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"))
