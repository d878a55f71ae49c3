"""Filings and archives on shapes that the given tables lack."""

import io
import random
import tarfile
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from exhibita.operators import anchors, checks, evidence, hooks, runs
from exhibita.sources import archives as R
from exhibita.sources import submissions as S
from exhibita.sources import tables
from exhibita.sources.html import page_text
from exhibita.sources.tables import read_canonical, read_exhibits, read_prompt_views, work_dir, write_exhibits, write_views

FULL = """<SUBMISSION>
<ACCESSION-NUMBER> 0001-20-000001\x20
<CIK>7
<TYPE>10-K
<FILING-DATE>20200102
<DOCUMENT>
<TYPE>EX-10.1
<SEQUENCE>3
<FILENAME>a.htm
<TEXT>
body a
</TEXT>
</DOCUMENT>
<DOCUMENT>
<TYPE>EX-99
<SEQUENCE> 2 
<TEXT>b <TEXT>again</TEXT>rest</TEXT>
</DOCUMENT>
<DOCUMENT>
<FILENAME>c.htm
no text <TYPE>not at the start
<SEQUENCE>
last"""
BARE = "<DOCUMENT>\r<TYPE>EX-1\x0b<SEQUENCE>one\n<TEXT></TEXT></DOCUMENT>"


def test_submission_fields(spark):
    rows = [(1, FULL), (2, BARE), (3, "no documents"), (4, None), (5, "")]
    subs = S.with_header(spark.createDataFrame(rows, "sub long, text string"))
    head = {r["sub"]: (r["accession"], r["cik"], r["form_type"], r["filing_date"]) for r in subs.collect()}
    assert head == {1: ("0001-20-000001", "7", "10-K", "20200102"), 2: (None, None, "EX-1\x0b<SEQUENCE>one", None), 3: (None,) * 4, 4: (None,) * 4, 5: (None,) * 4}
    docs = {(r["sub"], r["pos"]): (r["type"], r["sequence"], r["filename"], r["content"]) for r in S.documents(subs).collect()}
    assert docs == {
        (1, 0): ("EX-10.1", "3", "a.htm", "\nbody a\n"),
        (1, 1): ("EX-99", "2", None, "b <TEXT>again"),
        (1, 2): (None, "", "c.htm", None),
        (2, 0): ("EX-1", "one", None, ""),
    }


def archive(mode, members):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data or b"")
            if data is None:
                info.type = tarfile.DIRTYPE
            t.addfile(info, io.BytesIO(data or b""))
    return out.getvalue()


@pytest.mark.parametrize("mode", ["w", "w:gz", "w:bz2", "w:xz"])
def test_archives(spark, tmp_path, mode):
    made = archive(mode, [("d.nc", None), ("x/0001-20-1.nc", b"ok \xff\xc3\xa9"), ("Y_2.NC", b""), ("z.txt", b"z")])
    (tmp_path / "a.tar").write_bytes(made)
    found = R.archives(spark, [str(tmp_path / "a.tar")])
    rows = S.decode_lossy(R.members(found)).orderBy("member_pos").collect()
    assert [(r["member_pos"], r["member_name"], r["text"]) for r in rows] == [(1, "x/0001-20-1.nc", "ok é"), (2, "Y_2.NC", "")]
    some = R.members(found, ["0001_201"]).collect()
    assert [r["member_name"] for r in some] == ["x/0001-20-1.nc"]
    streamed = R.read_members(spark, [str(tmp_path / "a.tar")])
    assert {r["matched"] for r in streamed.collect()} == {None}
    assert sorted(map(tuple, streamed.drop("matched").collect())) == sorted(map(tuple, R.members(found).collect()))
    listed = R.read_members(spark, [str(tmp_path / "a.tar")], ["none", "20-1", "0001_201"])
    assert [(r["member_name"], r["matched"]) for r in listed.collect()] == [("x/0001-20-1.nc", "20-1")]
    for wrong in ("none.tar", "none/*.tar"):
        with pytest.raises(FileNotFoundError, match="none"):
            R.read_members(spark, [str(tmp_path / "a.tar"), str(tmp_path / wrong)])
    with pytest.raises(ValueError, match="no accessions"):
        R.read_members(spark, [str(tmp_path / "a.tar")], [])


def test_archives_keep_the_order_of_the_arguments(spark, tmp_path):
    for name, text in (("a.tar", b"from a"), ("b.tar.gz", b"from b")):
        (tmp_path / name).write_bytes(archive("w:gz" if name.endswith("gz") else "w", [("x/1.nc", text), (f"x/{name}.nc", b"own"), ("x/1.nc", b"again")]))
    paths = [str(tmp_path / "b.tar.gz"), str(tmp_path / "a.tar")]
    for rows in (R.read_members(spark, paths), R.members(R.archives(spark, paths))):
        got = {(r["tar_pos"], r["tarball"].rsplit("/", 1)[1], r["member_pos"]) for r in rows.collect()}
        assert got == {(k, n, m) for k, n in ((0, "b.tar.gz"), (1, "a.tar")) for m in range(3)}
        first = S.first_per_key(rows, "member_name", list(S.READ_ORDER)).collect()
        assert {r["member_name"]: bytes(r["content"]) for r in first}["x/1.nc"] == b"from b" and len(first) == 3


def test_many_archives_are_one_scan_with_a_partition_each(spark, tmp_path):
    (tmp_path / "some").mkdir()
    for k in range(40):
        (tmp_path / "some" / f"{k:02d}.tar").write_bytes(archive("w", [(f"{k}.nc", b"x")]))
    (tmp_path / "some" / "_SUCCESS").write_bytes(b"")
    rows = R.read_members(spark, [str(tmp_path / "some" / "3*.tar"), str(tmp_path / "some"), str(tmp_path / "some" / "07.tar")])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") == 1 and "Union" not in plan
    assert rows.rdd.getNumPartitions() == 10 + 40 + 1
    got = [(r["tar_pos"], r["member_name"]) for r in rows.collect()]
    assert got == [(0, f"{k}.nc") for k in range(30, 40)] + [(1, f"{k}.nc") for k in range(40)] + [(2, "7.nc")]


def test_hooks_keep_the_type_of_item_ids(spark):
    pick = lambda prompt, view: [{"anchor_id": "A0001", "label": "l", "type": "sentence", "start": 0, "end": len(view)}]
    views = spark.createDataFrame([("0001-20-1_02", "abc"), ("x", None)], "item_id string, text string")
    assert [tuple(r)[:6] for r in hooks.index_items(views, "p", pick).orderBy("item_id").collect()] == [("0001-20-1_02", "A0001", "l", "sentence", 0, 3), ("x", "A0001", "l", "sentence", 0, 0)]
    renamed = hooks.index_items(views.withColumnRenamed("item_id", "doc"), "p", pick, item="doc")
    assert renamed.columns[0] == "doc" and renamed.count() == 2


def test_views_are_kept_by_run(spark, tmp_path):
    texts = spark.createDataFrame([("a", "one"), ("b", None)], "item_id string, text string")
    write_views(texts, str(tmp_path / "views"), "r1")
    write_views(texts.limit(1), str(tmp_path / "views"), "r2")
    assert {tuple(r) for r in read_prompt_views(spark, str(tmp_path / "views"), "r1").collect()} == {("a", "one"), ("b", None)}
    assert read_prompt_views(spark, str(tmp_path / "views"), "r2").columns == ["item_id", "prompt_view"]
    with pytest.raises(ValueError, match="r3"):
        read_canonical(spark, str(tmp_path / "views"), "r3")


def test_accession_list_and_match(spark, tmp_path):
    (tmp_path / "list").write_text("\n  00-1 \n\n0 \n")
    listed = S.accession_list(spark.read.text(str(tmp_path / "list")))
    assert [r["accession"] for r in listed.orderBy("list_pos").collect()] == ["00-1", "0"]
    names = spark.createDataFrame([("a_0-01.nc",), ("b0",), ("c",), ("b0",), (None,)], "member_name string")
    matched = S.match_accessions(names, listed)
    assert sorted(map(tuple, matched.collect())) == [("a_0-01.nc", "00-1"), ("b0", "0"), ("b0", "0")]
    assert "NestedLoop" not in matched._jdf.queryExecution().executedPlan().toString()
    assert {r[0]: r[1] for r in S.match_accessions(names, None).collect()} == {"a_0-01.nc": None, "b0": None, "c": None, None: None}
    with pytest.raises(ValueError, match="no accessions"):
        S.match_accessions(names, listed.limit(0))
    (tmp_path / "blank").write_text("\n  \n")
    with pytest.raises(ValueError, match="no accessions"):
        S.accession_list(spark.read.text(str(tmp_path / "blank")))


def test_the_first_in_the_list_is_found_among_many_lengths(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("01-_") for _ in range(n))
    entries = [word(rng.randint(1, 7)) for _ in range(40)] + ["--", "0123456789" * 30]
    names = [word(rng.randint(0, 12)) for _ in range(80)]
    plain = lambda x: x.replace("-", "").replace("_", "")
    first = {n: next((e for e in entries if plain(e) in plain(n)), None) for n in names}
    listed = spark.createDataFrame(list(enumerate(entries)), "list_pos long, accession string")
    found = S.match_accessions(spark.createDataFrame([(n, 1) for n in names], "member_name string, list_pos int"), listed)
    assert sorted(map(tuple, found.collect())) == sorted((n, 1, first[n]) for n in names if first[n] is not None)
    assert {n: R.Listed(entries).first(n) for n in names} == first


def documents(spark, *sections, keep=None, content=True):
    """The kept documents of submissions that are given as lists of ``(type, sequence, filename)``."""
    tag = lambda name, x: "" if x is None else f"<{name}>{x}\n"
    texts = ["".join(f"<DOCUMENT>\n{tag('TYPE', t)}{tag('SEQUENCE', q)}{tag('FILENAME', f)}<TEXT>{t}</TEXT></DOCUMENT>" for t, q, f in own) for own in sections]
    subs = spark.createDataFrame([(7, "a-1", x) for x in texts] + [(8, "b", None), (9, "b", "no documents")], "sub long, accession string, text string")
    return S.with_documents(subs, keep, content=content)


def test_primary_documents_and_defaults_inside_the_row(spark):
    subs = documents(
        spark,
        [("A", "3", "f"), ("B", " 2", ""), ("A", "2", None)],
        [("A", "9", "f"), ("B", "x", "f")],
        [("A", "-1", "f"), ("B", "+0", "f")],
        [("B", None, None), ("A", "", "g")],
        [("A", "5", "f")] * 2,
    )
    assert "Exchange" not in subs._jdf.queryExecution().executedPlan().toString()
    rows = [[(d["pos"], d["ordinal"], d["sequence"], d["filename"], d["primary"], d["item_id"]) for d in r["documents"]] for r in subs.collect()]
    assert rows == [
        [(0, 1, "3", "f", False, "a-1_3"), (1, 2, "2", "EX-10-2.html", True, "a-1_2"), (2, 3, "2", "EX-10-2.html", False, "a-1_2")],
        [(0, 1, "9", "f", True, "a-1_9"), (1, 2, "x", "f", False, "a-1_x")],
        [(0, 1, "-1", "f", True, "a-1_-1"), (1, 2, "+0", "f", False, "a-1__0")],
        [(0, 1, "01", "EX-10-01.html", True, "a-1_01"), (1, 2, "02", "g", False, "a-1_02")],
        [(0, 1, "5", "f", True, "a-1_5"), (1, 2, "5", "f", False, "a-1_5")],
    ]


def test_kept_documents_are_numbered_and_flattened(spark):
    subs = documents(spark, [("A", None, None), ("B", None, None), ("C", None, None)], [("A", "1", "f")], keep=lambda d: d["type"] != "A")
    flat = S.flat(subs)
    assert flat.columns == ["sub", "accession", *S.DOCUMENT]
    assert [tuple(r) for r in flat.select("pos", "ordinal", "type", "sequence", "content", "primary").collect()] == [(1, 1, "B", "01", "B", True), (2, 2, "C", "02", "C", False)]
    bare = S.flat(documents(spark, [(f"T{k}", None, None) for k in range(120)], content=False))
    assert "content" not in bare.columns and [r["sequence"] for r in bare.collect()][98:101] == ["99", "100", "101"]


def test_items_from_archives_in_one_call(spark, tmp_path):
    (tmp_path / "a.tar").write_bytes(archive("w", [("0001-20-000001.nc", FULL.encode()), ("7-7.nc", BARE.encode()), ("8-8.nc", BARE.encode())]))
    listed = spark.createDataFrame([(0, "0001-20-000001"), (1, "7-7")], "list_pos long, accession string")
    members = R.read_members(spark, [str(tmp_path / "a.tar")])
    got = {(r["member_pos"], r["item_id"], r["primary"], r["cik"]) for r in S.items_of(members, listed).collect()}
    assert got == {(0, "0001-20-000001_3", False, "7"), (0, "0001-20-000001_2", True, "7"), (0, "0001-20-000001_03", False, "7"), (1, "7-7_one", True, None)}
    pushed = S.items_of(R.read_members(spark, [str(tmp_path / "a.tar")], ["0001-20-000001", "7-7"]))
    assert sorted(r["item_id"] for r in pushed.collect()) == sorted(x[1] for x in got)
    # without a list only the header says which submission it is
    assert {r["member_pos"] for r in S.items_of(members).collect()} == {0}


def test_doc_types(spark):
    kinds = spark.createDataFrame([("EX-10.1",), ("ex-99",), (None,)], "type string")
    keep = lambda *a: [r[0] for r in kinds.where(S.doc_type_matches(kinds["type"], *a)).collect()]
    assert keep() == ["EX-10.1", "ex-99", None] and keep(["Ex-10"]) == ["EX-10.1"] and keep(None, "X-9") == ["ex-99"]


def test_stage_checks_and_errors(spark, tmp_path):
    have = spark.createDataFrame([(1, "a"), (2, "b")], "item_id long, text string")
    want = spark.createDataFrame([(1,), (3,)], "item_id long")
    with pytest.raises(ValueError, match="3"):
        evidence.require(want, have, "views")
    assert evidence.require(want.where("item_id = 1"), have, "views") is have
    with pytest.raises(ValueError):
        evidence.require_rows(have.limit(0), "items")
    with pytest.raises(Exception, match="no view of item 3"):
        evidence.view_with_fallback(want, have, have.limit(0)).collect()
    bad = spark.createDataFrame([(1, '{"anchors":[]}'), (2, '{"anchors":[{"anchor_id":"A","start":null}]}'), (3, '{"anchors":[{"start":"x"}]}')], "item_id long, json string")
    for i, message in ((1, "no anchors in 1"), (2, "start is no offset"), (3, "start is no offset")):
        with pytest.raises(Exception, match=message):
            evidence.read_anchor_json(bad.where(f"item_id = {i}")).collect()
    record = runs.run_record("r", spark.createDataFrame([("a",)], "accession string"), spark.createDataFrame([("a", "i")], "accession string, item_id string"), [], {})
    runs.append_run(record, str(tmp_path / "runs"))
    assert runs.read_run(spark, str(tmp_path / "runs"), "r").count() == 1
    with pytest.raises(ValueError):
        runs.read_run(spark, str(tmp_path / "runs"), "other")
    rows = spark.createDataFrame([("r", "i", 1, "old"), ("r", "i", 2, "new"), ("s", "i", 3, "x")], "run_id string, item_id string, order int, html string")
    write_exhibits(rows, str(tmp_path / "ex"))
    assert [tuple(r) for r in read_exhibits(spark, str(tmp_path / "ex"), "r").collect()] == [("i", "new")]


def test_a_required_join_fails_in_its_own_pass(spark):
    have = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (2, "c", 7)], "item_id long, text string, _there int")
    want = spark.createDataFrame([(1, "own"), (1, "own"), (2, "own")], "item_id long, text string")
    found = checks.join_required(want, have)
    assert found.columns == ["item_id", "text", "_there"]
    assert sorted(tuple(r) for r in found.collect()) == [(1, "a", 5), (1, "a", 5), (1, "b", 6), (1, "b", 6), (2, "c", 7)]
    assert checks.join_required(want.limit(0), have).count() == 0
    for lost, name in ((spark.createDataFrame([(9, "x")], want.schema), "9"), (spark.createDataFrame([(None, "x")], want.schema), "null")):
        wrong = checks.join_required(want.union(lost), have, stage="views")
        # neither a filter on the other side nor a narrow selection turns the error off
        for use in (wrong, wrong.where("text = 'a'"), wrong.where("_there > 6").select("_there"), wrong.groupBy().count()):
            with pytest.raises(Exception, match=f"views: nothing for item {name}"):
                use.collect()


def test_a_stage_is_counted_in_the_pass_that_writes_it(spark, tmp_path):
    runs_of = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            runs_of.add(b.num_rows)
            yield b

    rows = spark.range(1000).selectExpr("id", "if(id % 10 = 0, null, id % 3) AS v").mapInArrow(seen, "id long, v long")
    out = checks.write_stage(rows, str(tmp_path / "a"), "a", {"total": F.sum("v"), "known": F.count("v"), "none": F.sum(F.lit(None).cast("long"))})
    values = [i % 3 for i in range(1000) if i % 10]
    assert out == {"n_rows": 1000, "total": sum(values), "known": len(values), "none": 0} and runs_of.value == 1000
    assert spark.read.parquet(str(tmp_path / "a")).count() == 1000
    # a shuffle before the writer changes no count
    assert checks.write_stage(rows.repartition(3, "v"), str(tmp_path / "b"), "b")["n_rows"] == 1000
    for empty in (rows.limit(0), rows.where("id < 0"), rows.join(rows.where("id < 0").select("id"), "id")):
        with pytest.raises(ValueError, match="views: no rows"):
            checks.write_stage(empty, str(tmp_path / "c"), "views")
        assert not (tmp_path / "c").exists()
    assert checks.write_stage(rows.where("id < 0"), str(tmp_path / "c"), "views", {"total": F.sum("v")}, may_be_empty=True) == {"n_rows": 0, "total": 0}
    store = runs.Properties(spark, str(tmp_path / "store"))
    store.report("r", "a", {"n_rows": 3})
    store.report("r", "a", out)
    assert {r["key"]: r["value"] for r in store.read("r").collect()}["a.n_rows"] == "1000"


def test_spans_are_checked_over_stretches(spark, monkeypatch):
    monkeypatch.setattr(anchors, "STRETCH", 16)
    body = "0123456789" * 10
    spans = [(0, 20), (18, 30), (30, 40), (40, 90), (33, 34), (95, 101), (None, 3), (98, 97)]
    rows = [(1, f"A{k}", a, b, max(0, (a or 0) - 2), min(100, b + 2), body[max(0, (a or 0) - 2) : min(100, b + 2)]) for k, (a, b) in enumerate(spans)]
    rows.append((1, "T", 91, 92, 89, 94, "x"))
    rows.append((1, "N", 93, 94, 91, 96, None))
    rows.append((2, "L", 0, 1, 0, 1, "x"))
    schema = "item_id long, anchor_id string, start int, end int, snippet_start int, snippet_end int, snippet string"
    found = anchors.violations(spark.createDataFrame(rows, schema).withColumn("_text", F.lit(1)), spark.createDataFrame([(1, body), (1, body), (3, "")], "item_id long, text string"))
    got = sorted((r["anchor_id"], r["problem"]) for r in found.collect())
    known = sorted((r for r in rows if r[0] == 1), key=lambda r: (r[2] is not None, r[2] or 0, r[3]))
    expected, before = [], None
    for _, anchor, a, b, x, y, snippet in known:
        if a is None or not 0 <= a <= b <= len(body):
            expected.append((anchor, "bounds"))
        if before is not None and a is not None and before > a:
            expected.append((anchor, "overlap"))
        if snippet != body[x:y]:
            expected.append((anchor, "text"))
        before = b if a is not None else None
    assert got == sorted(expected) and len(got) == 8


def test_helper_columns_give_way_to_the_inputs(spark):
    texts = spark.createDataFrame([(1, "0123456789")], "item_id long, text string")
    own = spark.createDataFrame([(1, 2, 4, "a", "b", "c", "d")], "item_id long, start int, end int, _text string, _spans string, _stretch string, _window string")
    row = evidence.snippets(own, texts, bandwidth=1).first()
    assert (row["snippet"], row["_text"], row["_spans"], row["_stretch"], row["_window"]) == ("1234", "a", "b", "c", "d")
    listed = spark.createDataFrame([(0, "1-2")], "list_pos long, accession string")
    member = spark.createDataFrame([("f/12.nc", "n", "p", "e")], "member_name string, _name string, _plain string, _entry string")
    assert tuple(S.match_accessions(member, listed).first()) == ("f/12.nc", "n", "p", "e", "1-2")
    items = spark.createDataFrame([(1, "n", "o")], "item_id long, _new string, _old string")
    assert tuple(evidence.view_with_fallback(items, texts, texts).first()) == (1, "n", "o", "0123456789")
    pages = spark.createDataFrame([("<p>a</p>", "p", "q")], "html string, _plain string, _page string")
    assert tuple(page_text(pages).first()) == ("p", "q", "a")


def test_snippet_windows(spark):
    texts = spark.createDataFrame([(1, "0123456789𝒳"), (2, "")], "item_id long, text string")
    rows = [(1, 0, 2), (1, 9, 11), (1, 50, 60), (2, 0, 0), (3, 0, 1)]
    found = evidence.snippets(spark.createDataFrame(rows, "item_id long, start int, end int"), texts, bandwidth=2)
    got = {(r["item_id"], r["start"]): (r["snippet"], r["snippet_start"], r["snippet_end"]) for r in found.collect()}
    assert got == {(1, 0): ("0123", 0, 4), (1, 9): ("789𝒳", 7, 11), (1, 50): ("", 48, 11), (2, 0): ("", 0, 0)}


def test_snippets_of_repeated_items(spark):
    texts = spark.createDataFrame([(1, 1, "old text"), (1, 2, "the new text"), (2, 1, "x" * 30), (2, 2, "x" * 30), (None, 1, "y"), (3, 1, None)], "item_id long, ord int, text string")
    chosen = spark.createDataFrame([(1, 0, 3, "a"), (1, 4, 7, "b"), (1, 4, 7, "b"), (2, 5, 6, "c"), (None, 0, 1, "d"), (3, 0, 1, "e")], "item_id long, start int, end int, snippet string")
    with pytest.raises(Exception, match="two different texts of item 1"):
        evidence.snippets(chosen, texts).collect()
    got = evidence.snippets(chosen, texts, bandwidth=1, order=["ord"])
    assert got.columns == ["item_id", "start", "end", "snippet_start", "snippet_end", "snippet"]
    assert sorted(tuple(r)[:3] + (r["snippet"],) for r in got.collect()) == [(1, 0, 3, "the "), (1, 4, 7, " new "), (1, 4, 7, " new "), (2, 5, 6, "xxx")]
    # each row of a text by its own key
    own = evidence.snippets(chosen.withColumn("ord", F.lit(1)), texts, item=["item_id", "ord"], bandwidth=0)
    assert sorted((r["item_id"], r["snippet"]) for r in own.collect()) == [(1, "old"), (1, "tex"), (1, "tex"), (2, "x")]


@pytest.mark.parametrize("bits", [2, 3, 13])
def test_windows_of_long_texts(spark, monkeypatch, bits):
    rng = random.Random(4)
    text = "".join(rng.choice("ab𝒳é\n") for _ in range(500))
    monkeypatch.setattr(evidence, "PIECE_BITS", bits)
    monkeypatch.setattr(evidence, "STRETCH", 50)
    spans = [(1, a, a + rng.randint(0, 60)) for a in range(0, 520, 3)]
    df = spark.createDataFrame(spans, "item_id long, start int, end int")
    got = evidence.snippets(df, spark.createDataFrame([(1, text)], "item_id long, text string"), bandwidth=5)
    rows = {(r["start"], r["end"]): (r["snippet"], r["snippet_start"], r["snippet_end"]) for r in got.collect()}
    assert rows == {(a, b): (text[max(0, a - 5) : min(500, b + 5)], max(0, a - 5), min(500, b + 5)) for _, a, b in spans}


def test_anchor_files_are_in_the_order_of_the_texts(spark, tmp_path):
    texts = spark.createDataFrame([(k, "First sentence here. Second one here. Third one here.") for k in (5, 3, 9, 5)], "item_id long, text string").coalesce(1)
    found = anchors.anchors(texts)
    evidence.write_anchor_tsv(found, str(tmp_path / "tsv"))
    lines = [x.split("\t") for f in sorted((tmp_path / "tsv").glob("*.csv")) for x in f.read_text().splitlines()]
    assert lines[0] == ["item_id", "anchor_id", "anchor_type", "start", "end", "label"]
    assert [x[:2] for x in lines[1:]] == [[str(k), f"A000{n}"] for k in (5, 3, 9, 5) for n in (1, 2, 3)]
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, evidence.read_anchor_tsv(spark, str(tmp_path / "tsv")).drop("label", "item_id").collect())) == sorted(map(tuple, found.drop("item_id").collect()))


def test_indexing_resumes_and_calls_no_item_twice(spark, tmp_path):
    log, fails = tmp_path / "log", tmp_path / "fails"
    log.mkdir()
    fails.write_text("")

    def select(prompt, view):
        if view.endswith("7") and fails.exists():
            raise RuntimeError("out of order")
        with open(log / view, "a") as f:
            f.write("x")
        return [{"anchor_id": f"A{k}", "label": prompt, "type": "sentence", "start": 0, "end": None} for k in range(int(view[-1]) % 3)]

    views = spark.createDataFrame([(k if k else None, f"view {k}") for k in range(40)] + [(3, "view 3")], "item_id long, text string")
    run = lambda: hooks.index_items(views, "p", select, store=str(tmp_path / "store"))
    with pytest.raises(Exception, match="out of order"):
        run()
    done = {f.name for f in log.iterdir()}
    assert 0 < len(done) < 40
    fails.unlink()
    for _ in range(2):
        rows = [tuple(r) for r in run().collect()]
        assert sorted(Counter((r[0] or 0) for r in rows).items()) == sorted({k: (k % 10) % 3 * (2 if k == 3 else 1) for k in range(40) if (k % 10) % 3}.items())
    assert {f.name: f.read_text() for f in log.iterdir()} == {f"view {k}": "x" for k in range(40)}
    assert rows[0][5] is None and rows[0][6] == hooks.prompt_digest("p")
    # another prompt is another call
    assert hooks.index_items(views.where("item_id = 5"), "q", select, store=str(tmp_path / "store")).count() == 2
    assert (log / "view 5").read_text() == "xx"


@pytest.mark.parametrize("kept", [False, True])
def test_extraction_streams_an_items_snippets_in_order(spark, tmp_path, kept):
    calls = tmp_path / "calls"
    calls.write_text("")

    def extract(prompt, frames):
        item, n, last, most = None, 0, -1, 0
        for rows in frames:
            item, n, most = rows["item_id"].iloc[0], n + len(rows), max(most, len(rows))
            assert list(rows["start"]) == list(range(last + 1, last + 1 + len(rows)))
            last += len(rows)
        with open(calls, "a") as f:
            f.write("x")
        if n > 1:
            yield pd.DataFrame({"item_id": [item], "n": [n], "most": [most]})

    rows = spark.range(30_000).selectExpr("if(id < 29990, 1, id) AS item_id", "if(id < 29990, id, 0) AS start").repartition(8)
    store = str(tmp_path / "store") if kept else None
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        run = lambda: [tuple(r) for r in hooks.extract_items(rows, "p", extract, "item_id long, n long, most long", order=["start"], store=store).collect()]
        assert run() == [(1, 29990, 1000)]
        assert run() == [(1, 29990, 1000)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(calls.read_text()) == (11 if kept else 22)


def test_merges_at_once_are_both_kept(spark, tmp_path):
    update = lambda *rows: spark.createDataFrame(list(rows), "run_id string, key string, value string")
    store = runs.Properties(spark, str(tmp_path / "runs"))
    read = lambda: {(r["run_id"], r["key"]): r["value"] for r in store.read().collect()}
    assert read() == {}
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda k: runs.Properties(spark, store.path).merge(update(("r", f"k{k}", f"v{k}"), ("s", f"k{k}", None))), range(6)))
    expected = {(r, f"k{k}"): f"v{k}" if r == "r" else None for r in "rs" for k in range(6)}
    assert read() == expected
    store.merge(update(("r", "k1", "new")))
    expected["r", "k1"] = "new"
    assert read() == expected and store.read("r").count() == 6
    # a merge that is cut off before it is committed is not seen
    update(("r", "k2", "lost")).write.parquet(str(tmp_path / "runs" / "data" / "half"))
    assert read() == expected
    store.compact()
    assert read() == expected and len(store._log()[0]) == 1
    assert store.clean() == 7 and read() == expected
    store.merge(spark.createDataFrame([("r", "k3", "b", 2), ("r", "k3", "a", 1)], "run_id string, key string, value string, seq int"))
    expected["r", "k3"] = "b"
    store.compact()
    assert read() == expected


def test_exhibits_are_chosen_by_their_places(spark, tmp_path, monkeypatch):
    rows = [("r", i, k, f"{i}-{k}") for i in ("a", "b", None) for k in range(5)] + [("r", "c", 1, "only"), ("s", "a", 9, "other run"), ("r", "b", 4, "b-4")]
    write_exhibits(spark.createDataFrame(rows, "run_id string, item_id string, order int, html string").repartition(3), str(tmp_path / "ex"))
    for most in (200_000, 0):
        monkeypatch.setattr(tables, "BROADCAST_ROWS", most)
        found = read_exhibits(spark, str(tmp_path / "ex"), "r")
        assert sorted(map(tuple, found.collect()), key=str) == sorted([("a", "a-4"), ("b", "b-4"), (None, "None-4"), ("c", "only")], key=str)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert ("html" in "".join(x for x in plan.splitlines() if "Exchange hash" in x)) is False


def test_an_items_snippets_are_not_dealt_out_again_for_extraction(spark, tmp_path):
    spark.createDataFrame([(k, f"text {k} of item. " * 9) for k in range(20)], "item_id long, text string").write.parquet(f"{tmp_path}/t")
    texts, keep = spark.read.parquet(f"{tmp_path}/t"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = evidence.snippets(anchors.anchors(texts), texts)

        def extract(prompt, frames):
            yield pd.DataFrame({"starts": [[int(s) for f in frames for s in f["start"]]]})

        out = hooks.extract_items(found, "p", extract, "starts array<long>", order=["start"])
        moved = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        assert moved(out) == moved(found)
        assert [r[0] for r in out.collect()] == [sorted(r[0]) for r in out.collect()] and out.count() == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_many_small_calls_are_kept_in_few_files(spark, tmp_path):
    views = spark.range(3000).select(F.col("id").alias("item_id"), F.col("id").cast("string").alias("text")).coalesce(1)
    found = hooks.index_items(views.repartition(1), "p", lambda p, v: [{"anchor_id": v, "label": "l", "type": "t", "start": 0, "end": 1}], store=str(tmp_path / "s"))
    assert {(r["item_id"], r["anchor_id"]) for r in found.collect()} == {(k, str(k)) for k in range(3000)}
    assert len(list((tmp_path / "s").rglob("*.parquet"))) <= 4


def test_lossy_texts_are_decoded_a_few_at_a_time(spark, monkeypatch):
    df = spark.range(3).select("id", F.lit(b"x").alias("content"))
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, read, schema: read)
    batch = pa.RecordBatch.from_pydict({"id": list(range(1000)), "content": [b"a\xff%d" % k for k in range(1000)]})
    parts = list(S.decode_lossy(df)(iter([batch])))
    assert max(p.num_rows for p in parts) <= S.SLICE
    assert [t for p in parts for t in p.column("text").to_pylist()] == [f"a{k}" for k in range(1000)]


def test_filters(spark):
    docs = spark.createDataFrame([(1, "EX-1"), (2, None)], "cik long, type string")
    assert hooks.filter_documents(docs).count() == 2
    assert hooks.filter_documents(docs, lambda d: d["type"] == "EX-1").count() == 1
    assert hooks.filter_callable(docs, lambda s, d: s["cik"] == 2, ["cik"], ["type"]).collect()[0][0] == 2


def test_a_cluster_needs_a_shared_folder():
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(unset)
