"""Canonical text, tables and anchors on shapes that the given tables lack."""

import pytest
from pyspark.sql import functions as F

from exhibita.functions import text as T
from exhibita.operators import anchors as A
from exhibita.sources.html import fenced_text, page_text, with_parts


def canonical(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), "item_id long, html string")
    rows = with_parts(df).select("item_id", T.canonical(fenced_text(F.col("parts"))).alias("t")).orderBy("item_id").collect()
    return [r["t"] for r in rows]


def test_html_nodes(spark):
    got = canonical(
        spark,
        "<p>A</p>\n<p>B</p><p>C</p>",
        "<p>A</p>\n \n<p>B</p>",
        "wo<!-- c -->rd &eacute;&#33;&amp;lt; <script>x</script><style>y</style><template>z</template>",
        "<pre>a\n\n\nb   c</pre>",
        None,
        "",
        "a\x0cb c",
    )
    assert got == ["A\n\nB C", "A\n\nB", "wo rd é!&lt;", "a\n\nb c", "", "", "a\nb\nc"]


def test_tables(spark):
    got = canonical(
        spark,
        "<p>x</p>\n<table><tr><th> a  b<th>c|d</tr><tr><td>1\n2</td></tr><tr></tr><tr><td></td></tr></table>\n<p>y</p>",
        "<table><tr><td>o<table><tr><td>i</td></tr></table></td><td>p</td></tr></table>",
        "<table>  one\n <b>two</b></table>",
        "<table> <b> </b></table>z",
        "<table><tr><td>open",
        "[[TABLE]] kept   as is\n\n\n[[/TABLE]]",
    )
    assert got[0] == "x\n\n[[TABLE]]\n| a b | c|d |\n| --- | --- |\n| 1\n2 | |\n| | |\n[[/TABLE]]\n\ny"
    assert got[1] == "[[TABLE]]\n| o i | i | p |\n| --- | --- | --- |\n| i | | |\n[[/TABLE]]"
    assert got[2:] == ["[[TABLE]]\none\ntwo\n[[/TABLE]]", "z", "[[TABLE]]\n| open |\n| --- |\n[[/TABLE]]", "[[TABLE]] kept as is\n\n\n[[/TABLE]]"]


def test_lists(spark):
    text = "intro\n(a)  one\n  wrapped   here\n• two\n(the) three\n1. four\n-\n- five "
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(T.canonical(F.col("t"))).first()[0]
    assert got == "intro\n- one\nwrapped here\n- two\n- three\n1. four\n-\n- five"


def spans(spark, text):
    df = spark.createDataFrame([(1, text)], "item_id long, text string")
    rows = A.anchors(df).orderBy("start").collect()
    assert [r["anchor_id"] for r in rows] == [f"A{k:04d}" for k in range(1, len(rows) + 1)]
    return [(r["anchor_type"], text[r["start"] : r["end"]]) for r in rows]


def test_sentences(spark):
    text = "Acme Inc. made it. (Inc. too, see gov. rules here. \n\n J. Doe agreed. 3 left! yes. indeed it was. 𝒳yz ends here. Next one is long."
    assert spans(spark, text) == [
        ("sentence", "Acme Inc. made it. (Inc."),
        ("sentence", "too, see gov."),
        ("sentence", "rules here. "),
        ("sentence", " J. Doe agreed. 3 left! yes."),
        ("sentence", "indeed it was. 𝒳yz ends here."),
        ("sentence", "Next one is long."),
    ]


def test_long_block_and_fragments(spark):
    words = "word " * 90
    assert spans(spark, f"A. {words}end") == [("sentence", "A."), ("sentence", f"{words}end")]
    assert spans(spark, f"x1 A. {words}end.") == [("sentence", "x1 A."), ("sentence", f"{words}end.")]
    assert spans(spark, f"{words}end.") == [("sentence", f"{words}end.")]
    assert spans(spark, "First sentence here.\nTiny one. Another sentence.") == [("sentence", "First sentence here.\nTiny one."), ("sentence", "Another sentence.")]


def test_tables_and_bullets_in_order(spark):
    text = "Before the table.\n\n[[TABLE]]\n| a |\n\nx\n[[/TABLE]]\n\nlead\n- one\n more\n- two\n- three\n\n- alone\nprose\n\n   \n\n"
    assert spans(spark, text) == [
        ("sentence", "Before the table."),
        ("table", "[[TABLE]]\n| a |\n\nx\n[[/TABLE]]"),
        ("bullet", "lead"),
        ("bullet", "- one\n more"),
        ("bullet", "- two"),
        ("bullet", "- three"),
        ("sentence", "- alone\nprose"),
    ]


def test_repeated_and_missing_item_ids(spark):
    text = "First sentence here. Second one.\n\n[[TABLE]]\nx\n[[/TABLE]]"
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (None, "Another text."), (2, None)], "item_id long, text string")
    rows = [(r["item_id"], r["anchor_id"], r["start"], r["end"]) for r in A.anchors(df).collect()]
    own = [("A0001", 0, 20), ("A0002", 21, 32), ("A0003", 34, 56)]
    assert sorted(rows, key=str) == sorted([(i, *x) for i in (1, 1, None) for x in own] + [(None, "A0001", 0, 13)], key=str)
    views = [r["text"] for r in A.annotated(df).collect()]
    assert sorted(views) == sorted(["[[A0001]]\nFirst sentence here.\n\n[[A0002]]\nSecond one.\n\n[[A0003]]\n[[TABLE]]\nx\n[[/TABLE]]\n"] * 3 + ["[[A0001]]\nAnother text.\n"])
    plan = A.anchors(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 257])
def test_running_sums(spark, n):
    values = [(7 * k) % 5 for k in range(n)]
    got = spark.createDataFrame([(values,)], "v array<int>").select(A.running(F.col("v"))).first()[0]
    assert got == [sum(values[:k]) for k in range(n)]


def test_pages_of_any_kind(spark):
    pages = [
        "<p>plain &amp; simple</p><p>two</p>",
        "<p>caf&eacute; &#8212; &nbsp;x</p>",
        "<p title='a>b'>odd</p>",
        "<p>a < b</p>",
        "<pre>a\n\n\nb</pre>",
        "<p>x</p>\n   <p>y</p>",
        None,
        "",
        "<table><tr><td>c</td></tr></table>",
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "item_id long, html string").withColumn("text", F.lit("mine"))
    got = {r["item_id"]: r["text"] for r in page_text(df).collect()}
    parts = with_parts(df.drop("text"))
    general = {r["item_id"]: r["t"] for r in parts.select("item_id", T.outer_newlines(fenced_text(F.col("parts"))).alias("t")).collect()}
    assert got == general
    assert got[0] == "plain & simple\ntwo" and got[1] == "café — \xa0x" and got[2] == "odd" and got[6] == "" and got[8] == "[[TABLE]]\n| c |\n| --- |\n[[/TABLE]]"
    plain = {r[0] for r in df.where(T.is_plain_page(F.col("html"))).select("item_id").collect()}
    assert plain == {0, 7}


def test_a_long_word_before_a_sentence_end(spark):
    word = "x" * 200_000  # a search for the last word from every place would take minutes
    text = f"{word}ab. Another sentence here. Made by Some Corp. of old.\u2003 And so Ninc. Last sentence one"
    found = [t if len(t) < 100 else len(t) for _, t in spans(spark, text)]
    assert found == [len(word) + 3, "Another sentence here.", "Made by Some Corp. of old.", "And so Ninc.", "Last sentence one"]


def test_a_named_reference_needs_its_semicolon(spark):
    pages = ["<h1>a&&amp</h1><p>&eacute;x &copyx &notit; &#33; & b</p>", "<table><tr><td>a&lt b&lt;</td></tr></table>"]
    df = spark.createDataFrame(list(enumerate(pages)), "item_id long, html string")
    got = [r["text"] for r in page_text(df).orderBy("item_id").collect()]
    assert got == ["a&&amp\néx &copyx &notit; ! & b", "[[TABLE]]\n| a&lt b< |\n| --- |\n[[/TABLE]]"]


@pytest.mark.parametrize("text", ["", " \n\n ", None])
def test_nothing_to_anchor(spark, text):
    df = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert A.anchors(df).count() == 0


def test_markdown_table_of_rows(spark):
    df = spark.createDataFrame([([["a", "b"], ["c"]],), ([["only"]],)], "r array<array<string>>")
    assert [r[0] for r in df.select(T.markdown_table(F.col("r"))).collect()] == ["| a | b |\n| --- | --- |\n| c |  |", "| only |\n| --- |"]
