"""Tool calls, audio, main text, repeats and token counts against brute force and on edge cases."""

import hashlib
import json
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from exhibita.llm import audioprint, repeats, tokens, toolcalls, wrappers

# ---- repeats ----


def brute_repeats(rows, length=repeats.LENGTH):
    low = {}
    for i, b in rows:
        if i is not None:
            for s in range(len(b) - length + 1):
                low[b[s : s + length]] = min(low.get(b[s : s + length], i), i)
    out = Counter()
    for i, b in rows:
        covered = bytearray(len(b))
        for s in range(len(b) - length + 1) if i is not None else ():
            if low[b[s : s + length]] < i:
                covered[s : s + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, covered, strict=True) if not c)
        runs = sum(1 for k in range(len(b)) if covered[k] and (not k or not covered[k - 1]))
        out[i, len(b), sum(covered), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


def repeat_rows():
    rnd = random.Random(5)
    base = ["".join(rnd.choice("ab é\0") for _ in range(400)) for _ in range(6)] + ["a" * 700, "ab" * 300]
    rows = []
    for i in range(80):
        text = "".join(b[rnd.randrange(300) :][: rnd.randrange(330)] for b in rnd.choices(base, k=rnd.randrange(4)))
        rows.append((i * 7 % 61 if i % 9 else 5, text if i else None))
    return [*rows, (None, base[0]), (90, base[0]), (90, base[0]), (-4, base[1]), (7, "x" * 49), (8, "x" * 50), (9, "x" * 51)]


@pytest.mark.parametrize("piece,batch", [(1 << 18, 8 << 20), (64, 700)])
def test_repeats_match_brute_force(spark, monkeypatch, piece, batch):
    monkeypatch.setattr(repeats, "PIECE", piece)
    monkeypatch.setattr(repeats, "BATCH_BYTES", batch)
    rows = repeat_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("mine")).repartition(3)
    got = Counter(map(tuple, repeats.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()))
    assert got == brute_repeats([(i, (t or "").encode()) for i, t in rows])


def test_repeats_keep_bytes_and_empty_table(spark):
    text = "".join(chr(97 + k * k % 23) for k in range(120))
    df = spark.createDataFrame([(1, text), (2, "<<" + text + ">>")], "doc_id long, text string")
    found = {r["doc_id"]: bytes(r["kept"]).decode() for r in repeats.remove_repeats(df, keep_bytes=True).collect()}
    assert found == {1: text, 2: "<<>>"}
    assert repeats.remove_repeats(df.limit(0)).count() == 0
    short = spark.createDataFrame([(1, "short"), (2, None)], "doc_id long, text string").withColumns({"key": F.lit(1), "id": F.lit(2), "a.b": F.lit(3)})
    assert {tuple(r)[:3] for r in repeats.remove_repeats(short).select("doc_id", "n_bytes", "n_removed").collect()} == {(1, 5, 0), (2, 0, 0)}


def test_family_levels_grow_geometrically():
    family, rnd, smallest = repeats.Family(), np.random.default_rng(0), {}
    for doc in range(64):
        keys = rnd.integers(0, 500, 40).astype(np.uint64)
        # what a new batch meets in the levels is what came before it
        assert family.smallest(keys, keys % np.uint64(7)).tolist() == [smallest.get(k, np.iinfo(np.int64).max) for k in keys.tolist()]
        family.insert(keys, keys % np.uint64(7), np.full(40, doc), doc)
        for k in keys.tolist():
            smallest.setdefault(k, doc)
        sizes = [len(level[0]) for level in family.levels]
        assert all(a > 2 * b for a, b in zip(sizes, sizes[1:]))
    keys = np.arange(500, dtype=np.uint64)
    expected = [smallest.get(k, np.iinfo(np.int64).max) for k in range(500)]
    assert family.smallest(keys, keys % np.uint64(7)).tolist() == expected
    assert family.smallest(keys, keys % np.uint64(7) + np.uint64(9)).min() == np.iinfo(np.int64).max, "equal keys with another check"
    whole = family.whole()
    assert whole[0].tolist() == sorted(smallest) and whole[2].tolist() == whole[3].tolist() == [smallest[k] for k in sorted(smallest)]


def test_hot_assignments_are_dealt_by_window(spark, monkeypatch):
    rnd = random.Random(8)
    notice = "= all rights reserved here ="
    rows = [(k, "".join(rnd.choice("abcdefgh ") for _ in range(60)) + notice + "".join(rnd.choice("abcdefgh ") for _ in range(60))) for k in range(60)]
    rows += [(100 + k, rows[k][1][20:140] + "-" * 90) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(repeats, "BATCH_BYTES", 3000)
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", 8)
    chunks = repeats.batches_of(df, "doc_id", "text", repeats.new_path(spark))
    assert len(repeats._hot(chunks)) >= 1
    got = Counter(map(tuple, repeats.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()))
    assert got == brute_repeats([(i, t.encode()) for i, t in rows])


@pytest.mark.parametrize("scan", [1, 400])
def test_scans_of_several_batches_compare_bytes(spark, monkeypatch, scan):
    monkeypatch.setattr(repeats, "BATCH_BYTES", 700)
    monkeypatch.setattr(repeats, "SCAN", scan)
    monkeypatch.setattr(repeats, "_several", lambda hashes, docs: np.ones(len(hashes), bool))  # as if all hashes were one
    rows = repeat_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(map(tuple, repeats.remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()))
    assert got == brute_repeats([(i, (t or "").encode()) for i, t in rows])


def test_only_windows_that_two_documents_may_share_are_ordered():
    hashes, docs = np.array([7, 3, 7, 3, 5, 9, 9], np.uint64), np.array([1, 2, 4, 2, 1, 8, repeats.STORED])
    assert repeats._several(hashes, docs).tolist() == [True, False, True, False, False, True, True]
    assert repeats._several(hashes[:0], docs[:0]).tolist() == []


def test_several_messages_are_scanned_at_once():
    sizes = [5, 1, 2, 9, 3, 3, 1]
    cuts = repeats._together(sizes, 6)
    assert cuts == [(0, 2), (2, 4), (4, 6), (6, 7)] and repeats._together([], 6) == []
    rnd, family, smallest = np.random.default_rng(1), repeats.Family(), {}
    for n in range(30):
        keys = rnd.integers(0, 300, 90).astype(np.uint64)
        docs, batches = rnd.integers(0, 1000, 90), rnd.integers(0, 5, 90) + 10 * n
        for k, d in zip(keys.tolist(), docs.tolist(), strict=True):
            smallest[k] = min(smallest.get(k, d), d)
        assert family.insert(keys, keys % np.uint64(3), docs, batches).tolist() == [smallest[k] for k in keys.tolist()]


def test_work_on_a_batch_does_not_grow_with_the_partitions(monkeypatch):
    rnd, made = random.Random(4), {}
    texts = ["".join(rnd.choice("abcdefgh ") for _ in range(3000)).encode() for _ in range(10)]
    row = {"ids": list(range(10)), "sizes": [3000] * 10, "blob": repeats.zstandard.ZstdCompressor().compress(b"".join(texts))}

    class Counted:
        def __getattr__(self, name):
            return getattr(np, name)

        def arange(self, *args):
            out = np.arange(*args)
            made[n_parts] = made.get(n_parts, 0) + len(out)
            return out

    monkeypatch.setattr(repeats, "np", Counted())
    for n_parts in (2, 64):
        b, one, two = repeats.Batch(row, n_parts, np.zeros(0, np.uint64)), [], []
        for p, (s, e) in b.parts.items():
            one.append({"part": p, "blob": repeats._pack(np.packbits(np.zeros(e - s, bool)), np.packbits(np.ones(e - s, bool)))})
            two.append({"part": p, "blob": repeats._pack(np.packbits(np.ones(int(b.size[b.head[s:e]].sum()), bool)))})
        made[n_parts] = 0
        assert [edges.tolist() for _, edges in repeats._removed(b, one, two)] == [[0, 3000]] * 10
    assert made[64] < 1.1 * made[2]


@pytest.mark.parametrize("hot", [150_000, 3])
def test_new_batches_meet_a_stored_index(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(repeats, "BATCH_BYTES", 900)
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", hot)
    rows, stored = [(i, t) for i, t in repeat_rows() if i is not None], []
    for generation in range(4):
        own = rows[generation::4]
        df = spark.createDataFrame(own, "doc_id long, text string").repartition(2)
        got = Counter(map(tuple, repeats.remove_repeats(df, index=str(tmp_path / "index"), expected_bytes=1 << 20).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()))
        # stored documents come before all new ones
        order = [(i - 10_000, (t or "").encode()) for i, t in stored] + [(i, (t or "").encode()) for i, t in own]
        assert got == Counter({k: n for k, n in brute_repeats(order).items() if k[0] > -1000})
        stored += own
    levels = repeats.Index(spark, str(tmp_path / "index")).read("levels", repeats.KINDS).collect()
    assert {r["chunk"] for r in levels} == {1, 2, 3, 4} and any(r["covers"] for r in levels)


# ---- token counts ----


def library_count(scores, byte_fallback, text):
    from tokenizers import Tokenizer, models

    vocabulary = [("<unk>", 0.0), *((f"<0x{k:02X}>", 0.0) for k in range(256)), *scores.items()] if byte_fallback else [("<unk>", 0.0), *scores.items()]
    own = Tokenizer(models.Unigram(vocabulary, 0, byte_fallback))
    return len(own.encode("▁" + text.replace(" ", "▁"), add_special_tokens=False).ids) if text else 0


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_counts_match_the_library(byte_fallback):
    scores = {"▁": -3.0, "a": -2.0, "b": -2.0, "ab": -4.0, "ba": -3.5, "aba": -6.0, "▁a": -4.5, "▁▁": -5.0, "é": -3.0, "bab": -5.5, "c": -9.0, "cc": -9.0}
    vocabulary, rnd = tokens.Vocabulary(scores, byte_fallback), random.Random(2)
    # the library takes the lowest score of all its pieces for unknown characters; here that is one of ours
    for _ in range(400):
        text = "".join(rnd.choice("aabbc é漢🙂z") for _ in range(rnd.randrange(14)))
        assert vocabulary.count(text)[0] == library_count(scores, byte_fallback, text), text


def test_counts_with_the_public_vocabulary(spark, monkeypatch):
    vocabulary = tokens.load_vocabulary(tokens.default_path())
    texts = ["", None, " ", "Hello world", "é漢\n\t x", "  two  spaces  ", "▁mark", "word " * 50_000, "x" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"n_tokens": F.lit("mine"), "_count_text": F.lit(1), "a.b": F.lit(2)})
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(df, vocabulary).collect()}
    import sentencepiece
    from tokenizers import Tokenizer, models

    model = sentencepiece.SentencePieceProcessor(model_file=tokens.default_path())
    own = Tokenizer(models.Unigram([(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], 0, True))
    for i, t in enumerate(texts):
        assert got[i] == (len(own.encode("▁" + t.replace(" ", "▁"), add_special_tokens=False).ids) if t else 0), t
    monkeypatch.setattr(tokens, "PIECE", 7)
    for t in texts[:-2]:
        assert tokens.Vocabulary(vocabulary.scores).count(t)[0] == vocabulary.count(t)[0]
    assert tokens.count_tokens(df.limit(0), vocabulary).count() == 0


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_slices_of_a_word_make_no_difference(monkeypatch, byte_fallback):
    scores = {"▁": -3.0, "a": -2.0, "b": -2.0, "ab": -4.0, "ba": -3.5, "aba": -6.0, "▁a": -4.5, "bab": -5.5, "abababa": -9.0}
    vocabulary, rnd = tokens.Vocabulary(scores, byte_fallback), random.Random(3)
    for _ in range(200):
        word = "".join(rnd.choice("aabbé漢z") for _ in range(rnd.randrange(1, 60)))
        monkeypatch.setattr(tokens, "SLICE", 1 << 14)
        whole = vocabulary._any(word)
        for size in (1, 2, 5, 13):
            monkeypatch.setattr(tokens, "SLICE", size)
            assert vocabulary._any(word) == pytest.approx(whole)


def test_a_long_text_without_spaces_takes_little_memory():
    import tracemalloc

    vocabulary = tokens.Vocabulary({"a": -1.0, "b": -1.5, "ab": -2.0, "▁": -3.0})
    text = "ab" * 200_000 + "é"
    tracemalloc.start()
    n, unknown, _ = vocabulary.count(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (n, unknown) == (200_003, 1) and peak < 15 << 20


def test_a_mark_inside_a_piece_is_refused():
    with pytest.raises(ValueError):
        tokens.Vocabulary({"a▁b": -1.0})


# ---- main text ----

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href=x>a</a><li>b</ul></nav>
<div id="cookie-notice">We use</div><main><article class="post"><header><h1>Head {0} &amp; co</h1><span>By X</span></header><p>One <b>bold</b> <i>it</i>, two&nbsp; three.
<p>Para &lt;{0}&gt;</p><div class="ad-slot">buy</div>{1}<form><input><p>mail</p></form><section class="comments"><p>nice</p></section></article></main>
<aside>side</aside><script>if(a<b){{"</p>"}}</script><footer>f</footer></body></html>"""


def test_main_text_of_a_site(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.format(i, "<ul>" + "<li>x<li>y" * (i % 3) + "</ul>")) for i in range(9)]
    rows += [(20, "http://b.example", None), (21, None, ""), (22, "no url", "just <p>text</p>"), (22, "no url", "just <p>text</p>"), (23, "http://b.example", "<p>un<b>closed <i")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("mine"))
    found = wrappers.main_text(df)
    assert Counter(found.columns) == Counter(["page_id", "url", "html", "text", "n_chars"])
    out = found.collect()
    assert len(out) == len(rows)
    for r in out:
        if r["page_id"] < 20:
            items = "\nx\ny" * (r["page_id"] % 3)
            assert r["text"] == f"Head {r['page_id']} & co\nOne bold it, two three.\nPara <{r['page_id']}>{items}"
        assert r["n_chars"] == len(r["text"])
    rest = {r["page_id"]: r["text"] for r in out if r["page_id"] >= 20}
    assert rest[20] == rest[21] == "" and rest[22] == "just\ntext"
    assert wrappers.main_text(df.limit(0)).count() == 0


def covered(page, wrapper):
    """Whether the wrapper has a slot for every text of a page."""
    tree, _ = wrappers.parse(page)
    return len(wrappers.matched(tree, wrapper)) == len(wrappers.leaves(tree))


def test_wrappers_align_in_groups(spark, monkeypatch):
    rows = [("h", f"<body><div class=content>{'<h2>a</h2>' * (i % 2)}{'<p>x</p>' * (i % 5)}{'<hr><em>s</em>' * (i % 3)}<p>end</p></div></body>") for i in range(30)]
    df = spark.createDataFrame(rows, "host string, html string")
    one = wrappers.infer_wrappers(df).collect()
    monkeypatch.setattr(wrappers, "GROUP", 4)
    many = wrappers.infer_wrappers(df).collect()
    assert len(one) == len(many) == 1
    for found in (one, many):
        node = wrappers.node_of(json.loads(found[0]["wrapper"]))
        assert wrappers.expression(node).startswith("<body> <div*> ") and "(<h2> TEXT </h2>)?" in wrappers.expression(node)
        assert all(covered(page, node) for _, page in rows)


def test_expression_has_optional_and_repeated_groups():
    tree = lambda page: wrappers.parse(page)[0]
    a, b = tree("<ul><li>a</li><li>b</li></ul><p>x</p>"), tree("<ul><li>a</li></ul>")
    assert wrappers.expression(wrappers.merge(a, b)) == "<ul> (<li> TEXT </li>)+ </ul> (<p> TEXT </p>)?"
    pairs = tree("<dl><dt>a</dt><dd>1</dd><dt>b</dt><dd>2</dd></dl>")
    assert wrappers.expression(pairs) == "<dl> (<dt> TEXT </dt> <dd> TEXT </dd>)+ </dl>"
    single = tree("<dl><dt>a</dt><dd>1</dd></dl>")
    assert wrappers.expression(wrappers.merge(single, pairs)) == wrappers.expression(pairs)
    assert len(wrappers.matched(single, pairs)) == 2 == len(set(wrappers.matched(single, pairs).values()))
    # like goes with like: the block in front that one page lacks does not take the place of the article
    front = tree("<div>note</div><div><h2>t</h2><p>x</p></div>")
    bare = tree("<div><h2>t</h2><p>x</p><ul><li>y</ul></div>")
    assert wrappers.expression(wrappers.merge(front, bare)) == "(<div> TEXT </div>)? <div> <h2> TEXT </h2> <p> TEXT </p> (<ul> <li> TEXT </li> </ul>)? </div>"


def alone(page):
    """The text of a page that is its host's only one."""
    tree, lines = wrappers.parse(page)
    own = {k: x for x, k in ((x, wrappers.matched(tree, tree)[id(x)]) for x in wrappers.leaves(tree))}
    slots = {k: (1, sum(len(lines[i][0]) for i in x.lines), sum(lines[i][1] for i in x.lines), True, 1) for k, x in own.items()}
    return wrappers.extract(page, tree, slots)


def test_only_names_and_roles_mark_surroundings():
    page = '<article><p style="overflow:hidden" data-class="ad">a <a href="/?id=ad&class=menu" title="share hidden">b</a></p><p hidden>c</p><p aria-hidden="true">d</p><p role=alert>e</p></article>'
    assert alone(page) == "a b"


def test_names_of_what_stands_beside_do_not_count():
    page = '<div class="page has-sidebar"><div class="content with-comments">text</div><div class="sidebar">s</div></div>'
    assert alone(page) == "text"


def test_without_article_the_longest_container_counts():
    page = '<div class="menu"><a>x</a></div><div class="wrap"><div id="left-sidebar">s</div><div class="txt"><h2>T</h2><p>para one</p><p>para two</div></div><div class=footer>c</div>'
    assert alone(page) == "T\npara one\npara two"


def site(i, note):
    """A page without telling names: what is the article can be told from other pages of the site alone."""
    paragraphs = "".join(f"<p>Report {i} part {k} says what happened there and then." for k in range(1 + i % 3))
    return (
        f"<html><body>{'<div><p>We will close early today, dear readers.</div>' if note else ''}"
        "<div><b>The Daily</b> is the paper that has been read in this town for more than a hundred years, by all who can read and by many who can not.</div>"
        f"<div><ul><li><a href=/a>News</a><li><a href=/b>Views {i}</a></ul></div>"
        f"<div><div><h2>Headline {i}</h2>{paragraphs}<p><i>Tell us what you think.</i></div>"
        "<div><p>All rights reserved. No part of this page may be printed, sold, lent or read aloud without the leave of the owners, who never give it.</div></div></body></html>"
    )


def test_the_wrapper_decides_what_is_the_article(spark):
    rows = [(i, "http://plain.example/x", site(i, i % 4 == 1)) for i in range(24)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in wrappers.main_text(df).collect():
        i = r["page_id"]
        body = [f"Report {i} part {k} says what happened there and then." for k in range(1 + i % 3)]
        # the last line never changes but stands in one repeated group with those that do
        assert r["text"].split("\n") == [f"Headline {i}", *body, "Tell us what you think."]
        # without the wrapper all of the page would be left
        assert "All rights reserved" in wrappers.extract(r["html"], wrappers.Node(""), {}) and "hundred years" in wrappers.extract(r["html"], wrappers.Node(""), {})


def texts_of(spark, pages, host="t.example"):
    df = spark.createDataFrame([(i, f"http://{host}/", x) for i, x in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in wrappers.main_text(df).orderBy("page_id").collect()]


def test_an_article_loses_nothing_that_its_pages_share(spark):
    page = "<html><body><article><h1>Title {0}</h1><section><p>A note that all of our reports share.</p></section><p>Text {0} of the article.</p><ul><li><a href=1>More {0}</a><li><a href=2>Else {0}</a></ul></article></body></html>"
    for n in (1, 8):
        assert texts_of(spark, [page.format(i) for i in range(n)]) == [f"Title {i}\nA note that all of our reports share.\nText {i} of the article.\nMore {i}\nElse {i}" for i in range(n)]


@pytest.mark.parametrize("n", [1, 5, 50])
def test_copies_of_one_page_keep_their_article(spark, n):
    plain = "<html><body><div><ul><li><a href=/>Home</a></ul></div><div><h2>Title of it</h2><p>The first part of the text.</p><p>The second part of it.</p></div></body></html>"
    named = "<html><body><nav>x</nav><article><h1>Title of it</h1><p>The first part of the text.</p></article></body></html>"
    assert texts_of(spark, [plain] * n) == ["Title of it\nThe first part of the text.\nThe second part of it."] * n
    assert texts_of(spark, [named] * n) == ["Title of it\nThe first part of the text."] * n


@pytest.mark.parametrize(
    "page",
    [
        '<body><div class="top">Top</div><div class="story-body social"><h1>Head {0}</h1><p>{1}</p></div><div class="widget">Small</div></body>',
        '<body><main><div class="entry search-result"><h1>Head {0}</h1><p>{1}</p></div></main></body>',
        '<body><form id="aspnetForm" action="x"><input type="hidden" value="v"><div class="menu">m</div><div><h1>Head {0}</h1><p>{1}</p></div><button>Go</button></form></body>',
        '<body><form><article><h1>Head {0}</h1><p>{1}</p><form><label>Mail</label><input><p>Get our letter</p></form></article></form></body>',
        '<body><div class="widget"><div class="widget"><h1>Head {0}</h1><p>{1}</p></div></div></body>',
        '<body><article><h1>Head {0}</h1><div class="promo-widget"><p>{1}</p></div><div class="share">Share it</div></article></body>',
    ],
)
@pytest.mark.parametrize("n", [1, 9])
def test_names_that_sound_like_surroundings_do_not_hide_the_article(spark, page, n):
    bodies = [f"What happened there and then in part {i} of the long report, as it was told to us by all who were there." for i in range(n)]
    expected = [f"Head {i}\n{b}" for i, b in enumerate(bodies)]
    got = texts_of(spark, [page.format(i, b) for i, b in enumerate(bodies)])
    assert [x.removeprefix("Top\n") for x in got] == expected


def test_marked_surroundings_beside_an_article_are_left_out(spark):
    page = '<body><div class="newsletter">{2}</div><article><h1>Head {0}</h1><p>Text {0} of it.</p><div class="social">Share {0}</div><form><p>Mail us {0}</p></form><div class="related"><p>{2}</p></div></article><div class="comments"><p>{1}</p></div></body>'
    got = texts_of(spark, [page.format(i, f"a long comment {i} " * 30, f"more {i} of it, and more") for i in range(8)])
    assert got == [f"Head {i}\nText {i} of it." for i in range(8)]


def test_every_layout_of_a_host_counts(spark):
    article = "<body><nav>n</nav><article><h1>T{0}</h1><p>text {0} one two</p></article></body>"
    content = "<body><div class=top>top</div><div class=content><h1>T{0}</h1><p>text {0} one two</p></div></body>"
    rows = [(i, None if i % 3 else "/relative", (article if i % 2 else content).format(i)) for i in range(20)]
    out = wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in out} == {i: f"T{i}\ntext {i} one two" for i in range(20)}


def test_deep_and_long_pages(spark):
    deep = "<div>" * 5000 + "<p>deep text</p><nav>menu</nav>" + "</div>" * 5000
    long = "<article>" + "<p>para</p>" * 100_000 + "</article>"
    inline = "<article><p>" + "<b>x" * 5000 + "</article>"
    df = spark.createDataFrame([(0, "http://d.example", deep), (1, "http://l.example", long), (2, "http://i.example", inline)], "page_id long, url string, html string")
    df = df.withColumns({"_host": F.lit(1), "_html": F.lit(2), "a.b": F.lit(3)})
    out = {r["page_id"]: r for r in wrappers.main_text(df).collect()}
    assert out[0]["text"] == "deep text" and out[1]["n_chars"] == 499_999 and out[2]["text"] == "x" * 5000
    assert (out[0]["_host"], out[0]["_html"], out[0]["a.b"]) == (1, 2, 3)


# ---- tool calls ----

CALL = "conv_id long, call_id string, name string, arguments string, parents array<string>, turn long"


def test_tool_calls(spark):
    calls = [
        (1, "a", "search", '{"turn": 1, "query": "é \\"q\\""}', [], 0),
        (1, "b", "search", '{"query": 5, "more": {"z":1,"a":[2, 1]}}', ["a", "zz"], 0),
        (1, "c", "search", "{broken", ["b", "a"], 0),
        (1, "d", "none", "[1]", ["c"], 0),
        (2, "x", "search", '{"turn":1,"query":"q"}', ["y"], 0),
        (2, "y", "search", '{"turn":1,"query":"q"}', ["x"], 0),
        (2, "z", "search", None, ["y"], 0),
        (3, "a", "search", '{"turn":1.5,"query":"q"}', None, 0),
        (3, "a", "search", '{"turn":1.5,"query":"q"}', None, 0),
        (None, None, "search", "{}", None, 0),
    ]
    results = [(1, "a", "two"), (1, "a", "one"), (1, "q", "lost"), (3, "a", None), (None, "a", "nobody's"), (1, None, "nobody's")]
    out = toolcalls.link(spark.createDataFrame(calls, CALL), spark.createDataFrame(results, "conv_id long, call_id string, content string"), toolcalls.TOOLS).collect()
    got = {(r["conv_id"], r["call_id"]): r for r in out}
    assert len(out) == len(calls) + 1
    assert got[1, "a"]["canonical"] == '{"arguments":{"query":"é \\"q\\"","turn":1},"id":"a","level":0,"name":"search","result":"one"}'
    assert (got[1, "a"]["n_results"], got[1, "a"]["errors"], got[1, "a"]["status"]) == (2, [], "linked")
    assert got[1, "b"]["errors"] == ["more: unknown", "query: not string", "turn: missing"] and got[1, "b"]["level"] == 1
    assert json.loads(got[1, "b"]["canonical"])["arguments"] == {"more": {"a": [2, 1], "z": 1}, "query": 5}
    assert got[1, "c"]["errors"] == ["arguments are no JSON"] and json.loads(got[1, "c"]["canonical"])["arguments"] == "{broken"
    assert (got[1, "d"]["level"], got[1, "d"]["errors"]) == (3, ["arguments are no object"])
    assert [got[2, k]["level"] for k in "xyz"] == [None] * 3
    assert got[1, "q"]["status"] == "orphan" and got[1, "q"]["canonical"] is None and got[2, "x"]["status"] == "unanswered"
    assert got[3, "a"]["errors"] == ["turn: not integer"]
    for r in out:
        if r["canonical"]:
            json.loads(r["canonical"])
    order = [(r["conv_id"] or 0, -1 if r["level"] is None else r["level"]) for r in out]
    assert order == sorted(order)


def test_levels_of_chains_and_graphs(spark):
    rnd = random.Random(6)
    rows, expected = [], {}
    for conv in range(6):
        names = [f"n{k}" for k in range(60)]
        parents = {n: [names[k - 1]] if k % 20 and conv < 2 else rnd.sample(names[:k], min(k, rnd.choice((0, 1, 1, 2)))) for k, n in enumerate(names)}
        if conv == 5:
            parents["n10"] = ["n12"]
            parents["n12"] = ["n11"]
            parents["n11"] = ["n10"]
        level = {}
        for _ in names:
            for n in names:
                if all(p in level for p in parents[n]):
                    level[n] = 1 + max((level[p] for p in parents[n]), default=-1)
        expected |= {(conv, n): level.get(n) for n in names}
        rows += [(conv, n, parents[n] + ["gone"]) for n in names]
    rows += [(9, "self", ["self"]), (9, "after", ["self"])]
    expected |= {(9, "self"): None, (9, "after"): None}
    rnd.shuffle(rows)
    got = {(r[0], r[1]): r[2] for r in toolcalls.levels(spark.createDataFrame(rows, "conv_id long, call_id string, parents array<string>")).collect()}
    assert got == expected


def test_long_arguments_and_clashing_names(spark):
    long = "x" * 300_000
    calls = spark.createDataFrame([(1, "a", "search", json.dumps({"turn": 1, "query": long}), None, 0)], CALL)
    results = spark.createDataFrame([(1, "a", long)], "conv_id long, call_id string, content string")
    clash = {c: F.lit(c) for c in ("_call", "level", "status", "n_results", "top", "dist", "_one", "a.b")}
    (r,) = toolcalls.link(calls.withColumns(clash), results.withColumns(clash), toolcalls.TOOLS).collect()
    assert (r["status"], r["level"], r["errors"]) == ("linked", 0, []) and json.loads(r["canonical"])["arguments"]["query"] == long == json.loads(r["canonical"])["result"]


def test_tool_calls_of_empty_tables(spark):
    calls, results = spark.createDataFrame([], CALL), spark.createDataFrame([], "conv_id long, call_id string, content string")
    assert toolcalls.link(calls, results, toolcalls.TOOLS).count() == 0


# ---- audio ----


def melody(seed, n=40):
    rnd = np.random.default_rng(seed)
    time = np.arange(1000) / 4000
    return np.concatenate([np.sin(2 * np.pi * 523.25 * 2 ** (rnd.integers(0, 12) / 12) * time) * 0.5 for _ in range(n)])


def brute_alignments(prints, probing, queries):
    """``(query row, other row) -> (offset, error)`` of distinct ``(key, print)`` rows, by trying every offset."""
    rows, out = sorted({(k, p) for k, p in prints if k is not None and p}), {}
    for key, own in rows:
        if key not in queries:
            continue
        looked = {}
        for i, x in zip(*probing[key, own], strict=True):
            looked.setdefault(x, set()).add(i)
        for other, theirs in rows:
            if (other, theirs) == (key, own):
                continue
            histogram = Counter(i - j for j, x in enumerate(theirs) for i in looked.get(x, ()))
            over = {d: min(len(own), len(theirs) + d) - max(d, 0) for d in histogram}
            ranked = sorted((-n, abs(d), d) for d, n in histogram.items() if over[d] >= audioprint.LEAST_OVERLAP)
            if ranked:
                d = ranked[0][2]
                bits = sum(((own[i] ^ theirs[i - d]) & 0xFFFFFFFF).bit_count() for i in range(max(d, 0), max(d, 0) + over[d]))
                if bits / (32 * over[d]) <= audioprint.MAX_ERROR:
                    out[(key, own), (other, theirs)] = d, bits / (32 * over[d])
    return out


def pairs_of(prints, queries):
    """The operator's alignments by rows: classes expanded by their members."""
    found, members = audioprint.classes(prints)
    asked = queries.withColumn("class", F.md5(F.array_join(F.col("print").cast("array<string>"), ",").cast("binary"))).dropDuplicates(["class"])
    got = audioprint.aligned(found.cache(), asked)
    prints_of = {r["class"]: tuple(r["print"]) for r in found.collect()}
    inside = {}
    for r in members.collect():
        inside.setdefault(r["class"], []).append((r["key"], prints_of[r["class"]]))
    return {(q, o): (r["offset"], r["error"]) for r in got.collect() for q in inside[r["query"]] for o in inside[r["other"]] if q != o}


@pytest.mark.parametrize("block,cells", [(1 << 19, 1 << 21), (300, 1000)])
def test_alignment_matches_brute_force(spark, tmp_path, monkeypatch, block, cells):
    monkeypatch.setattr(audioprint, "BLOCK_INTS", block)
    monkeypatch.setattr(audioprint, "CELLS", cells)
    song, rnd = melody(1), np.random.default_rng(9)
    shift = 20 * audioprint.HOP
    media = [
        (0, song),
        (1, song[shift:]),
        (2, song + rnd.normal(0, 0.02, len(song))),
        (3, melody(2)),
        (4, np.zeros(9000)),
        (14, np.zeros(30_000)),
        (24, np.zeros(9000)),
        (5, song[:500]),
        (6, None),
        (7, song),
        (7, song),
        (0, melody(3)),
        (10, np.concatenate([np.zeros(9000), song, np.ones(9000) * 0.5])),
        (None, song),
    ]
    rows = [(i, None if s is None else audioprint.encode(s, 4000)) for i, s in media] + [(8, b"no audio"), (9, b"")]
    df = spark.createDataFrame(rows, "vec_id long, audio binary").withColumn("print", F.lit("mine")).withColumn("_audio", F.lit("theirs"))
    prints = audioprint.fingerprints(df, probing=True).cache()
    assert prints.columns == ["vec_id", "_audio", "print", "probe_at", "probe"] and audioprint.fingerprints(df).columns == ["vec_id", "_audio", "print"]
    known = prints.collect()
    size = {r["vec_id"]: len(r["print"]) for r in known if r["vec_id"] != 0}
    assert size[5] == size[6] == size[8] == size[9] == 0 and size[7] == (len(song) - audioprint.WINDOW) // audioprint.HOP + 2 - audioprint.SPAN
    probing = {(r["vec_id"], tuple(r["print"])): (r["probe_at"], r["probe"]) for r in known}
    queries = prints.where("vec_id % 2 = 0")
    got = pairs_of(prints, queries)
    # a class is asked for all of its members
    asked = {r["vec_id"] for r in known if r["vec_id"] is not None}
    expected = brute_alignments([(r["vec_id"], tuple(r["print"])) for r in known], probing, asked)
    even = {tuple(r["print"]) for r in known if r["vec_id"] is not None and r["vec_id"] % 2 == 0}
    assert {k: (d, round(e, 9)) for k, (d, e) in got.items()} == {k: (d, round(e, 9)) for k, (d, e) in expected.items() if k[0][1] in even}
    assert got[(7, probing and next(p for k, p in probing if k == 7)), (1, next(p for k, p in probing if k == 1))][0] == 20
    found, _ = audioprint.classes(prints.limit(0))
    assert audioprint.aligned(found, prints.where("vec_id = 7").withColumn("class", F.lit("c"))).count() == 0


def test_alignment_query_matches_brute_force(spark, tmp_path):
    rnd = np.random.default_rng(4)
    base = rnd.normal(0, 0.125, (12, 64))
    vectors = [(k, (base[k % 12] + rnd.normal(0, 0.016, 64)).tolist()) for k in range(400)] + [(500, None), (550, []), (600, [0.0] * 64)]
    vectors += [(k, vectors[0][1]) for k in (50, 401, 402)] + [(100, vectors[100][1]), (150, vectors[3][1]), (700, vectors[9][1]), (None, vectors[0][1])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("key", F.lit(1)).withColumn("vector", F.lit(1))
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    media = audioprint.with_audio(df)
    known = audioprint.fingerprints(media, probing=True).collect()
    probing = {(r["vec_id"], tuple(r["print"])): (r["probe_at"], r["probe"]) for r in known}
    prints = [(r["vec_id"], tuple(r["print"])) for r in known]
    expected = brute_alignments(prints, probing, {k for k, _ in prints if k is not None and k % 50 == 0})
    best, count = {}, Counter()
    for (q, o), (d, e) in expected.items():
        count[q] += 1
        best[q] = min(best.get(q, (9.0, 0, 0)), (e, o[0], d))
    out = audioprint.op5_audio_align(spark, str(tmp_path)).collect()
    assert Counter(r["vec_id"] for r in out) == Counter(k for k, _ in vectors if k is not None and k % 50 == 0)
    for r in out:
        # the print is told apart by its digest
        q = next((k, p) for k, p in prints if k == r["vec_id"] and hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() == r["print_sha256"])
        e, o, d = best.get(q, (None, None, None))
        assert (r["n_ints"], r["n_aligned"], r["best_id"], r["best_offset"]) == (len(q[1]), count[q], o, d)
        assert r["best_error"] == (None if e is None else pytest.approx(e))
    # recall against all pairs at the true offset
    near = {(a, b) for a in prints for b in prints if a != b and a[0] is not None and b[0] is not None and a[0] % 50 == 0 and a[1] and len(a[1]) == len(b[1])
            and np.unpackbits((np.array(a[1], np.int32) ^ np.array(b[1], np.int32)).view(np.uint8)).mean() <= audioprint.MAX_ERROR}
    assert len(near) > 50 and len(near & set(expected)) >= 0.9 * len(near)


def errors_at_all_offsets(p, q):
    """``(offset, error)`` of two prints wherever they overlap enough."""
    bits = np.bitwise_count((p[:, None] ^ q[None, :]).view(np.uint32)).astype(np.int64)
    diagonals = ((d, np.diagonal(bits, -d)) for d in range(1 - len(q), len(p)))
    return {d: x.mean() / 32 for d, x in diagonals if len(x) >= audioprint.LEAST_OVERLAP}


def recall_of(prints, probed, queries):
    """Pairs that align somewhere, and those of them that are found at such an offset."""
    true = found = 0
    for k in queries:
        index = audioprint.Queries([prints[k]], [probed[k][0]], [probed[k][1]])
        for j, other in enumerate(prints):
            good = {d for d, e in errors_at_all_offsets(prints[k], other).items() if e <= audioprint.MAX_ERROR} if j != k else set()
            if good:
                _, offset, _ = index.align(other, audioprint.MAX_ERROR, audioprint.LEAST_OVERLAP)
                true, found = true + 1, found + bool(good & set(offset.tolist()))
    return true, found


def test_recall_over_all_offsets():
    rnd = np.random.default_rng(5)
    media = [melody(k) for k in range(24)]
    for song in media[:24]:  # cut out, so shifted, and noisy
        for noise in (0.02, 0.05, 0.1, 0.2):
            a = rnd.integers(0, 12_000)
            part = song[a : a + rnd.integers(12_000, 26_000)]
            media.append(part + rnd.normal(0, noise, len(part)))
    made = [audioprint.fingerprint(x, 4000) for x in media]
    probed = [tuple(y.view(np.int32) for y in map(np.ascontiguousarray, (a.astype(np.int32), b.astype(np.uint32)))) for a, b in (audioprint.probes(*x) for x in made)]
    true, found = recall_of([x[0].view(np.int32) for x in made], probed, range(24))
    assert true > 60 and found >= 0.9 * true


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_recall_on_the_given_vectors(spark):
    rows = [r.asDict() for r in audioprint.fingerprints(audioprint.with_audio(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")), probing=True).collect()]
    prints, probed = [np.array(r["print"], np.int32) for r in rows], [(np.array(r["probe_at"], np.int32), np.array(r["probe"], np.int32)) for r in rows]
    true, found = recall_of(prints, probed, [k for k, r in enumerate(rows) if r["vec_id"] % 50 == 0])
    assert found >= 0.9 * true


def test_silence_costs_no_more_than_its_runs(spark):
    silent = [(k, audioprint.encode(np.zeros(80_000 + 256 * k), 4000)) for k in range(60)]
    prints = audioprint.fingerprints(spark.createDataFrame(silent, "vec_id long, audio binary"), probing=True).cache()
    index = audioprint.Queries(*[[np.array(r[c], np.int32) for r in prints.collect()] for c in ("print", "probe_at", "probe")])
    assert len(index.query) <= 4 * 60  # a run or two for each recording and probe
    assert len(pairs_of(prints, prints)) == 60 * 59


def test_stereo_is_averaged_and_other_widths_give_nothing():
    import io
    import wave

    def wav(width, channels, data):
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(channels)
            w.setsampwidth(width)
            w.setframerate(8000)
            w.writeframes(data)
        return out.getvalue()

    both = np.array([[16384, 0], [0, -16384]], "<i2")
    samples, rate = audioprint.decode(wav(2, 2, both.tobytes()))
    assert rate == 8000 and samples.tolist() == [0.25, -0.25]
    assert len(audioprint.decode(wav(1, 1, b"\x80" * 10))[0]) == 0
    still = bytearray(wav(2, 1, b"\1\0" * 9000))
    still[24:28] = bytes(4)  # a frame rate of zero
    assert len(audioprint.decode(bytes(still))[0]) == 0 and len(audioprint.decode(bytes(still)[:60])[0]) == 0
