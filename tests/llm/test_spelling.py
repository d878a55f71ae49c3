"""Spelling variants against comparing all pairs, over several blocks, and on odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from exhibita.llm import spelling as S
from exhibita.llm.common import Scratch

DOCS = "doc_id long, text string, word string, n long, key string"


def counts(rows):
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            total[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(words):
    out = {}
    for w, n in words.items():
        near = [x for x in words if is_near(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        out[w] = [best if best and words[best] >= 2 * n else None, None, n, len(near), None]
        out[w][4] = words[out[w][0]] if out[w][0] else None
    for w, x in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        x[1] = root
    return {w: tuple(x) for w, x in out.items()}


def vocabulary(rng, n, letters="abcdeé", low=5, high=9):
    words = {}
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))
        words[w] = rng.choice((3, 3, 4, 7, 20, 60, 500))
        if rng.random() < 0.6:
            k = rng.randrange(len(w))
            words[rng.choice((w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]))] = rng.choice((3, 4, 9, 30))
    return words


def found(spark, words):
    df = spark.createDataFrame([(w, n) for w, n in words.items()], "word string, n long")
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in S.variants(df).collect()}


def test_words_are_counted_with_the_rules_misspellings(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(("Straße", "naïve", "THERE", "there", "e", "×÷×÷×", "aĀbcdef", "x_yzzyx")) for _ in range(60))) for i in range(120)]
    rows += [(None, "there There thère " * 3), (900, None), (901, ""), (7, "again " * 5), (7, "again " * 5), (902, "z" * 5000 + " " + "z" * 5000 + " " + "z" * 5000)]
    df = spark.createDataFrame([(*r, "x", 1, None) for r in rows], DOCS)
    for piece, counted in ((1 << 20, 400_000), (7, 3)):
        monkeypatch.setattr(S, "PIECE", piece)
        monkeypatch.setattr(S, "COUNTED", counted)
        monkeypatch.setattr(S, "AT_ONCE", 4 * piece)
        got = {r["word"]: r["n"] for r in S.word_counts(df).collect()}
        assert got == counts(rows)
    assert len(got) > 8
    assert S.word_counts(df.limit(0)).collect() == []


@pytest.mark.parametrize(("block", "compared"), [(250_000, 30), (300, 30), (300, 0)])
def test_variants_match_all_pairs(spark, monkeypatch, block, compared):
    monkeypatch.setattr(S, "BLOCK", block)
    monkeypatch.setattr(S, "COMPARED", compared)
    words = vocabulary(random.Random(2), 700)
    words |= {"жаяжа": 9, "жаяжб": 40, "жаящб": 3, "漢漢漢漢漢": 3, "漢漢漢漢字": 8, "漢漢漢字": 20, "𝒳𝒳𝒳𝒳𝒳": 3, "𝒳𝒳𝒳𝒳a": 50}
    assert found(spark, words) == brute(words)


def test_anagrams_fill_blocks_that_no_split_divides(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 200)
    rng = random.Random(3)
    words = {"".join(rng.sample("aabbcc", 6)): rng.choice((3, 9, 40)) for _ in range(400)}
    words |= {"".join(rng.sample("aabbcd", 6)): rng.choice((3, 9, 40)) for _ in range(400)}
    words |= {"".join(rng.sample("aabbc", 5)): rng.choice((3, 9, 40)) for _ in range(100)}
    assert found(spark, words) == brute(words)


def test_the_tree_prunes_and_finds_every_pair():
    words = list(vocabulary(random.Random(4), 4000, "abcdefghij", 8, 8))
    words = [w for w in words if len(w) == 8]
    block = S.Block(words)
    pairs = set(block.near(words, 0))
    holes = defaultdict(list)
    for i, w in enumerate(words):
        for k in range(8):
            holes[k, w[:k] + w[k + 1 :]].append(i)
    assert pairs == {(i, j) for own in holes.values() for i in own for j in own if i != j}
    met = sum(len(own) * len(block.leaves[leaf]) for leaf, own in S.touched(block.tree, block.own.classes, 1, 1))
    assert met < 0.4 * len(block.own.classes) ** 2


def test_upper_splits_deal_every_word_to_one_place(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 500)
    words = vocabulary(random.Random(5), 500)
    df = spark.createDataFrame([(w, n) for w, n in words.items()], "word string, n long")
    plan = S.layout(df)
    held = [(x, w) for *x, kind, w in plan.at(list(words)) if kind == 2]
    assert sorted(w for _, w in held) == sorted(words)
    sizes = Counter(tuple(x) for x, _ in held)
    assert len(sizes) > 8 and max(sizes.values()) < len(words) / 3


def test_odd_rows_and_roots(spark):
    df = spark.createDataFrame([("abcde", 3), ("abcde", 3), (None, 9), ("abcdf", 6), ("abcdg", 12), ("abcdeg", 24)], "word string, n long")
    got = {r["word"]: tuple(r) for r in S.variants(df).collect()}
    assert got["abcde"] == ("abcde", "abcdeg", "abcdeg", 3, 3, 24) and set(got) == {"abcde", "abcdf", "abcdg", "abcdeg"}
    assert got["abcdf"][1:3] == ("abcdg", "abcdeg")
    assert S.variants(df.limit(0)).collect() == []
    texts = spark.createDataFrame([("abcdf", "x"), ("other", "y"), (None, "z")], "word string, _root string")
    rows = S.with_roots(S.variants(df), texts)
    assert rows.columns == ["word", "_root", "root"]
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted([("abcdf", "x", "abcdeg"), ("other", "y", "other"), (None, "z", None)], key=repr)
    with Scratch(spark) as scratch:
        assert S.near_words(df.where("word = 'abcde'").distinct(), scratch).collect() == []
