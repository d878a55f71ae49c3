"""Spelling variants: words at one edit, found by k-d trees over letter counts.

A word is the vector of how often it has each letter. One inserted or deleted letter changes one count by one; one
replaced letter takes one from a count and adds one to another. So the near words of a word lie in a small box around
its vector, at an L1 distance of one (length plus one) or two (same length), and a k-d tree over the vectors of one
length is searched with that box. A query goes down both sides of a split only where a count stands right at it, and
each such step uses up the one increase or the one decrease that an edit can make.

Words of one length are split by the upper levels of such a tree into blocks, which tasks hold one at a time. Words are
dealt out to the block that holds them and, as queries, to all blocks that their box touches: those of their own length,
and those of the next length, where the smaller of the two lengths is the queries. Inside a block the distinct vectors
(classes of anagrams) are a k-d tree; the letter order of two classes' words is then verified by what is left when the
letter that one has more is taken out, looked up in a table, never by pairs.

Anagrams are never near, so a block that no split can divide, words that are all anagrams of one another, is divided by
the words' hashes, and queries go to all of its parts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, named, spare, table, written
from .dialogue import CRC_TABLE, _crc_sql

#: Words have at least so many code points and occurrences.
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: One run in so many is misspelt by rule.
ONE_IN = 97
#: A form has at least so many times the occurrences.
TIMES = 2
#: Letters of the words in a block, about.
BLOCK = 250_000
#: Words of a length that are looked at to choose its upper splits, for each block.
LOOKED_AT = 64
#: Vectors in a leaf of a block's tree.
LEAF = 24
#: Two classes' words are all compared if their pairs are at most so many for each word, and looked up in a table otherwise.
COMPARED = 30
#: Vectors times letters that are compared at once.
AT_ONCE = 4 << 20
#: Runs and characters that a task counts before it hands them on.
COUNTED, PIECE = 400_000, 1 << 20
#: Places of a vector: a to z, U+00C0 to U+00FF, and eight that all other code points share.
SHARED, PLACES = 90, 98

_LETTERS = "[A-Za-zÀ-ÿ]"
_RUN = re.compile(_LETTERS + "+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def misspelt(start: int, run: str) -> str:
    """A run as it counts: where ``ONE_IN`` divides the crc32 of ``doc:run``, one code point is taken out by that number.

    ``start`` is the crc32 of ``doc:``.
    """
    h = zlib.crc32(run.encode(), start)
    if h % ONE_IN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _pieces(text: str) -> Iterator[str]:
    """A text cut between runs into pieces of about ``PIECE`` characters."""
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        if end < len(text):
            m = _RUN.match(text, end)
            end = m.end() if m else end
        yield text[at:end]
        at = end


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)``: the results of all runs, with the rule's misspellings, that are long and frequent enough.

    Null texts have none; a null key is empty in the rule. Texts of any length are read in pieces, and each task adds up
    what it has counted before the counts are shuffled, so a frequent word is no burden.
    """
    # a run does not get longer, so shorter ones can be left out at once
    long_run = re.compile(f"{_LETTERS}{{{max(1, least_length)},}}")
    rows = docs.select(F.coalesce(named(key).cast("string"), F.lit("")).alias("key"), named(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def batch_of() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc, x in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                own: Counter = Counter()
                start = zlib.crc32(f"{doc}:".encode())
                for piece in _pieces(x.as_py() or ""):
                    own.update(long_run.findall(piece.translate(_LOWER)))
                for run, n in own.items():
                    if len(word := misspelt(start, run)) >= least_length:
                        total[word] += n
                if len(total) > COUNTED:
                    yield batch_of()
        if total:
            yield batch_of()

    found = rows.mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ---- vectors and trees ----


def _place(c: int) -> int:
    return c - 97 if 97 <= c <= 122 else 26 + c - 0xC0 if 0xC0 <= c <= 0xFF else SHARED + c % (PLACES - SHARED)


def vectors(words: list[str]) -> np.ndarray:
    """How often each word has each letter; counts are exact, whatever a word's length."""
    longest = max(map(len, words), default=0)
    out = np.zeros((len(words), PLACES), np.int16 if longest < 1 << 14 else np.int32)
    for k, w in enumerate(words):
        for c, n in Counter(w).items():
            out[k, _place(ord(c))] += n
    return out


#: A tree is a leaf's number, or (place, threshold, left, right): counts up to the threshold are on the left.
Tree = int | tuple


def grow(points: np.ndarray, leaf: int) -> tuple[Tree, list[np.ndarray]]:
    """A k-d tree over points, and the points of each leaf; at most ``leaf`` in each, but for points that are all equal.

    The place that spreads most is split at its median.
    """
    leaves: list[np.ndarray] = []

    def build(own: np.ndarray) -> Tree:
        if len(own) > leaf:
            values = points[own]
            at = int(np.argmax(values.var(axis=0)))
            column = values[:, at]
            low, high = int(column.min()), int(column.max())
            if low < high:
                threshold = min(int(np.median(column)), high - 1)
                left = column <= threshold
                return at, threshold, build(own[left]), build(own[~left])
        leaves.append(own)
        return len(leaves) - 1

    return build(np.arange(len(points))), leaves


def touched(tree: Tree, points: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(leaf, points)``: the points whose box, ``up`` more and ``down`` fewer letters, reaches into each leaf."""
    n = len(points)
    stack = [(tree, np.arange(n), np.full(n, up), np.full(n, down))]
    while stack:
        node, own, more, less = stack.pop()
        if not len(own):
            continue
        if isinstance(node, int):
            yield node, own
            continue
        at, threshold, left, right = node
        x = points[own, at]
        inside, over, under = x <= threshold, (x == threshold) & (more > 0), (x == threshold + 1) & (less > 0)
        for side, keep, m, s in ((left, inside | under, more, less - under), (right, ~inside | over, more - over, less)):
            stack.append((side, own[keep], m[keep], s[keep]))


def _near_classes(tree: Tree, leaves: list[np.ndarray], data: np.ndarray, queries: np.ndarray, up: int, down: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(queries, data)``, arrays of pairs where the second has ``up`` letters more and ``down`` fewer than the first."""
    for leaf, own in touched(tree, queries, up, down):
        points = data[leaves[leaf]]
        step = max(1, AT_ONCE // max(1, points.size))
        for k in range(0, len(own), step):
            part = own[k : k + step]
            # both lengths are known, so as many letters are missing as must be if so many are added
            added = np.maximum(points[None, :, :] - queries[part][:, None, :], 0).sum(2)
            one, two = np.nonzero(added == up)
            yield part[one], leaves[leaf][two]


class Words:
    """Words of one length, their letters as numbers, and their classes of equal counts."""

    def __init__(self, words: list[str]):
        self.words = words
        size = len(words[0]) if words else 0
        self.letters = np.array(words, f"U{size}").view(np.uint32).reshape(len(words), size) if size else np.zeros((len(words), 0), np.uint32)
        self.classes, of = np.unique(vectors(words), axis=0, return_inverse=True)
        #: Words by class, and where each class begins.
        self.order = np.argsort(of.ravel(), kind="stable")
        self.sizes = np.bincount(of.ravel(), minlength=len(self.classes))
        self.begin = np.concatenate(([0], np.cumsum(self.sizes)[:-1])) if len(self.classes) else np.zeros(0, np.int64)

    def of(self, k: int) -> list[int]:
        """The words of a class."""
        return self.order[self.begin[k] : self.begin[k] + self.sizes[k]].tolist()


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of letters differ by one edit, ``b`` being as long as ``a``, or one longer."""
    size = a.shape[1]
    if size == b.shape[1]:
        return (a != b).sum(1) == 1
    front = np.logical_and.accumulate(a == b[:, :size], axis=1).sum(1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return front + back >= size


def _compared(one: Words, two: Words, qs: np.ndarray, ds: np.ndarray) -> Iterator[tuple[int, int]]:
    """The near words of pairs of classes, by comparing each word of the one with each of the other."""
    many = one.sizes[qs] * two.sizes[ds]
    ends = np.cumsum(many)
    at = 0
    while at < len(qs):
        # as many pairs of classes as are compared at once, one at least
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE // max(8, two.letters.shape[1]), "right")))
        q, d, n = qs[at:stop], ds[at:stop], many[at:stop]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(two.sizes[d], n)
        i = one.order[np.repeat(one.begin[q], n) + k // width]
        j = two.order[np.repeat(two.begin[d], n) + k % width]
        good = one_edit(one.letters[i], two.letters[j]) if one.letters.shape[1] <= two.letters.shape[1] else one_edit(two.letters[j], one.letters[i])
        yield from zip(i[good].tolist(), j[good].tolist(), strict=True)
        at = stop


def _holes(word: str, places: np.ndarray) -> Iterator[tuple[int, str]]:
    """The word less one of its letters with one of these places, with where it stood."""
    for k, c in enumerate(word):
        if places[_place(ord(c))]:
            yield k, word[:k] + word[k + 1 :]


def _met(one: Words, two: Words, q: int, d: int) -> Iterator[tuple[int, int]]:
    """The near words of two large classes, which meet by what is left of them without the letter that each has more.

    If both had one they must have had it at the same position. Classes that are equal can differ in letters that share
    a place.
    """
    apart = two.classes[d] - one.classes[q]
    more, fewer = apart < 0, apart > 0
    if not apart.any():
        more = fewer = (np.arange(PLACES) >= SHARED) & (one.classes[q] > 0)
    left = defaultdict(list)
    for i in one.of(q):
        for k, rest in _holes(one.words[i], more) if more.any() else [(-1, one.words[i])]:
            left[k if fewer.any() else -1, rest].append(i)
    for j in two.of(d):
        seen = set()
        for k, rest in _holes(two.words[j], fewer) if fewer.any() else [(-1, two.words[j])]:
            for i in left.get((k if more.any() else -1, rest), ()):
                if i not in seen and one.words[i] != two.words[j]:
                    seen.add(i)
                    yield i, j


class Block:
    """Words of one length with a k-d tree over their classes."""

    def __init__(self, words: list[str]):
        self.own = Words(words)
        self.tree, self.leaves = grow(self.own.classes, LEAF)

    def near(self, queries: list[str], longer: int) -> Iterator[tuple[int, int]]:
        """``(query, word)`` at one edit, where the block's words are ``longer`` by 0, 1 or -1; all queries have one length."""
        asked, own = Words(queries), self.own
        ways = [{0: (1, 1), 1: (1, 0), -1: (0, 1)}[longer]]
        # places that several code points share: a letter may be replaced there without a change of counts
        if longer == 0 and own.classes[:, SHARED:].any():
            ways.append((0, 0))
        for up, down in ways:
            for qs, ds in _near_classes(self.tree, self.leaves, own.classes, asked.classes, up, down):
                n, m = asked.sizes[qs], own.sizes[ds]
                few = n * m <= COMPARED * (n + m)
                yield from _compared(asked, own, qs[few], ds[few])
                for q, d in zip(qs[~few].tolist(), ds[~few].tolist(), strict=True):
                    yield from _met(asked, own, q, d)


# ---- dealing out ----


class Layout:
    """How the words of each length are split: the upper tree of a length, and into how many parts each of its leaves is dealt."""

    def __init__(self, sizes: dict[int, int], trees: dict[int, Tree], parts: dict[int, list[int]]):
        self.sizes, self.trees, self.parts = sizes, trees, parts

    def roles(self, length: int) -> list[tuple[int, int]]:
        """Where words of a length ask: the length that is asked, and how much longer its words are."""
        own = self.sizes.get(length, 0)
        out = [(length, 0)]
        if self.sizes.get(length + 1, 0) >= own:
            out.append((length + 1, 1))
        if self.sizes.get(length - 1, 0) > own:
            out.append((length - 1, -1))
        return [x for x in out if x[0] in self.sizes]

    def at(self, words: list[str]) -> Iterator[tuple[int, int, int, int, str]]:
        """``(length, leaf, part, kind, word)``: each word where it is held (kind 2), and where it asks (kind: how much longer)."""
        by_length = defaultdict(list)
        for w in words:
            by_length[len(w)].append(w)
        for length, own in by_length.items():
            points = vectors(own)
            for leaf, at in touched(self.trees.get(length, 0), points, 0, 0):
                n = self.parts.get(length, [1])[leaf]
                for k in at.tolist():
                    yield length, leaf, zlib.crc32(own[k].encode("utf-8", "surrogatepass")) % n, 2, own[k]
            for other, longer in self.roles(length):
                up, down = {0: (1, 1), 1: (1, 0), -1: (0, 1)}[longer]
                for leaf, at in touched(self.trees.get(other, 0), points, up, down):
                    for part in range(self.parts.get(other, [1])[leaf]):
                        for k in at.tolist():
                            yield other, leaf, part, longer, own[k]


def layout(words: DataFrame) -> Layout:
    """The layout of ``(word, n)``: lengths with more than a block of letters are split by a tree over a look at their words.

    The look decides how even the blocks are, never which words are found near. It has ``LOOKED_AT`` words for each
    block, so what reaches the driver is a small fixed share of the words, and nothing of lengths that fill one block.
    """
    lengths = words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n"))
    sizes = {r["length"]: r["n"] for r in lengths.collect()}
    large = {k: -(-k * n // BLOCK) for k, n in sizes.items() if k * n > BLOCK}
    trees: dict[int, Tree] = {}
    parts: dict[int, list[int]] = {}
    if large:
        wanted = F.create_map(*[F.lit(x) for k, n in large.items() for x in (k, min(1.0, n * LOOKED_AT / sizes[k]))])
        share = F.coalesce(F.try_element_at(wanted, F.length("word")), F.lit(0.0))
        look = words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < share * (1 << 20)).select("word").collect()
        by_length = defaultdict(list)
        for r in look:
            by_length[len(r["word"])].append(r["word"])
        for length, own in by_length.items():
            tree, leaves = grow(vectors(own), LOOKED_AT)
            trees[length] = tree
            # a leaf that could not be split further has anagrams only
            parts[length] = [max(1, len(x) // LOOKED_AT) for x in leaves]
    return Layout(sizes, trees, parts)


#: A word's near words as far as one task has seen them: how many, and the one that occurs most, the smallest of equals.
NEAR = "word string, m long, best_n long, best string"


def near_words(words: DataFrame, scratch: Scratch) -> DataFrame:
    """``(word, m, best_n, best)`` for each of ``(word, n)`` that has near words: how many, and the most frequent (ties: the smallest)."""
    plan = words.sparkSession.sparkContext.broadcast(layout(words))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["length", "leaf", "part", "kind", "word", "n"]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64())
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                cut = batch.slice(k, 2000)
                n_of = dict(zip(cut.column("word").to_pylist(), cut.column("n").to_pylist(), strict=True))
                rows = [(*x, n_of[x[4]]) for x in plan.value.at(list(n_of))]
                columns = list(zip(*rows, strict=True)) if rows else [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    def search(group: pa.Table) -> pa.Table:
        kind, words, n = (group[c].to_pylist() for c in ("kind", "word", "n"))
        n_of, own = dict(zip(words, n, strict=True)), sorted({w for w, k in zip(words, kind, strict=True) if k == 2})
        block, found = Block(own), {}

        def meet(word: str, other: str) -> None:
            m, best_n, best = found.get(word, (0, -1, ""))
            x = n_of[other]
            found[word] = (m + 1, *((x, other) if x > best_n or x == best_n and other < best else (best_n, best)))

        for longer in (0, 1, -1):
            asked = sorted({w for w, k in zip(words, kind, strict=True) if k == longer})
            for i, j in block.near(asked, longer) if asked else ():
                meet(asked[i], own[j])
                if longer:  # of the same length the other word asks itself
                    meet(own[j], asked[i])
        columns = ([*found], *([x[k] for x in found.values()] for k in range(3)))
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["word", "m", "best_n", "best"])

    dealt = words.mapInArrow(deal, "length int, leaf int, part int, kind int, word string, n long")
    some = dealt.groupBy("length", "leaf", "part").applyInArrow(search, NEAR)
    # the largest n first, then the smallest word: the best row is the least of these
    order = F.struct((-F.col("best_n")).alias("less"), "best")
    out = some.groupBy("word").agg(F.sum("m").alias("m"), F.min(order).alias("o"))
    return scratch.written(out.select("word", "m", (-F.col("o.less")).alias("best_n"), F.col("o.best").alias("best")))


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of each of ``(word, n)``.

    Near words differ by exactly one inserted, deleted or replaced code point. A word's form is its near word with the
    largest n, the smallest in code-point order among equals, if that is at least ``times`` its own; the root is the last
    when forms are followed, the word itself without a form. Null words go; of repeated words one row counts. An empty
    table gives an empty result.
    """
    with Scratch(words.sparkSession) as scratch:
        words = scratch.written(words.where("word IS NOT NULL").groupBy("word").agg(F.max("n").alias("n")))
        near = near_words(words, scratch)
        found = words.join(near, "word", "left")
        has = F.col("best_n") >= F.lit(times) * F.col("n")
        found = found.select("word", "n", F.coalesce("m", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n"))
        found = scratch.written(found)
        # chains are short, since n at least doubles at each step; they are followed by doubling
        links = scratch.written(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
        while True:
            onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
            grown = scratch.written(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
            if grown.where("moved").isEmpty():
                break
            links = grown.select("word", "root")
        return written(found.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def with_roots(found: DataFrame, words: DataFrame, word: str = "word") -> DataFrame:
    """``words`` with ``root``: the root that ``variants`` found for each, or the word itself; null stays null."""
    key, root = spare(words, "_key", "_root")
    roots = found.where("form IS NOT NULL").select(F.col("word").alias(key), F.col("root").alias(root))
    out = words.join(roots, named(word) == named(key), "left").withColumn("root", F.coalesce(named(root), named(word)))
    return out.drop(key, root)


def op11_spelling(spark, sf_dir: str) -> DataFrame:
    """The spelling variants among the words of all documents."""
    return variants(word_counts(table(spark, sf_dir, "documents")))


#: DuckDB: words by the rule; near pairs by what is left of two words when one letter is taken out.
ORACLE = rf"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL
), hashed AS (
  SELECT run, n, {_crc_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs, crc_table
), counted AS (
  SELECT CASE WHEN h % {ONE_IN} = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, sum(n) AS n FROM hashed GROUP BY 1
), w AS (
  SELECT word, CAST(n AS BIGINT) AS n FROM counted WHERE length(word) >= {LEAST_LENGTH} AND n >= {LEAST_COUNT}
), holes AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM w, unnest(range(1, length(word) + 1)) AS t(i)
), near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN w b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, {{'a': -m, 'b': encode(other)}}) AS other, max(m) AS m FROM near GROUP BY word
), formed AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {TIMES} * n THEN other END AS form, CASE WHEN m >= {TIMES} * n THEN m END AS form_n FROM w LEFT JOIN best USING (word)
), followed AS (
  SELECT word, word AS root, 0 AS k FROM formed UNION ALL SELECT f.word, g.form, k + 1 FROM followed f JOIN formed g ON g.word = f.root WHERE g.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, arg_max(root, k) AS root FROM followed GROUP BY word) USING (word)
"""
