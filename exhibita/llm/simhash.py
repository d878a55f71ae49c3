"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position of a 64-bit fingerprint gets a non-zero 3-bit vector. For each of the seven non-zero 3-bit
vectors v, table v looks at the positions whose vector has an odd product with v. Two positions always leave some
v with even products to both, so two fingerprints at 2 or fewer differing bits agree on the whole mask of some
table: every such pair collides. Fingerprints that collide nowhere are alone.

A table keeps 36 bits, which chance alone makes equal once there are billions of fingerprints. So a bucket with
several fingerprints is split by the same seven masks over the bits that are left: what differs inside it lies there,
and the guarantee holds again. After ``LEVELS`` of this six bits are left, a bucket has ``2 ** 6`` fingerprints at
most, and the ones in it at 2 or fewer differing bits are linked. Only fingerprints that still share a bucket go on.

``keep_one_of_each`` finds near copies in the usual sense, by a share of equal five-word shingles. Fingerprints propose
first, each text with its component's representative; an exact prefix join on the shingles then finds every pair that no
radius holds, see ``copy_links``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, named, spare, table, with_made, without, written
from .components import connected_components

SHINGLE = 3
RADIUS = 2
#: How often buckets are split, and the bits that may be left then at most: a bucket has no more fingerprints than these can tell apart.
LEVELS, MOST_LEFT = 3, 6
SEED = 42
#: For near copies: words in a shingle, and least share of equal shingles.
COPY_SHINGLE, COPY_SHARE = 5, 0.8
#: Pairs of one text that are judged in one group.
HUB = 1000
#: Members of a bucket that the others are held against first.
PIVOTS = 3
#: One text in ``ORDER_ONE_IN`` is read for the order of shingles; those seen ``ORDER_LEAST`` times, ``ORDER_MOST`` at
#: most, come last. The order decides how many candidates there are, never which pairs are found.
ORDER_ONE_IN, ORDER_LEAST, ORDER_MOST = 16, 3, 200_000
#: Different texts with one 64-bit hash that are told apart at most; of 1e12 texts some 30,000 would be.
MOST_SHARED = 100_000
#: Nodes, shingles or rows' keys that are broadcast at most, 8 or 16 bytes each; beyond that they are joined like any table.
BROADCAST_NODES = 1 << 21
#: Shingles whose hashes are held at once.
PIECE = 1 << 16
#: Texts whose shingles a worker holds at once.
ROWS = 256
#: Fixed odd multipliers that make a shingle's hash of its words' hashes.
BASE, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93

#: A-Z to a-z; everything else stays.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a UTF-8 text's word shingles, unsigned; zero where there are no words."""
    found = text.translate(_LOWER).split() if text else []
    if not found:
        return 0
    n = max(1, len(found) - shingle + 1)
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[min(shingle, len(found)) - 1 :]
    votes, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for k in range(0, n, PIECE):
        cut = zip(starts[k : min(n, k + PIECE)].tolist(), last[k : k + PIECE].tolist(), strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in cut], ">u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def shingle_hashes(text: bytes | None, shingle: int = COPY_SHINGLE) -> np.ndarray:
    """The hashes of all distinct shingles of a text, in order; one zero where there are no words."""
    found = text.translate(_LOWER).split() if text else []
    if not found:
        return np.zeros(1, np.uint64)
    digest, size = xxhash.xxh64_intdigest, min(shingle, len(found))
    words = np.array([digest(w, SEED) for w in found], np.uint64)
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = out * np.uint64(BASE) + words[k : k + n]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(MIX)
    return np.unique(out ^ (out >> np.uint64(29)))


def covering_masks(positions: list[int] | range = range(64), radius: int = RADIUS) -> list[int]:
    """The ``2 ** (radius + 1) - 1`` masks over some bit positions, unsigned."""
    size = 1 << (radius + 1)
    at = {p: 1 + i % (size - 1) for i, p in enumerate(positions)}
    return [sum(1 << p for p in positions if (at[p] & v).bit_count() % 2) for v in range(1, size)]


def split_masks(levels: int, radius: int = RADIUS) -> list[list[list[int]]]:
    """For each level and each table of the level before, the masks that split its buckets: all bits kept so far."""
    out, whole = [], [0]
    for _ in range(levels):
        out.append([[m | n for n in covering_masks([p for p in range(64) if not m >> p & 1], radius)] for m in whole])
        whole = [m for masks in out[-1] for m in masks]
    return out


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``fp``, the SimHash as a signed long. Null and empty texts get 0."""
    base = without(docs, "fp")
    kept = [c for c in base.columns if keep is None or c in keep]

    def score(texts: pa.Array) -> list[np.ndarray]:
        return [np.array([fingerprint(x.as_py()) for x in texts], np.uint64).view(np.int64)]

    return with_made(base, kept, [named(text).cast("binary")], {"fp": T.LongType()}, lambda: score)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(distinct_fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``(u, v)`` between the distinct fingerprints ``fp`` at up to ``radius`` differing bits.

    All that share a bucket at the last level are linked there; a pair may come from several tables but is given
    once. No bucket is gathered before it is bounded by the bits that are left.
    """
    found = distinct_fps.select("fp", F.lit(0).alias("t"))
    for level in split_masks(LEVELS, radius):
        masks = F.array(*[F.array(*[F.lit(_signed(m)).cast("long") for m in own]) for own in level])
        tables = found.select("fp", "t", F.posexplode(F.element_at(masks, F.col("t") + 1)).alias("v", "mask"))
        tables = tables.select("fp", (F.col("t") * len(level[0]) + F.col("v")).alias("t"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
        shared = tables.groupBy("t", "key").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a <> b")
        found = written(tables.join(shared.select("t", "key"), ["t", "key"], "left_semi"))
    left = 64 - min(m.bit_count() for own in level for m in own)
    if left > MOST_LEFT:
        raise ValueError(f"{left} bits are left after {LEVELS} levels; a bucket could hold 2 ** {left} fingerprints")
    buckets = found.groupBy("t", "key").agg(F.collect_list("fp").alias("fps"))
    near = F.transform("fps", lambda u: F.struct(u.alias("u"), F.filter("fps", lambda v: (v < u) & (F.bit_count(u.bitwiseXOR(v)) <= radius)).alias("vs")))
    rows = buckets.select(F.explode(near).alias("x")).select(F.col("x.u").alias("u"), F.explode("x.vs").alias("v"))
    return rows.distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fp, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest key that can be reached over links of 2 or fewer differing bits. Texts
    without words share fingerprint zero and are linked like any others; long texts are hashed whole. Repeated rows
    keep one row each; a null key counts only where no other key is in the component. An empty table gives an empty
    result. Other input columns, whatever their names, are left out.
    """
    rows = docs.select(named(key).alias("_key"), named(text).alias("_text"))
    fps = written(fingerprints(rows, "_text", ["_key"]))
    # equal fingerprints are one node, so copies cost nothing further on
    classes = fps.groupBy("fp").agg(F.min("_key").alias("low"))
    roots = connected_components(links(classes.select("fp")))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "low", F.coalesce("root", "fp").alias("root"))
    low = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    own = rooted.join(low, "root").select("fp", "component_id")
    return fps.join(own, "fp").select(F.col("_key").alias(key), "fp", "component_id")


def _sets(texts: DataFrame) -> DataFrame:
    """``(node, h)``: all distinct shingles of each node of ``(node, text)``, once for each task that reads its text."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in _slices(batches):
            nodes, found = [], []
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text"), strict=True):
                if node not in seen:
                    seen.add(node)
                    nodes.append(node)
                    found.append(shingle_hashes(text.as_py()).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["node", "h"])

    return texts.mapInArrow(gather, "node long, h array<long>")


def _common(texts: DataFrame) -> np.ndarray:
    """The shingles that are frequent in a sample of ``(node, text)``, frequent ones last."""
    sample = _sets(texts.where(F.pmod("node", F.lit(ORDER_ONE_IN)) == 0).dropDuplicates(["node"]))
    seen = sample.select(F.explode("h").alias("x")).groupBy("x").agg(F.count("*").alias("n"))
    rows = seen.where(F.col("n") >= ORDER_LEAST).orderBy(F.desc("n"), "x").limit(ORDER_MOST).collect()
    return np.array([r["x"] for r in reversed(rows)], np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``ROWS`` rows, so that a worker holds little at once."""
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            yield batch.slice(k, ROWS)


def prefixes(texts: DataFrame, share: float = COPY_SHARE) -> DataFrame:
    """``(node, n, cold, tokens)``: the first shingles of each row of ``(node, text)``, rare ones first.

    Two sets with ``share`` of their union in common have one of these in common: all orders are the same, and a
    set of n must share ``share * n`` with the other. ``n`` is the size, ``cold`` how many in the prefix are rare.
    """
    common = _common(texts)
    by_value = np.argsort(common)
    values = common[by_value]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sizes, colds, firsts = [], [], []
            for x in batch.column("text"):
                h = shingle_hashes(x.as_py()).view(np.int64)
                n = len(h)
                rank = np.full(n, -1)
                if len(values):
                    at = np.minimum(np.searchsorted(values, h), len(values) - 1)
                    rank = np.where(values[at] == h, by_value[at], -1)
                first = np.lexsort((h, rank))[: n - math.ceil(share * n - 1e-9) + 1]
                sizes.append(n)
                colds.append(int((rank[first] < 0).sum()))
                firsts.append(h[first])
            columns = [batch.column("node"), pa.array(sizes, pa.int32()), pa.array(colds, pa.int32()), pa.array(firsts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "cold", "tokens"])

    return texts.mapInArrow(cut, "node long, n int, cold int, tokens array<long>")


def _shared_tokens(texts: DataFrame, scratch: Scratch, share: float) -> DataFrame:
    """``(token, node, n, at, cold, indexed)``: the prefix shingles that can make a pair, once for each node, and their places.

    A shingle can only do so if it stands in two rows and is indexed in one of them. Most stand in one alone, so they are
    counted by themselves first; only the rows of the others move with their nodes.
    """
    rows = scratch.written(prefixes(texts, share))
    every = rows.select(F.posexplode("tokens").alias("at", "token"), "node", "n", "cold").withColumn("indexed", _indexed(share))
    seen = every.groupBy("token").agg(F.count("*").alias("rows"), F.max("indexed").alias("some")).where("rows > 1 and some")
    seen = scratch.written(seen.select("token"))
    if seen.count() <= BROADCAST_NODES:
        seen = F.broadcast(seen)
    once = every.join(seen, "token", "left_semi").groupBy("token", "node")
    return scratch.written(once.agg(*(F.min(x).alias(x) for x in ("n", "at", "cold", "indexed"))))


def _possible(a: str, b: str, share: float) -> Column:
    """Whether sets of these sizes that have their first common shingle at these places can share enough."""
    n, m, i, j = (F.col(x) for x in (f"{a}.n", f"{b}.n", f"{a}.at", f"{b}.at"))
    return F.least(n - i, m - j) >= share / (1 + share) * (n + m) - 1e-6


def _indexed(share: float) -> Column:
    """Whether a prefix shingle at place ``at`` of a set of ``n`` can be the first that it has in common with a set as large or larger.

    Such a pair shares ``2 * share / (1 + share)`` of the smaller set, so its first common shingle comes early in that.
    """
    return F.col("at") <= F.col("n") - F.ceil(F.col("n") * (2 * share / (1 + share)) - 1e-9)


def _size_class(n: Column, share: float) -> Column:
    """Sizes by powers of ``1 / share``; never falling as ``n`` grows."""
    return F.floor(F.log(n.cast("double")) / -math.log(share)).cast("int")


def _within(few: DataFrame, every: DataFrame, share: float) -> DataFrame:
    """Pairs ``a`` of ``every`` and ``b`` of ``few`` in one bucket, of different components, of which one is indexed and no larger.

    Both have ``token``; the members are structs. They meet by bucket and size class, so sizes that no bound allows do
    not meet at all.
    """
    low, high = F.ceil(F.col("b.n") * share - 1e-9), F.floor(F.col("b.n") / share + 1e-9)
    asked = few.withColumn("class", F.explode(F.sequence(_size_class(F.greatest(low, F.lit(1)), share), _size_class(high, share))))
    held = every.withColumn("class", _size_class(F.col("a.n"), share))
    apart = F.expr("a.root <> b.root and (a.root = main or a.node < b.node)")
    indexed = asked.where("b.indexed").join(held, ["token", "class"]).where(apart & F.expr("b.n <= a.n"))
    probing = asked.join(held.where("a.indexed"), ["token", "class"]).where(apart & F.expr("a.n <= b.n"))
    return indexed.select("a", "b").union(probing.select("a", "b"))


def _represented(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, rep)`` for the nodes ``(node, text)`` of SimHash components that hold several: the smallest node of each."""
    fps = scratch.written(fingerprints(texts, "text", ["node"]).distinct())
    roots = connected_components(links(fps.select("fp").distinct())).withColumnRenamed("node", "fp")
    rooted = fps.join(roots, "fp", "left").select("node", F.coalesce("root", "fp").alias("root"))
    low = rooted.groupBy("root").agg(F.min("node").alias("rep"), F.count("*").alias("n")).where("n > 1")
    return rooted.join(low, "root").select("node", "rep")


def _proposed(tokens: DataFrame, texts: DataFrame, scratch: Scratch, share: float) -> DataFrame:
    """Pairs ``(u, v)`` of a node and the representative of its SimHash component, less those that sizes and places rule out."""
    own = tokens.join(_represented(texts, scratch), "node").select("token", "rep", F.struct("node", "n", "at", "indexed").alias("a"))
    heads = own.where("a.node = rep").withColumnRenamed("a", "b")
    both = own.where("a.node <> rep").join(heads, ["token", "rep"]).where("a.indexed or b.indexed").where(_possible("a", "b", share))
    return both.select(F.greatest("a.node", "b.node").alias("u"), F.least("a.node", "b.node").alias("v")).distinct()


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Those of the pairs ``(u, v)`` that are not in one of the components ``(node, root)``."""
    if found.count() <= BROADCAST_NODES:
        found = F.broadcast(found)
    rows = pairs.join(found.select(F.col("node").alias("u"), F.col("root").alias("a")), "u", "left")
    rows = rows.join(found.select(F.col("node").alias("v"), F.col("root").alias("b")), "v", "left")
    return rows.where("a is null or b is null or a <> b").select("u", "v")


def copy_links(texts: DataFrame, scratch: Scratch, share: float = COPY_SHARE) -> DataFrame:
    """Edges ``(u, v)`` between nodes ``(node, text)`` whose sets of shingles share ``share`` of their union.

    SimHash comes first: a node is judged against the representative of its component, and what that has linked needs no
    pairs any more. The exact join follows for all others. The nodes that have a prefix shingle in common are a bucket. First they are held against ``PIVOTS`` of them: the
    ones with fewest rare shingles, which in a group around one text is that text. No bucket is gathered or paired
    up in this. Then what that has linked is one component, and the nodes outside their bucket's main component are
    held against those of the bucket that are not in theirs, see ``_within``: of a pair the smaller set must have the
    shingle in its shorter, indexed prefix. A bucket that no member has there, such as that of a template's shingle in
    texts that differ too much besides, has no pairs at all. So every pair is settled: judged, ruled out by sizes and
    places, or already in one component. The result can be read while ``scratch`` is open.
    """
    # texts and sets are read again rather than kept: they would be most of the disk
    tokens = _shared_tokens(texts, scratch, share)
    same = scratch.written(judged(scratch.written(_proposed(tokens, texts, scratch, share)), texts, scratch, share))
    own = F.struct("node", "n", "at", "indexed")
    # one order for all buckets: those of a large group then agree on their pivots
    picks = [F.min_by(own, F.struct(F.col("cold") / F.col("n"), F.xxhash64("node", F.lit(k)))) for k in range(PIVOTS)]
    pivots = tokens.groupBy("token").agg(F.count("*").alias("size"), F.array_distinct(F.array(*picks)).alias("pivots"), F.max("indexed").alias("some")).where("size > 1 and some")
    shared = scratch.written(tokens.join(pivots, "token").select("token", "node", "n", "at", "indexed", "pivots"))
    first = shared.select(own.alias("a"), F.explode("pivots").alias("b")).where("a.node <> b.node")
    first = first.where(_possible("a", "b", share))
    first = first.select(F.greatest("a.node", "b.node").alias("u"), F.least("a.node", "b.node").alias("v")).distinct()
    first = scratch.written(_apart(first, connected_components(same)))
    links = scratch.written(same.union(judged(first, texts, scratch, share)))
    found = connected_components(links)
    roots = shared.join(found, "node", "left").select(F.struct("node", "n", "at", "indexed", F.coalesce("root", "node").alias("root")).alias("a"), "token", F.col("pivots")[0]["node"].alias("p"))
    roots = roots.join(found.select(F.col("node").alias("p"), F.col("root").alias("main")), "p", "left").select("token", "a", F.coalesce("main", "p").alias("main"))
    few = roots.where("a.root <> main").select("token", F.col("a").alias("b"), "main")
    rest = _within(few, roots.select("token", "a"), share).where(_possible("a", "b", share))
    rest = rest.select(F.greatest("a.node", "b.node").alias("u"), F.least("a.node", "b.node").alias("v")).distinct()
    rest = scratch.written(rest.join(first, ["u", "v"], "left_anti"))
    return links.union(judged(rest, texts, scratch, share))


def judged(pairs: DataFrame, texts: DataFrame, scratch: Scratch, share: float = COPY_SHARE) -> DataFrame:
    """Those of the pairs ``(u, v)`` whose texts ``(node, text)`` have, of all distinct shingles, ``share`` of their union in common.

    Texts do not move. Their sets do once: that of ``u`` for each pair, that of ``v`` for each group of some ``HUB`` of its
    pairs, where it comes first, so that a task holds one set and streams the others.
    """
    groups = F.ceil(F.count("*") / HUB).alias("groups")
    asked = pairs.join(pairs.groupBy("v").agg(groups), "v").select("u", "v", F.pmod(F.xxhash64("u"), "groups").alias("part"))
    sent = asked.select(F.col("v").alias("node"), "v", "part", F.lit(False).alias("other")).distinct()
    sent = scratch.written(sent.union(asked.select(F.col("u").alias("node"), "v", "part", F.lit(True))))
    wanted = sent.select("node").distinct()
    if sent.count() <= BROADCAST_NODES:
        sent, wanted = F.broadcast(sent), F.broadcast(wanted)
    sets = _sets(texts.join(wanted, "node", "left_semi")).join(sent, "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, base, last = None, None, None
        for batch in batches:
            near: list[tuple[int, int]] = []
            sets, v, part, other, node = batch.column("h"), *(batch.column(c).to_pylist() for c in ("v", "part", "other", "node"))
            for k in range(batch.num_rows):
                # rows of texts that stand in several tasks repeat
                if (v[k], part[k], node[k]) == last:
                    continue
                last = (v[k], part[k], node[k])
                own = sets[k].values.to_numpy().view(np.uint64)
                if not other[k]:
                    at, base = (v[k], part[k]), own.copy()
                    continue
                if at != (v[k], part[k]):
                    raise ValueError("a text of a pair is missing")
                place = np.minimum(np.searchsorted(base, own), len(base) - 1)
                equal = int((base[place] == own).sum())
                if equal >= share * (len(base) + len(own) - equal):
                    near.append((node[k], v[k]))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in near], pa.int64()) for i in (0, 1)], names=["u", "v"])

    rows = sets.select("v", "part", "other", "node", "h").repartition("v", "part").sortWithinPartitions("v", "part", "other", "node")
    return rows.mapInArrow(compare, "u long, v long")


def _nodes(text: Column, docs: DataFrame) -> Column:
    """A long for each different text; null and empty texts are equal.

    It is the text's hash, or where different texts share that (their MD5 tells), a hash of the MD5.
    """
    own = F.coalesce(text, F.lit("")).cast("binary")
    node, digest = F.xxhash64(own), F.md5(own)
    hashed = docs.select(node.alias("node"), digest.alias("digest")).groupBy("node").agg(F.min("digest").alias("a"), F.max("digest").alias("b"))
    shared = [r[0] for r in hashed.where("a <> b").select("node").limit(MOST_SHARED + 1).collect()]
    if len(shared) > MOST_SHARED:
        raise ValueError("too many different texts have one hash")
    return F.when(node.isin(shared), F.xxhash64(digest)).otherwise(node) if shared else node


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts and near copies: the one with the smallest key.

    Near copies share at least ``COPY_SHARE`` of all their distinct five-word shingles; groups are the components
    over such links. Null and empty texts are equal; long texts count whole. Rows without a key cannot be told apart
    and are kept. Where rows with different texts share the smallest key, the one with the lowest hash stays; of
    repeated rows one stays. An empty table stays empty. All columns are kept as they are, whatever their names.
    """
    # the digest of the whole row tells rows with one key apart
    digest, node, rows = spare(docs, "_digest", "_node", "_rows")
    whole = docs.where(named(key).isNotNull())
    whole = whole.withColumn(digest, F.xxhash64(*map(named, docs.columns))).withColumn(node, _nodes(named(text), whole))
    nodes = whole.groupBy(named(node).alias("node")).agg(F.min(F.struct(named(key).alias("k"), named(digest).alias("d"))).alias("low"))
    texts = whole.select(named(node).alias("node"), named(text).cast("binary").alias("text"))
    with Scratch(docs.sparkSession) as scratch:
        nodes = scratch.written(nodes)
        roots = connected_components(copy_links(texts, scratch))
        best = nodes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("low").alias("b"))
        best = written(best.select(F.col("b.k").alias(key), F.col("b.d").alias(digest)))
    own = [named(key), named(digest)]
    if isinstance(docs.schema[key].dataType, T.IntegralType) and best.count() <= BROADCAST_NODES:
        # only rows that repeat need to meet: no other text moves
        chosen = whole.join(F.broadcast(best), [key, digest], "left_semi")
        again = F.broadcast(written(chosen.groupBy(*own).agg(F.count("*").alias(rows)).where(named(rows) > 1).select(*own)))
        one = chosen.join(again, [key, digest], "left_anti").union(chosen.join(again, [key, digest], "left_semi").dropDuplicates([key, digest]))
    else:
        # the join has dealt the rows out by the columns that repeated rows agree on
        one = whole.join(best, [key, digest], "left_semi").dropDuplicates([key, digest])
    return one.select(*map(named, docs.columns)).union(docs.where(named(key).isNull()))


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# fixed values: the primes of XXH64
_PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
_WIDE = "CAST(18446744073709551616 AS UHUGEINT)"


def _whole(x: int | str) -> str:
    return f"CAST({x} AS UHUGEINT)"


def _times(x: str, n: int) -> str:
    return f"(({x}) * {_whole(n)} % {_WIDE})"


def _plus(x: str, n: int | str) -> str:
    return f"((({x}) + {_whole(n)}) % {_WIDE})"


def _turned(x: str, n: int) -> str:
    return f"(({x}) * {_whole(1 << n)} % {_WIDE} + ({x}) // {_whole(1 << 64 - n)})"


def _round(acc: str, lane: str) -> str:
    return _times(_turned(f"(({acc}) + {_times(lane, _PRIMES[1])}) % {_WIDE}", 31), _PRIMES[0])


def _lanes(first: str, count: str, step: int = 8, size: int = 8) -> str:
    """DuckDB SQL: little-endian numbers of ``size`` bytes from a list ``b``."""
    one = " + ".join(f"CAST(b[{first} + {step} * i + {j + 1}] AS UHUGEINT) * {_whole(1 << 8 * j)}" for j in range(size))
    return f"list_transform(range({count}), lambda i: {one})"


def _reduced(start: str, items: str, step: str) -> str:
    return f"list_reduce(list_concat([{start}], {items}), lambda h, x: {step})"


def _oracle() -> str:
    """DuckDB SQL of op6: XXH64 of every shingle, majorities by bit, links by comparing all fingerprints."""
    p1, p2, p3, p4, p5 = _PRIMES
    begin = [SEED + p1 + p2, SEED + p2, SEED, SEED - p1]
    stripes = ", ".join(f"{_reduced(_whole(v % (1 << 64)), _lanes(str(8 * k), 'n // 32', 32), _round('h', 'x'))} AS v{k}" for k, v in enumerate(begin))
    mixed = " + ".join(_turned(f"v{k}", r) for k, r in enumerate((1, 7, 12, 18)))
    for k in range(4):
        mixed = _reduced(f"({mixed}) % {_WIDE}", f"[{_round(_whole(0), f'v{k}')}]", _plus(_times("xor(h, x)", p1), p4))
    eight = _plus(_times(_turned(f"xor(h, {_round(_whole(0), 'x')})", 27), p1), p4)
    four = _plus(_times(_turned(f"xor(h, {_times('x', p1)})", 23), p2), p3)
    byte = _times(_turned(f"xor(h, {_times('x', p5)})", 11), p1)
    final = _reduced("h", f"[{_whole(p2)}, {_whole(p3)}, {_whole(1)}]", f"CASE WHEN x = {_whole(p2)} THEN xor(h, h // {_whole(1 << 33)}) * x % {_WIDE} WHEN x = {_whole(p3)} THEN xor(h, h // {_whole(1 << 29)}) * x % {_WIDE} ELSE xor(h, h // {_whole(1 << 32)}) END")
    bits = " + ".join(f"CASE WHEN 2 * sum(CAST(h // {_whole(1 << k)} % 2 AS BIGINT)) > count(*) THEN {_whole(1 << k)} ELSE {_whole(0)} END" for k in range(64))
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS words FROM documents
), s AS (
  SELECT doc_id, array_to_string(words[i:i + {SHINGLE - 1}], ' ') AS shingle FROM w, unnest(range(1, greatest(2, len(words) - {SHINGLE - 2}))) AS t(i) WHERE len(words) > 0
), d AS (
  SELECT shingle, list_transform(regexp_extract_all(hex(encode(shingle)), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS b FROM (SELECT DISTINCT shingle FROM s)
), sized AS (SELECT *, len(b) AS n FROM d
), striped AS (SELECT *, {stripes} FROM sized
), started AS (SELECT shingle, b, n, ((CASE WHEN n >= 32 THEN {mixed} ELSE {_whole(SEED + p5)} END) + CAST(n AS UHUGEINT)) % {_WIDE} AS h FROM striped
), lanes8 AS (SELECT shingle, b, n, {_reduced('h', _lanes('32 * (n // 32)', 'n % 32 // 8'), eight)} AS h FROM started
), lanes4 AS (SELECT shingle, b, n, {_reduced('h', _lanes('8 * (n // 8)', 'n % 8 // 4', 4, 4), four)} AS h FROM lanes8
), lanes1 AS (SELECT shingle, {_reduced('h', _lanes('4 * (n // 4)', 'n % 4', 1, 1), byte)} AS h FROM lanes4
), hashed AS (SELECT shingle, {final} AS h FROM lanes1
), prints AS (
  SELECT w.doc_id, coalesce(fp, 0) AS fp FROM w LEFT JOIN (SELECT doc_id, CAST({bits} AS UBIGINT) AS fp FROM s JOIN hashed USING (shingle) GROUP BY doc_id) USING (doc_id)
), different AS (SELECT fp, min(doc_id) AS low FROM prints GROUP BY fp
), links AS (
  SELECT a.fp AS u, b.fp AS v FROM different a, different b WHERE bit_count(CAST(xor(a.fp, b.fp) AS HUGEINT)) <= {RADIUS}
), reached AS (SELECT fp AS u, fp AS v FROM different UNION SELECT r.u, l.v FROM reached r JOIN links l ON r.v = l.u
), components AS (SELECT r.u AS fp, min(low) AS component_id FROM reached r JOIN different d ON r.v = d.fp GROUP BY r.u
)
SELECT doc_id, lower(lpad(hex(CAST(fp AS UBIGINT)), 16, '0')) AS fingerprint, component_id FROM prints JOIN components USING (fp)
"""


ORACLE = _oracle()
