"""Toxicity, SimHash, decontamination, mixing and sharding against brute force and on edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from exhibita.llm import decontaminate, mixing, sharding, simhash, toxicity
from exhibita.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


# ---- decontamination ----


def brute_windows(texts, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    out = {}
    for i, t in texts:
        w, hit, found = words(t), set(), set()
        for item, b in items:
            b = words(b)
            n = min(window, len(b))
            for k in range(len(b) - n + 1) if b else ():
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == b[k : k + n]:
                        hit.update(range(j, j + n))
                        found.add(str(item))
        ids = ",".join(sorted(found))
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit))
    return out


BENCH = [(1, "one two three four five six seven eight nine ten eleven twelve"), (10, "Short Item"), (2, None), (3, ""), (4, "- -"), (5, "é漢 x1"), (6, "short item")]
TEXTS = [
    (1, "a ONE two,three four five six seven eight nine ten b"),
    (2, "two three four five six seven eight nine ten eleven twelve and one two three"),
    (3, "nothing here"),
    (4, None),
    (5, ""),
    (6, "the short. item! and É漢 x1, é漢-x1"),
    (7, "short " * 3000 + "item " * 3000),
]


@pytest.mark.parametrize("window", [1, 3, 10])
def test_parts_have_the_windows_of_their_item(window):
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 9, 10, 11, 200):
        own = [f"w{k}" * int(rng.integers(1, 9)) for k in rng.integers(0, 50, n)]
        text = ", ".join(own).encode()
        whole = {tuple(own[k : k + min(window, n)]) for k in range(n - min(window, n) + 1)} if n else set()
        for size in (1, 30, 300):
            cut = [p.decode().split() for p in decontaminate.parts(text, window, size)]
            assert {tuple(p[k : k + min(window, n)]) for p in cut for k in range(len(p) - min(window, n) + 1)} == whole


def test_no_block_is_over_its_bound(spark, monkeypatch):
    sizes, real = [], decontaminate.Windows.__init__

    def begin(self, items, window=10):
        sizes.append(sum(len(t) for _, t in items))
        real(self, items, window)

    monkeypatch.setattr(decontaminate.Windows, "__init__", begin)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 10_000)
    monkeypatch.setattr(decontaminate, "PART_BYTES", 1000)
    long = [f"long{k}" for k in range(20_000)]
    bench = [(1, " ".join(long))] + [(2 + k, " ".join(f"b{k}w{j}" for j in range(20))) for k in range(300)]
    texts = [(0, " ".join(long[7000:7015])), (1, " ".join(f"b{k}w{j}" for k in (3, 4) for j in range(20))), (2, "clean text"), (3, " ".join(long[100:109]))]
    found = decontaminate.find_contamination(docs(spark, [(i, t, "s") for i, t in texts]), spark.createDataFrame(bench, "item_id long, text string"))
    assert {r["doc_id"]: (r["hit_spans"], r["hit_items"]) for r in found.collect()} == {0: ([0, 15], ["1"]), 1: ([0, 40], ["5", "6"]), 2: ([], []), 3: ([], [])}
    assert len(sizes) > 15 and max(sizes) <= 10_000


def test_decontamination_matches_brute_force_and_blocks(spark, monkeypatch):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    rows = docs(spark, [(i, t, "s") for i, t in TEXTS])
    expected = brute_windows(TEXTS, BENCH)
    whole = {r[0]: tuple(r)[1:] for r in decontaminate.digest(decontaminate.find_contamination(rows, bench)).collect()}
    assert whole == expected
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 20)
    blocks = {r[0]: tuple(r)[1:] for r in decontaminate.digest(decontaminate.find_contamination(rows, bench)).collect()}
    assert blocks == expected


def test_decontamination_removes_and_keeps(spark, monkeypatch):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    rows = docs(spark, [(i, t, "s") for i, t in TEXTS]).withColumn("n_words", F.lit("x"))
    kept = decontaminate.remove_documents(rows.drop("n_words"), bench)
    assert sorted(r[0] for r in kept.collect()) == [3, 4, 5] and kept.columns == rows.drop("n_words").columns
    spans = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(rows, bench).collect()}
    assert spans[1] == "a  b" and spans[3] == "nothing here" and spans[4] is None and spans[6] == "the ! and É漢 x1, "
    clash = rows.drop("n_words").withColumns({"_scan_text": F.lit(1), "a.b": F.lit(2), "k0": F.lit(3), "digest": F.lit(4), "spans": F.lit(5)})
    for block in (1 << 20, 40):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        out = decontaminate.find_contamination(clash, bench)
        assert out.columns == [*clash.columns, *decontaminate.COLUMNS]
        assert {(r["_scan_text"], r["a.b"], r["k0"], r["digest"], r["spans"]) for r in out.collect()} == {(1, 2, 3, 4, 5)}
        assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.digest(decontaminate.find_contamination(rows, none)).where("contaminated").count() == 0
    assert decontaminate.find_contamination(rows.limit(0), bench).count() == 0


# ---- SimHash ----


def brute_fingerprint(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", [None, "", " \t", "One", "a b", "a b c", "É b\x0bC d\xa0e", "x " * 200_000, "a\x1cb c d"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode() if text is not None else None) == brute_fingerprint(text)


def test_masks_cover_every_pair():
    for level in simhash.split_masks(simhash.LEVELS):
        assert all(len(masks) == 7 for masks in level)
    first, *_, last = simhash.split_masks(simhash.LEVELS)
    assert max(64 - m.bit_count() for masks in last for m in masks) <= simhash.MOST_LEFT
    for i in range(64):
        for j in range(i, 64):
            both = 1 << i | 1 << j
            own = [0]
            for level in simhash.split_masks(simhash.LEVELS):  # the tables in which the pair still collides
                own = [7 * t + v for t in own for v, m in enumerate(level[t]) if not both & m]
                assert own


def test_links_match_brute_force(spark):
    rnd = np.random.default_rng(1)
    base = [int(x) for x in rnd.integers(0, 1 << 63, 12)]
    fps = {0} | {b ^ sum(1 << int(k) for k in rnd.integers(0, 64, rnd.integers(0, 6))) for b in base for _ in range(25)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    pairs = edges.collect()
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 2 for a, b in pairs)
    expected = brute_components(signed, [(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2])
    got = dict.fromkeys(signed) | {f: f for f in signed} | {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert got == expected


def test_a_template_makes_no_pairs_of_texts_that_differ_too_much(spark, monkeypatch):
    seen, real = [], simhash.judged

    def judged(pairs, texts, scratch, share=simhash.COPY_SHARE):
        seen.append(pairs.count())
        return real(pairs, texts, scratch, share)

    monkeypatch.setattr(simhash, "judged", judged)
    template = " ".join(f"t{k}" for k in range(100))
    # 13 words of 113 differ: 0.787 of the shingles are shared
    rows = [(i, template + " " + " ".join(f"own{i}x{k}" for k in range(13)), "s") for i in range(1500)]
    # and two of them have a near copy each
    rows += [(5000 + i, rows[i][1] + " more", "s") for i in (3, 4)]
    kept = {r["doc_id"] for r in simhash.keep_one_of_each(docs(spark, rows)).collect()}
    assert kept == set(range(1500)) and sum(seen) < 20


def test_prefixes_meet_whatever_the_sizes(spark):
    rng = np.random.default_rng(11)
    base = [[f"b{j}w{k}" for k in range(90)] for j in range(12)]
    rows = []
    for i in range(260):
        own = list(base[i % 12])
        for k in rng.integers(0, 90, rng.integers(0, 3)):
            own[k] = f"x{i}y{k}"
        cut = int(rng.integers(0, 14))
        rows.append((i, " ".join(own[:90 - cut] + [f"z{i}n{k}" for k in range(int(rng.integers(0, 8)))]), "s"))
    sets = [set(zip(*[t.split()[k:] for k in range(5)], strict=False)) for _, t, _ in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    kept = {r["doc_id"] for r in simhash.keep_one_of_each(docs(spark, rows)).collect()}
    assert kept == {i for i in range(len(rows)) if top(i) == i} and 12 < len(kept) < 200


def test_near_duplicates_and_survivors(spark):
    long = " ".join(f"w{k}" for k in range(400))
    rows = [(5, long, "s"), (3, long, "s"), (9, long.replace("w7 ", "w7x "), "s"), (1, "alone text here now", "t"), (8, "", "s"), (7, None, "s"), (3, long, "s"), (2, "other words", None)]
    df = docs(spark, rows).withColumn("fp", F.lit(1)).withColumn("component_id", F.lit(1))
    found = simhash.near_duplicates(df)
    fps = {i: brute_fingerprint(t) for i, t, _ in rows}
    expected = brute_components(list(fps), [(a, b) for a in fps for b in fps if (fps[a] ^ fps[b]).bit_count() <= 2])
    got = [(r[0], r[1] % (1 << 64), r[2]) for r in found.collect()]
    assert Counter(got) == Counter((i, fps[i], expected[i]) for i, _, _ in rows)
    kept = simhash.keep_one_of_each(docs(spark, rows))
    assert sorted(r[0] for r in kept.collect()) == [1, 2, 3, 7] and kept.columns == df.columns[:5]
    twice = simhash.keep_one_of_each(docs(spark, [(1, long, "s"), (1, "quite another text", "s"), (1, long, "s"), (None, long, "s")]))
    assert Counter(r["text"] for r in twice.collect()) == Counter([long, "quite another text", long])
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.keep_one_of_each(docs(spark, [])).count() == 0
    clash = docs(spark, rows).withColumns({"_digest": F.lit("mine"), "_node": F.lit(7), "a.b": F.lit(1.5), "token": F.lit("t")})
    kept = simhash.keep_one_of_each(clash)
    assert kept.columns == clash.columns and Counter(map(tuple, kept.collect())) <= Counter(map(tuple, clash.collect()))
    assert sorted(r[0] for r in kept.collect()) == [1, 2, 3, 7]


def test_different_texts_with_one_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(simhash.F, "xxhash64", lambda *c, real=F.xxhash64: F.lit(5).cast("long") if len(c) == 1 and "md5" not in str(c[0]) else real(*c))
    rows = [(k, f"text number {k} of some words that differ {k}", "s") for k in range(20)]
    df = docs(spark, rows + [(100, rows[0][1], "s")])
    node = simhash._nodes(F.col("text"), df)
    assert df.select(node.alias("n")).distinct().count() == 20


def test_near_copies_are_caught_and_others_kept(spark):
    rnd = np.random.default_rng(8)
    vocabulary = [f"w{k}" for k in range(3000)]
    rows, copies = [], 0
    for i in range(120):
        words = list(rnd.choice(vocabulary, 300))
        rows.append((10 * i, " ".join(words), "s"))
        if i % 3 == 0:
            changed = list(words)
            for k in rnd.integers(0, 300, 1 + i % 4):
                changed[k] = "edited"
            rows.append((10 * i + 1, " ".join(changed).upper(), "s"))
            copies += 1
        if i % 3 == 1:  # half of the text is another one
            rows.append((10 * i + 2, " ".join(words[:150] + list(rnd.choice(vocabulary, 150))), "s"))
    hot = rows[0][1]
    rows += [(5000 + k, hot.replace("w1", f"v{k}", 1), "s") for k in range(60)]
    kept = {r["doc_id"] for r in simhash.keep_one_of_each(docs(spark, rows).repartition(3)).collect()}
    assert {i for i, _, _ in rows if i % 10 in (0, 2) and i < 5000} <= kept
    lost = [i for i in kept if i % 10 == 1 and i < 5000]
    assert len(lost) <= 0.05 * copies and not [i for i in kept if i >= 5000]


def edited(words, edits, tag):
    """``words`` with ``edits`` words replaced, so far apart that each changes five shingles."""
    out = list(words)
    for k in range(edits):
        out[4 + k * ((len(words) - 8) // edits)] = f"{tag}x{k}"
    return " ".join(out)


def test_long_texts_just_below_the_share_are_kept(spark):
    rows = []
    for i in range(24):
        words = [f"t{i}w{k}" for k in range(3000)]
        rows += [(2 * i, " ".join(words), "s"), (2 * i + 1, edited(words, 67, f"t{i}"), "s")]  # 2661 of 3331 shingles: 0.7989
    assert simhash.keep_one_of_each(docs(spark, rows)).count() == len(rows)


@pytest.mark.parametrize("limit", [1 << 21, 0])
def test_every_pair_just_above_the_share_is_caught(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "BROADCAST_NODES", limit)
    rows = []
    for i in range(24):
        size, edits = ((3000, 66), (104, 2), (50, 1))[i % 3]  # shares of 0.8016, 0.8182 and 0.8039
        words = [f"t{i}w{k}" for k in range(size)]
        rows += [(2 * i, " ".join(words), "s"), (2 * i + 1, edited(words, edits, f"t{i}"), "s")]
    kept = simhash.keep_one_of_each(docs(spark, rows))
    assert {r["doc_id"] for r in kept.collect()} == {2 * i for i in range(24)}


def test_repeated_rows_meet_alone_whatever_the_keys(spark, monkeypatch):
    text, other = " ".join(f"w{k}" for k in range(40)), " ".join(f"x{k}" for k in range(40))
    rows = [(7, text, "s")] * 60 + [(3, other, "s")] * 2 + [(9, other + " end", "s"), (5, "", "s"), (6, None, "s")]
    expected = {(3, other), (5, ""), (7, text)}
    for limit in (1 << 21, 0):
        monkeypatch.setattr(simhash, "BROADCAST_NODES", limit)
        for kind in ("long", "string"):
            df = docs(spark, rows).repartition(3)
            kept = simhash.keep_one_of_each(df.withColumn("doc_id", df.doc_id.cast(kind)))
            assert sorted((int(r["doc_id"]), r["text"]) for r in kept.collect()) == sorted(expected)


def test_a_crowded_bucket_around_one_text_is_settled(spark):
    base = [f"w{k}" for k in range(60)]
    rows = [(0, " ".join(base), "s")]
    for k in range(250):  # each shares 0.84 with the base, and most some 0.70 with one another
        words = list(base)
        words[5 + k % 50] = f"v{k}"
        rows.append((1 + k, " ".join(words), "s"))
    # beside the group: shares most of its shingles with all, and is near to none but its own copy
    far = base[:45] + [f"far{k}" for k in range(15)]
    rows += [(1000, " ".join(far), "s"), (1001, " ".join(far[:-1] + ["end"]), "s")]
    kept = simhash.keep_one_of_each(docs(spark, rows))
    assert {r["doc_id"] for r in kept.collect()} == {0, 1000}


def test_fingerprints_propose_first_and_their_pairs_are_not_judged_again(spark, monkeypatch):
    seen, real = [], simhash.judged

    def judged(pairs, texts, scratch, share=simhash.COPY_SHARE):
        seen.append(pairs.count())
        return real(pairs, texts, scratch, share)

    monkeypatch.setattr(simhash, "judged", judged)
    rows, equal, far = [], 0, 0
    for i in range(30):
        words = [f"t{i}w{k}" for k in range(60)]
        rows += [(2 * i, " ".join(words), "s"), (2 * i + 1, edited(words, 1, f"t{i}"), "s")]
        fps = [brute_fingerprint(t) for _, t, _ in rows[-2:]]
        equal, far = equal + ((fps[0] ^ fps[1]).bit_count() <= 2), far + ((fps[0] ^ fps[1]).bit_count() > 2)
    kept = simhash.keep_one_of_each(docs(spark, rows))
    assert {r["doc_id"] for r in kept.collect()} == {2 * i for i in range(30)}
    assert equal and far and seen[0] == equal and sum(seen[1:]) == far


def test_a_hubs_pairs_are_judged_in_groups(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(simhash, "HUB", 3)
    words = [f"w{k}" for k in range(60)]
    texts = [(0, " ".join(words).encode())] + [(k, edited(words, 1 + k % 2 * 5, f"x{k}").encode()) for k in range(1, 20)]
    df = spark.createDataFrame(texts * 3, "node long, text binary").repartition(5)
    pairs = spark.createDataFrame([(k, 0) for k in range(1, 20)], "u long, v long")
    with simhash.Scratch(spark) as scratch:
        found = {tuple(r) for r in simhash.judged(pairs, df, scratch).collect()}
    assert found == {(k, 0) for k in range(2, 20, 2)}


def test_components_of_a_long_chain(spark):
    chain = spark.range(60).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v")).union(spark.createDataFrame([(100, 100), (201, 200), (201, 200)], "u long, v long"))
    got = {r["node"]: r["root"] for r in connected_components(chain).collect()}
    assert got == dict.fromkeys(range(61), 0) | {200: 200, 201: 200}
    assert connected_components(chain.limit(0)).count() == 0


# ---- mixing ----


def draw(seed, key, rate):
    parts = max(1, math.ceil(rate / mixing.MEAN))
    total = 0
    for j in range(1, parts + 1):
        u = (int(hashlib.md5(f"{seed}:count:{j}:{key}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
        p = c = math.exp(-rate / parts)
        k = 0
        while c < u and k < mixing.TERMS:
            k += 1
            p *= rate / parts / k
            c += p
            total += 1
    return total


def test_mixing_matches_its_formula(spark):
    rows = [(i, "x" * (i % 7), "big" if i % 3 else "small") for i in range(300)] + [(1000, None, None), (1001, "t" * 9, "off"), (1, "dup", "big")]
    df = docs(spark, rows).withColumn("replica", F.lit("mine"))
    got = mixing.replicate(df, {"small": 40.0, "off": 0.0})
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(t or "") + 1
    weight = {s: {"small": 40.0, "off": 0.0}.get(s, 1.0) for s in size}
    rate = {s: weight[s] / sum(weight.values()) * sum(size.values()) / size[s] for s in size}
    expected = Counter()
    for i, t, s in rows:
        expected[i, t, s] += draw(mixing.SEED, i, rate[s])
    out = got.collect()
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in out) == +expected
    assert any(rate[s] > mixing.MEAN for s in rate), "a mean that is drawn in parts"
    order = [(r["shuffle_key"], r["replica"]) for r in out]
    assert order == sorted(order)
    assert mixing.replicate(docs(spark, []), {}).count() == 0


def test_mixing_of_a_tiny_source_with_a_huge_weight(spark, monkeypatch):
    rows = [(i, "x" * 500, "big") for i in range(100)] + [(1000, "t", "tiny")]
    df = docs(spark, rows).withColumns({c: F.lit(c) for c in ("_rate", "_parts", "_below", "_source", "_weight", "_bytes", "_count", "_begin", "a.b")})
    whole = mixing.replicate(df, {"tiny": 1.0}).collect()
    rate = 0.5 * sum(len(t) + 1 for _, t, _ in rows) / 2
    copies = [r["replica"] for r in whole if r["doc_id"] == 1000]
    assert sorted(copies) == list(range(1, draw(mixing.SEED, 1000, rate) + 1)) and len(copies) > 10_000
    assert whole[0]["_rate"] == "_rate" and whole[0]["a.b"] == "a.b"
    monkeypatch.setattr(mixing, "AT_ONCE", 7)
    assert Counter(map(tuple, mixing.replicate(df, {"tiny": 1.0}).collect())) == Counter(map(tuple, whole))


def test_mixing_beyond_the_broadcast_bound(spark, monkeypatch):
    df = docs(spark, [(i, "text", f"s{i % 5}") for i in range(50)])
    near = sorted(map(tuple, mixing.replicate(df, {"s1": 5.0}).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 2)
    assert sorted(map(tuple, mixing.replicate(df, {"s1": 5.0}).collect())) == near


# ---- sharding ----


@pytest.mark.parametrize("n", [0, 1, 2, 3, 8, 10, 97, 1000])
def test_permutation(n):
    assert sorted(sharding.permute(np.arange(n), n).tolist()) == list(range(n))
    if n > 90:
        assert sharding.permute(np.arange(n), n, 1).tolist() != sharding.permute(np.arange(n), n, 2).tolist()


def test_shards(spark):
    rows = [(i % 90, f"t{i % 40}" if i % 11 else None, "s") for i in range(203)] + [(None, "n", "s"), (7, "é" * 1000, "s")]
    df = docs(spark, rows).withColumns({"slot": F.lit("mine"), "_part": F.lit(1), "_local": F.lit(2), "_start": F.lit(3), "a.b": F.lit(4)}).repartition(6)
    out = sharding.shards(df).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((i, t) for i, t, _ in rows)
    assert sorted(r["row_number"] for r in out) == list(range(len(rows)))
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[k]) for k in range(8)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    order = [r["doc_id"] if r["doc_id"] is not None else -1 for r in sorted(out, key=lambda r: r["row_number"])]
    assert order == sorted(order)
    again = sharding.shards(df.repartition(3)).collect()
    place = lambda rows: Counter((r["doc_id"], r["text"], r["position"]) for r in rows)
    assert place(out) == place(again)
    assert sharding.shards(docs(spark, [])).count() == 0


def test_sharding_query_columns(spark, tmp_path):
    docs(spark, [(i, None if i == 3 else f"é{i}", "s") for i in range(20)]).write.parquet(f"{tmp_path}/documents.parquet")
    for r in sharding.op7_sharding(spark, str(tmp_path)).collect():
        data = b"" if r["doc_id"] == 3 else f"é{r['doc_id']}".encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)


# ---- toxicity ----


def corpus(n=600):
    rnd = np.random.default_rng(3)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    rows, labels = [], []
    for i in range(n):
        text = list(rnd.choice(words, 60))
        toxic = i % 5 == 0
        if toxic:
            text[5] = ["idiotic", "vermin"][i % 2]
        if i % 3 == 0:  # a group is mentioned more often in toxic sentences
            text[7] = "woman" if toxic or i % 9 == 0 else "man"
        rows.append((i, " ".join(text), "s"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_learns_and_ignores_identity(spark, monkeypatch):
    rows, labels = corpus()
    df, known = docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(df, known)
    assert "=idiotic" in model.features or "^idiotic" in model.features
    base = rows[1][1]
    assert model.score(base + " idiotic") > 0.7 > 0.3 > model.score(base)
    gap = abs(model.score(base + " woman") - model.score(base + " man"))
    monkeypatch.setattr(toxicity, "COUNTERFACTUAL", 0.0)
    free = toxicity.fit(df, known)
    assert gap <= abs(free.score(base + " woman") - free.score(base + " man")) + 1e-9 and gap < 0.05
    scored = {r["doc_id"]: r for r in toxicity.classify(df, model).collect()}
    held = [(scored[i]["predicted"], t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(p == t for p, t in held) / len(held) > 0.98


def test_toxicity_edge_cases(spark):
    odd = docs(spark, [(1, None, "s"), (2, "", "s"), (None, "word " * 300_000, "s"), (1, None, "s")]).withColumn("score", F.lit("mine")).withColumn("_text", F.lit("x")).withColumn("a.b", F.lit(1))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(odd, none)
    out = toxicity.classify(odd, model).collect()
    assert len(out) == 4 and all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in out)
    some = spark.createDataFrame([(1, 1, 1), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    assert toxicity.classify(odd.limit(0), toxicity.fit(odd, some)).count() == 0


def test_held_out_rows_are_never_learnt(spark):
    rows, labels = corpus(90)
    used = toxicity.training_rows(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "doc_id", "text", "toxic", 1000)
    texts = {r["text"] for r in used.collect()}
    assert texts == {t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1}


def test_training_rows_are_distinct_and_bounded(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1][:10]
    rows = [(ids[0], "same", "s")] * 50 + [(ids[1], f"text {k}", "s") for k in range(40)] + [(i, "same", "s") for i in ids[2:]]
    labels = spark.createDataFrame([(i, 1, int(i == ids[5])) for i in ids], "doc_id long, quality int, toxic int")
    every = toxicity.training_rows(docs(spark, rows), labels, "doc_id", "text", "toxic", 1000).collect()
    assert Counter(r["text"] for r in every) == Counter({t for _, t, _ in rows}) and {r["text"]: r["toxic"] for r in every}["same"] == 1
    for limit in (1, 2, 7):
        assert toxicity.training_rows(docs(spark, rows), labels, "doc_id", "text", "toxic", limit).count() <= limit


def brute_vector(words, features):
    """Feature values of a list of words, written out."""
    total, out = len(words), [0.0] * (2 * len(features))
    for f, k in features.items():
        heavy = sum(words.count(w) ** 0.5 for w in set(words) if (w == f[1:] if f[0] == "=" else w.startswith(f[1:])))
        if heavy:
            out[k], out[len(features) + k] = 1.0, min(2.0, 100 * heavy / (total + 50))
    return np.array(out)


def brute_features(rows):
    """The selected words and prefixes, straight from the definition."""
    held = [({f for w in re.findall(r"[^\W\d_]+", t.lower()) for f in toxicity.candidates(w)}, y) for t, y in rows]
    n, p = len(held), sum(y for _, y in held)
    tested = {f for fs, _ in held for f in fs}
    ranked = []
    for f in tested:
        a, b = sum(f in fs for fs, y in held if y), sum(f in fs for fs, y in held if not y)
        gap = max(0.0, abs(a * (n - p - b) - b * (p - a)) - n / 2)
        chi2 = n * gap**2 / (p * (n - p) * (a + b) * (n - a - b)) if 0 < a + b < n else 0.0
        if a * (n - p) > b * p and math.erfc(math.sqrt(chi2 / 2)) * len(tested) <= toxicity.FALSE_FEATURES:
            ranked.append((-chi2, -len(f), f, (a, b)))
    kept, same = [], defaultdict(list)
    for _, _, f, counts in sorted(ranked):
        if not (f[0] == "^" and any(x[1:].startswith(f[1:]) for x in same[counts])):
            same[counts].append(f)
            kept.append(f)
    return kept


def test_toxicity_is_the_minimum_of_its_loss(spark):
    rows, labels = corpus(300)
    toxic = {i: t for i, _, t in labels}
    used = [(t, toxic[i]) for i, t, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    model = toxicity.fit(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert list(model.features)[: len(brute_features(used))] == brute_features(used) and set(model.features) >= {"=woman", "=man", "=she", "=frau"}
    words = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    w = np.concatenate((model.weights, [model.bias]))
    gradient = np.array([*[toxicity.RIDGE] * len(model.weights), 1e-6]) * w
    for t, y in used:
        x = np.append(brute_vector(words(t), model.features), 1.0)
        gradient += (1 / (1 + math.exp(-x @ w)) - y) * x
        for sentence in re.findall(r"[^.!?\n]+", t):
            other = [toxicity.SWAP.get(u, u) for u in words(sentence)]
            if other != words(sentence):
                change = np.append(brute_vector(words(sentence), model.features) - brute_vector(other, model.features), 0.0)
                gradient += toxicity.COUNTERFACTUAL * (change @ w) * change
    assert np.abs(gradient).max() < 1e-2
    for t, _ in used[:20]:
        assert model.score(t) == pytest.approx(1 / (1 + math.exp(-np.append(brute_vector(words(t), model.features), 1.0) @ w)))


def test_penalty_acts_on_the_given_tables(spark, monkeypatch):
    path = "/root/testdata/sf0.01"
    given = [spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels")]
    kept = {}
    monkeypatch.setattr(toxicity, "_newton", lambda x, y, penalty, fit=toxicity._newton: (kept.update(penalty=penalty), fit(x, y, penalty))[1])
    model = toxicity.fit(*given)
    outside = kept["penalty"] - np.diag(np.diag(kept["penalty"]))
    assert np.count_nonzero(outside) >= 2
    monkeypatch.setattr(toxicity, "COUNTERFACTUAL", 0.0)
    free = toxicity.fit(*given)
    assert model.features == free.features and np.abs(model.weights - free.weights).max() > 1e-3
    met = [f for f in toxicity.identity_features() if outside[model.features[f]].any()]
    gap = lambda m: sum(abs(m.weights[m.features[f]] - m.weights[m.features["=" + toxicity.SWAP[f[1:]]]]) for f in met)
    assert met and gap(model) < gap(free)
