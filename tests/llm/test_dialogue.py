"""Repair of conversations against trying all edits, on long conversations and odd rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from exhibita.llm import dialogue as D

TURNS = "conv_id long, turn long, role string, text string, n int, first string, conv string, _kind string"


def all_ways(turns):
    """Cost and audit of the best edits of ``(initial, fault)`` turns, by trying them all with up to two insertions at each place."""
    best = None
    for own in itertools.product(*[("D",) if f in (D.BLANK, D.DUPLICATE) else ("D", "K", "R") for _, f in turns]):
        for gaps in itertools.product(range(3), repeat=len(turns) + 1):
            audit = "".join("I" * g + e for g, e in zip(gaps, (*own, ""), strict=True))
            cost, made, k = 0, "", 0
            for e in audit:
                if e == "I":
                    made += "a" if made[-1:] == "u" else "u"
                    cost += 3
                    continue
                initial, fault = turns[k]
                k += 1
                if e == "D":
                    cost += 4
                    continue
                made += initial if e == "K" else "a" if made[-1:] == "u" else "u"
                cost += 3 * (e == "R") + 3 * (fault == D.CUT)
            if re.fullmatch("(s?(ua)+)?", made) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def plain(turns):
    """The best way to each state from the start, with whole strings."""
    start = {0: (0, "")}

    def close(b):
        for to, sources in ((2, (0, 1, 3)), (3, (2,))):
            ways = ([b[to]] if to in b else []) + [(b[s][0] + 3, b[s][1] + "I") for s in sources if s in b]
            if ways:
                b[to] = min(ways)
        return b

    best = close(start)
    for initial, fault in turns:
        ways = defaultdict(list)
        for s, (c, a) in best.items():
            ways[s].append((c + 4, a + "D"))
            if fault not in (D.BLANK, D.DUPLICATE):
                more = 3 * (fault == D.CUT)
                to = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[s].get(initial)
                if to is not None:
                    ways[to].append((c + more, a + "K"))
                ways[3 if s == 2 else 2].append((c + 3 + more, a + "R"))
        best = close({s: min(w) for s, w in ways.items()})
    return min(best[s] for s in (0, 3) if s in best)


def brute(rows, every):
    out, convs = {}, defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t, " " if r is None else r, " " if x is None else x))
    for c in every:
        own = sorted(convs[c], key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        seen, faults = set(), []
        for _, r, x in own:
            stripped = x.strip(" \t\n\v\f\r")
            faults.append(D.BLANK if not stripped else D.DUPLICATE if (r, x) in seen else D.FINE if stripped[-1] in ".!?" else D.CUT)
            seen.add((r, x))
        cost, audit = plain([(r[:1], f) for (_, r, _), f in zip(own, faults, strict=True)])
        lines, k, last = [], 0, "a"
        for e in audit:
            if e == "I":
                lines.append("assistant:" if last == "u" else "user:")
            else:
                _, r, x = own[k]
                k += 1
                if e == "D":
                    continue
                lines.append(f"{r}:{x}" if e == "K" else ("assistant:" if last == "u" else "user:") + x)
            last = lines[-1][:1]
        numbers = [t for t, _, _ in own if t is not None]
        initials = [r[:1] for _, r, _ in own]
        out[c] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            faults.count(D.BLANK), faults.count(D.DUPLICATE), faults.count(D.CUT),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def made(rng, n_convs, longest):
    rows = []
    for c in range(n_convs):
        for t in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None])
            text = rng.choice(["Yes.", "No", " ", "", None, "é 漢!", f"turn {t}.", f"turn {t}", "ends. \n"])
            rows.append((c if c else None, rng.choice([t, t, t, t // 2, None]), role, text))
    return rows


def found(spark, rows, **more):
    df = spark.createDataFrame([(*r, 0, None, "x", None) for r in rows], TURNS)
    out = D.repair(df, **more)
    assert out.columns == ["conv_id", *D.RESULT]
    got = [tuple(r) for r in out.collect()]
    assert len({r[0] for r in got}) == len(got)
    return {r[0]: r[1:] for r in got}


def test_the_program_finds_the_least_of_the_cheapest_edits():
    rng = random.Random(5)
    for _ in range(150):
        turns = [(rng.choice("suat"), rng.choice((D.FINE, D.FINE, D.CUT, D.BLANK, D.DUPLICATE))) for _ in range(rng.randint(0, 4))]
        ways = D.cheapest(turns)
        assert min(ways[s] for s in (0, 3) if s in ways) == all_ways(turns) == plain(turns)
    for _ in range(60):
        turns = [(rng.choice("sua"), rng.choice((D.FINE, D.CUT, D.BLANK))) for _ in range(rng.randint(50, 300))]
        ways = D.cheapest(turns)
        assert min(ways[s] for s in (0, 3) if s in ways) == plain(turns)


def test_equal_hashes_of_different_audits_are_told_apart(monkeypatch):
    monkeypatch.setattr(D, "PRIME", 3)
    rng = random.Random(6)
    for _ in range(60):
        turns = [(rng.choice("sua"), rng.choice((D.FINE, D.CUT, D.BLANK))) for _ in range(rng.randint(0, 80))]
        ways = D.cheapest(turns)
        assert min(ways[s] for s in (0, 3) if s in ways) == plain(turns)


def test_conversations_are_repaired(spark):
    rows = made(random.Random(7), 60, 9)
    assert found(spark, rows) == brute(rows, {r[0] for r in rows})


@pytest.mark.parametrize("stretch", [1, 7])
def test_long_conversations_are_chained_over_tasks(spark, monkeypatch, stretch):
    monkeypatch.setattr(D, "STRETCH", stretch)
    rows = made(random.Random(8), 12, 120)
    rows += [(3, t, "user" if t % 2 else "assistant", "same") for t in range(400)]
    rows += [(4, 1, "user", "Repeated.")] * 300 + [(5, None, None, None)] * 100
    assert found(spark, rows) == brute(rows, {r[0] for r in rows})


def test_conversations_without_turns_and_empty_tables(spark):
    every = spark.createDataFrame([(1,), (2,), (None,)], "conv_id long")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Ho.")]
    got = found(spark, rows, all_conversations=every)
    assert got[2] == got[None] == nothing and got[1][5:7] == (0, "KK")
    assert found(spark, []) == {}
    assert found(spark, [(1, 0, " ", "\t")])[1] == (0, 1, 0, 0, 0, 4, "D", nothing[-1])


def test_damage_follows_the_rule(spark):
    rows = [(c, t, "assistant", f"Text {t}. And? more!") for c in (1, None) for t in (*range(200), None)]
    expected = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            one = (c, t, "user" if kind == 4 else r, "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x)
            expected += [one] * (1 + (kind == 3))
    df = spark.createDataFrame([(*r, 0, None, "x", None) for r in rows], TURNS)
    assert sorted(map(tuple, D.damaged(df).collect()), key=repr) == sorted(expected, key=repr)
    nulls = spark.createDataFrame([(1, 7, None, None)], "conv_id long, turn long, role string, text string")
    assert {tuple(r)[2:] for r in D.damaged(nulls).select("conv_id", "turn", "role", F.col("text")).collect()} == {(" ", " ")}
