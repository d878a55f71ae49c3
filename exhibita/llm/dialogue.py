"""Repair of conversations: the cheapest edits that make the roles alternate, with an audit of what was done.

A conversation's turns must be at most one ``system`` followed by pairs of ``user`` and ``assistant``. Each turn is kept,
given another role, or deleted, and empty turns may be inserted; of the cheapest ways the one whose audit, the edits'
initials in order, is least counts.

The audits of a dynamic program are strings that share long prefixes, so they are nodes of a tree (``Audits``): a node
has its parent, its last edit, ancestors at powers of two and a rolling hash. Two audits of equal cost are compared at
the end of their longest common prefix, which is searched by hashes; equal hashes of different nodes are checked edit by
edit. Of two audits over the same turns with equal cost neither is a prefix of the other, since an edit more would be
an insertion more and cost something; so the smaller one stays the smaller whatever follows.

Turns are sorted over all tasks, so that a conversation of any length is cut into stretches. Most conversations lie
inside one and are done there. For the stretches of a longer one the program is worked out from every state to every
state; these small tables are chained in one pass in order. That pass streams, since the digest of the repaired text can
only be taken in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import Scratch, named, table, written

#: What edits cost; ``TRUNCATED`` is added for a truncated turn that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Turns and bytes of text of a stretch at most; one longer turn is a stretch of its own.
STRETCH, STRETCH_BYTES = 2048, 4 << 20
#: Rows in a batch that a task hands on.
ROWS = 500
#: The rolling hash of audits.
BASE, PRIME = 1_000_003, (1 << 61) - 1

#: States: nothing yet, after the system turn, after a user, after an assistant. A conversation may end at first or last.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a role's initial leads from each state.
_NEXT = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]
#: The role that must come next, but for the system's.
_ROLE = ["user", "user", "assistant", "user"]
_TO = [USER, USER, ASSISTANT, USER]
_ADJACENT = ("su", "ua", "au")
#: A turn's faults.
FINE, BLANK, DUPLICATE, CUT = range(4)

_LAST = re.compile(r"[^\x20\x09-\x0D]")
_SPACE = " \t\n\v\f\r"


class Audits:
    """Audits as nodes that share their prefixes; node 0 is the empty one."""

    __slots__ = ("up", "edit", "depth", "sum")

    def __init__(self) -> None:
        self.up, self.edit, self.depth, self.sum = [[]], [""], [0], [0]

    def add(self, parent: int, edit: str) -> int:
        """The audit ``parent`` with one edit more."""
        up, k = [parent], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.up.append(up)
        self.edit.append(edit)
        self.depth.append(self.depth[parent] + 1)
        self.sum.append((self.sum[parent] * BASE + ord(edit)) % PRIME)
        return len(self.edit) - 1

    def cut(self, node: int, depth: int) -> int:
        """The first ``depth`` edits of an audit."""
        more = self.depth[node] - depth
        while more:
            k = more.bit_length() - 1
            node, more = self.up[node][k], more - (1 << k)
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two audits of one length are equal: by hash, and where different nodes agree in that, edit by edit."""
        if a == b or self.sum[a] != self.sum[b]:
            return a == b
        while a != b:
            if self.edit[a] != self.edit[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def common(self, a: int, b: int) -> int:
        """The length of the longest common prefix."""
        depth = min(self.depth[a], self.depth[b])
        a, b = self.cut(a, depth), self.cut(b, depth)
        if self.same(a, b):
            return depth
        for k in range(len(self.up[a]) - 1, -1, -1):
            if k < len(self.up[a]) and k < len(self.up[b]) and not self.same(self.up[a][k], self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
        return self.depth[a] - 1

    def less(self, a: int, x: str, b: int, y: str) -> bool:
        """Whether audit ``a`` with edit ``x`` comes before audit ``b`` with edit ``y``."""
        n = self.common(a, b)
        return self.at(a, x, n) < self.at(b, y, n)

    def at(self, node: int, more: str, k: int) -> str:
        """The edit number ``k`` of an audit with one edit more, '' at its end."""
        if k >= self.depth[node]:
            return more if k == self.depth[node] else ""
        return self.edit[self.cut(node, k + 1)]

    def text(self, node: int) -> str:
        """An audit written out."""
        out = []
        while node:
            out.append(self.edit[node])
            node = self.up[node][0]
        return "".join(reversed(out))


def _best(audits: Audits, ways: list[tuple[int, int, str]]) -> tuple[int, int]:
    """The cheapest of ``(cost, audit, edit)``, the least of equals, as a node; an empty edit is the audit itself."""
    cost, node, edit = ways[0]
    for c, n, e in ways[1:]:
        if c < cost or c == cost and audits.less(n, e, node, edit):
            cost, node, edit = c, n, e
    return cost, audits.add(node, edit) if edit else node


def _inserted(audits: Audits, best: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """The best way to each state with insertions; two in a row at most are of use."""
    for to, sources in ((USER, (START, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
        ways = [(*best[to], "")] if to in best else []
        ways += [(best[s][0] + INSERT, best[s][1], "I") for s in sources if s in best]
        if ways:
            best[to] = _best(audits, ways)
    return best


def cheapest(turns: list[tuple[str, int]], start: int = START) -> dict[int, tuple[int, str]]:
    """From ``start`` over turns ``(initial of the role, fault)``: cost and audit of the best way to each state."""
    audits = Audits()
    best = _inserted(audits, {start: (0, 0)})
    for initial, fault in turns:
        ways: dict[int, list[tuple[int, int, str]]] = {}
        extra = TRUNCATED if fault == CUT else 0
        for state, (cost, node) in best.items():
            ways.setdefault(state, []).append((cost + DELETE, node, "D"))
            if fault not in (BLANK, DUPLICATE):
                to = _NEXT[state].get(initial)
                if to is not None:
                    ways.setdefault(to, []).append((cost + extra, node, "K"))
                ways.setdefault(_TO[state], []).append((cost + REROLE + extra, node, "R"))
        best = _inserted(audits, {state: _best(audits, own) for state, own in ways.items()})
    return {state: (cost, audits.text(node)) for state, (cost, node) in best.items()}


def repaired(turns: list[tuple[str, str]], audit: str, state: int = START) -> tuple[list[str], int]:
    """The lines ``role:text`` that an audit makes of turns ``(role, text)``, and the state at the end."""
    out, k = [], 0
    for edit in audit:
        role, text = turns[k] if edit != "I" else ("", "")
        k += edit != "I"
        if edit == "D":
            continue
        if edit == "K":
            state = _NEXT[state][role[:1]]
        else:
            role, state = _ROLE[state], _TO[state]
        out.append(f"{role}:{text}")
    return out, state


def fault_of(text: str, seen: bool) -> int:
    """A turn's first fault: blank, a duplicate of an earlier one, or cut off before the end of a sentence."""
    if not _LAST.search(text):
        return BLANK
    return DUPLICATE if seen else FINE if text.rstrip(_SPACE)[-1] in ".!?" else CUT


class _Stretch:
    """Neighbouring turns of one conversation."""

    __slots__ = ("conv", "turns", "faults", "numbers", "bytes", "first")

    def __init__(self, conv, first: bool):
        self.conv, self.first = conv, first
        self.turns: list[tuple[str, str]] = []
        self.faults: list[int] = []
        self.numbers: list = []
        self.bytes = 0

    def add(self, number, role: str, text: str, seen: bool) -> None:
        self.turns.append((role, text))
        self.faults.append(fault_of(text, seen))
        self.numbers.append(number)
        self.bytes += len(text)

    def counts(self) -> dict:
        """What is counted: faults, illegal neighbours, and the numbers of the turns."""
        initials = [r[:1] for r, _ in self.turns]
        numbers = [n for n in self.numbers if n is not None]
        return {
            "blank": self.faults.count(BLANK), "duplicate": self.faults.count(DUPLICATE), "truncated": self.faults.count(CUT),
            "illegal": sum(a + b not in _ADJACENT for a, b in zip(initials, initials[1:], strict=False)),
            "low": min(numbers, default=None), "high": max(numbers, default=None), "distinct": len(set(numbers)),
            "head": initials[0] if initials else None, "tail": initials[-1] if initials else None,
        }

    def ways(self, starts: Iterator[int] | tuple[int, ...]) -> list[dict]:
        turns = [(r[:1], f) for (r, _), f in zip(self.turns, self.faults, strict=True)]
        return [{"p": p, "q": q, "cost": c, "audit": a} for p in starts for q, (c, a) in cheapest(turns, p).items()]


def _gaps(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else high - low + 1 - distinct


def _result(counts: dict, cost: int, audit: str, digest: str) -> dict:
    own = {k: counts[k] for k in ("blank", "duplicate", "truncated", "illegal")}
    return {"gaps": _gaps(counts["low"], counts["high"], counts["distinct"]), **own, "cost": cost, "audit": audit, "repaired_sha256": digest}


#: What is returned for each conversation.
RESULT = {"gaps": "long", **dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), "long"), "audit": "string", "repaired_sha256": "string"}
_COUNTS = "struct<blank: long, duplicate: long, truncated: long, illegal: long, low: long, high: long, distinct: long, head: string, tail: string>"
#: A stretch of a conversation that has more of them, or may have.
_PART = f"part int, seq long, counts {_COUNTS}, ways array<struct<p: int, q: int, cost: long, audit: string>>, role array<string>, text array<string>"


def _schema(kind: T.DataType, *more: str) -> T.StructType:
    out = T.StructType([T.StructField("conv", kind)])
    for ddl in more:
        out = T.StructType([*out, *T.StructType.fromDDL(ddl)])
    return out


_RESULT_DDL = ", ".join(f"{k} {v}" for k, v in RESULT.items())


def _in_batches(rows: Iterator[dict], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of ``ROWS``, less where stretches hold much text."""
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(map(len, row.get("text") or ()))
        if len(held) >= ROWS or size > STRETCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, arrow)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, arrow)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Stretch, bool]]:
    """The stretches of a task's sorted turns, and whether each is known to be its whole conversation."""
    own, begun, cut = None, False, False
    for batch in batches:
        for conv, number, role, text, n, first in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "n", "first")), strict=True):
            if own is None or conv != own.conv:
                if own is not None:
                    yield own, begun and not cut
                    begun = True  # what stands at the task's ends may go on in other tasks
                own, cut = _Stretch(conv, True), False
            for k in range(n):
                if len(own.turns) >= STRETCH or own.bytes > STRETCH_BYTES:
                    cut = True
                    yield own, False
                    own = _Stretch(conv, False)
                own.add(number, role, text, not first or k > 0)
    if own is not None:
        yield own, False


def _later(a: tuple | None, x: str, b: tuple | None, y: str) -> bool:
    """Whether audit ``a`` with ``x`` behind it comes after ``b`` with ``y``; audits are chains of pieces that share their beginnings."""
    left, right = [x], [y]
    while a is not b:
        (a, x), (b, y) = a, b
        left.append(x)
        right.append(y)
    return "".join(reversed(left)) > "".join(reversed(right))


def _written_out(audit: tuple | None) -> str:
    out = []
    while audit is not None:
        audit, piece = audit
        out.append(piece)
    return "".join(reversed(out))


def _chained(rows: Iterator[dict]) -> Iterator[dict]:
    """Results of conversations from their stretches in order, holding one audit and one digest for each state."""
    conv, live, counts, last = None, {}, {}, None

    def done() -> dict:
        cost, audit, digest = min((live[s][0], _written_out(live[s][1]), live[s][2].hexdigest()) for s in (START, ASSISTANT) if s in live)
        return {"conv": conv, **_result(counts, cost, audit, digest)}

    for row in rows:
        c = row["counts"]
        if not live or row["conv"] != conv:
            if live:
                yield done()
            conv, live = row["conv"], {START: (0, None, hashlib.sha256(), False)}
            counts, last = {**dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "distinct"), 0), "low": None, "high": None}, None
        for k in ("blank", "duplicate", "truncated", "illegal"):
            counts[k] += c[k]
        if c["head"] is not None:
            counts["illegal"] += last is not None and last + c["head"] not in _ADJACENT
            last = c["tail"]
        if c["low"] is not None:
            # turns are in order: only the last number before can come again
            counts["distinct"] += c["distinct"] - (counts["high"] == c["low"])
            counts["low"] = c["low"] if counts["low"] is None else counts["low"]
            counts["high"] = c["high"]
        turns, after = list(zip(row["role"], row["text"], strict=True)), {}
        best: dict[int, tuple[int, int, str]] = {}
        for way in row["ways"]:
            p, q, own = way["p"], way["q"], way["audit"]
            if p in live:
                cost = live[p][0] + way["cost"]
                if q not in best or cost < best[q][0] or cost == best[q][0] and _later(live[best[q][1]][1], best[q][2], live[p][1], own):
                    best[q] = (cost, p, own)
        for q, (cost, p, own) in best.items():
            _, before, digest, some = live[p]
            lines, _ = repaired(turns, own, p)
            digest = digest.copy()
            if lines:
                digest.update((("\n" if some else "") + "\n".join(lines)).encode("utf-8", "surrogatepass"))
            after[q] = (cost, (before, own), digest, some or bool(lines))
        live = after
    if live:
        yield done()


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", all_conversations: DataFrame | None = None) -> DataFrame:
    """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of every conversation.

    Turns are taken in the order of their numbers, null ones first; turns with one number in the order of role and text.
    A null role or text is one space, so the turn is blank. Only roles that begin with s, u or a can be kept. Null
    conversation ids are one conversation. Repeated rows are turns of their own, all but the first duplicates (or
    blank). A conversation of ``all_conversations`` without turns, or with none that stays, has the empty audit and the
    digest of the empty text. An empty table gives an empty result; further columns, whatever their names, are left out.
    """
    space = F.lit(" ")
    rows = turns.select(named(conv).alias("conv"), named(turn).cast("long").alias("turn"), F.coalesce(named(role), space).alias("role"), F.coalesce(named(text), space).alias("text"))
    # the first turn of each role and text is not a duplicate; a row that marks it has no turns itself
    order = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    firsts = rows.groupBy("conv", "role", "text").agg(F.min(order).alias("o"))
    firsts = firsts.select("conv", F.col("o.turn").alias("turn"), "role", "text", F.lit(0).alias("n"), F.lit(True).alias("first"))
    every = (turns if all_conversations is None else all_conversations).select(named(conv).alias("conv")).distinct()
    nothing = every.select("conv", *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"))], F.lit(0).alias("n"), F.lit(True).alias("first"))
    # equal turns are counted before they are sorted, so they are one row however many there are
    counted = rows.select("*", F.lit(1).alias("n"), F.lit(False).alias("first")).union(firsts).union(nothing)
    counted = counted.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"), F.max("first").alias("first"))
    keys = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text")]
    kind = turns.schema[conv].dataType
    schema = _schema(kind, "whole boolean", _RESULT_DDL, _PART)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def made() -> Iterator[dict]:
            for seq, (own, whole) in enumerate(_stretches(batches)):
                if whole:
                    ends = {w["q"]: (w["cost"], w["audit"]) for w in own.ways((START,))}
                    cost, audit = min(ends[s] for s in (START, ASSISTANT) if s in ends)
                    digest = hashlib.sha256("\n".join(repaired(own.turns, audit)[0]).encode("utf-8", "surrogatepass")).hexdigest()
                    yield {"conv": own.conv, "whole": True, **_result(own.counts(), cost, audit, digest)}
                else:
                    ways = own.ways(range(4))
                    yield {"conv": own.conv, "whole": False, "part": part, "seq": seq, "counts": own.counts(), "ways": ways, "role": [r for r, _ in own.turns], "text": [t for _, t in own.turns]}

        yield from _in_batches(made(), schema)

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_batches(_chained(row for batch in batches for k in range(batch.num_rows) for row in batch.slice(k, 1).to_pylist()), chained)

    chained = _schema(kind, _RESULT_DDL)
    cores = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the order must hold over all tasks, so their number is fixed here and small ones are not joined again
    spread = counted.repartitionByRange(cores, *keys).sortWithinPartitions(*keys)
    with Scratch(turns.sparkSession) as scratch:
        found = scratch.written(spread.mapInArrow(scan, schema))
        parts = found.where("NOT whole").select("conv", "part", "seq", "counts", "ways", "role", "text")
        parts = parts.repartition("conv").sortWithinPartitions("conv", "part", "seq")
        names = list(RESULT)
        out = written(found.where("whole").select("conv", *names).union(parts.mapInArrow(chain, chained).select("conv", *names)))
    return out.withColumnRenamed("conv", conv)


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, turn, role, text)`` with faults made by rule: by the crc32 of ``conv:turn`` modulo 20 a turn is dropped (0), emptied (1),
    robbed of its ``.!?`` (2), repeated (3) or given to the user (4). Nulls are one space here."""
    as_text = lambda c: F.coalesce(named(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(as_text(conv), F.lit(":"), as_text(turn)).cast("binary")) % 20
    rows = turns.select(named(conv).alias(conv), named(turn).alias(turn), as_text(role).alias(role), as_text(text).alias(text), kind.alias("_kind")).where("_kind <> 0")
    new = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(named(text), "[.!?]", "")).otherwise(named(text))
    rows = rows.select(conv, turn, F.when(F.col("_kind") == 4, "user").otherwise(named(role)).alias(role), new.alias(text), "_kind")
    return rows.withColumn("_copy", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_kind", "_copy")


def op13_repair(spark, sf_dir: str) -> DataFrame:
    """Every conversation damaged by rule and repaired."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(damaged(turns), all_conversations=turns)


def _crc_sql(text: str) -> str:
    """DuckDB SQL: the crc32 of a text, where ``crcs`` is the table's column."""
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {data}), lambda c, x: xor(c >> 8, crcs[(xor(c, x) & 255) + 1])), CAST(4294967295 AS BIGINT))"


CRC_TABLE = "crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs)"


def _oracle() -> str:
    """DuckDB SQL of op13: the best way to each state as a struct of cost, audit and repaired lines, turn by turn."""
    way = lambda state, cost, edit, line: f"CASE WHEN b{state} IS NOT NULL THEN {{'cost': b{state}.cost + {cost}, 'audit': b{state}.audit || '{edit}', 'lines': {f'list_append(b{state}.lines, {line})' if line else f'b{state}.lines'}}} END"
    least = lambda *ways: f"list_min(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))"
    kept, line = "CASE WHEN fault IN ('blank', 'duplicate') THEN NULL ELSE ({}) END", "role || ':' || text"
    cut = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    keep = lambda state, initial: kept.format(f"CASE WHEN initial = '{initial}' THEN {way(state, cut, 'K', line)} END")
    other = lambda state, role: kept.format(way(state, f"3 + {cut}", "R", f"'{role}:' || text"))
    gone = lambda state: way(state, 4, "D", "")
    step = {
        0: least(gone(0)), 1: least(gone(1), keep(0, "s")),
        2: least(gone(2), *(keep(s, "u") for s in (0, 1, 3)), *(other(s, "user") for s in (0, 1, 3))),
        3: least(gone(3), keep(2, "a"), other(2, "assistant")),
    }
    user = least("b2", *(way(s, 3, "I", "'user:'") for s in (0, 1, 3)))
    assistant = least("b3", way(2, 3, "I", "'assistant:'"))
    kind = "STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR[])"
    null = f"CAST(NULL AS {kind})"
    return rf"""
WITH RECURSIVE {CRC_TABLE}, d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations, crc_table
), after AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM d, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER w AS k, left(role, 1) AS initial, left(lag(role) OVER w, 1) AS before_
  FROM after WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM numbered
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (k > 1 AND before_ || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id
), ways AS (
  SELECT conv_id, 0 AS k, CAST({{'cost': 0, 'audit': '', 'lines': []}} AS {kind}) AS b0, {null} AS b1, CAST({{'cost': 3, 'audit': 'I', 'lines': ['user:']}} AS {kind}) AS b2,
         CAST({{'cost': 6, 'audit': 'II', 'lines': ['user:', 'assistant:']}} AS {kind}) AS b3 FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, k, b0, b1, b2, CAST({assistant} AS {kind}) AS b3 FROM (
    SELECT conv_id, k, b0, b1, CAST({user} AS {kind}) AS b2, b3 FROM (
      SELECT w.conv_id, w.k + 1 AS k, {", ".join(f"CAST({x} AS {kind}) AS b{s}" for s, x in step.items())}
      FROM ways w JOIN judged j ON w.conv_id IS NOT DISTINCT FROM j.conv_id AND j.k = w.k + 1))
), ends AS (
  SELECT conv_id, list_min([b0, b3]) AS best FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) = 1 AS last_ FROM ways) WHERE last_
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       best.cost AS cost, best.audit AS audit, sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN counted c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


ORACLE = _oracle()
