"""Removal of repeated passages over sparse suffix arrays in a logarithmic index family.

Every window of ``LENGTH`` bytes is assigned to the smallest hash among the ``GRAM``-byte strings in it, so equal
windows are assigned alike wherever they stand. A maximal run of windows with one assignment is a *segment*, one
for about 17 bytes: segments are the sampled suffixes. They are dealt out by their assignment, so that windows
that could be equal meet in one partition, whose size follows from the total of bytes. An assignment that very many
different segments share (a short notice, a run of dashes) would fill one partition; a count finds such ones first,
and their windows are dealt out each by itself, by their own hash.

Round one indexes segments as they are. In each partition the batches come in order of their smallest document. Each,
or several of ``SCAN`` keys together, becomes an array of its distinct segments in order, is merge-scanned against the
existing levels of the family for segments that a smaller document has, and then becomes a level itself; levels of like
size merge, so that their sizes grow geometrically. Where documents overlap in number with those of later batches, they
are scanned once more when those are in.
Round two takes the segments that share an assignment with different ones (some 5 %): the first holder of each sends
its bytes. Windows whose hash no other document has cannot be equal to another's; the others go, batch by batch, into a
family of arrays of real 50-byte suffixes, in byte order, which settles them one by one.

With ``index`` the batches and levels are kept as Parquet, and later documents are scanned against them: the levels
that a generation merges are superseded, the others stay as they were written.

A suffix array of every byte would cost 8 bytes and more of shuffle for each byte of text; this takes about one.
Hot passages cost nothing extra: equal segments of a batch travel once. Segments count as equal where 96 bits of
hashes agree; of 1e12 segments, each held against those of its own assignment, that errs once in some 1e7 runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import named, new_path, table, written

LENGTH = 50
GRAM = 20
#: Bytes of text in a batch, and bytes of text that one index partition stands for.
BATCH_BYTES, PART_BYTES = 8 << 20, 24 << 20
#: Keys that a partition scans against its levels at once; the messages of several batches make up so many.
SCAN = 1 << 17
#: Windows of a text that are hashed at once.
PIECE = 1 << 16
#: Windows in a segment at most, so that its first and last window cover all of it.
RUN = LENGTH - GRAM + 1
#: Different segments of one assignment from which on its windows are dealt out each by itself, and such assignments
#: at most; with more, the most frequent ones are, and the partitions of the others are larger.
HOT_SEGMENTS, HOT_MOST = 150_000, 1 << 20
#: Smaller than any document: stored documents come before all new ones.
STORED = np.iinfo(np.int64).min
#: Fixed odd multipliers of the hashes.
BASE, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(MIX)
    h ^= h >> np.uint64(29)
    h *= np.uint64(MIX)
    h ^= h >> np.uint64(32)
    return h


_POWER = {s: np.uint64(pow(BASE, s, 1 << 64)) for s in (1, 2, 4, 8, 16)}


def _doubled(data: np.ndarray) -> dict[int, np.ndarray]:
    """Polynomial hashes of all strings of 1, 2, 4, 8 and 16 bytes."""
    out = {1: data.astype(np.uint64) + np.uint64(1)}
    for s in (1, 2, 4, 8):
        out[2 * s] = out[s][:-s] * _POWER[s]
        out[2 * s] += out[s][s:]
    return out


def _hashes(doubled: dict[int, np.ndarray], n: int, places: np.ndarray | None = None) -> np.ndarray:
    """Polynomial hashes of the strings of ``n`` bytes, at all places or at some."""
    out, at, count = None, 0, len(doubled[1]) - n + 1
    while at < n:
        s = max(k for k in doubled if k <= n - at)
        part = doubled[s][at : at + count] if places is None else doubled[s][places + at]
        out = part if out is None else out * _POWER[s] + part
        at += s
    return out


def _lowest(h: np.ndarray, width: int) -> np.ndarray:
    """The minimum over every ``width`` neighbours."""
    s, low = 1, h
    while 2 * s <= width:
        low = np.minimum(low[:-s], low[s:])
        s *= 2
    n = len(h) - width + 1
    return np.minimum(low[:n], low[width - s : width - s + n])


def segments(data: bytes, start: np.ndarray, end: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Assignment, content hash, first window, number of windows and text of each segment of several texts.

    The texts stand one after the other in ``data``, from ``start`` to ``end``; no window reaches across two of them.
    Windows with an assignment in ``hot`` (in order) are segments of their own, assigned to their own hash.
    """
    blank = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    which = np.flatnonzero(end - start >= LENGTH)
    if not len(which):
        return blank
    start, beyond = start[which], end[which] - LENGTH + 1
    raw, parts = np.frombuffer(data, np.uint8), []
    for at in range(0, len(raw) - LENGTH + 1, PIECE):
        doubled = _doubled(raw[at : at + PIECE + LENGTH - 1])
        low = _lowest(_mixed(_hashes(doubled, GRAM)), RUN)
        if len(hot):
            at_hot = np.flatnonzero(hot[np.minimum(np.searchsorted(hot, low), len(hot) - 1)] == low)
            low[at_hot] = _mixed(_hashes(doubled, LENGTH, at_hot) ^ np.uint64(MIX))
        edges = [start, beyond]
        edges = [x[np.searchsorted(x, at) : np.searchsorted(x, at + len(low))] - at for x in edges]
        cut = np.zeros(len(low) + 1, bool)
        cut[1:-1] = low[1:] != low[:-1]
        cut[0] = cut[-1] = True
        for x in edges:
            cut[x] = True
        first = np.flatnonzero(cut)
        size = np.diff(first)
        first = first[:-1]
        text = np.searchsorted(start, first + at, "right") - 1
        inside = (text >= 0) & (first + at < beyond[text])
        first, size, text = first[inside], size[inside], text[inside]
        if len(size) and size.max() > RUN:  # periodic text
            pieces = -(-size // RUN)
            step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first, size, text = np.repeat(first, pieces) + step * RUN, np.minimum(RUN, np.repeat(size, pieces) - step * RUN), np.repeat(text, pieces)
        content = _mixed(_hashes(doubled, LENGTH, first)) * np.uint64(BASE) + _hashes(doubled, LENGTH, first + size - 1) + size.astype(np.uint64)
        parts.append((low[first], content, first + at, size, which[text]))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


class Family:
    """Sorted arrays of distinct keys in levels of geometrically growing size, largest first.

    A level has keys, a check that equal keys must share (or None), the smallest document of each key, and the batch
    that this document came in. ``made`` are the stored levels that went into it.
    """

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray]] = []
        self.made: list[set[int]] = []

    def stored(self, level: tuple, made: int) -> None:
        """A level as it was written."""
        self.levels.append(level)
        self.made.append({made})
        order = sorted(range(len(self.levels)), key=lambda k: -len(self.levels[k][0]))
        self.levels, self.made = [self.levels[k] for k in order], [self.made[k] for k in order]

    def insert(self, keys: np.ndarray, check: np.ndarray | None, docs: np.ndarray, batch: int | np.ndarray = 0) -> np.ndarray:
        """Scans a new batch against the levels and itself and makes it a level; keys may repeat and come in any order.

        Returns the smallest document of each key so far.
        """
        *new, order, group = self._sorted(keys, check, docs, np.broadcast_to(batch, len(keys)))
        made, found = set(), np.empty(len(keys), np.int64)
        found[order] = np.minimum(self.smallest(new[0], new[1]), new[2])[group]
        while self.levels and len(self.levels[-1][0]) <= 2 * len(new[0]):
            new, made = self._both(self.levels.pop(), new), made | self.made.pop()
        self.levels.append(tuple(new))
        self.made.append(made)
        return found

    @staticmethod
    def _sorted(keys, check, docs, batches) -> tuple:
        """A level, the order of the keys, and each ordered key's place in the level."""
        if not len(keys):
            return keys, check, docs, batches, np.zeros(0, np.int64), np.zeros(0, np.int64)
        order = np.argsort(keys, kind="stable")  # merges runs that are in order already
        keys, docs, batches = keys[order], docs[order], batches[order]
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        if check is not None:
            check = check[order]
            new[1:] |= check[1:] != check[:-1]
        first = np.flatnonzero(new)
        low = np.minimum.reduceat(docs, first)
        group = np.cumsum(new) - 1
        at = np.flatnonzero(docs == low[group])
        holder = at[np.concatenate(([True], group[at[1:]] != group[at[:-1]]))]
        return keys[first], None if check is None else check[first], low, batches[holder], order, group

    def _both(self, a: tuple, b: tuple) -> tuple:
        return self._sorted(*(None if x is None else np.concatenate((x, y)) for x, y in zip(a, b, strict=True)))[:4]

    def whole(self) -> tuple:
        """All levels as one array; the levels stay."""
        out = self.levels[-1]
        for level in self.levels[-2::-1]:
            out = self._both(level, out)
        return out

    @staticmethod
    def _look(level: tuple, keys: np.ndarray, check: np.ndarray | None) -> np.ndarray:
        have, checks, docs, _ = level
        out = np.full(len(keys), np.iinfo(np.int64).max)
        if len(have):
            at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
            if checks is None:
                return np.where(have[at] == keys, docs[at], out)
            for near in (at, np.minimum(at + 1, len(have) - 1)):  # two that share a key differ in the check
                out = np.where((have[near] == keys) & (checks[near] == check), docs[near], out)
        return out

    def smallest(self, keys: np.ndarray, check: np.ndarray | None = None) -> np.ndarray:
        """The smallest document of each key over all levels."""
        out = np.full(len(keys), np.iinfo(np.int64).max)
        for level in self.levels:
            out = np.minimum(out, self._look(level, keys, check))
        return out


def _pack(*arrays: np.ndarray) -> bytes:
    sizes = np.array([len(a.tobytes()) for a in arrays], np.int64)
    return zstandard.ZstdCompressor(level=1).compress(sizes.tobytes() + b"".join(a.tobytes() for a in arrays))


def _unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes, at, out = np.frombuffer(raw, np.int64, len(kinds)), 8 * len(kinds), []
    for size, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


class Batch:
    """The segments of a batch of documents, dealt to ``n_parts`` partitions and made distinct.

    The same batch always gives the same order, so verdicts travel back as bits without addresses.
    """

    def __init__(self, row: dict, n_parts: int, hot: np.ndarray):
        self.ids = np.array([x if x is not None else -1 for x in row["ids"]], np.int64)
        self.known = np.array([x is not None for x in row["ids"]], bool)
        self.ends = np.cumsum(np.array([0, *row["sizes"]], np.int64))
        self.data = zstandard.ZstdDecompressor().decompress(row["blob"]) if self.ends[-1] else b""
        start = np.where(self.known, self.ends[:-1], self.ends[1:])  # without an id a text has no windows
        assigned, content, first, size, doc = segments(self.data, start, self.ends[1:], hot)
        low = _mixed(assigned)
        part = ((low >> np.uint64(32)) % np.uint64(n_parts)).astype(np.uint16 if n_parts <= 1 << 16 else np.uint64)
        key = _mixed(content ^ (low * np.uint64(BASE)))
        order = np.argsort(key)
        order = order[np.argsort(part[order], kind="stable")]
        self.first, self.size, self.doc = first[order], size[order], doc[order]
        part, key = part[order], key[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (part[1:] != part[:-1]))) if len(key) else np.zeros(0, bool)
        self.head = np.flatnonzero(new)  # one of each distinct segment
        self.group = np.cumsum(new) - 1
        self.key, self.low, self.assigned = key[self.head], low[order][self.head].astype(np.uint32), assigned[order][self.head]
        self.holder = np.minimum.reduceat(self.ids[self.doc], self.head) if len(key) else np.zeros(0, np.int64)
        parts = part[self.head].astype(np.int64)
        cuts = np.flatnonzero(np.concatenate(([True], parts[1:] != parts[:-1]))) if len(parts) else np.zeros(0, np.int64)
        ends = np.concatenate((cuts[1:], [len(parts)]))[: len(cuts)]
        self.parts = {p: (a, e) for p, a, e in zip(parts[cuts].tolist(), cuts.tolist(), ends.tolist(), strict=True)}

    def verdicts(self, packed: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
        """For each distinct segment: whether a smaller document than its holder has it; whether it goes to round two."""
        earlier, open_ = np.zeros(len(self.head), bool), np.zeros(len(self.head), bool)
        for x in packed or ():
            a, b = self.parts[x["part"]]
            bits = [np.unpackbits(y, count=b - a).astype(bool) for y in _unpack(x["blob"], "u1", "u1")]
            earlier[a:b], open_[a:b] = bits
        return earlier, open_

    def text(self, which: np.ndarray) -> np.ndarray:
        """The bytes of distinct segments, one after the other."""
        at = self.head[which]
        return np.frombuffer(self.data, np.uint8)[_places(self.first[at], self.size[at] + LENGTH - 1)]


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each ``start`` on, ``size`` of them, one range after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _together(sizes: list[int], least: int) -> list[tuple[int, int]]:
    """Ranges of neighbours, each of ``least`` or more in all but the last."""
    cuts, held = [0], 0
    for k, n in enumerate(sizes):
        held += n
        if held >= least or k == len(sizes) - 1:
            cuts.append(k + 1)
            held = 0
    return list(zip(cuts, cuts[1:]))


BATCH = "chunk long, n_bytes long, ids array<long>, sizes array<int>, blob binary"
SENT = "part long, chunk long, blob binary"
_SENT = ["part", "chunk", "blob"]


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def batches_of(docs: DataFrame, key: str, text: str, path: str, generation: int = 0) -> DataFrame:
    """Documents in compressed batches of about ``BATCH_BYTES``, written once so that every pass sees the same ones."""

    def pack(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, ids, texts, held = (generation << 44) + (TaskContext.get().partitionId() << 20), [], [], 0

        def out() -> pa.RecordBatch:
            blob = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            values = [[number], [held], [ids], [[len(t) for t in texts]], [blob]]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            names = ["chunk", "n_bytes", "ids", "sizes", "blob"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=names)

        for batch in stream:
            for i, t in zip(batch.column("id"), batch.column("text"), strict=True):
                ids.append(i.as_py())
                texts.append(t.as_py() or b"")
                held += len(texts[-1])
                if held >= BATCH_BYTES or len(ids) >= 100_000:
                    yield out()
                    number, ids, texts, held = number + 1, [], [], 0
        if ids:
            yield out()

    rows = docs.select(named(key).cast("long").alias("id"), named(text).cast("binary").alias("text"))
    rows.mapInArrow(pack, BATCH).write.mode("overwrite").parquet(path)
    return docs.sparkSession.read.schema(BATCH).parquet(path)


def _each(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in stream:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_py() for name in batch.schema.names}


def _hot(chunks: DataFrame) -> np.ndarray:
    """The assignments that very many different segments share, in order."""

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for row in _each(stream):
            low, n = np.unique(Batch(row, 1, none).assigned, return_counts=True)
            several = n > 1
            yield pa.RecordBatch.from_arrays([pa.array(low[several].view(np.int64)), pa.array(n[several].astype(np.int64))], names=["low", "n"])

    found = chunks.mapInArrow(count, "low long, n long").groupBy("low").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT_SEGMENTS)
    rows = found.orderBy(F.desc("n"), "low").limit(HOT_MOST).collect()
    return np.sort(np.array([r["low"] for r in rows], np.int64).view(np.uint64))


def _round_one(chunks: DataFrame, n_parts: int, hot: Broadcast, levels: DataFrame | None = None, generation: int = 0) -> DataFrame:
    """Verdicts on the batches (kind 0); with stored levels also what later batches need: new levels (1), and the keys of
    segments that stored batches have to send (2)."""
    keeps = levels is not None

    def send(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(stream):
            b = Batch(row, n_parts, hot.value)
            base = int(b.holder.min()) if len(b.holder) else 0
            yield _rows(
                [
                    (p, row["chunk"], _pack(np.array([base]), b.key[s:e], b.low[s:e], *_narrow(b.holder[s:e] - base)))
                    for p, (s, e) in b.parts.items()
                ],
                _SENT,
            )

    def settle(group: pa.Table) -> pa.Table:
        part, family, sent = group["part"][0].as_py(), Family(), []
        stored = {}
        for chunk, kind, covers, blob in zip(*(group[c] for c in ("chunk", "kind", "covers", "blob")), strict=True):
            if kind.as_py():
                stored[chunk.as_py()] = (covers.as_py(), blob)
            else:
                sent.append((chunk.as_py(), *_keys(blob.as_py())))
        gone = {m for covers, _ in stored.values() for m in covers}
        for made, (_, blob) in stored.items():
            if made not in gone:
                key, low, chunk = _unpack(blob.as_py(), "u8", "u4", "i8")
                family.stored((key, low, np.full(len(key), STORED), chunk), made)
        sent.sort(key=lambda x: (int(x[3].min()), x[0]))
        scans = []
        for s, e in _together([len(x[1]) for x in sent], SCAN):
            key, low, doc = (np.concatenate([x[k] for x in sent[s:e]]) for k in (1, 2, 3))
            chunk = np.repeat([x[0] for x in sent[s:e]], [len(x[1]) for x in sent[s:e]])
            scans.append((s, e, low, family.insert(key, low, doc, chunk) < doc, key, doc))
        for _, e, low, settled, key, doc in scans:
            if e < len(sent) and sent[e][3].min() < doc.max():  # a later batch has smaller documents
                settled |= family.smallest(key, low) < doc
        # how many different segments, and documents, share an assignment
        key, low, doc, chunk = family.whole() if family.levels else (np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64))
        order = np.argsort(low, kind="stable")
        new = np.concatenate(([True], low[order][1:] != low[order][:-1])) if len(low) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        several = np.diff(np.concatenate((first, [len(low)]))) > 1
        if len(first):
            several &= np.minimum.reduceat(doc[order], first) != np.maximum.reduceat(doc[order], first)
        shared, rows, opened = low[order][first][several], [], []
        for s, e, low_, settled, *_ in scans:
            at = np.minimum(np.searchsorted(shared, low_), max(len(shared) - 1, 0))
            open_ = ~settled & (shared[at] == low_) if len(shared) else np.zeros(len(low_), bool)
            opened.append(low_[open_])
            cuts = np.cumsum([len(x[1]) for x in sent[s : e - 1]], dtype=np.int64)
            for x, mine, its in zip(sent[s:e], np.split(settled, cuts), np.split(open_, cuts), strict=True):
                if mine.any() or its.any():
                    rows.append((part, x[0], 0, [], _pack(np.packbits(mine), np.packbits(its))))
        if keeps:
            asked = np.isin(low, np.concatenate([np.zeros(0, np.uint32), *opened])) & (doc == STORED)
            for own in np.unique(chunk[asked]):
                rows.append((part, int(own), 2, [], _pack(key[asked & (chunk == own)])))
            fresh = [k for k, made in enumerate(family.made) if len(made) != 1 or not any(m in stored and family.levels[k][2].max(initial=STORED) == STORED for m in made)]
            if fresh and sent:
                merged, covers = Family(), set()
                for k in fresh:
                    level = family.levels[k]
                    merged.levels.append(level)
                    covers |= family.made[k]
                key, low, _, chunk = merged.whole()
                rows.append((part, generation, 1, sorted(covers), _pack(key, low, chunk)))
        return pa.Table.from_batches([_kinds(rows)])

    rows = chunks.mapInArrow(send, SENT).select("part", "chunk", F.lit(0).alias("kind"), F.array().cast("array<long>").alias("covers"), "blob")
    if keeps:
        rows = rows.union(levels.select(*_KINDS))
    return rows.groupBy("part").applyInArrow(settle, KINDS)


KINDS = "part long, chunk long, kind int, covers array<long>, blob binary"
_KINDS = ["part", "chunk", "kind", "covers", "blob"]


def _kinds(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=_KINDS)


def _narrow(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative numbers as their low and high halves; the high ones are mostly zero and compress away."""
    offsets = offsets.astype(np.uint64)
    return offsets.astype(np.uint32), (offsets >> np.uint64(32)).astype(np.uint32)


def _keys(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    base, key, low, doc, high = _unpack(blob, "i8", "u8", "u4", "u4", "u4")
    return key, low, (doc.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32))).astype(np.int64) + base[0]


def _several(hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which windows have a hash that another document has too: no others can be equal."""
    order = np.argsort(hashes)
    hashes, docs, out = hashes[order], docs[order], np.empty(len(order), bool)
    first = np.flatnonzero(np.concatenate((np.ones(min(len(order), 1), bool), hashes[1:] != hashes[:-1])))
    if len(first):
        several = np.minimum.reduceat(docs, first) != np.maximum.reduceat(docs, first)
        out[order] = np.repeat(several, np.diff(np.concatenate((first, [len(order)]))))
    return out


def _suffixes(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The ``LENGTH`` bytes from each place on, as strings in byte order."""
    view = np.lib.stride_tricks.sliding_window_view(text, LENGTH)[at]
    return np.ascontiguousarray(view).view(f"S{LENGTH}").ravel()


def _round_two(chunks: DataFrame, n_parts: int, hot: Broadcast, stored: DataFrame | None = None) -> DataFrame:
    """Verdicts on the open windows of the batches, and of ``stored`` ones the segments that they are asked for."""

    def bytes_of(b: Batch, row: dict, chosen, holder) -> pa.RecordBatch:
        rows = []
        for p, (s, e) in b.parts.items():
            which = chosen(p, s, e)
            if len(which):
                rows.append((p, row["chunk"], _pack(b.size[b.head[which]].astype(np.uint8), holder(which), b.text(which))))
        return _rows(rows, _SENT)

    def send(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(stream):
            b = Batch(row, n_parts, hot.value)
            _, open_ = b.verdicts(row["one"])
            yield bytes_of(b, row, lambda p, s, e, open_=open_: s + np.flatnonzero(open_[s:e]), lambda which, b=b: b.holder[which])

    def send_stored(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(stream):
            b = Batch(row, n_parts, hot.value)
            asked = {x["part"]: _unpack(x["blob"], "u8")[0] for x in row["asked"]}
            none = np.zeros(0, np.uint64)
            yield bytes_of(b, row, lambda p, s, e, b=b, asked=asked: s + np.flatnonzero(np.isin(b.key[s:e], asked.get(p, none))), lambda which: np.full(len(which), STORED))

    def settle(group: pa.Table) -> pa.Table:
        part, family, sent, rows = group["part"][0].as_py(), Family(), [], []
        for chunk, blob in zip(group["chunk"], group["blob"], strict=True):
            size, doc, text = _unpack(blob.as_py(), "u1", "i8", "u1")
            size = size.astype(np.int64)
            at = _places(np.cumsum(size + LENGTH - 1) - (size + LENGTH - 1), size)
            sent.append((int(doc.min()), int(doc.max()), chunk.as_py(), text, at, np.repeat(doc, size)))
        sent.sort(key=lambda x: x[:3])
        ends = np.cumsum([0, *(len(x[4]) for x in sent)])
        hashes = np.empty(ends[-1], np.uint64)
        for s, e, x in zip(ends, ends[1:], sent):
            hashes[s:e] = _hashes(_doubled(x[3]), LENGTH, x[4])
        several = np.split(_several(hashes, np.concatenate([x[5] for x in sent])), ends[1:-1])
        del hashes

        def shared(s: int, e: int) -> tuple[np.ndarray, np.ndarray]:
            keys = [_suffixes(x[3], x[4][k]) for x, k in zip(sent[s:e], several[s:e], strict=True)]
            return np.concatenate(keys), np.concatenate([x[5][k] for x, k in zip(sent[s:e], several[s:e], strict=True)])

        scans = []
        for s, e in _together([int(x.sum()) for x in several], SCAN):
            key, doc = shared(s, e)
            scans.append((s, e, doc.max(initial=STORED), family.insert(key, None, doc) < doc))
        for s, e, most, hit in scans:
            if e < len(sent) and sent[e][0] < most:  # a later batch has smaller documents
                key, doc = shared(s, e)
                hit |= family.smallest(key) < doc
        hits, s = np.concatenate([x[3] for x in scans]), 0
        for (_, most, chunk, *_), found in zip(sent, several, strict=True):
            at = np.flatnonzero(found)
            found[at] = hits[s : s + len(at)]
            s += len(at)
            if most != STORED:
                rows.append((part, chunk, _pack(np.packbits(found))))
        return pa.Table.from_batches([_rows(rows, _SENT)])

    rows = chunks.mapInArrow(send, SENT)
    if stored is not None:
        rows = rows.union(stored.mapInArrow(send_stored, SENT))
    return rows.groupBy("part").applyInArrow(settle, SENT)


def _removed(b: Batch, one: list[dict] | None, two: list[dict] | None) -> Iterator[tuple[int, np.ndarray]]:
    """For each document of a batch the edges of the byte runs to remove, alternating starts and ends."""
    earlier, open_ = b.verdicts(one)
    holder = b.holder[b.group]
    whole = earlier[b.group] | (b.ids[b.doc] > holder)
    first, size, doc = [b.first[whole]], [b.size[whole]], [b.doc[whole]]
    if two:
        windows = b.size[b.head]
        bits = np.zeros(int(windows.sum()), bool)  # by distinct segment and window
        start = np.cumsum(windows) - windows
        for x in two:
            s, e = b.parts[x["part"]]
            which = s + np.flatnonzero(open_[s:e])
            n = windows[which]
            bits[_places(start[which], n)] = np.unpackbits(*_unpack(x["blob"], "u1"), count=int(n.sum()))
        mine = np.flatnonzero(open_[b.group] & ~whole)
        at = _places(start[b.group[mine]], b.size[mine])
        window = np.repeat(b.first[mine], b.size[mine]) + at - np.repeat(start[b.group[mine]], b.size[mine])
        hit = bits[at]
        first.append(window[hit])
        size.append(np.ones(int(hit.sum()), np.int64))
        doc.append(np.repeat(b.doc[mine], b.size[mine])[hit])
    first, size, doc = np.concatenate(first), np.concatenate(size), np.concatenate(doc)
    order = np.lexsort((first, doc))
    doc = doc[order]
    first = first[order] - b.ends[doc]
    end = first + size[order] + LENGTH - 1
    cuts = np.searchsorted(doc, np.arange(len(b.ids) + 1))
    for k in range(len(b.ids)):
        s, e = cuts[k], cuts[k + 1]
        if s == e:
            yield k, np.zeros(0, np.int64)
            continue
        # windows come in order of start and all have one length, so ends are in order within each run of segments
        top = np.maximum.accumulate(end[s:e])
        new = np.concatenate(([True], first[s + 1 : e] > top[:-1]))
        at = np.flatnonzero(new)
        yield k, np.stack((first[s:e][at], np.concatenate((top[at[1:] - 1], top[-1:]))), axis=1).ravel()


class Index:
    """Batches and levels that were kept at a path, generation by generation; a generation counts once its row is written."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        try:
            rows = spark.read.parquet(f"{path}/generations").orderBy("generation").collect()
        except AnalysisException as failure:
            if failure.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            rows = []
        self.known = [r["generation"] for r in rows]
        self.n_parts = rows[0]["n_parts"] if rows else None
        self.hot = np.array(rows[0]["hot"] if rows else [], np.int64).view(np.uint64)
        self.generation = len(rows) + 1

    def read(self, what: str, schema: str) -> DataFrame:
        """``batches`` or ``levels`` of all generations."""
        paths = [f"{self.path}/{what}-{g}" for g in self.known]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def close(self, n_parts: int, hot: np.ndarray) -> None:
        """The generation counts from now on."""
        row = [(self.generation, n_parts, hot.view(np.int64).tolist())]
        self.spark.createDataFrame(row, "generation long, n_parts long, hot array<long>").coalesce(1).write.mode("append").parquet(f"{self.path}/generations")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_bytes: bool = False, index: str | None = None, expected_bytes: int = 0) -> DataFrame:
    """``(key, n_bytes, spans, n_removed, n_spans, kept_sha256)`` for every row, and ``kept`` on demand.

    ``spans`` alternates starts and ends of the maximal byte runs that are removed: the bytes of every 50-byte
    string that also starts in a document with a smaller key. Null texts are empty; texts under 50 bytes lose
    nothing; a null key is neither smaller nor larger than any other, so its row is left alone; rows with equal
    keys do not remove one another. Texts of any length are taken whole. The key must be an integer. An empty table
    gives an empty result; other input columns, whatever their names, are left out.

    With ``index``, a path, the documents also lose what any document has that an earlier call kept there, whatever
    their keys, and are kept there themselves (with their keys and texts). ``expected_bytes``, of the first call, is
    the size of all the texts to come, so that the index has partitions enough.
    """
    spark = docs.sparkSession
    kept = Index(spark, index) if index else None
    path = f"{index}/batches-{kept.generation}" if kept else new_path(spark)
    chunks = batches_of(docs, key, text, path, kept.generation if kept else 0)
    if kept and kept.n_parts:
        n_parts, hot = kept.n_parts, kept.hot
    else:
        total = chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
        n_parts = max(8, -(-max(total, expected_bytes) // PART_BYTES))
        hot = _hot(chunks)
    shared = spark.sparkContext.broadcast(hot)

    def by_chunk(verdicts: DataFrame, name: str) -> DataFrame:
        # as many entries as index partitions that the batch has segments in
        return verdicts.groupBy("chunk").agg(F.collect_list(F.struct("part", "blob")).alias(name))

    settled = written(_round_one(chunks, n_parts, shared, kept.read("levels", KINDS) if kept else None, kept.generation if kept else 0))
    one = by_chunk(settled.where("kind = 0"), "one")
    asked = kept.read("batches", BATCH).join(by_chunk(settled.where("kind = 2"), "asked"), "chunk") if kept else None
    opened = chunks.join(one, "chunk")
    two = by_chunk(written(_round_two(opened, n_parts, shared, asked)), "two")
    judged = chunks.join(one, "chunk", "left").join(two, "chunk", "left")
    if kept:
        settled.where("kind = 1").write.mode("overwrite").parquet(f"{index}/levels-{kept.generation}")
        kept.close(n_parts, hot)

    def finish(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(stream):
            b = Batch(row, n_parts, shared.value)
            out: list[list] = [[] for _ in range(7)]
            for k, edges in _removed(b, row["one"], row["two"]):
                data = b.data[b.ends[k] : b.ends[k + 1]]
                inner = [0, *edges.tolist(), len(data)]
                kept = b"".join(data[s:e] for s, e in zip(inner[::2], inner[1::2], strict=True)) if len(edges) else data
                values = (row["ids"][k], len(data), edges.tolist(), len(data) - len(kept), len(edges) // 2)
                for column, v in zip(out, (*values, hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None), strict=True):
                    column.append(v)
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], names=_RESULT)

    result = judged.mapInArrow(finish, "key long, n_bytes long, spans array<long>, n_removed long, n_spans long, kept_sha256 string, kept binary")
    result = result.withColumnRenamed("key", key)
    return result if keep_bytes else result.drop("kept")


_RESULT = ["key", "n_bytes", "spans", "n_removed", "n_spans", "kept_sha256", "kept"]


def op9_repeats(spark, sf_dir: str) -> DataFrame:
    """Bytes of every document less the 50-byte strings that a document with a smaller id has too."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT r, doc_id, p, substring(h, 2 * p + 1, 100) AS g FROM d, unnest(range(0, n - 49)) AS t(p) WHERE n >= 50
), low AS (
  SELECT g, min(doc_id) AS m FROM w GROUP BY g
), hit AS (
  SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS q FROM w JOIN low USING (g) WHERE m < doc_id
), grouped AS (
  SELECT r, p, sum(CASE WHEN q IS NULL OR p > q + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS k FROM hit
), runs AS (
  SELECT r, k, min(p) AS a, max(p) + 50 AS b FROM grouped GROUP BY r, k
), gaps AS (
  SELECT r, k, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM runs
), cut AS (
  SELECT d.r, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept, max(b) AS last
  FROM gaps JOIN d USING (r) GROUP BY d.r
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substring(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""
