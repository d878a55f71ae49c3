"""Chroma audio fingerprints and the alignment of recordings by them.

A recording becomes frames of twelve pitch-class energies. Sixteen rectangle filters, evaluated over an integral
image of the frames, each give two bits for every frame; the 32 bits are packed into one integer. Two recordings
that share integers are aligned by a histogram of the offsets between them, and the bits that differ over the
overlap at the most frequent offset say how alike they are.

Recordings with equal prints are one class, looked up once. The queries, a stated set, are broadcast as an index from
integers to runs of positions, in blocks of bounded size; each task holds its own classes against a block. A run of
equal integers is one posting with a length, so silence costs no more than a change of tone. What a task finds it sums
up for each query before anything is shuffled: no pairs of recordings are shuffled or kept.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import in_blocks, named, table, with_made, without, written

WINDOW, HOP = 1024, 256
#: Frames that a filter window spans.
SPAN = 16
#: Lowest and highest frequency that counts, in Hz.
LOW, HIGH = 60.0, 3520.0
#: A filter's value beyond this sets the second bit.
STEP = 0.35
#: Uncertain bits of a query's integer that are tried both ways.
FLIPS = 1
#: Of the overlap's bits, the share that may differ, and the least number of integers in the overlap. Shorter or less alike
#: overlaps share too few integers to be found; within these bounds recall over all offsets is 0.9 and more, as tested.
MAX_ERROR, LEAST_OVERLAP = 0.15, 32
QUERY_STEP = 50
#: Integers of queries that are broadcast at once, and cells of a histogram or of an overlap that a task holds at once.
BLOCK_INTS, CELLS = 1 << 19, 1 << 21
#: Rendering of the registered query: samples a second, seconds a segment, segments.
RATE, SECONDS, SEGMENTS = 4000, 0.25, 16


def filters() -> list[tuple[int, int, int, int, int]]:
    """Kind, first pitch class, height, first frame and width of the sixteen filters, by rule."""
    out = []
    for k in range(16):
        height, width = (3, 4, 6, 12)[k % 4], (4, 8, 12, 16)[(k // 4 + k) % 4]
        out.append((k % 3, (5 * k) % (13 - height), height, (3 * k) % (SPAN + 1 - width), width))
    return out


FILTERS = filters()


def chroma(samples: np.ndarray, rate: int) -> np.ndarray:
    """Pitch-class energies, a row for each frame, each row of unit length (or zero)."""
    n = (len(samples) - WINDOW) // HOP + 1
    if n < 1:
        return np.zeros((0, 12))
    hz = np.fft.rfftfreq(WINDOW, 1 / rate)
    used = np.flatnonzero((hz >= LOW) & (hz <= min(HIGH, rate / 2)))
    to = np.zeros((len(used), 12))
    to[np.arange(len(used)), np.round(12 * np.log2(hz[used] / 440.0)).astype(int) % 12] = 1
    taper, parts = np.hanning(WINDOW), []
    frames = np.lib.stride_tricks.sliding_window_view(samples, WINDOW)[::HOP]
    for k in range(0, n, 2048):
        energy = np.abs(np.fft.rfft(frames[k : k + 2048] * taper, axis=1)[:, used]) ** 2 @ to
        size = np.linalg.norm(energy, axis=1, keepdims=True)
        parts.append(np.where(size > 1e-6, energy / np.maximum(size, 1e-6), 0))
    return np.concatenate(parts)


def fingerprint(samples: np.ndarray, rate: int) -> tuple[np.ndarray, np.ndarray]:
    """The packed integers of a recording, unsigned, and for each its ``FLIPS`` least certain bits as masks.

    A recording of fewer than ``SPAN`` frames has none.
    """
    image = chroma(samples, rate)
    n = len(image) - SPAN + 1
    if n < 1:
        return np.zeros(0, np.uint32), np.zeros((0, FLIPS), np.uint32)
    total = np.zeros((len(image) + 1, 13))
    total[1:, 1:] = image.cumsum(0).cumsum(1)
    t = np.arange(n)

    def area(t0: int, t1: int, y0: int, y1: int) -> np.ndarray:
        return total[t + t1, y1] - total[t + t0, y1] - total[t + t1, y0] + total[t + t0, y0]

    out = np.zeros(n, np.uint32)
    margins, masks = np.zeros((n, len(FILTERS))), np.zeros((n, len(FILTERS)), np.uint32)
    for k, (kind, y, h, x, w) in enumerate(FILTERS):
        if kind == 0:  # upper against lower half
            a, b = area(x, x + w, y, y + h // 2), area(x, x + w, y + (h + 1) // 2, y + h)
        elif kind == 1:  # earlier against later half
            a, b = area(x, x + w // 2, y, y + h), area(x + w // 2, x + w, y, y + h)
        else:  # middle third of the pitches against the rest
            a = area(x, x + w, y + h // 3, y + 2 * h // 3 + (h < 3))
            b = (area(x, x + w, y, y + h) - a) / 2
        value = np.log((a + 0.01) / (b + 0.01))
        # two bits; neighbouring levels differ in one of them
        steps = np.abs(value[:, None] - np.array([-STEP, 0, STEP]))
        level = (value > -STEP).astype(np.uint32) + (value > 0) + (value > STEP)
        out = (out << np.uint32(2)) | (level ^ (level >> np.uint32(1))).astype(np.uint32)
        margins[:, k] = steps.min(1)
        place = np.uint32(2 * (len(FILTERS) - 1 - k))
        masks[:, k] = np.where(steps.argmin(1) == 1, np.uint32(2), np.uint32(1)) << place
    least = np.argsort(margins, axis=1, kind="stable")[:, :FLIPS]
    return out, np.take_along_axis(masks, least, 1)


def probes(ints: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and integers to look up: each integer with every subset of its uncertain bits flipped."""
    found = ints[:, None]
    for k in range(masks.shape[1]):
        found = np.concatenate((found, found ^ masks[:, k : k + 1]), axis=1)
    return np.repeat(np.arange(len(ints)), found.shape[1]), found.ravel()


def decode(audio: bytes | None) -> tuple[np.ndarray, int]:
    """Samples between -1 and 1 of 16-bit PCM WAV data, channels averaged; nothing for null or unreadable data.

    Data of another width, without channels or with a frame rate of zero count as unreadable.
    """
    try:
        with wave.open(io.BytesIO(audio or b"")) as w:
            n, rate = w.getnchannels(), w.getframerate()
            if w.getsampwidth() != 2 or rate < 1 or n < 1:
                return np.zeros(0), RATE
            data = w.readframes(w.getnframes())
            data = np.frombuffer(data[: len(data) // 2 * 2], "<i2").astype(np.float64) / 32768
            return data[: len(data) // n * n].reshape(-1, n).mean(1), rate
    except (wave.Error, EOFError, ValueError, ZeroDivisionError):
        return np.zeros(0), RATE


def encode(samples: np.ndarray, rate: int) -> bytes:
    """16-bit PCM WAV data."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def render(vector: list[float] | None) -> bytes | None:
    """A vector as a recording: in each segment twelve of its components set the strengths of the pitch classes."""
    if vector is None:
        return None
    v = np.nan_to_num(np.array([x if x is not None else 0.0 for x in vector], float))
    if not len(v):
        return encode(np.zeros(0), RATE)
    time = np.arange(int(RATE * SECONDS)) / RATE
    tones = np.sin(2 * np.pi * 523.25 * 2 ** (np.arange(12)[:, None] / 12) * time)
    at = (4 * np.arange(SEGMENTS)[:, None] + np.arange(12)) % len(v)
    strength = np.exp(np.clip(6 * v[at], -8, 8))
    return encode(((strength / strength.sum(1, keepdims=True)) @ tones).ravel(), RATE)


def with_audio(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``(key, audio)``: a media column derived from a vector table."""
    rows = vectors.select(named(key).alias("key"), named(vector).alias("vector"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):  # a recording is far larger than its vector
                part = batch.slice(k, 256)
                audio = pa.array([render(x.as_py()) for x in part.column("vector")], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("key"), audio], names=["key", "audio"])

    kind = vectors.schema[key].dataType.simpleString()
    return rows.mapInArrow(make, f"key {kind}, audio binary").withColumnRenamed("key", key)


def fingerprints(media: DataFrame, audio: str = "audio", keep: list[str] | None = None, probing: bool = False) -> DataFrame:
    """``media`` with ``print``, the packed integers (as signed ints) of each recording; empty where there is none.

    With ``probing`` also ``probe_at`` and ``probe``: what a query looks up, see ``probes``.
    """
    new = ["print", *(["probe_at", "probe"] if probing else [])]
    base = without(media, *new)
    kept = [c for c in base.columns if (c != audio if keep is None else c in keep)]

    def score(batch: pa.Array) -> list[list]:
        made: list[list] = [[] for _ in new]
        for x in batch:
            ints, masks = fingerprint(*decode(x.as_py()))
            made[0].append(ints.view(np.int32))
            if probing:
                at, found = probes(ints, masks)
                made[1].append(at.astype(np.int32))
                made[2].append(found.view(np.int32))
        return made

    return with_made(base, kept, [named(audio)], dict.fromkeys(new, T.ArrayType(T.IntegerType())), lambda: score)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position and length of each run of equal neighbours."""
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
    return first, np.diff(np.concatenate((first, [len(values)])))


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` of each size, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Queries:
    """The prints of some queries, and an index from integers to runs of positions in them."""

    def __init__(self, prints: list[np.ndarray], probe_at: list[np.ndarray], probe: list[np.ndarray]):
        self.size = np.array([len(p) for p in prints], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.ints = np.concatenate([np.zeros(0, np.int32), *prints])
        parts = []
        for q, (at, x) in enumerate(zip(probe_at, probe, strict=True)):
            order = np.lexsort((at, x))
            at, x = at[order].astype(np.int64), x[order]
            once = np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]) | (at[1:] != at[:-1])))) if len(x) else []
            at, x = at[once], x[once]
            # of one integer, positions that follow one another are a run
            new = np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]) | (at[1:] != at[:-1] + 1)))) if len(x) else np.zeros(0, np.int64)
            parts.append((x[new], np.full(len(new), q), at[new], np.diff(np.concatenate((new, [len(x)])))))
        value, self.query, self.at, self.length = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(value, kind="stable")
        value, self.query, self.at, self.length = value[order], self.query[order], self.at[order], self.length[order]
        self.first = _runs(value)[0]
        self.values = value[self.first]
        self.count = np.diff(np.concatenate((self.first, [len(value)])))

    def align(self, p: np.ndarray, max_error: float, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The queries that align with a print: their numbers, offsets and errors."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if not len(p) or not len(self.values):
            return none
        starts, lengths = _runs(p)
        at = np.minimum(np.searchsorted(self.values, p[starts]), len(self.values) - 1)
        met = np.flatnonzero(self.values[at] == p[starts])
        if not len(met):
            return none
        n = self.count[at[met]]
        post, own = _ranges(self.first[at[met]], n), np.repeat(met, n)
        order = np.argsort(self.query[post], kind="stable")
        post, own = post[order], own[order]
        asked, edges = np.unique(self.query[post], return_index=True)
        edges = np.concatenate((edges, [len(post)]))
        width = int(self.size[asked].max()) + len(p) + 3
        step, out = max(1, CELLS // width), []
        for k in range(0, len(asked), step):
            part = slice(edges[k], edges[min(k + step, len(asked))])
            out.append(self._peaks(p, asked[k : k + step], post[part], starts[own[part]], lengths[own[part]], width, max_error, least))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    def _peaks(self, p, asked, post, j, m, width, max_error, least):
        """Offsets with most shared integers and the errors there, for the queries ``asked``."""
        row = np.searchsorted(asked, self.query[post]) * width
        zero = len(p)
        near, length = row + self.at[post] - j + zero, self.length[post]
        # two runs meet at a trapezoid of offsets, which is four steps of the second difference
        codes = np.concatenate((near - m + 1, near + length + 1, near + length - m + 1, near + 1))
        signs = np.repeat(np.array([1, 1, -1, -1]), len(near))
        table = np.bincount(codes, signs, len(asked) * width).reshape(-1, width).cumsum(1).cumsum(1).round().astype(np.int64)
        offset = np.arange(width) - zero
        size = self.size[asked][:, None]
        over = np.minimum(size, len(p) + offset) - np.maximum(offset, 0)
        table[over < least] = 0
        order = np.lexsort((offset, np.abs(offset)))  # of equal peaks the one nearest to zero
        best = order[table[:, order].argmax(1)]
        rows = np.flatnonzero(table[np.arange(len(asked)), best] > 0)
        offset, over = offset[best[rows]], over[rows, best[rows]]
        error, group = np.zeros(len(rows)), np.cumsum(over) // CELLS
        for g in np.unique(group):
            own = np.flatnonzero(group == g)
            first, n = np.maximum(offset[own], 0), over[own]
            a = self.ints[_ranges(self.begin[asked[rows[own]]] + first, n)]
            b = p[_ranges(first - offset[own], n)]
            bits = np.bitwise_count((a ^ b).view(np.uint32)).astype(np.int64)
            error[own] = np.add.reduceat(bits, np.cumsum(n) - n) / (32.0 * n)
        good = error <= max_error
        return asked[rows[good]], offset[good], error[good]


def classes(prints: DataFrame, key: str = "vec_id") -> tuple[DataFrame, DataFrame]:
    """``(class, print, n, low, next)`` of the different prints, and the membership ``(key, class)``.

    ``n`` counts the distinct keys of a class, ``low`` and ``next`` are the smallest two. Null keys, and empty or null
    prints, are in no class. Equal rows count once; a key with several prints is in the class of each.
    """
    rows = prints.where(named(key).isNotNull() & (F.size("print") > 0))
    digest = F.md5(F.array_join(F.col("print").cast("array<string>"), ",").cast("binary"))
    members = written(rows.select(named(key).alias("key"), digest.alias("class")).distinct())
    low = members.groupBy("class").agg(F.count("*").alias("n"), F.min("key").alias("low"))
    # dealt by key and class, so that a large class is spread
    rest = members.join(low.select("class", F.col("low").alias("key")), ["class", "key"], "left_anti")
    low = low.join(rest.groupBy("class").agg(F.min("key").alias("next")), "class", "left")
    different = rows.groupBy(digest.alias("class")).agg(F.first("print").alias("print"))
    return different.join(low, "class"), members


def _scan(found: DataFrame, queries: DataFrame, schema: str, report, max_error: float, least: int) -> DataFrame:
    """``report`` of each task's classes ``found`` held against ``queries``, block by block of the queries."""
    spark = found.sparkSession
    asked = queries.where(F.size("print") > 0)
    total = asked.agg(F.coalesce(F.sum(F.size("print")), F.lit(0))).first()[0]
    n = -(-total // BLOCK_INTS)

    def blocks():
        for k in range(n):
            block = asked if n == 1 else asked.where(F.pmod(F.xxhash64("class"), F.lit(n)) == k)
            rows = block.select("class", "print", "probe_at", "probe").collect()
            if rows:
                arrays = [[np.array(r[c], np.int32) for r in rows] for c in ("print", "probe_at", "probe")]
                yield [r["class"] for r in rows], Queries(*arrays)

    def scan(shared) -> DataFrame:
        def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, index = shared.value

            def matches():
                for batch in batches:
                    for k in range(batch.num_rows):
                        row = {c: batch.column(c)[k] for c in batch.schema.names}
                        p = row.pop("print").values.to_numpy(zero_copy_only=False).astype(np.int32)
                        q, offset, error = index.align(p, max_error, least)
                        if len(q):
                            yield {c: v.as_py() for c, v in row.items()}, q, offset, error

            yield from report(names, matches())

        return found.mapInArrow(hold, schema)

    out = in_blocks(spark, blocks(), scan)
    return spark.createDataFrame([], schema) if out is None else out


def aligned(found: DataFrame, queries: DataFrame, max_error: float = MAX_ERROR, least: int = LEAST_OVERLAP) -> DataFrame:
    """``(query, other, offset, error)``: the classes that align with a query's class; with ``classes``' membership
    these are the recordings.

    ``found`` are classes, ``queries`` has ``class``, ``print``, ``probe_at`` and ``probe``, a row for each. Candidates
    share a probed integer; ``offset`` is the most frequent difference of positions of shared integers among those
    with an overlap of ``least`` integers or more (of equal ones the one nearest to zero, then the smaller one),
    ``error`` the share of differing bits over the overlap there, ``max_error`` at most. A class aligns with itself.
    Recordings that share nothing with a query are not found: tests hold the recall against brute force.
    """

    def report(names, matches):
        for row, q, offset, error in matches:
            own = pa.array([row["class"]] * len(q), pa.string())
            columns = [pa.array([names[k] for k in q], pa.string()), own, pa.array(offset, pa.int32()), pa.array(error, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["query", "other", "offset", "error"])

    return _scan(found.select("class", "print"), queries, "query string, other string, offset int, error double", report, max_error, least)


def counted(found: DataFrame, queries: DataFrame, max_error: float = MAX_ERROR, least: int = LEAST_OVERLAP) -> DataFrame:
    """``(query, n, best)``: for each query's class how many recordings of other classes align with it, and the best.

    ``best`` is the smallest of ``(error, other, offset)`` over those classes, ``other`` the smallest key of a class.
    Every task sums up what it has found, so a row for each query and task is shuffled.
    """
    kind = found.schema["low"].dataType
    schema = f"query string, n long, error double, other {kind.simpleString()}, offset int"
    types = (pa.string(), pa.int64(), pa.float64(), to_arrow_type(kind), pa.int32())

    def report(names, matches):
        n, best = {}, {}
        for row, q, offset, error in matches:
            for k, d, e in zip(q.tolist(), offset.tolist(), error.tolist(), strict=True):
                if names[k] != row["class"]:
                    n[k] = n.get(k, 0) + row["n"]
                    here = (e, row["low"], d)
                    if k not in best or here < best[k]:
                        best[k] = here
        made = [[names[k] for k in n], list(n.values()), *([best[k][i] for k in n] for i in range(3))]
        yield pa.RecordBatch.from_arrays([pa.array(m, t) for m, t in zip(made, types, strict=True)], names=["query", "n", "error", "other", "offset"])

    out = _scan(found.select("class", "print", "n", "low"), queries, schema, report, max_error, least)
    return out.groupBy("query").agg(F.sum("n").alias("n"), F.min(F.struct("error", "other", "offset")).alias("best"))


def op5_audio_align(spark, sf_dir: str) -> DataFrame:
    """For every recording whose id is divisible by 50: how many others align with it, and which one does best.

    A recording is a distinct id and print; its own class counts without itself. Equal rows give equal rows.
    """
    vectors = table(spark, sf_dir, "embeddings")
    found, _ = classes(written(fingerprints(with_audio(vectors), keep=["vec_id"])))
    found = written(found)
    asked = with_audio(vectors.where(F.col("vec_id") % QUERY_STEP == 0))
    asked = written(fingerprints(asked, keep=["vec_id"], probing=True))
    joined = F.array_join(F.col("print").cast("array<string>"), ",").cast("binary")
    asked = asked.withColumn("class", F.md5(joined))
    different = asked.dropDuplicates(["class"])
    others = counted(found, different)
    own = found.select("class", (F.col("n") - 1).alias("twins"), "low", "next")
    rows = asked.join(own, "class", "left").join(others.withColumnRenamed("query", "class"), "class", "left")
    # its own class aligns with it wherever there is enough to overlap
    enough = (F.size("print") >= LEAST_OVERLAP) & (F.col("twins") > 0)
    twin = F.when(F.col("low") != F.col("vec_id"), F.col("low")).otherwise(F.col("next"))
    kind = f"struct<error: double, other: {found.schema['low'].dataType.simpleString()}, offset: int>"
    copy = F.when(enough, F.struct(F.lit(0.0).alias("error"), twin.alias("other"), F.lit(0).alias("offset"))).cast(kind)
    best = F.least(F.col("best").cast(kind), copy)
    number = F.coalesce("n", F.lit(0).cast("long")) + F.when(enough, F.col("twins")).otherwise(0)
    return rows.select("vec_id", F.size("print").alias("n_ints"), F.sha2(joined, 256).alias("print_sha256"), number.alias("n_aligned"), best.alias("best")).select(
        "vec_id",
        "n_ints",
        "print_sha256",
        "n_aligned",
        F.col("best.other").alias("best_id"),
        F.col("best.offset").alias("best_offset"),
        F.col("best.error").alias("best_error"),
    )
