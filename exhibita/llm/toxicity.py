"""Toxicity: a counterfactually regularised classifier of whole texts.

Features are words and word prefixes that are markedly more frequent in toxic labelled documents, and all identity
terms, each as presence and as density. A logistic regression is fitted to them with a penalty on the squared change
of the logit when the identity terms of a labelled sentence are swapped for others of their group. Both terms of
every swap are features, whatever the labels say about them, so the penalty always has something to hold together:
a group that is mentioned more often in toxic texts does not get a score of its own.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import named, table, with_made, without, written

#: Labelled texts that the classifier is fitted on at most: those with the lowest hashes.
MAX_TRAINING_ROWS = 20_000
#: Features that are selected at most, and candidates that are looked at for them.
MAX_FEATURES, CANDIDATES = 300, 3_000
#: How many words and prefixes without a bearing on the labels may be expected among the features, whatever the number looked at.
FALSE_FEATURES = 1.0
RIDGE = 0.1
COUNTERFACTUAL = 10.0
THRESHOLD = 0.7
PREFIXES = range(3, 8)
#: Characters of a text that are held as words at once.
PIECE = 1 << 20
#: Words whose features a worker remembers.
REMEMBERED = 200_000
COLUMNS = ("score", "predicted")

#: Terms that name a group of people; a swap takes the next term of its tuple.
IDENTITY_GROUPS = (
    ("woman", "man"),
    ("women", "men"),
    ("girl", "boy"),
    ("girls", "boys"),
    ("she", "he"),
    ("her", "his"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("immigrant", "citizen", "refugee"),
    ("immigrants", "citizens", "refugees"),
    ("disabled", "deaf", "blind"),
    ("old", "young"),
    ("frau", "mann"),
    ("frauen", "männer"),
    ("femme", "homme"),
    ("femmes", "hommes"),
    ("mujer", "hombre"),
    ("mujeres", "hombres"),
)
SWAP = {t: g[(i + 1) % len(g)] for g in IDENTITY_GROUPS for i, t in enumerate(g)}

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def word_counts(text: str | None) -> Counter:
    """How often each lower-cased word of a text occurs; long texts are taken in pieces cut at spaces."""
    counts: Counter = Counter()
    start, text = 0, text or ""
    while start < len(text):
        cut = text.find(" ", start + PIECE)
        cut = len(text) if cut < 0 else cut
        counts.update(_WORD.findall(text[start:cut].lower()))
        start = cut
    return counts


def swapped(counts: Counter) -> Counter:
    """The counts with every identity term replaced by the next of its group."""
    out: Counter = Counter()
    for w, n in counts.items():
        out[SWAP.get(w, w)] += n
    return out


def candidates(word: str) -> list[str]:
    """The features that a word may have: itself and its prefixes."""
    return [f"={word}", *(f"^{word[:k]}" for k in PREFIXES if len(word) >= k)]


@dataclass
class Model:
    """Selected features with the weights of presence and density, and the bias."""

    features: dict[str, int]
    weights: np.ndarray
    bias: float
    seen: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def of(self, word: str) -> tuple[int, ...]:
        found = self.seen.get(word)
        if found is None:
            if len(self.seen) > REMEMBERED:
                self.seen.clear()
            get = self.features.get
            found = self.seen[word] = tuple(i for c in candidates(word) if (i := get(c)) is not None)
        return found

    def vector(self, counts: Counter) -> dict[int, float]:
        """Feature values: 1 at ``i`` where feature i is present, its density at ``k + i`` for k features."""
        heavy: dict[int, float] = {}
        of = self.of
        for word, n in counts.items():
            for i in of(word):
                heavy[i] = heavy.get(i, 0.0) + n**0.5
        k, total = len(self.features), counts.total()
        out = dict.fromkeys(heavy, 1.0)
        out.update({k + i: min(2.0, 100 * v / (total + 50)) for i, v in heavy.items()})
        return out

    def score(self, text: str | None) -> float:
        z = self.bias + sum(self.weights[i] * v for i, v in self.vector(word_counts(text)).items())
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, limit: int) -> DataFrame:
    """``(text, toxic)`` of the labelled rows that may be learnt from: ``limit`` different texts at most.

    The rows whose crc32 of the id is 1 modulo 3 are held out. Of the others, the ``limit`` ids and then the
    ``limit`` texts with the lowest hashes are taken, however often an id is repeated. A text with several labels is
    toxic if one of them says so. Null ids, labels and texts are left out.
    """
    ids = labels.select(named(key).alias("id"), named(label).cast("int").alias("toxic"))
    ids = ids.where("id IS NOT NULL AND toxic IS NOT NULL").where(F.crc32(F.col("id").cast("string").cast("binary")) % 3 != 1)
    ids = ids.groupBy("id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(limit)
    # limit bounds what is broadcast
    rows = docs.select(named(key).alias("id"), named(text).alias("text")).where("text IS NOT NULL").join(F.broadcast(ids), "id")
    rows = written(rows.select("toxic", "text", F.md5(F.col("text").cast("binary")).alias("h")))
    once = rows.groupBy("h").agg(F.max("toxic").alias("toxic")).orderBy("h").limit(limit)
    return rows.drop("toxic").join(F.broadcast(once), "h").groupBy("h").agg(F.first("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic")


def least_chi2(tested: int) -> float:
    """The chi-square that ``FALSE_FEATURES`` of ``tested`` features without a bearing are expected to pass."""
    low, high = 0.0, 1000.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if math.erfc(math.sqrt(middle / 2)) * tested > FALSE_FEATURES else (low, middle)
    return high


def identity_features() -> list[str]:
    """Both terms of every swap as features."""
    return [f"={t}" for t in SWAP]


def _select(rows: DataFrame, n_toxic: int, n: int) -> dict[str, int]:
    """The features with the highest chi-square among those that toxic documents have more often, and all identity terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic: Counter = Counter()
        clean: Counter = Counter()

        def out() -> pa.RecordBatch:
            names = list(toxic.keys() | clean.keys())
            made = [names, [toxic[x] for x in names], [clean[x] for x in names]]
            toxic.clear()
            clean.clear()
            return pa.RecordBatch.from_arrays([pa.array(made[0], pa.string()), *(pa.array(m, pa.int64()) for m in made[1:])], names=["f", "t", "c"])

        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("toxic"), strict=True):
                into = toxic if label.as_py() == 1 else clean
                into.update({c for w in word_counts(text.as_py()) for c in candidates(w)})
                if len(toxic) + len(clean) > 300_000:
                    yield out()
        yield out()

    found = rows.mapInArrow(count, "f string, t long, c long").groupBy("f").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    tested = Observation()
    found = found.observe(tested, F.count("*").alias("n"))
    a, b, d = F.col("t").cast("double"), F.col("c").cast("double"), float(n - n_toxic)
    # with the correction for small counts
    gap = F.greatest(F.abs(a * (d - b) - b * (n_toxic - a)) - n / 2, F.lit(0.0))
    chi2 = n * gap * gap / (n_toxic * max(d, 1.0) * (a + b) * (n - a - b + 1e-9) + 1e-9)
    ranked = found.withColumn("chi2", chi2).where(a * d > b * n_toxic).orderBy(F.desc("chi2"), F.desc(F.length("f")), "f")
    best = ranked.limit(CANDIDATES).collect()
    floor = least_chi2(tested.get["n"])
    best = [r for r in best if r["chi2"] >= floor]
    # a prefix that stands for the same documents as a longer one, or as one word, says nothing more
    by_counts: dict[tuple, list[str]] = {}
    kept: list[str] = []
    for r in best:
        f = r["f"]
        same = by_counts.setdefault((r["t"], r["c"]), [])
        if f[0] == "^" and any(x[1:].startswith(f[1:]) for x in same):
            continue
        same.append(f)
        kept.append(f)
    return {f: i for i, f in enumerate(dict.fromkeys(kept[:MAX_FEATURES] + identity_features()))}


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_rows: int = MAX_TRAINING_ROWS,
) -> Model:
    """The classifier learnt from at most ``max_rows`` labelled documents.

    Without a toxic or without a clean row there is nothing to tell apart: the model then scores every text with
    the share of toxic rows (0 where there are no rows at all).
    """
    spark = docs.sparkSession
    rows = written(training_rows(docs, labels, key, text, label, max_rows))
    n, n_toxic = rows.agg(F.count("*"), F.coalesce(F.sum((F.col("toxic") == 1).cast("int")), F.lit(0))).first()
    if not n_toxic or n_toxic == n:
        share = n_toxic / n if n else 0.0  # as far as that can be told from no rows of one kind
        return Model({}, np.zeros(0), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    chosen = _select(rows, n_toxic, n)
    blank = Model(chosen, np.zeros(2 * len(chosen)), 0.0)
    shared = spark.sparkContext.broadcast(blank)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            ats, values = [], []
            for t in batch.column("text"):
                v = model.vector(word_counts(t.as_py()))
                ats.append(list(v))
                values.append(list(v.values()))
            arrays = [batch.column("toxic"), pa.array(ats, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["toxic", "at", "value"])

    def changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums over the sentences with identity terms of products of the changes that a swap makes."""
        model = shared.value
        gram: dict[tuple[int, int], float] = {}
        for batch in batches:
            for t in batch.column("text"):
                for sentence in _SENTENCE.findall(t.as_py()):
                    counts = word_counts(sentence)
                    if counts.keys().isdisjoint(SWAP):
                        continue
                    x, y = model.vector(counts), model.vector(swapped(counts))
                    d = {i: v for i in x.keys() | y.keys() if (v := x.get(i, 0.0) - y.get(i, 0.0))}
                    for i in d:
                        for j in d:
                            gram[i, j] = gram.get((i, j), 0.0) + d[i] * d[j]
        made = [[i for i, _ in gram], [j for _, j in gram], list(gram.values())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(made[0], pa.int32()), pa.array(made[1], pa.int32()), pa.array(made[2], pa.float64())], names=["i", "j", "s"]
        )

    # at most max_rows rows, and at most as many sums as pairs of features
    sample = rows.mapInArrow(vectors, "toxic int, at array<int>, value array<float>").collect()
    pairs = rows.mapInArrow(changes, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    k = 2 * len(chosen)
    x = np.zeros((len(sample), k + 1), np.float32)
    x[:, k] = 1
    for row, r in zip(x, sample, strict=True):
        row[r["at"]] = r["value"]
    y = np.array([r["toxic"] == 1 for r in sample], float)
    penalty = np.diag([*[RIDGE] * k, 1e-6])
    for i, j, s in pairs:
        penalty[i, j] += COUNTERFACTUAL * s
    w = _newton(x, y, penalty)
    return Model(chosen, w[:k], float(w[k]))


def _newton(x: np.ndarray, y: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Minimises the logistic loss plus half the quadratic penalty."""

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.sum(np.logaddexp(0, z) - y * z) + 0.5 * w @ penalty @ w)

    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        gradient = x.T @ (p - y) + penalty @ w
        hessian = x.T @ (x * (p * (1 - p))[:, None]).astype(np.float32) + penalty
        step, scale = np.linalg.solve(hessian + 1e-6 * np.eye(len(w)), gradient), 1.0
        while scale > 1e-4 and loss(w - scale * step) > loss(w):
            scale /= 2
        w = w - scale * step
        if np.abs(scale * step).max() < 1e-5:
            break
    return w


def classify(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: toxic likelier) and ``predicted`` (1 from ``threshold`` on).

    Null and empty texts have no features and get the score of the bias alone. Repeated rows get equal scores, long
    texts are scored whole, an empty table stays empty, and input columns with one of the two names are replaced.
    """
    base = without(docs, *COLUMNS)
    kept = [c for c in base.columns if keep is None or c in keep]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        judge = shared.value.score
        return lambda texts: [[judge(t.as_py()) for t in texts]]

    scored = with_made(base, kept, [text if text in kept else named(text)], {"score": T.DoubleType()}, make)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return classify(docs, model, keep=["doc_id"]).select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).alias("held_out"), "score", "predicted"
    )
