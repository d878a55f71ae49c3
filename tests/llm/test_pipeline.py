"""The pipeline on a small corpus with planted cases, stage by stage, and the registry of queries."""

from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from exhibita.llm import mixing
from exhibita.llm.common import BATCH_BYTES, shared_dir, small_batches


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    rnd = np.random.default_rng(11)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(500)]
    rows, labels = [], []
    for i in range(400):
        text = list(rnd.choice(words, 80))
        toxic = i % 8 == 0
        if toxic:
            text[3] = ("idiotic", "vermin")[i % 16 // 8]
        rows.append((i, " ".join(text), "en", f"src{i % 4}", 0))
        labels.append((i, 1, int(toxic)))
    clean = [r for r in rows if r[0] % 8]
    copies = [(1000 + k, t, "en", "src0", 0) for k, (_, t, *_) in enumerate(clean[:20])]
    near = [(1100 + k, t.rsplit(" ", 1)[0] + " other", "en", "src1", 0) for k, (_, t, *_) in enumerate(clean[20:40])]
    item = " ".join(rnd.choice(words, 25))
    leaks = [(1200 + k, " ".join(rnd.choice(words, 40)) + " " + item.upper(), "en", "src2", 0) for k in range(10)]
    odd = [(1300, None, None, "src3", None), (1301, "", "en", "src3", 0), (None, "no id", "en", "src3", 0), (1302, "w " * 50_000, "en", "src3", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows + copies + near + leaks + odd, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels + [(None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), {"toxic": {r[0] for r in rows if r[0] % 8 == 0}, "clean": {r[0] for r in clean}, "copies": range(1000, 1020), "near": range(1100, 1120), "leaks": range(1200, 1210)}


def test_stages_take_effect_and_keep_the_rest(spark, tables):
    path, planted = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, path).cache()
        assert docs.columns[:5] == columns and (k == 4 or docs.columns == columns)
        kept.append(Counter(r["doc_id"] for r in docs.select("doc_id").collect()))
    after_toxic, after_dedup, after_leaks, mixed, sharded = kept
    assert not planted["toxic"] & set(after_toxic) and planted["clean"] <= set(after_toxic)
    assert not set(planted["copies"]) & set(after_dedup) and planted["clean"] <= set(after_dedup)
    assert len(set(planted["near"]) & set(after_dedup)) <= 1
    assert not set(planted["leaks"]) & set(after_leaks) and set(after_leaks) == set(after_dedup) - set(planted["leaks"])
    assert mixed and set(mixed) <= set(after_leaks)
    assert sharded == mixed
    sizes = Counter(r["shard"] for r in docs.collect())
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 8


def test_run_is_the_stages_in_order(spark, tables):
    path, _ = tables
    out = corpus_pipeline.run(spark, path)
    assert out.columns[-4:] == ["row_number", "position", "shard", "slot"] and out.count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_dedup", "decontamination", "mixing", "sharding"]
    assert set(mixing.WEIGHTS) <= {"src0", "src1", "src2"}


def test_empty_tables(spark, tables, tmp_path):
    path, _ = tables
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_python_gets_small_batches_and_each_text_once(spark, tables, tmp_path, monkeypatch):
    path, _ = tables
    rnd = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{x}" for x in rnd.integers(0, 10**6, 500)), "en", "src0", 0) for i in range(2000)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    frame, seen = type(docs), []

    def watched(self, func, schema, *args, **options):
        seen.append(self.columns)

        def checked(batches):
            def each():
                for batch in batches:
                    if batch.nbytes > 5 << 20:
                        raise ValueError(f"{batch.nbytes} bytes in a batch")
                    yield batch

            yield from func(each())

        return original(self, checked, schema, *args, **options)

    original = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", watched)
    for _, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, docs, path).count() == 2000
    assert seen.count([f"k{i}" for i in range(5)]) == 2


def test_a_session_keeps_its_own_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    other = spark.newSession()
    other.conf.set(key, "1m")
    small_batches(other)
    assert other.conf.get(key) == "1m"
    other = spark.newSession()
    small_batches(other)
    assert int(other.conf.get(key)) == BATCH_BYTES


def test_registry():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if k.startswith("op")} and "pipeline" in names


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[2,1,1024]", "yarn"])
def test_a_cluster_needs_a_shared_folder(master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=context))
