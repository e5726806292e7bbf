"""The versioned index: refreshed equals new, replays change nothing, searches keep their version, few blocks and cells are read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.operators import search
from quern.sources import index, vector_index, versions
from quern.streaming import refresh

TERMS = ["license", "token", "public"]


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet").select("doc_id", "text").cache()


@pytest.fixture(scope="module")
def built(spark, docs, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("index"))
    index.refresh(spark, at, docs, 0)
    return at


def test_batches_replays_versions_and_compaction(spark, docs, tmp_path):
    at = str(tmp_path / "index")
    first = docs.where("doc_id < 600").withColumn("text", F.when(F.col("doc_id") % 3 == 0, "an old text of license token").otherwise(F.col("text")))
    second = docs.where("doc_id >= 500 or doc_id % 3 = 0").select("doc_id", "text", (F.col("doc_id") % 7 == 0).alias("deleted"))
    live = docs.where("doc_id % 7 <> 0 or doc_id < 500 and doc_id % 3 <> 0")
    one = index.refresh(spark, at, first, 0)
    before = rows(index.search(spark, at, TERMS, 10))
    assert before == rows(search.bm25(first, TERMS, 10))
    two = index.refresh(spark, at, second.union(second), 1)
    assert index.refresh(spark, at, first, 0) == two == index.refresh(spark, at, first, 1)
    assert rows(index.search(spark, at, TERMS, 10)) == rows(search.bm25(live, TERMS, 10))
    assert (two["n"], two["words"]) == tuple(search.postings(live).agg(F.countDistinct("doc_id"), F.sum("tf")).first())
    # a search that has read the first version goes on with it
    assert rows(index.search(spark, at, TERMS, 10, one)) == before
    three = index.compact(spark, at)
    assert len(three["segments"]) == 1 and rows(index.search(spark, at, TERMS, 10)) == rows(search.bm25(live, TERMS, 10))
    assert rows(index.search(spark, at, TERMS, 10, one)) == before
    # what a compacted index is told later counts too
    index.refresh(spark, at, live.where("doc_id % 2 = 0").select("doc_id", F.lit("").alias("text")), 2)
    blank = live.withColumn("text", F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("text")))
    assert rows(index.search(spark, at, TERMS, 10)) == rows(search.bm25(blank, TERMS, 10))
    index.vacuum(spark, at)
    assert versions.numbers(spark, at) == [4] and rows(index.search(spark, at, TERMS, 10)) == rows(search.bm25(blank, TERMS, 10))
    with pytest.raises(versions.Conflict):
        versions.commit(spark, at, 4, {})


def test_a_version_is_seen_only_when_whole(spark, docs, tmp_path, monkeypatch):
    at = str(tmp_path / "index")
    index.refresh(spark, at, docs.where("doc_id < 50"), 0)
    before = rows(index.search(spark, at, TERMS, 5))
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(index.versions, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        index.refresh(spark, at, docs, 1)
    assert rows(index.search(spark, at, TERMS, 5)) == before
    index.refresh(spark, at, docs, 1)
    assert rows(index.search(spark, at, TERMS, 5)) == rows(search.bm25(docs, TERMS, 5))


def test_a_stream_feeds_the_index(spark, docs, tmp_path):
    at, folder = str(tmp_path / "index"), str(tmp_path / "in")
    for part in ("doc_id < 100", "doc_id between 80 and 200"):
        docs.where(part).coalesce(1).write.mode("append").parquet(folder)
        refresh.catch_up(spark, folder, docs.schema, str(tmp_path / "state"), index.as_batches(spark, at))
    assert versions.load(spark, at)["n"] == docs.where("doc_id <= 200").count()
    assert rows(index.search(spark, at, TERMS, 10)) == rows(search.bm25(docs.where("doc_id <= 200"), TERMS, 10))


def test_synchronise_follows_the_documents(spark, docs, tmp_path):
    at, some = str(tmp_path / "index"), docs.where("doc_id < 60")
    one = index.synchronise(spark, at, some)
    assert index.synchronise(spark, at, some) == one
    changed = docs.where("doc_id between 20 and 80").withColumn("text", F.when(F.col("doc_id") == 30, "token token").otherwise(F.col("text")))
    assert index.synchronise(spark, at, changed)["n"] == 61
    assert rows(index.search(spark, at, TERMS, 10)) == rows(search.bm25(changed, TERMS, 10))


@pytest.mark.parametrize("terms", [["the"], ["a", "the"], ["of", "license"], ["nosuchword"], []])
def test_common_terms_need_few_blocks(spark, docs, built, terms, monkeypatch):
    told = {}
    assert rows(index.search(spark, built, terms, 10, told=told)) == (rows(search.bm25(docs, terms, 10)) if terms else [])
    if "the" in terms:
        assert 0 < told["read"] < told["stored"]
    monkeypatch.setattr(index, "LISTED", 0)
    assert rows(index.search(spark, built, terms, 10)) == (rows(search.bm25(docs, terms, 10)) if terms else [])


def test_terms_and_ranges_reach_the_scan(spark, built):
    plan = index.search(spark, built, ["the"], 10)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(term), IsNotNull(range), EqualTo(term,the)" in plan or "EqualTo(term,the)" in plan and "range" in plan.split("PushedFilters")[1][:400]


def test_odd_documents(spark, tmp_path):
    at = str(tmp_path / "index")
    assert index.search(spark, at, ["a"], 3).count() == 0
    index.refresh(spark, at, spark.createDataFrame([], "doc_id long, text string"), 0)
    assert index.search(spark, at, ["a"], 3).count() == 0
    data = [(1, None), (2, ""), (3, "a " * 50_000), (4, "a b"), (4, "a c"), (None, "a a a")]
    index.refresh(spark, at, spark.createDataFrame(data, "doc_id long, text string"), 1)
    assert versions.load(spark, at)["n"] == 4 and [r.doc_id for r in index.search(spark, at, ["a"], 3).collect()] == [3, 4]
    assert index.search(spark, at, ["c"], 3).count() == 1 and index.search(spark, at, ["b"], 3).count() == 0


def test_vectors_are_found_in_few_cells(spark, tmp_path):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, 6000)] + 0.15 * rng.normal(size=(6000, 16))).astype(np.float32)
    data = [(k, v.tolist()) for k, v in enumerate(x)] + [(7000, None), (7001, [0.0] * 16), (7002, [float("nan")] * 16), (7003, [float("inf")] + [0.0] * 15), (7004, x[5].tolist())]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(4).cache()
    at, hits = str(tmp_path / "v"), 0
    version = vector_index.write(df, at)
    assert version["n"] == 6001 and vector_index.synchronise(spark, at, df) == version
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in (0, 5, 77):
        told, about = {}, {}
        query = [float(v) for v in x[q]]
        exact = rows(search.nearest(df.where("vec_id < 6000 or vec_id = 7004"), query, 10))
        assert rows(vector_index.search(spark, at, query, 10, told=told)) == exact
        assert told["cells_read"] < told["cells"] / 2 and told["files_read"] < told["files"] / 2
        found = vector_index.search(spark, at, query, 10, probes=2, told=about)
        hits += len({r[0] for r in rows(found)} & {r[0] for r in exact})
        assert about["cells_read"] == 2
        assert "PartitionFilters: [cell" in found._jdf.queryExecution().executedPlan().toString()
    assert hits >= 27
    assert sorted(np.argsort(-(unit @ unit[77]))[:5].tolist()) == sorted(r[0] for r in rows(vector_index.search(spark, at, [float(v) for v in x[77]], 5)))
    assert vector_index.synchronise(spark, at, df.where("vec_id < 100"))["n"] == 100
    assert vector_index.search(spark, at, [0.0] * 16, 5).count() == 0


def test_recall_on_the_table(spark, sf_dir, tmp_path):
    df = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.1')}/embeddings.parquet")
    at, hits = str(tmp_path / "v"), 0
    cells = len(vector_index.write(df, at)["cells"])
    for r in df.where("vec_id in (0, 500, 1999)").collect():
        query = [float(v) for v in r.embedding]
        exact = rows(search.nearest(df, query, 10))
        assert rows(vector_index.search(spark, at, query, 10)) == exact
        hits += len({x[0] for x in exact} & {x[0] for x in rows(vector_index.search(spark, at, query, 10, probes=max(1, cells - 1)))})
    assert hits >= 27


def test_a_batch_is_dealt_out_once(spark, docs, tmp_path, monkeypatch):
    """Texts of ids that come once aren't shuffled to find that out, and a range's blocks are made by one task (F3 to F6)."""
    assert "Exchange" not in index.changed(docs)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(index, "WORDS_A_TASK", 20_000)
    at = str(tmp_path / "index")
    name = index.refresh(spark, at, docs, 0)["segments"][0]["name"]
    blocks = spark.read.parquet(f"{at}/segments/{name}/blocks").withColumn("file", F.input_file_name())
    assert blocks.select("file").distinct().count() > 1
    assert blocks.groupBy("range").agg(F.countDistinct("file").alias("files")).agg(F.max("files")).first()[0] == 1
    assert rows(index.search(spark, at, TERMS, 10)) == rows(search.bm25(docs, TERMS, 10))


def test_batches_joined_by_a_shuffle_and_repeated_ids(spark, tmp_path, monkeypatch):
    """Of an id that comes more than once the same row holds after every call."""
    data = [(1, "x"), (2, ""), (4, "a b"), (4, "a c"), (5, None)]
    table = spark.createDataFrame(data, "doc_id long, text string")
    for most in (index.MOST_BROADCAST, 0):
        monkeypatch.setattr(index, "MOST_BROADCAST", most)
        at = str(tmp_path / f"index{most}")
        for _ in range(3):
            assert index.synchronise(spark, at, table)["n"] == 4
            assert [index.search(spark, at, [w], 3).count() for w in "abcx"] == [1, 0, 1, 1]
        assert index.synchronise(spark, at, table.where("doc_id <> 1"))["n"] == 3
        assert index.search(spark, at, ["x"], 3).count() == 0
        assert index.synchronise(spark, at, table.where("text = 'a b'"))["words"] == 2
