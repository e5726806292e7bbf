"""The n-gram table grows with the corpus, and joined ratios equal those of one array."""

from quern.llm import quality
from quern.llm.common import read
from tests.llm.test_contracts import llr


def test_buckets_follow_the_corpus(spark, sf_dir):
    """Above the floor, 16 times the text has eight times the buckets; all texts are weighed, none is sampled."""
    docs = read(spark, sf_dir, "documents")
    size = sum(len(r.text.encode()) for r in docs.collect() if r.text)
    assert quality.text_bytes(docs) == size and quality.bucket_number(docs) == quality.BUCKETS
    numbers = [quality._buckets(10**9 * 16**k) for k in range(4)]
    assert numbers[0] > quality.BUCKETS
    assert all(abs(b / a - 8) < 0.001 for a, b in zip(numbers, numbers[1:], strict=False))


def test_joined_ratios(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    docs = docs.union(docs.limit(5)).select("doc_id", "text")  # repeated rows keep one mean
    trusted = quality.trusted_ids(read(spark, sf_dir, "labels"))
    buckets = 1 << 22
    found = quality._scored(docs, trusted, "doc_id", "text", buckets, quality.THRESHOLD, slots=1 << 10).select("doc_id", "llr").collect()
    expected = llr(docs.toPandas(), {r.doc_id for r in trusted.collect()}, buckets)
    assert len(found) == docs.count()
    assert all(abs(r.llr - expected[r.doc_id]) < 1e-9 for r in found)


def test_target_is_counted_on_all_trusted_documents(spark):
    docs = spark.range(25_000).selectExpr("id AS doc_id", "concat('word', id % 7) AS text")
    counts = quality.bucket_counts(docs, spark.range(-10_000, 25_000).selectExpr("id AS doc_id"))
    assert [tuple(r) for r in counts.selectExpr("sum(raw)", "sum(target)").collect()] == [(25_000, 25_000)]


def test_scores_do_not_depend_on_the_order_of_rows(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = quality.trusted_ids(read(spark, sf_dir, "labels"))
    runs = [sorted((r.doc_id, r.llr) for r in quality.score(d, trusted).collect()) for d in (docs, docs.repartition(7), docs.orderBy("text"))]
    assert runs[0] == runs[1] == runs[2]


def test_trusted_ids_beyond_the_bound_are_drawn_by_their_hash(spark, monkeypatch):
    monkeypatch.setattr(quality, "MOST_TRUSTED", 5_000)
    docs = spark.range(25_000).selectExpr("id AS doc_id", "concat('word', id % 7) AS text")
    sums = [quality.bucket_counts(d, spark.range(25_000).selectExpr("id AS doc_id")).selectExpr("sum(raw)", "sum(target)").first() for d in (docs, docs.repartition(5))]
    assert sums[0] == sums[1] and sums[0][0] == 25_000 and 4_600 < sums[0][1] < 5_400
