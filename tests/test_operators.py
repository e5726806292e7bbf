from pyspark.sql import functions as F

from quern.functions import dates, text
from quern.operators import identity, listing, search
from quern.sources import catalogue
from quern.streaming import refresh


def column(spark, values, expression):
    return [r[0] for r in spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string").orderBy("k").select(expression(F.col("v"))).collect()]


def test_external_links(spark):
    assert column(spark, ["http://a", "HTTPS://a", "//a", "/a", "index.html", "mailto:a@b", "", "ftp://a", None], text.is_external) == [True] * 3 + [False] * 6


def test_partial_dates_never_gain_a_day(spark):
    assert column(spark, ["2026", "2026년", "2026-09", "2026-09-15", "soon", None], lambda v: dates.precision(dates.parse(v))) == [1, 1, 2, 3, 0, 0]
    assert column(spark, ["2026", "2026-09", "2026-09-15"], lambda v: dates.label(dates.parse(v))) == ["2026년", "2026년 9월", "2026-09-15"]
    assert column(spark, ["2026", "2026-09", "2026-09-15", "2026-08-31"], lambda v: dates.month_bucket(dates.parse(v))) == ["2026년", "2026년 9월", "2026년 9월", "2026년 8월"]


def test_brackets_of_addresses_stay(spark):
    assert column(spark, ["https://e.test/x(INI)", "https://e.test/x/#a"], text.url_key) == ["e.test/x(INI)", "e.test/x#a"]


def test_only_scheme_and_host_are_the_same_in_any_case(spark):
    assert column(spark, ["HTTP://WWW.E.test/D?id=AbC#P1", "http://e.test/d?id=aBc#p1"], text.url_key) == ["e.test/D?id=AbC#P1", "e.test/d?id=aBc#p1"]


def test_dictionary_words_are_no_patterns(spark):
    assert column(spark, ["a.b axb $1"], lambda v: text.words_replaced(v, {"a.b": "c$1"})) == ["c$1 axb $1"]


def test_of_equal_records_the_earliest_exact_date_survives(spark):
    rows = [(1, 1, "a", 0, "2020"), (1, 2, "b", 0, "2019-05-01"), (1, 3, "c", 0, "2018-07-09"), (2, 4, "a", 0, None), (2, 5, "b", 0, "2021")]
    merged = identity.merge(spark.createDataFrame(rows, "cluster int, id int, source string, priority int, date string"))
    assert sorted((r.cluster, r.id, r.date) for r in merged.collect()) == [(1, 3, "2018-07-09"), (2, 4, "2021")]


def test_titles_told_apart_with_null_and_common_titles(spark):
    rows = [(1, None, "X", None), (2, None, "Y", "B"), *[(k, "T", "X" if k % 2 else "Y", None) for k in range(10, 40)]]
    out = identity.told_apart(spark.createDataFrame(rows, "id int, title string, issuer string, bill_no string"))
    assert {r.id: r.display_title for r in out.collect() if r.id < 12} == {1: None, 2: None, 10: "T (Y)", 11: "T (X)"} and out.count() == 32


def test_facets_are_or_within_and_and_across(spark):
    docs = spark.createDataFrame([(1, "a", ["x", "y"]), (2, "b", ["x"]), (3, "b", ["z"]), (4, None, [])], "id int, source string, topic array<string>")
    ids = lambda chosen: sorted(r.id for r in listing.facet_filter(docs, chosen).collect())
    assert ids({"source": ["a", "b"], "topic": ["x"]}) == [1, 2]
    assert ids({"source": None, "topic": []}) == [1, 2, 3, 4]
    assert {r.topic: r.n for r in listing.facet_counts(docs, "topic").collect()} == {"x": 2, "y": 1, "z": 1}


def test_counts_of_a_facet_sum_to_all(spark, sf_dir):
    docs = catalogue.read_table(spark, sf_dir, "documents")
    assert listing.facet_counts(docs, "source").agg(F.sum("n")).first()[0] == docs.count()


def test_components_do_not_depend_on_the_order_of_edges(spark):
    nodes = spark.createDataFrame([(k,) for k in range(40)], "id int")
    chain = [(k, k + 1) for k in range(0, 30)] + [(35, 36)]
    first = {r.id: r.cluster for r in identity.components(nodes, spark.createDataFrame(chain, "a int, b int")).collect()}
    turned = [(b, a) for a, b in reversed(chain)]
    assert first == {r.id: r.cluster for r in identity.components(nodes, spark.createDataFrame(turned, "a int, b int")).collect()}
    assert first[30] == 0 and first[31] == 31 and first[36] == 35


def test_merging_twice_changes_nothing(spark):
    rows = spark.createDataFrame([(1, "a", 1, "T", "u1"), (2, "b", 0, "the t - x", "u2")], "id int, source string, priority int, original_title string, url string")
    clusters = identity.components(rows, identity.match_edges(rows))
    merged = identity.merge(rows.join(clusters, "id"))
    assert [(r.id, r.url, r.sources, r.n_records) for r in merged.collect()] == [(2, "u2", ["a", "b"], 2)]
    again = merged.withColumn("source", F.col("sources")[0]).withColumn("priority", F.lit(0)).select("id", "source", "priority", "original_title", "url")
    assert identity.components(again, identity.match_edges(again)).count() == 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id int, source string, priority int, original_title string, url string")
    assert identity.components(none, identity.match_edges(none)).count() == 0
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert search.bm25(docs, ["x"], 5).count() == 0 and search.postings(docs).count() == 0


def test_documents_are_read_by_the_declared_schema(spark, tmp_path):
    (tmp_path / "documents.json").write_text('{"id": "1", "title": "T", "date": {"y": 2026}, "summary": "One two", "embedding": [1.0, 0.0]}\n{"id": "2", "unknown": 5}\n')
    docs = catalogue.read_documents(spark, str(tmp_path / "documents.json"))
    assert docs.schema == catalogue.DOCUMENT and docs.count() == 2


def test_a_refresh_takes_each_file_once(spark, tmp_path):
    folder, seen = str(tmp_path / "in"), []
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    rows.write.parquet(folder)
    take = lambda batch, n: seen.extend(r.id for r in batch.collect())
    refresh.catch_up(spark, folder, rows.schema, str(tmp_path / "state"), take)
    spark.createDataFrame([(3, "c")], "id long, v string").write.mode("append").parquet(folder)
    refresh.catch_up(spark, folder, rows.schema, str(tmp_path / "state"), take)
    assert sorted(seen) == [1, 2, 3]


def test_a_stream_counts_days_like_a_batch(spark, sf_dir, tmp_path):
    events = catalogue.read_table(spark, sf_dir, "events")
    events.write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "events"))
    query = refresh.daily_counts(stream, "ts", "event_type").writeStream.outputMode("complete").format("memory").queryName("days").trigger(availableNow=True).start()
    query.awaitTermination()
    both = lambda df: sorted((str(r.day), r.event_type, r.n) for r in df.collect())
    assert both(spark.table("days")) == both(refresh.daily_counts(events, "ts", "event_type"))
