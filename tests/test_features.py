"""Catalogue features against plain loops, with rows that the tables lack."""

import json
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from quern.functions import dates, issuers, text
from quern.operators import curation, listing, search
from quern.plans import registry
from quern.sources import catalogue
from tests.compare import same


def column(spark, values, expression):
    return [r[0] for r in spark.createDataFrame(list(enumerate(values)), "k int, v string").orderBy("k").select(expression(F.col("v"))).collect()]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def replaced(title, entries, longest=8):
    """Leftmost, then longest, whole words only."""
    parts, out, k = re.findall(r"\w+|\W+", title), "", 0
    while k < len(parts):
        for n in range(2 * longest - 1, 0, -2):
            term = "".join(parts[k : k + n])
            if re.match(r"\w", parts[k]) and k + n <= len(parts) and term in entries:
                out, k = out + entries[term], k + n
                break
        else:
            out, k = out + parts[k], k + 1
    return out


def test_dictionary_of_many_entries(spark, tmp_path):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(60)] + ["data", "act", "보호", "é"]
    phrase = lambda: rng.choice([" ", " ", "-", ", "]).join(rng.choice(words) for _ in range(rng.randint(1, 4)))
    entries = {phrase(): f"<{k}>$1\\" for k in range(400)} | {f"unused {k}": "x" for k in range(100_000)}
    titles = [rng.choice(["", "(", " "]) + " ".join(phrase() for _ in range(rng.randint(0, 5))) + rng.choice(["", ")", "!"]) for _ in range(200)] + ["", None, "dataact data", "  "]
    rows = spark.createDataFrame(list(enumerate(titles)), "id int, title string")
    made = lambda pairs, at: spark.createDataFrame(pairs, "term string, replacement string").write.parquet(str(tmp_path / at)) or spark.read.parquet(str(tmp_path / at))
    table, small = made(list(entries.items()), "large"), made([("a", "b")], "small")
    found = {r.id: r.replaced for r in curation.words_from_table(rows, table).collect()}
    assert found == {k: t if t is None else replaced(t, entries) for k, t in enumerate(titles)}
    assert len(plan_of(curation.words_from_table(rows, table)).splitlines()) == len(plan_of(curation.words_from_table(rows, small)).splitlines())
    assert curation.words_from_table(rows.limit(0), small).count() == 0


KOREAN = ["인공지능기본법 제정안", "인공 지능", "AI기본법과 데이터", "지능", "法律法", "한", "the AI Act, the ai act", None, "", "東京都のデータ 東京", "a b a b a"]


@pytest.mark.parametrize("wanted", ["지능기본", "인공지능", "기본법", "the ai", "AI기본", "법", "法", "法律", "東京", "a b a", "act the", "AI", "nothing", "", "京都"])
def test_phrases_are_found_as_a_scan_finds_them(spark, wanted):
    docs = spark.createDataFrame(list(enumerate(KOREAN)), "doc_id int, text string")
    index = search.positions(docs)
    found = {r.doc_id: r.n for r in search.phrase(index, wanted).collect()}
    unspaced = "[가-힣一-鿿぀-ヿ]"

    def units(t):
        out = []
        for run in re.findall(rf"{unspaced}+|(?:(?!{unspaced})\w)+", (t or "").lower()):
            out += [run[k : k + 2] for k in range(max(1, len(run) - 1))] if re.match(unspaced, run) else [run]
        return out

    asked = units(wanted)
    expected = {}
    for k, t in enumerate(KOREAN):
        own = units(t)
        hits = sum(own[i : i + len(asked)] == asked for i in range(len(own) - len(asked) + 1)) if asked else 0
        if len(asked) == 1 and len(wanted) == 1 and not wanted.isascii():
            hits = sum(wanted in u for u in own)
        if hits:
            expected[k] = hits
    assert found == expected
    if wanted in ("지능기본", "기본법"):
        assert found  # inside an unspaced compound


def test_words_asked_for_reach_the_scan(spark, tmp_path):
    search.positions(spark.createDataFrame(list(enumerate(KOREAN)), "doc_id int, text string")).write.parquet(str(tmp_path / "p"))
    plan = search.phrase(spark.read.parquet(str(tmp_path / "p")), "the ai")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(term), In(term, [ai,the])" in plan or "In(term" in plan


def test_facets_are_counted_under_the_others_in_one_pass(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice(["a", "b", None]), rng.choice(["x", "y", "z"]), rng.choice([None, [], ["t"], ["t", "u", "t"], ["v", None]]), rng.randrange(3)) for k in range(300)]
    docs = spark.createDataFrame(rows, "id int, source string, kind string, topic array<string>, year int")
    chosen = {"source": ["a"], "kind": ["x", "y"], "topic": ["t", "v"], "year": None}
    values = {"source": lambda r: {r[1]}, "kind": lambda r: {r[2]}, "topic": lambda r: set(r[3] or []), "year": lambda r: {str(r[4])}}
    expected = {}
    for f, of in values.items():
        for r in rows:
            if all(not v or values[g](r) & set(v) for g, v in chosen.items() if g != f):
                for v in of(r) - {None}:
                    expected[f, v] = expected.get((f, v), 0) + 1
    out = listing.counts_under_filters(docs, chosen)
    assert {(r.facet, r.value): r.n for r in out.collect()} == expected
    assert listing.counts_under_filters(docs.limit(0), chosen).count() == 0


def test_initials_are_one_sign_as_in_sql(spark, tmp_path):
    """Every letter with another case, some of whose capitals are two or three signs in Spark (F1)."""
    signs = [c for c in map(chr, range(1, 0x1FFFF)) if not "\ud800" <= c <= "\udfff" and (c.upper() != c or c.lower() != c)]
    docs = [(k, c + rest, "en", "src0", 900) for k, (c, rest) in enumerate((c, r) for c in signs for r in ("", "\u0301 b", "x@y"))] + [(-1, None, "en", "src0", None), (-2, "", "en", "src0", 900)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    same(registry.facet_counts_under_filters(spark, str(tmp_path)), db, registry.ORACLES["facet_counts_under_filters"])


def test_one_scan_counts_five_facets(spark, sf_dir):
    from quern.plans import registry

    plan = registry.facet_counts_under_filters(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_the_longest_domain_wins(spark):
    hosts = ["a.gov.kr", "gov.kr", "x.kr", "kr", "notgov.kr", "b.a.gov.kr", "example", "", None, "a..kr"]
    suffixes = spark.createDataFrame([("kr", "KR"), ("GOV.kr", "G"), ("a.gov.kr", "A"), ("kr", "ZZ"), (None, "N")], "suffix string, country string")
    found = {r.host: r.country for r in issuers.by_domain(spark.createDataFrame([(h,) for h in hosts], "host string"), suffixes).collect()}
    assert found == {"a.gov.kr": "A", "gov.kr": "G", "x.kr": "KR", "kr": "KR", "notgov.kr": "KR", "b.a.gov.kr": "A", "a..kr": "KR"}


def test_hosts_without_users_and_ports(spark):
    urls = ["https://u:p@Host.test:8080/x", "//h.test", "http://[::1]:80/", "http://h.test?x=a@b", "HTTP://H.test#a@b:1", "mailto:a@b.test", "", None, " https://h.test:1 "]
    assert column(spark, urls, text.url_host) == ["host.test", "h.test", "[::1]", "h.test", "h.test", "", "", None, "h.test"]


def test_titles_of_any_page(spark):
    pages = ["<TITLE>A</TITLE>", '<title lang="en"\n>A\n B</title >', "<title>1 < 2 &amp; 3&gt;2</title>", "<title>&#65;&#x1F600;&#xD800;&amp;lt;</title>", "<titles>no</titles><title></title>", "", None, "<title>never closed"]
    assert column(spark, pages, text.page_title) == ["A", "A B", "1 < 2 & 3>2", "A\U0001f600�&lt;", "", "", None, ""]


def test_days_that_the_calendar_has(spark):
    given = ["2026-13", "2026-13-45", "2026-02-30", "2024-02-29", "2023-02-29", "2026-00-10", "2026-04-31", "2026-12-31", "2026-05-00"]
    assert column(spark, given, lambda v: dates.label(dates.parse(v))) == ["2026년", "2026년", "2026년 2월", "2024-02-29", "2023년 2월", "2026년", "2026년 4월", "2026-12-31", "2026년 5월"]


def test_summaries_of_several_lines(spark):
    assert column(spark, ["x 핵심내용: one\ntwo", "핵심내용\n\n둘", "핵심내용", "no\nlabel"], text.summary_of) == ["one\ntwo", "둘", "핵심내용", "no\nlabel"]


def test_broken_json_is_told_and_kept(spark, tmp_path):
    good = {"id": "1", "title": "T", "date": {"y": 2026}, "topics": ["a"], "embedding": [1.0, 2]}
    lines = [json.dumps(good), '{"id": "2"', "[]", "null", "{}", json.dumps({"id": 3, "title": ["x"], "date": {"y": "soon"}, "new": {"a": [1]}}), '{"id": null, "url": null}', "", json.dumps({"topics": "one"})]
    (tmp_path / "in.json").write_text("\n".join(lines) + "\n")
    out = catalogue.read_checked(spark, str(tmp_path / "in.json")).collect()
    by = {r.line: r for r in out}
    assert len(out) == 8  # all but the blank line
    assert by[lines[0]].problem is None and by[lines[0]].date.y == 2026 and by[lines[0]].rescued == {}
    assert [by[lines[k]].problem for k in (1, 2, 3)] == ["not JSON", "not an object", "not an object"] and by[lines[1]].id is None
    assert by[lines[4]].problem is None and by[lines[6]].problem is None
    odd = by[lines[5]]
    assert odd.id == "3" and odd.rescued["new"] == '{"a":[1]}' and odd.problem.startswith("other type") and odd.date is None or odd.date.y is None
    assert by[lines[8]].problem == "other type: topics" and by[lines[8]].rescued == {"topics": "one"}
