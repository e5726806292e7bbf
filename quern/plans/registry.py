"""Catalogue queries by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.functions import dates, issuers, text
from quern.operators import curation, identity, listing, search
from quern.sources import clusters, index, vector_index
from quern.sources.catalogue import read_checked, read_documents, unified
from quern.sources.catalogue import read_table as table
from quern.sources.shared import kept_folder, scratch
from quern.streaming import refresh

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Registers a function under its name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def inline(rows: list[tuple], names: str) -> str:
    """Rows as a DuckDB table expression."""

    def value(v) -> str:
        return "NULL" if v is None else str(v) if isinstance(v, int | float) else "[" + ", ".join(map(value, v)) + "]" if isinstance(v, list) else "'" + v.replace("'", "''") + "'"

    return f"(VALUES {', '.join('(' + ', '.join(map(value, r)) + ')' for r in rows)}) t({names})"


# ---------------------------------------------------------------- the list


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def facet_count_source(spark, d):
    return listing.facet_counts(table(spark, d, "documents"), "source")


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def facet_count_lang(spark, d):
    return listing.facet_counts(table(spark, d, "documents"), "lang")


@query("SELECT doc_id, lang, source, n_chars FROM documents WHERE source IN ('src0', 'src3') AND lang IN ('en', 'de')")
def facet_filter_lang_source(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return listing.facet_filter(docs, {"lang": ["en", "de"], "source": ["src0", "src3"], "kind": None})


@query("""WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, source) AS place FROM c)
SELECT source, n, place::INTEGER AS place, (SELECT count(*) FROM c) > 5 AS more FROM r WHERE place <= 5""")
def facet_top_values(spark, d):
    return listing.top_values(table(spark, d, "documents"), "source", 5)


FIVE = {"lang": ["en", "de"], "source": ["src0", "src1", "src2", "src5"], "size": ["long", "middle"], "mail": None, "initial": ["A", "E", "T"]}
_FIVE_SQL = {"lang": "lang", "source": "source", "size": "CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 3000 THEN 'middle' ELSE 'long' END", "mail": "CASE WHEN contains(text, '@') THEN 'yes' ELSE 'no' END", "initial": "upper(text[1])"}


def _five_sql() -> str:
    """Each facet counted by itself, under the conditions of the others."""
    tests = {f: f"{f} IN ({', '.join(repr(v) for v in values)})" for f, values in FIVE.items() if values}
    counts = [f"SELECT '{f}' AS facet, {f} AS value, count(*) AS n FROM d WHERE {f} IS NOT NULL AND {' AND '.join(t for g, t in tests.items() if g != f)} GROUP BY {f}" for f in FIVE]
    return f"WITH d AS (SELECT {', '.join(f'{sql} AS {f}' for f, sql in _FIVE_SQL.items())} FROM documents) {' UNION ALL '.join(counts)}"


@query(_five_sql())
def facet_counts_under_filters(spark, d):
    """Five facets over all documents, each counted under the filters of the four others, in one scan."""
    size = F.when(F.col("n_chars") < 500, "short").when(F.col("n_chars") < 3000, "middle").otherwise("long")
    own = {"lang": F.col("lang"), "source": F.col("source"), "size": size, "mail": F.when(F.col("text").contains("@"), "yes").otherwise("no"), "initial": text.upper_sign(F.substring("text", 1, 1))}
    return listing.counts_under_filters(table(spark, d, "documents").select(*[c.alias(n) for n, c in own.items()]), FIVE)


YEARS = range(1995, 2002)


@query("SELECT o_orderpriority, " + ", ".join(f"count(*) FILTER (WHERE year(o_orderdate) = {y}) AS y{y}" for y in YEARS) + " FROM orders GROUP BY o_orderpriority")
def heatmap_priority_year(spark, d):
    return listing.matrix(table(spark, d, "orders"), "o_orderpriority", F.year("o_orderdate"), YEARS)


@query("""WITH c AS (SELECT o_orderpriority, year(o_orderdate)::INTEGER AS year, count(*) AS n FROM orders GROUP BY ALL)
SELECT *, round(n / max(n) OVER (PARTITION BY o_orderpriority), 6) AS density FROM c""")
def heatmap_density(spark, d):
    return listing.density(table(spark, d, "orders"), "o_orderpriority", F.year("o_orderdate"))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1997")
def heatmap_cell_drill(spark, d):
    return listing.cell(table(spark, d, "orders"), "o_orderpriority", "1-URGENT", "o_orderdate", 1997).select("o_orderkey", "o_orderpriority")


@query("""WITH c AS (SELECT year(o_orderdate)::INTEGER AS y, month(o_orderdate)::INTEGER AS m, count(*) AS n FROM orders WHERE o_orderdate IS NOT NULL GROUP BY ALL)
SELECT y, m, y || '년 ' || m || '월' AS label, n, y * 12 + m = max(y * 12 + m) OVER () AS open FROM c""")
def month_buckets(spark, d):
    return listing.months(table(spark, d, "orders"), "o_orderdate")


@query("""WITH c AS (SELECT DISTINCT year(ts)::INTEGER AS y, month(ts)::INTEGER AS m FROM events)
SELECT y || '년 ' || m || '월' AS label, y * 12 + m = max(y * 12 + m) OVER () AS open FROM c""")
def latest_month_flag(spark, d):
    return listing.months(table(spark, d, "events"), "ts").select("label", "open")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 20")
def newest_first_topk(spark, d):
    return listing.ordered(table(spark, d, "orders"), "o_orderdate", "o_orderkey", True, 20).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders ORDER BY orders.o_orderdate, o_orderkey LIMIT 20")
def oldest_first_topk(spark, d):
    return listing.ordered(table(spark, d, "orders"), "o_orderdate", "o_orderkey", False, 20).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("SELECT DISTINCT year(o_orderdate)::INTEGER AS year FROM orders WHERE o_orderdate IS NOT NULL")
def year_jump_list(spark, d):
    return listing.years(table(spark, d, "orders"), "o_orderdate")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 90 DAYS")
def recent_only(spark, d):
    return listing.recent(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", 90).select("o_orderkey")


@query("SELECT doc_id, text, lang, source, n_chars FROM documents WHERE doc_id = 7")
def get_document(spark, d):
    return listing.get_document(table(spark, d, "documents"), 7).select("doc_id", "text", "lang", "source", "n_chars")


@query("""SELECT CASE WHEN grouping(source) = 0 THEN 'source' WHEN grouping(lang) = 0 THEN 'lang' ELSE 'all' END AS facet, coalesce(source, lang) AS value, count(*) AS n, sum(n_chars)::BIGINT AS chars
FROM documents GROUP BY GROUPING SETS ((source), (lang), ())""")
def corpus_stats(spark, d):
    return listing.corpus_stats(table(spark, d, "documents"))


# ---------------------------------------------------------------- links and titles

EXTERNAL = "coalesce(regexp_matches(url, '^https?://', 'i') OR starts_with(url, '//'), false)"
LINKS = [("http://a.test",), ("HTTPS://a.test/x#1",), ("//a.test",), ("/a",), ("index.html",), ("mailto:a@b.test",), ("",), ("ftp://a.test",), (None,)]


@query(f"SELECT page_id, {EXTERNAL} AS external FROM pages")
def external_link_flag(spark, d):
    return table(spark, d, "pages").select("page_id", text.is_external(F.col("url")).alias("external"))


@query(f"SELECT url, CASE WHEN {EXTERNAL} THEN '_blank' END AS target, CASE WHEN {EXTERNAL} THEN 'noopener noreferrer' ELSE 'noopener' END AS rel, nullif(url, '') AS link, {EXTERNAL} AND url IS DISTINCT FROM 'http://a.test' AS apart FROM (SELECT url FROM pages UNION ALL SELECT url FROM {inline(LINKS, 'url')})")
def link_rewrite(spark, d):
    url = F.col("url")
    rows = table(spark, d, "pages").select("url").unionByName(spark.createDataFrame(LINKS, "url string"))
    return rows.select("url", text.link_target(url).alias("target"), text.link_rel(url, F.lit("noopener")).alias("rel"), text.title_link(url).alias("link"), text.opens_apart(url, F.lit("http://a.test")).alias("apart"))


HOST = "lower(string_split(list_last(string_split(string_split_regex(string_split(trim(url), '//')[2], '[/?#]')[1], '@')), ':')[1])"
HOST = f"CASE WHEN url IS NULL THEN NULL WHEN regexp_matches(trim(url), '^(https?:)?//', 'i') THEN {HOST} ELSE '' END"


VISITS = [("?k=law", "#x"), ("", ""), (None, "#top"), ("?a=1&b=2", None)]


@query(f"""SELECT 'index.html' || coalesce(search, '') || coalesce(hash, '') AS url FROM (SELECT search, hash FROM {inline(VISITS, 'search, hash')}
UNION ALL SELECT CASE WHEN strpos(path, '?') > 0 THEN path[strpos(path, '?'):] END, CASE WHEN strpos(url, '#') > 0 THEN url[strpos(url, '#'):] END FROM (SELECT url, string_split(url, '#')[1] AS path FROM pages))""")
def redirect_url(spark, d):
    """Visits with the query and fragment of every page's address."""
    sign = lambda c, part: F.when(part != "", F.concat(F.lit(c), part))
    url = F.col("url")
    rows = table(spark, d, "pages").select(sign("?", text.url_query(url)).alias("search"), sign("#", text.url_fragment(url)).alias("hash"))
    return rows.unionByName(spark.createDataFrame(VISITS, "search string, hash string")).select(text.redirect("index.html", F.col("search"), F.col("hash")).alias("url"))


@query(f"SELECT page_id, {HOST} AS host, regexp_extract(url, '[?]([^#]*)', 1) AS query, regexp_extract(url, '#(.*)$', 1) AS fragment FROM pages")
def url_parts(spark, d):
    url = F.col("url")
    return table(spark, d, "pages").select("page_id", text.url_host(url).alias("host"), text.url_query(url).alias("query"), text.url_fragment(url).alias("fragment"))


ADDRESSES = [
    ("https://www.a.test/doc/1/",), ("http://a.test/doc/1",), ("https://a.test/doc#part1",), ("https://a.test/doc#part2",), ("https://a.test/x(INI)",), (None,),
    ("HTTP://WWW.A.Test/D?id=AbC#P1",), ("http://a.test/d?id=aBc#p1",), ("//A.test",), ("https://a.test/",), ("https://a.test//?q=/",), ("https://a.test/x/#/y/",), ("/Local/Path//",), ("a.test/x",), ("",), ("https://a.test?x=//b.test/",), (" https://a.test/z/ ",),
]


def _url_key_sql(rows: str) -> str:
    """By positions of characters rather than by patterns: the server ends at the first of / ? #, the path at the first of ? #."""

    def first(text: str, signs: str) -> str:
        return "least(" + ", ".join(f"coalesce(nullif(strpos({text}, '{c}'), 0), 1000000)" for c in signs) + ")"

    return f"""SELECT url, lower(CASE WHEN lower(host[1:4]) = 'www.' THEN host[5:] ELSE host END) || rtrim(tail[1:{first("tail", "?#")} - 1], '/') || tail[{first("tail", "?#")}:] AS key FROM (
SELECT url, CASE WHEN pos = 0 THEN '' ELSE body[1:{first("body", "/?#")} - 1] END AS host, CASE WHEN pos = 0 THEN body ELSE body[{first("body", "/?#")}:] END AS tail FROM (
SELECT url, pos, CASE WHEN pos = 0 THEN trim(url) ELSE trim(url)[pos:] END AS body FROM (
SELECT url, CASE WHEN trim(url)[1:2] = '//' THEN 3 WHEN lower(trim(url)[1:7]) = 'http://' THEN 8 WHEN lower(trim(url)[1:8]) = 'https://' THEN 9 ELSE 0 END AS pos FROM {rows})))"""


@query(_url_key_sql(f"(SELECT url FROM pages UNION ALL SELECT url FROM {inline(ADDRESSES, 'url')})"))
def url_key_keep_fragment(spark, d):
    urls = table(spark, d, "pages").select("url").unionByName(spark.createDataFrame(ADDRESSES, "url string"))
    return urls.select("url", text.url_key(F.col("url")).alias("key"))


def _title_key_sql(title: str) -> str:
    return rf"trim(replace(regexp_replace(regexp_replace(lower(trim(regexp_replace({title}, '\s+', ' ', 'g'))), ' [-–—] .*$', ''), '^the ', ''), 'oecd.ai', 'oecdai'))"


TITLES = [("The AI Act",), ("AI Act — final text",), ("ai  act",), ("OECD.AI Principles",), ("OECDAI principles - 2024",), ("Theatre",), (None,)]


def _unescaped_sql(title: str) -> str:
    for name, own in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "''"), ("nbsp", " "), ("#39", "''"), ("amp", "&")):
        title = f"replace({title}, '&{name};', '{own}')"
    return title


#: By positions rather than by a pattern: from the sign that ends the opening tag to the closing one.
_FROM_TITLE = "html[nullif(strpos(translate(html, 'TILE', 'tile'), '<title'), 0):]"
_IN_TITLE = f"{_FROM_TITLE}[strpos({_FROM_TITLE}, '>') + 1:]"
PAGE_TITLE = f"coalesce(trim(regexp_replace({_unescaped_sql(f"{_IN_TITLE}[:strpos(translate({_IN_TITLE}, 'TILE', 'tile'), '</title') - 1]")}, '\\s+', ' ', 'g')), '')"
HEADS = [("<TITLE>One &amp; two</TITLE>",), ('<head><title lang="en">\n A  <b>B</b> &lt;C&gt; </title><title>no</title>',), ("<p>none</p>",), ("<title>It&#39;s</Title >",), ("<title>&amp;lt;</title>",), ("",)]


@query(f"SELECT title, {_title_key_sql('title')} AS key FROM (SELECT {PAGE_TITLE} AS title FROM (SELECT html FROM pages UNION ALL SELECT html FROM {inline(HEADS, 'html')}) UNION ALL SELECT title FROM {inline(TITLES, 'title')})")
def title_key(spark, d):
    heads = table(spark, d, "pages").select("html").unionByName(spark.createDataFrame(HEADS, "html string"))
    titles = heads.select(text.page_title(F.col("html")).alias("title")).unionByName(spark.createDataFrame(TITLES, "title string"))
    return titles.select("title", text.title_key(F.col("title")).alias("key"))


@query("SELECT page_id, url FROM pages WHERE length(url) > 0")
def pages_with_link(spark, d):
    return listing.with_link(table(spark, d, "pages")).select("page_id", "url")


@query(f"SELECT {_title_key_sql(PAGE_TITLE)} AS key, count(*) AS n FROM pages GROUP BY 1")
def title_cluster_counts(spark, d):
    return table(spark, d, "pages").groupBy(text.title_key(text.page_title(F.col("html"))).alias("key")).agg(F.count(F.lit(1)).alias("n"))


MARKED = [("**a** and __b__",), ("plain * text_",), ("__u__**b**",), (None,), ("law and **safety** law",)]


@query(rf"SELECT body, regexp_replace(regexp_replace(body, '\*\*([^*]+)\*\*', '<strong>\1</strong>', 'g'), '__([^_]+)__', '<u>\1</u>', 'g') AS html FROM (SELECT body FROM {inline(MARKED, 'body')} UNION ALL SELECT text || ' **' || source || '** __' || lang || '__' FROM documents)")
def markup_render(spark, d):
    """All documents, with their source in bold and their language underlined."""
    docs = table(spark, d, "documents").select(F.concat("text", F.lit(" **"), "source", F.lit("** __"), "lang", F.lit("__")).alias("body"))
    return docs.unionByName(spark.createDataFrame(MARKED, "body string")).select("body", text.markup(F.col("body")).alias("html"))


SUMMARIES = [("핵심내용: 요약 하나", "", "원문"), ("핵심내용 요약 둘", "new", "old"), ("no label", None, "old"), (None, "  ", None), ("머리말 핵심내용: 첫 줄\n둘째 줄", None, "a\nb"), ("핵심내용\n: 다음 줄", "", ""), ("핵심내용", "x", "y")]


@query(rf"SELECT body, coalesce(nullif(trim(ltrim(CASE WHEN ltrim(body[nullif(strpos(body, '핵심내용'), 0) + 4:], E' \n\t')[1] IN (':', '：') THEN ltrim(body[nullif(strpos(body, '핵심내용'), 0) + 4:], E' \n\t')[2:] ELSE body[nullif(strpos(body, '핵심내용'), 0) + 4:] END, E' \n\t')), ''), body) AS summary, coalesce(nullif(trim(rewritten), ''), original) AS kept FROM (SELECT * FROM {inline(SUMMARIES, 'body, rewritten, original')} UNION ALL SELECT CASE WHEN lang = 'de' THEN source || ' 핵심내용' || CASE WHEN n_chars % 2 = 0 THEN ':' ELSE '' END || E'\n' || text ELSE text END, CASE lang WHEN 'fr' THEN '  ' WHEN 'es' THEN NULL ELSE source END, lang FROM documents)")
def summary_fields(spark, d):
    """All documents, of which German ones have a label before their text, with a colon or without."""
    lang, colon = F.col("lang"), F.when(F.col("n_chars") % 2 == 0, ":").otherwise("")
    body = F.when(lang == "de", F.concat("source", F.lit(" 핵심내용"), colon, F.lit("\n"), "text")).otherwise(F.col("text"))
    docs = table(spark, d, "documents").select(body.alias("body"), F.when(lang == "fr", "  ").when(lang != "es", F.col("source")).alias("rewritten"), lang.alias("original"))
    rows = docs.unionByName(spark.createDataFrame(SUMMARIES, "body string, rewritten string, original string"))
    return rows.select("body", text.summary_of(F.col("body")).alias("summary"), text.kept_summary(F.col("rewritten"), F.col("original")).alias("kept"))


SCRIPTS = [("인공지능법", "An English summary"), ("인공지능법", "한글 요약"), ("AI Act", "An English summary"), ("혼합 AI", "mixed 요약")]


@query(f"SELECT title, summary, regexp_matches(title, '[가-힣]') AND regexp_matches(summary, '[A-Za-z]') AND NOT regexp_matches(summary, '[가-힣]') AS foreign_summary FROM (SELECT * FROM {inline(SCRIPTS, 'title, summary')} UNION ALL SELECT CASE WHEN lang = 'en' THEN source ELSE '문서 ' || source END, CASE WHEN lang = 'fr' THEN '요약 ' || text ELSE text END FROM documents)")
def foreign_summaries(spark, d):
    """All documents, with Korean titles but for English ones, and a Korean word before French texts."""
    lang = F.col("lang")
    title = F.when(lang == "en", F.col("source")).otherwise(F.concat(F.lit("문서 "), "source"))
    docs = table(spark, d, "documents").select(title.alias("title"), F.when(lang == "fr", F.concat(F.lit("요약 "), "text")).otherwise(F.col("text")).alias("summary"))
    return docs.unionByName(spark.createDataFrame(SCRIPTS, "title string, summary string")).select("title", "summary", text.only_summary_foreign(F.col("title"), F.col("summary")).alias("foreign_summary"))


# ---------------------------------------------------------------- dates

PATHS = [("https://a.test/2025/11/news.html",), ("https://a.test/2024/03/09/",), ("https://a.test/en/2093/",), ("https://a.test/2025/13/",), ("",), (None,), ("https://a.test/2025/110/",), ("https://a.test/2025/11",), ("https://a.test/2025/11/45/x",), ("https://a.test/x?at=/2025/11/",), ("https://a.test/2025/07?p=1",), ("https://a.test/12025/11/",), ("https://a.test/2024/02/30/",), ("/2023/05/06#a",)]


@query(f"""WITH p AS (SELECT url, string_split(regexp_replace(url, '[?#].*$', ''), '/') AS parts FROM (SELECT url FROM pages UNION ALL SELECT url FROM {inline(PATHS, 'url')})),
f AS (SELECT url, parts, list_min(list_filter(range(2, len(parts)), lambda k: regexp_full_match(parts[k], '20[0-9][0-9]') AND regexp_full_match(parts[k + 1], '0[1-9]|1[0-2]'))) AS k FROM p)
SELECT url, parts[k]::INTEGER AS y, parts[k + 1]::INTEGER AS m, CASE WHEN regexp_full_match(parts[k + 2], '[0-9][0-9]') AND try_cast(parts[k] || '-' || parts[k + 1] || '-' || parts[k + 2] AS DATE) IS NOT NULL THEN parts[k + 2]::INTEGER END AS d FROM f""")
def url_path_date(spark, d):
    date = dates.from_url_path(F.col("url"))
    urls = table(spark, d, "pages").select("url").unionByName(spark.createDataFrame(PATHS, "url string"))
    return urls.select("url", *[date[c].alias(c) for c in ("y", "m", "d")])


METAS = [
    ('<meta property="article:published_time" content="2025-11-03T10:00">',),
    ('<meta name="date" content="2024-07">',),
    ('<meta name="author" content="2020-01-01">',),
    ('<meta content="2023-02-01" name="date">',),
    ("<META itemprop='datePublished' content='2022-12-31'/>",),
    ('<meta name=date content=2021-06-05>',),
    ('<meta name="date" content="soon"><meta property="og:published_time" content="2019-01-02">',),
    ('<meta name="dateline" content="2018-01-01"><p>date content="2017-01-01"</p>',),
    ('<meta name="date"><p content="2016-01-01">',),
    ('<meta name="date" content="2024-19-77">',),
    ('<meta name="date" content="2023-02-29"/>',),
    ('<meta name="date" content="2024-02-29"/>',),
    (None,),
]
#: Each attribute of an element as one [name, value] pair, which tells nothing of their order or quotes.
META_SQL = r"""WITH m AS (SELECT html, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*>')) AS e FROM rows),
o AS (SELECT html, e, strpos(html, e) AS pos, regexp_extract_all(e, '([A-Za-z]+)\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1) AS k, list_transform(regexp_extract_all(e, '([A-Za-z]+)\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 2), lambda v: trim(v, '"'' /')) AS v FROM m),
d AS (SELECT html, pos, list_extract(v, list_position(list_transform(k, lambda x: lower(x)), 'content')) AS c FROM o
  WHERE len(list_filter(range(1, len(k) + 1), lambda j: lower(k[j]) IN ('name', 'property', 'itemprop') AND (lower(v[j]) IN ('date', 'datepublished') OR ends_with(lower(v[j]), 'published_time')))) > 0),
f AS (SELECT html, arg_min(c, pos) AS c FROM d WHERE regexp_matches(c, '^[0-9]{4}-[0-9]{2}') GROUP BY html)
SELECT rows.html, c[1:4]::INTEGER AS y, CASE WHEN c[6:7] BETWEEN '01' AND '12' THEN c[6:7]::INTEGER END AS m, day(try_cast(c[1:10] AS DATE))::INTEGER AS d FROM rows LEFT JOIN f ON f.html = rows.html"""


@query(META_SQL.replace("WITH m", f"WITH rows AS (SELECT html FROM pages UNION ALL SELECT html FROM {inline(METAS, 'html')}), m", 1))
def html_meta_date(spark, d):
    date = dates.from_html_meta(F.col("html"))
    pages = table(spark, d, "pages").select("html").unionByName(spark.createDataFrame(METAS, "html string"))
    return pages.select("html", *[date[c].alias(c) for c in ("y", "m", "d")])


@query("""WITH o AS (SELECT year(o_orderdate)::INTEGER AS y, CASE WHEN o_orderpriority <> '5-LOW' THEN month(o_orderdate)::INTEGER END AS m FROM orders WHERE o_orderdate IS NOT NULL)
SELECT y, m, CASE WHEN m IS NULL THEN y || '년' ELSE y || '년 ' || m || '월' END AS label, count(*) AS n FROM o GROUP BY y, m""")
def month_or_year_buckets(spark, d):
    """Orders of low priority as if only their year were known."""
    day = F.col("o_orderdate")
    known = F.col("o_orderpriority") != "5-LOW"
    date = dates.partial(F.year(day), F.when(known, F.month(day)), F.when(known, F.day(day)))
    return listing.date_buckets(table(spark, d, "orders").select(date.alias("date")), "date")


DATED = [
    (1, "bulk", "2020-08-04", "2017", None, None),
    (2, "bulk", "2019-05-01", None, None, None),
    (3, "bulk", "2020-11-04", "2018", "2018-06-05", None),
    (4, "confirmed", "2024-02-03", None, None, "2024-03-01"),
    (5, "confirmed", "2024", None, None, "2024-03-01"),
    (6, "confirmed", None, None, None, "2023-12-31"),
    (7, "posted", "2025-01-01", "2021-04-05", None, None),
    (8, "posted", "2025-01-01", None, None, None),
    (9, "text", "2026년", None, None, None),
]
#: Dates are split at hyphens; which column counts follows from how much of each is known.
DATED_SQL = f"""WITH rows AS (SELECT * FROM {inline(DATED, 'id, source, stated, original, other, added')} UNION ALL SELECT o_orderkey + 1000, CASE o_orderstatus WHEN 'F' THEN 'bulk' WHEN 'O' THEN 'confirmed' ELSE 'posted' END,
  CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y') WHEN o_orderpriority = '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y-%m-%d') END,
  CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y년') END, CASE WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%Y-%m') END, CASE WHEN o_orderkey % 5 > 0 THEN strftime(o_orderdate, '%Y-%m-01') END FROM orders),
long AS (SELECT id, c, string_split(replace(t, '년', ''), '-') AS p FROM (SELECT id, unnest(['stated', 'original', 'other', 'added']) AS c, unnest([stated, original, other, added]) AS t FROM rows) WHERE t IS NOT NULL),
dated AS (SELECT id, c, p[1]::INTEGER AS y, p[2]::INTEGER AS m, p[3]::INTEGER AS d, len(p) AS k FROM long),
known AS (SELECT id, source, coalesce(max(k) FILTER (WHERE c = 'stated' AND NOT (source = 'bulk' AND (y, m, d) IN ((2020, 8, 4), (2020, 11, 4)))), 0) AS ks, coalesce(max(k) FILTER (WHERE c = 'original'), 0) AS ko,
  coalesce(max(k) FILTER (WHERE c = 'other'), 0) AS kr FROM rows LEFT JOIN dated USING (id) GROUP BY id, source),
chosen AS (SELECT id, CASE source WHEN 'bulk' THEN CASE WHEN kr > CASE WHEN ko > 0 THEN ko ELSE ks END THEN 'other' WHEN ko > 0 THEN 'original' WHEN ks > 0 THEN 'stated' END
  WHEN 'confirmed' THEN CASE WHEN ks = 3 THEN 'stated' ELSE 'added' END WHEN 'posted' THEN 'original' ELSE 'stated' END AS c FROM known)
SELECT id, y, m, d, CASE k WHEN 3 THEN y || '-' || lpad(m::VARCHAR, 2, '0') || '-' || lpad(d::VARCHAR, 2, '0') WHEN 2 THEN y || '년 ' || m || '월' WHEN 1 THEN y || '년' END AS label FROM chosen LEFT JOIN dated USING (id, c)"""


@query(DATED_SQL)
def partial_date_resolution(spark, d):
    """All orders as if their dates were known as far as their priority tells. bulk: upload days of a whole collection don't count; confirmed: to the day, else added on; posted: a post's day never counts."""
    day, key, urgent = F.col("o_orderdate"), F.col("o_orderkey"), F.col("o_orderpriority")
    source = F.when(F.col("o_orderstatus") == "F", "bulk").when(F.col("o_orderstatus") == "O", "confirmed").otherwise("posted")
    stated = F.when(urgent == "5-LOW", F.date_format(day, "yyyy")).when(urgent == "3-MEDIUM", F.date_format(day, "yyyy-MM")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    more = [F.when(key % 3 == 0, F.date_format(day, "yyyy년")), F.when(key % 4 == 0, F.date_format(day, "yyyy-MM")), F.when(key % 5 > 0, F.date_format(day, "yyyy-MM-01"))]
    orders = table(spark, d, "orders").select((key + 1000).alias("id"), source.alias("source"), stated.alias("stated"), *[c.alias(n) for c, n in zip(more, ("original", "other", "added"), strict=True)])
    rows = orders.unionByName(spark.createDataFrame(DATED, "id long, source string, stated string, original string, other string, added string"))
    rows = rows.withColumns({c: dates.parse(F.col(c)) for c in ("stated", "original", "other", "added")})
    stated, original, other, added = (F.col(c) for c in ("stated", "original", "other", "added"))
    bulk = dates.not_bulk(stated, [(2020, 8, 4), (2020, 11, 4)])
    date = F.when(F.col("source") == "bulk", dates.most_exact(F.coalesce(original, bulk), other)).when(F.col("source") == "confirmed", dates.confirmed_or_added(stated, added)).when(F.col("source") == "posted", original).otherwise(stated)
    rows = rows.withColumn("date", date.cast(dates.PARTIAL))
    return rows.select("id", *[F.col("date")[c].alias(c) for c in ("y", "m", "d")], dates.label(F.col("date")).alias("label"))


# ---------------------------------------------------------------- curation and issuers

OFFICES = [("서울특별시교육청",), ("교육부·서울교육청",), ("부산광역시",), ("State of California",), ("City of New York",), ("Norwegian Ministry of Local Government and Regional Development",), ("上海市人民政府",), ("Ministry of Science",), ("서울대학교",), ("Stanford University",), ("한국전자통신연구원",), ("Lawrence Berkeley National Laboratory",), ("LG",), ("CJ",), ("Example Corp.",), ("(주)예시",), ("Incheon Office",), (None,)]
OFFICE_SQL = "CASE WHEN issuer IS NULL THEN NULL WHEN regexp_matches(issuer, '교육부.*교육청|Ministry of Local Government') THEN 'central' WHEN regexp_matches(issuer, '교육청|광역시|특별시|(State|City|County) of |Municipal|(省|市)人民政府|Provincial (People''s )?Government|Alberta') THEN 'regional' WHEN contains(issuer, '대학교') OR list_has_any(string_split_regex(issuer, '[^A-Za-z]+'), ['University', 'College']) THEN 'university' WHEN regexp_matches(issuer, '연구[소원]') OR list_has_any(string_split_regex(issuer, '[^A-Za-z]+'), ['Lab', 'Laboratory', 'Laboratories']) THEN 'lab' WHEN issuer LIKE '%주식회사%' OR issuer LIKE '%(주)%' OR list_has_any(string_split_regex(issuer, '[^A-Za-z]+'), ['Inc', 'Corp', 'Corporation', 'Ltd', 'LLC', 'LG', 'CJ']) THEN 'company' ELSE 'central' END"


@query(f"SELECT issuer, {OFFICE_SQL} AS level FROM (SELECT issuer FROM {inline(OFFICES, 'issuer')} UNION ALL SELECT CASE s_suppkey % 4 WHEN 0 THEN 'City of ' || n_name WHEN 1 THEN n_name || ' University' WHEN 2 THEN s_name || ' Ltd' ELSE s_name END FROM supplier JOIN nation ON s_nationkey = n_nationkey)")
def issuer_level(spark, d):
    """All suppliers under names that tell what they are."""
    rows, k = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")), F.col("s_suppkey") % 4
    name = F.when(k == 0, F.concat(F.lit("City of "), "n_name")).when(k == 1, F.concat("n_name", F.lit(" University"))).when(k == 2, F.concat("s_name", F.lit(" Ltd"))).otherwise(F.col("s_name"))
    return rows.select(name.alias("issuer")).unionByName(spark.createDataFrame(OFFICES, "issuer string")).select("issuer", issuers.level(F.col("issuer")).alias("level"))


PLACES = [(1, "Parliament", None, "https://p.test/1"), (2, "Agency", " ", "https://other.test/"), (3, "Agency", "KR", "https://p.test/2"), (4, None, None, None)]
HOSTS, ISSUERS = [("p.test", "EU"), ("m.example.com", "KR")], [("Agency", "US"), ("Parliament", "XX")]


@query(f"""SELECT p.id, coalesce(nullif(trim(p.country), ''), h.country, i.country) AS country FROM (SELECT id, issuer, country, url FROM {inline(PLACES, 'id, issuer, country, url')} UNION ALL SELECT page_id + 1000, CASE WHEN page_id % 2 = 0 THEN 'Agency' END, CASE WHEN page_id % 5 = 0 THEN 'FR' END, CASE WHEN page_id % 3 = 0 THEN 'http://m.example.com:80/' ELSE url END FROM pages) p
LEFT JOIN {inline(HOSTS, 'host, country').replace(' t(', ' h(')} ON string_split(split_part(p.url, '/', 3), ':')[1] = h.host LEFT JOIN {inline(ISSUERS, 'issuer, country').replace(' t(', ' i(')} ON p.issuer = i.issuer""")
def country_repair(spark, d):
    """All pages, of which every third has an address that tells its country, and every second a known issuer."""
    n = F.col("page_id")
    url = F.when(n % 3 == 0, "http://m.example.com:80/").otherwise(F.col("url"))
    pages = table(spark, d, "pages").select((n + 1000).alias("id"), F.when(n % 2 == 0, "Agency").alias("issuer"), F.when(n % 5 == 0, "FR").alias("country"), url.alias("url"))
    rows = pages.unionByName(spark.createDataFrame(PLACES, "id long, issuer string, country string, url string"))
    hosts = spark.createDataFrame(HOSTS, "host string, country string")
    names = spark.createDataFrame(ISSUERS, "issuer string, country string")
    return issuers.fill_country(rows, hosts, names, text.url_host(F.col("url"))).select("id", "country")


DOMAINS = [("example.com", "US"), ("Example.net", "FR"), ("example.org", "KR"), ("org", "XX"), ("m.example.com", "YY"), ("le.com", "ZZ"), ("example.com", "ZW"), ("blog.ththan.example.net", "DE"), ("therin.example.net", "JP")]
ODD_HOSTS = [(-1, "https://user:pw@www.example.com:8080/x"), (-2, "//EXAMPLE.org"), (-3, "http://notexample.com/"), (-4, "http://a.b.m.example.com?x=@example.net"), (-5, "mailto:a@example.com"), (-6, None), (-7, "http://example.com.evil.test:80#example.com")]


@query(f"""WITH p AS (SELECT id, {HOST} AS host FROM (SELECT page_id AS id, url FROM pages UNION ALL SELECT id, url FROM {inline(ODD_HOSTS, 'id, url')})),
m AS (SELECT id, country, row_number() OVER (PARTITION BY id ORDER BY length(suffix) DESC, country) AS n FROM p JOIN (SELECT lower(suffix) AS suffix, country FROM {inline(DOMAINS, 'suffix, country')}) s ON host = suffix OR host LIKE '%.' || suffix)
SELECT p.id, p.host, m.country FROM p LEFT JOIN m ON m.id = p.id AND m.n = 1""")
def country_by_address(spark, d):
    """Every page's country by the most specific domain entry."""
    rows = table(spark, d, "pages").select(F.col("page_id").alias("id"), "url").unionByName(spark.createDataFrame(ODD_HOSTS, "id long, url string"))
    rows = rows.select("id", text.url_host(F.col("url")).alias("host"))
    return rows.join(issuers.by_domain(rows, spark.createDataFrame(DOMAINS, "suffix string, country string")), "host", "left").select("id", "host", "country")


TOPICS = [(1, ["윤리·규범", "법", "가이드라인", "표준", "딥페이크"]), (2, ["국가안보", "피지컬AI"]), (3, ["법"])]


@query(f"SELECT id, array_to_string(list_filter(topics, lambda x: x NOT IN ('윤리·규범', '법', '가이드라인', '표준')), ',') AS topics FROM (SELECT * FROM {inline(TOPICS, 'id, topics')} UNION ALL SELECT doc_id + 1000, [lang, '법', source, CASE WHEN n_chars > 1000 THEN '표준' ELSE '딥페이크' END] FROM documents)")
def topic_minus_kind(spark, d):
    """All documents, with their language and source as topics beside a kind's."""
    more = F.when(F.col("n_chars") > 1000, "표준").otherwise("딥페이크")
    docs = table(spark, d, "documents").select((F.col("doc_id") + 1000).alias("id"), F.array("lang", F.lit("법"), "source", more).alias("topics"))
    return docs.unionByName(spark.createDataFrame(TOPICS, "id long, topics array<string>")).select("id", F.array_join(curation.topics_without_kinds(F.col("topics")), ",").alias("topics"))


RULES = {"(?i)licen[cs]e": 2.0, "(?i)token": 1.0, "@": 1.0}


@query("""WITH s AS (SELECT doc_id, CASE WHEN regexp_matches(text, 'licen[cs]e', 'i') THEN 2.0 ELSE 0.0 END + CASE WHEN regexp_matches(text, 'token', 'i') THEN 1.0 ELSE 0.0 END + CASE WHEN regexp_matches(text, '@') THEN 1.0 ELSE 0.0 END AS score FROM documents)
SELECT doc_id, score::DOUBLE AS score FROM s WHERE score >= 1 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)""")
def relevance_filter(spark, d):
    decisions = table(spark, d, "labels").select("doc_id", (F.col("quality") != 0).alias("keep"))
    return curation.relevant(table(spark, d, "documents"), decisions, RULES, 1.0).select("doc_id", "score")


# ---------------------------------------------------------------- identity


@query("""SELECT min(doc_id) AS doc_id, count(*) AS n, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM documents GROUP BY text""")
def merge_exact_duplicates(spark, d):
    return identity.exact_duplicates(table(spark, d, "documents").select("doc_id", "source", "text"))


EDGES = [(5, 4), (4, 3), (3, 1), (7, 8), (8, 9), (9, 7), (10, 10)]
NODES = [(n,) for n in range(1, 12)]


@query(f"""WITH RECURSIVE e AS (SELECT a, b FROM {inline(EDGES, 'a, b')} UNION ALL SELECT b, a FROM {inline(EDGES, 'a, b')}),
r AS (SELECT id, id AS place FROM {inline(NODES, 'id')} UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.place)
SELECT id, min(place) AS cluster FROM r GROUP BY id UNION ALL SELECT s_suppkey + 1000, min(s_suppkey) OVER (PARTITION BY s_nationkey) + 1000 FROM supplier""")
def identity_components(spark, d):
    """All suppliers, each linked to the next of its nation."""
    rows = table(spark, d, "supplier").select((F.col("s_suppkey") + 1000).alias("id"), "s_nationkey")
    after = F.lead("id").over(Window.partitionBy("s_nationkey").orderBy("id"))
    edges = rows.select(after.alias("a"), F.col("id").alias("b")).where("a is not null").unionByName(spark.createDataFrame(EDGES, "a long, b long"))
    return identity.components(rows.select("id").union(spark.createDataFrame(NODES, "id long")), edges)


RECORDS = [
    (1, "curated", 2, "The AI Act", "https://c.test/1", None, None),
    (2, "official", 0, "AI Act - final", "https://o.test/act", "2024-06-13", "text"),
    (3, "official", 0, "ISO 1", "https://iso.test/s#1", "2020", None),
    (4, "official", 0, "ISO 2", "https://iso.test/s#2", "2021", None),
    (5, "official", 1, "Statute (html)", "https://uk.test/s.html", "2019", "html"),
    (6, "official", 2, "Statute (pdf)", "https://uk.test/s.pdf", "2019", None),
    (7, "added", 1, "Right original", "https://x.test/same", None, None),
    (8, "official", 0, "Other document", "https://x.test/same", "2018", None),
]
SAME, APART = [(6, 5)], [(7, 8)]
MERGE_SQL = f"""WITH RECURSIVE rec AS (SELECT * FROM {inline(RECORDS, 'id, source, priority, title, url, date, summary')} UNION ALL SELECT page_id + 1000, {HOST}, page_id % 3, {PAGE_TITLE}, url, CASE page_id % 4 WHEN 0 THEN '2020-01-' || lpad((page_id % 28 + 1)::VARCHAR, 2, '0') WHEN 1 THEN '2019' END, NULL FROM pages),
held AS (SELECT unnest([a, b]) AS id FROM {inline(APART, 'a, b')}),
keyed AS (SELECT id, 't' || {_title_key_sql("title")} AS k FROM rec WHERE id NOT IN (SELECT id FROM held) UNION SELECT id, 'u' || key FROM rec JOIN (SELECT DISTINCT * FROM ({_url_key_sql("rec")})) u ON u.url = rec.url WHERE id NOT IN (SELECT id FROM held)),
e AS (SELECT x.id AS a, y.id AS b FROM keyed x JOIN keyed y USING (k) UNION SELECT a, b FROM {inline(SAME, 'a, b')} UNION SELECT b, a FROM {inline(SAME, 'a, b')}),
r AS (SELECT id, id AS place FROM rec UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.place), c AS (SELECT id, min(place) AS cluster FROM r GROUP BY id),
o AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY priority, CASE WHEN length(date) = 10 THEN date END NULLS LAST, id) AS n FROM rec JOIN c USING (id))
SELECT max(id) FILTER (WHERE n = 1) AS id, arg_min(date, n) FILTER (WHERE date IS NOT NULL) AS date, arg_min(url, n) FILTER (WHERE url IS NOT NULL) AS url, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, count(*) AS n_records FROM o GROUP BY cluster"""


@query(MERGE_SQL)
def identity_merge(spark, d):
    """All pages as records of their hosts, some with a day and some with a year, beside others with given and forbidden pairs."""
    n, url = F.col("page_id"), F.col("url")
    date = F.when(n % 4 == 0, F.format_string("2020-01-%02d", n % 28 + 1)).when(n % 4 == 1, "2019")
    pages = table(spark, d, "pages").select((n + 1000).alias("id"), text.url_host(url).alias("source"), (n % 3).cast("int").alias("priority"), text.page_title(F.col("html")).alias("original_title"), "url", date.alias("date"), F.lit(None).cast("string").alias("summary"))
    rows = pages.unionByName(spark.createDataFrame(RECORDS, "id long, source string, priority int, original_title string, url string, date string, summary string"))
    same, apart = spark.createDataFrame(SAME, "a int, b int"), spark.createDataFrame(APART, "a int, b int")
    clusters = identity.kept_apart(rows, identity.match_links(rows, same), apart)
    merged = identity.merge(rows.join(clusters, "id"))
    return merged.select("id", "date", "url", F.array_join("sources", ",").alias("sources"), "n_records")


BILLS = [(1, "AI Bill", "House", "H.R. 1"), (2, "AI Bill", "Senate", "S. 2"), (3, "AI Principles", "LG", None), (4, "AI Principles", "CJ", None), (5, "Alone", "X", "H.R. 9"), (6, "Twice", "Y", None), (7, "Twice", "Y", None)]


@query(f"""WITH t AS (SELECT * FROM {inline(BILLS, 'id, title, issuer, bill_no')} UNION ALL SELECT doc_id + 1000, lang || ' ' || n_chars % 50, source, CASE WHEN n_chars % 7 = 0 THEN 'No. ' || doc_id END FROM documents),
k AS (SELECT title, count(*) AS n, count(DISTINCT issuer) AS k FROM t GROUP BY title)
SELECT id, CASE WHEN n > 1 AND bill_no IS NOT NULL THEN title || ' (' || bill_no || ')' WHEN n > 1 AND k > 1 THEN title || ' (' || issuer || ')' ELSE title END AS display_title FROM t JOIN k USING (title)""")
def name_collision_suffix(spark, d):
    """All documents under titles that many share."""
    number = F.when(F.col("n_chars") % 7 == 0, F.concat(F.lit("No. "), F.col("doc_id").cast("string")))
    docs = table(spark, d, "documents").select((F.col("doc_id") + 1000).alias("id"), F.concat("lang", F.lit(" "), (F.col("n_chars") % 50).cast("string")).alias("title"), F.col("source").alias("issuer"), number.alias("bill_no"))
    return identity.told_apart(docs.unionByName(spark.createDataFrame(BILLS, "id long, title string, issuer string, bill_no string"))).select("id", "display_title")


@query("SELECT doc_id AS id, 'documents' AS source, lang, NULL::VARCHAR AS url FROM documents UNION ALL SELECT page_id, 'pages', NULL, url FROM pages")
def multi_source_union(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang")
    pages = table(spark, d, "pages").select(F.col("page_id").alias("id"), "url")
    return unified({"documents": docs, "pages": pages}).select("id", "source", "lang", "url")


PAGES_SQL = f"""rec AS (SELECT page_id AS id, {PAGE_TITLE} AS title, url, {HOST} AS source, CASE WHEN url LIKE 'https:%' THEN 0 ELSE 1 END AS priority FROM pages),
keyed AS (SELECT id, 't' || {_title_key_sql("title")} AS k FROM rec WHERE {_title_key_sql("title")} <> '' UNION SELECT id, 'u' || key FROM rec JOIN (SELECT DISTINCT * FROM ({_url_key_sql("pages")})) u ON u.url = rec.url WHERE key <> ''),
least AS (SELECT k, min(id) AS b FROM keyed GROUP BY k), e AS (SELECT id AS a, b FROM keyed JOIN least USING (k) UNION SELECT b, id FROM keyed JOIN least USING (k)),
r AS (SELECT id, id AS place FROM rec UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.place), c AS (SELECT id, min(place) AS cluster FROM r GROUP BY id)"""


def _page_records(spark, d):
    url, html = F.col("url"), F.col("html")
    return table(spark, d, "pages").select(F.col("page_id").alias("id"), text.page_title(html).alias("original_title"), "url", text.url_host(url).alias("source"), F.when(url.startswith("https:"), 0).otherwise(1).alias("priority"))


@query(f"WITH RECURSIVE {PAGES_SQL} SELECT id, cluster FROM c")
def identity_pages(spark, d):
    """All pages, linked by title and address."""
    records = _page_records(spark, d)
    return identity.components(records, identity.match_edges(records))


@query(f"WITH RECURSIVE {PAGES_SQL} SELECT id, cluster FROM c")
def identity_upkeep_pages(spark, d):
    """The same kept up by three batches of pages, the last of which comes twice."""
    records, at = _page_records(spark, d), scratch(spark, "clusters")
    batch = lambda i: F.pmod(F.xxhash64(i), F.lit(3))
    edges = identity.match_edges(records)
    for k in (0, 1, 2, 2):  # a link comes with the later of its records
        clusters.refresh(spark, at, records.where(batch("id") == k), edges.where(F.greatest(batch("a"), batch("b")) == k), k)
    return clusters.labels(spark, at)


@query(f"""WITH t AS (SELECT page_id AS id, {_title_key_sql(PAGE_TITLE)} AS key FROM pages), n AS (SELECT *, count(*) OVER w AS n, min(id) OVER w AS low, max(id) OVER w AS high FROM t WINDOW w AS (PARTITION BY key))
SELECT id, CASE WHEN key = '' OR n = 1 OR id = high THEN id ELSE low END AS cluster FROM n""")
def identity_apart_pages(spark, d):
    """Pages of one title, of which the last isn't the same as the first or the second: it alone leaves the cluster, and all others keep their links."""
    records = _page_records(spark, d).withColumn("url", F.lit(None).cast("string"))
    links = identity.match_links(records)
    titled = records.select("id", text.title_key(F.col("original_title")).alias("key")).where("key <> ''")
    ids = titled.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b"))
    second = titled.join(ids, "key").where("id > a and id < b").groupBy("key", "b").agg(F.min("id").alias("a"))
    apart = ids.where("a < b").select("a", "b").union(second.select("a", "b"))
    return identity.kept_apart(records, links, apart)


@query(f"""WITH RECURSIVE {PAGES_SQL}, w AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY priority, id) AS n FROM rec JOIN c USING (id))
SELECT cluster, max(id) FILTER (WHERE n = 1) AS id, max(url) FILTER (WHERE n = 1) AS url, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, count(*) AS n_records FROM w GROUP BY cluster""")
def identity_merge_pages(spark, d):
    """All pages, one row for each cluster; a page by https comes before others."""
    records = _page_records(spark, d)
    merged = identity.merge(records.join(identity.components(records, identity.match_edges(records)), "id"))
    return merged.select("cluster", "id", "url", F.array_join("sources", ",").alias("sources"), "n_records")


@query(f"""WITH t AS (SELECT page_id, {PAGE_TITLE} AS title, {HOST} AS issuer, nullif(regexp_extract(url, '[?]([^#]*)', 1), '') AS bill FROM pages),
n AS (SELECT title, count(*) AS n, count(DISTINCT issuer) AS k FROM t GROUP BY title)
SELECT page_id, CASE WHEN n > 1 AND bill IS NOT NULL THEN title || ' (' || bill || ')' WHEN n > 1 AND k > 1 THEN title || ' (' || issuer || ')' ELSE title END AS display_title FROM t JOIN n USING (title)""")
def name_collision_pages(spark, d):
    """All pages, with the query of the address in the place of a bill number."""
    url = F.col("url")
    rows = table(spark, d, "pages").select("page_id", text.page_title(F.col("html")).alias("title"), text.url_host(url).alias("issuer"), F.nullif(text.url_query(url), F.lit("")).alias("bill_no"))
    return identity.told_apart(rows).select("page_id", "display_title")


COLOURED = [("law",), ("bill",), ("treaty",), ("news",), ("other",), ("unheard of",), (None,)]
# The colour of each kind, written down a second time so that the query is held against something else than its own table.
PALETTE = "(VALUES ('law', '#1d4ed8'), ('bill', '#be123c'), ('admin', '#0369a1'), ('treaty', '#3d3a6e'), ('declaration', '#a16207'), ('guideline', '#0f766e'), ('strategy', '#c2410c'), ('report', '#474284'), ('standard', '#7c3aed'), ('institution', '#3f5340'), ('news', '#b44a58'), ('other', '#534f4a')) p(name, colour)"
ALL_KINDS = ["law", "bill", "admin", "treaty", "declaration", "guideline", "strategy", "report", "standard", "institution", "news", "other", "blog"]


@query(f"SELECT kind, CASE WHEN kind IS NOT NULL THEN coalesce(colour, '#534f4a') END AS colour FROM (SELECT kind FROM {inline(COLOURED, 'kind')} UNION ALL SELECT {ALL_KINDS}[n_chars % 13 + 1] FROM documents) LEFT JOIN {PALETTE} ON name = kind")
def kind_colour(spark, d):
    """All documents, each of one of thirteen kinds."""
    docs = table(spark, d, "documents").select(F.element_at(F.array(*[F.lit(k) for k in ALL_KINDS]), (F.col("n_chars") % 13 + 1).cast("int")).alias("kind"))
    return docs.unionByName(spark.createDataFrame(COLOURED, "kind string")).select("kind", curation.kind_colour(F.col("kind")).alias("colour"))


@query("SELECT doc_id::VARCHAR AS id, source AS sources, text AS summary, year(DATE '2026-01-01')::INTEGER AS y, NULL::INTEGER AS m FROM documents")
def documents_json(spark, d):
    """All documents written as JSON and read by the declared schema; a year alone stays one."""
    docs = table(spark, d, "documents")
    at = scratch(spark, "json")
    docs.select(F.col("doc_id").cast("string").alias("id"), F.array("source").alias("sources"), F.col("text").alias("summary"), F.struct(F.lit(2026).alias("y")).alias("date"), F.lit("x").alias("unknown")).write.mode("overwrite").json(at)
    return read_documents(spark, at).select("id", F.array_join("sources", ",").alias("sources"), "summary", F.col("date")["y"].alias("y"), F.col("date")["m"].alias("m"))


@query("""SELECT CASE lang WHEN 'de' THEN 'not JSON' WHEN 'fr' THEN 'other type: sources, date' WHEN 'es' THEN NULL END AS problem, CASE WHEN lang = 'de' THEN NULL ELSE doc_id::VARCHAR END AS id,
CASE lang WHEN 'fr' THEN 'date,sources' WHEN 'es' THEN 'extra' WHEN 'de' THEN NULL ELSE '' END AS rescued, CASE WHEN lang = 'de' THEN NULL ELSE text END AS summary FROM documents UNION ALL SELECT * FROM (VALUES ('not an object', NULL, NULL, NULL), ('not an object', NULL, NULL, NULL), ('not JSON', NULL, NULL, NULL))""")
def documents_json_checked(spark, d):
    """All documents as JSON lines, of which German ones break off, French ones have fields of other types and Spanish ones a field more; and three other broken lines."""
    at, lang = scratch(spark, "json"), F.col("lang")
    fields = F.struct(F.col("doc_id").cast("string").alias("id"), F.array("source").alias("sources"), F.col("text").alias("summary"), F.struct(F.lit(2026).alias("y")).alias("date"))
    odd = F.struct(F.col("doc_id").cast("string").alias("id"), F.lit("one").alias("sources"), F.col("text").alias("summary"), F.lit("soon").alias("date"))
    more = F.struct(F.col("doc_id").cast("string").alias("id"), F.array("source").alias("sources"), F.col("text").alias("summary"), F.lit(5).alias("extra"))
    whole = F.to_json(fields)
    line = F.when(lang == "de", F.substr(whole, F.lit(1), F.length(whole) - 3)).when(lang == "fr", F.to_json(odd)).when(lang == "es", F.to_json(more)).otherwise(whole)
    broken = spark.createDataFrame([("[1, 2]",), ("7",), ("nothing",), ("  ",)], "value string")
    table(spark, d, "documents").select(line.alias("value")).unionByName(broken).write.mode("overwrite").text(at)
    return read_checked(spark, at).select("problem", "id", F.array_join(F.array_sort(F.map_keys("rescued")), ",").alias("rescued"), "summary")


CODES = [("KR",), ("us",), ("EU",), ("KOR",), ("",), (None,)]


@query(f"SELECT code, CASE WHEN regexp_matches(upper(code), '^[A-Z]{{2}}$') THEN chr(unicode(substr(upper(code), 1, 1)) + 127397) || chr(unicode(substr(upper(code), 2, 1)) + 127397) END AS flag FROM (SELECT code FROM {inline(CODES, 'code')} UNION ALL SELECT lang FROM documents UNION ALL SELECT n_name[:n_nationkey % 3 + 1] FROM nation)")
def country_flag(spark, d):
    """All documents' languages and the first letters of all nations as codes."""
    nations = table(spark, d, "nation").select(F.substring("n_name", F.lit(1), F.col("n_nationkey") % 3 + 1).alias("code"))
    codes = table(spark, d, "documents").select(F.col("lang").alias("code")).unionByName(nations).unionByName(spark.createDataFrame(CODES, "code string"))
    return codes.select("code", text.country_flag(F.col("code")).alias("flag"))


MIXED = [("일본 promotion act",), ("영국 data act",), ("Aletheia 윤리",), ("promotional",)]


@query(rf"SELECT title, regexp_replace(regexp_replace(regexp_replace(title, '\bpromotion\b', '촉진', 'g'), '\bdata\b', '데이터', 'g'), '\bact\b', '법', 'g') AS repaired FROM (SELECT title FROM {inline(MIXED, 'title')} UNION ALL SELECT source || ' data act ' || n_chars || ' of promotion' FROM documents)")
def title_repair(spark, d):
    """All documents under titles with leftover words."""
    docs = table(spark, d, "documents").select(F.concat("source", F.lit(" data act "), F.col("n_chars").cast("string"), F.lit(" of promotion")).alias("title"))
    words = {"promotion": "촉진", "data": "데이터", "act": "법"}
    return docs.unionByName(spark.createDataFrame(MIXED, "title string")).select("title", text.words_replaced(F.col("title"), words).alias("repaired"))


@query(rf"""WITH p AS (SELECT page_id, {PAGE_TITLE} AS title FROM pages), w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+')) AS term FROM documents),
t AS (SELECT page_id, regexp_extract_all(title, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+') AS parts FROM p), e AS (SELECT page_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS k FROM t),
r AS (SELECT page_id, string_agg(CASE WHEN term IS NULL THEN part ELSE '[' || term || ']' END, '' ORDER BY k) AS replaced FROM e LEFT JOIN w ON term = part GROUP BY page_id)
SELECT p.page_id, p.title, coalesce(replaced, '') AS replaced FROM p LEFT JOIN r USING (page_id)""")
def title_dictionary_pages(spark, d):
    """All page titles, with every word that any document has in brackets: a dictionary of as many entries as documents have words."""
    titles = table(spark, d, "pages").select("page_id", text.page_title(F.col("html")).alias("title"))
    words = table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))).alias("term")).distinct()
    return curation.words_from_table(titles, words.withColumn("replacement", F.concat(F.lit("["), "term", F.lit("]"))), "page_id")


FOUND_DATES = [(1, 2024, None, None), (1, 2024, 5, 3), (1, 2024, 6, None), (2, 2020, 1, None), (2, None, None, None), (3, None, None, None), (4, 2021, 2, 2), (4, 2021, 2, 1)]


@query(f"""SELECT cluster, y, m, d FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY (CASE WHEN d IS NOT NULL THEN 3 WHEN m IS NOT NULL THEN 2 WHEN y IS NOT NULL THEN 1 ELSE 0 END) DESC, y, m, d) AS n FROM (SELECT * FROM {inline(FOUND_DATES, 'cluster, y, m, d')} UNION ALL SELECT o_custkey + 1000, year(o_orderdate), CASE WHEN o_orderpriority <> '5-LOW' THEN month(o_orderdate) END, CASE WHEN o_orderpriority < '3' THEN day(o_orderdate) END FROM orders)) WHERE n = 1""")
def cluster_best_date(spark, d):
    """All orders by customer, known to the day, the month or the year as their priority tells."""
    day, urgent = F.col("o_orderdate"), F.col("o_orderpriority")
    known = [F.year(day).alias("y"), F.when(urgent != "5-LOW", F.month(day)).alias("m"), F.when(urgent < "3", F.day(day)).alias("d")]
    orders = table(spark, d, "orders").select((F.col("o_custkey") + 1000).alias("cluster"), *known)
    rows = orders.unionByName(spark.createDataFrame(FOUND_DATES, "cluster long, y int, m int, d int"))
    best = identity.best_dates(rows.select("cluster", F.struct("y", "m", "d").alias("date")))
    return best.select("cluster", *[F.col("date")[c].alias(c) for c in ("y", "m", "d")])


# ---------------------------------------------------------------- search

TERMS = ["license", "token", "public"]
BM25_SQL = r"""WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS t FROM documents),
p AS (SELECT doc_id, len(t) AS dl, w, len(list_filter(t, lambda x: x = w)) AS tf FROM t, (SELECT unnest(['license', 'public', 'token']) AS w)),
s AS (SELECT count(*)::DOUBLE AS n, avg(len(t)) AS mean FROM t), df AS (SELECT w, count(*)::DOUBLE AS df FROM p WHERE tf > 0 GROUP BY w)
SELECT doc_id, round(sum(ln(1 + (s.n - df.df + 0.5::DOUBLE) / (df.df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / s.mean))), 6) AS score
FROM p JOIN df USING (w), s WHERE tf > 0 GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 10"""


@query(BM25_SQL)
def fts_bm25_topk(spark, d):
    return search.bm25(table(spark, d, "documents"), TERMS, 10)


@query(BM25_SQL)
def fts_index_search(spark, d):
    """The same from the index, which is brought to what documents hold now before it is asked."""
    at = kept_folder(spark, "index", d)
    version = index.synchronise(spark, at, table(spark, d, "documents").select("doc_id", "text"))
    return index.search(spark, at, TERMS, 10, version)


def _three_batches(spark, d) -> tuple[str, list]:
    """All documents, those labelled with an old text; their right texts, and bad ones deleted; nothing but one that was never there. Each twice."""
    at = scratch(spark, "refreshed")
    docs, labels = table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "labels")
    qualities = labels.select("doc_id", "quality").distinct()
    labelled = docs.join(index.few(qualities, qualities.count()), "doc_id", "left")
    old = F.when(F.col("quality").isNotNull(), F.concat(F.lit("token license "), "text")).otherwise(F.col("text"))
    batches = [
        labelled.select("doc_id", old.alias("text")),
        labelled.where("quality is not null").select("doc_id", "text", (F.col("quality") == 0).alias("deleted")),
        docs.agg((F.max("doc_id") + 1).alias("doc_id")).select("doc_id", F.lit(None).cast("string").alias("text"), F.lit(True).alias("deleted")),
    ]
    return at, [index.refresh(spark, at, b, k) for k in (0, 0, 1, 0, 1, 2, 1) for b in [batches[k]]]


@query(BM25_SQL.replace("FROM documents)", "FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0))", 1))
def index_refresh_search(spark, d):
    """A search after three batches with replays: what a new index of the remaining documents would give."""
    at, said = _three_batches(spark, d)
    return index.search(spark, at, TERMS, 10, said[-1])


@query(r"""WITH k AS (SELECT doc_id, len(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')) AS words, doc_id IN (SELECT doc_id FROM labels) AS labelled, doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) AS bad FROM documents),
a AS (SELECT 1 AS version, 0 AS last_batch, count(*) AS n, sum(words + CASE WHEN labelled THEN 2 ELSE 0 END) AS words FROM k), b AS (SELECT count(*) AS n, sum(words) AS words FROM k WHERE NOT bad)
SELECT step, version, last_batch, n::BIGINT AS n, words::BIGINT AS words FROM (SELECT unnest([0, 1]) AS step, a.* FROM a UNION ALL SELECT unnest([2, 3, 4]), 2, 1, b.* FROM b UNION ALL SELECT unnest([5, 6]), 3, 2, b.* FROM b)""")
def index_replay(spark, d):
    """What the index says of itself after each of seven calls, of which four hand in a batch again."""
    said = _three_batches(spark, d)[1]
    return spark.createDataFrame([(k, v["version"], v["last_batch"], v["n"], v["words"]) for k, v in enumerate(said)], "step int, version int, last_batch int, n long, words long")


@query(r"""WITH t AS (SELECT doc_id, ' ' || array_to_string(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> ''), ' ') || ' ' AS t FROM documents)
SELECT doc_id FROM t WHERE contains(t, ' under the ') OR contains(t, ' of the ')""")
def phrase_search(spark, d):
    """Documents with one of two exact phrases, by positions."""
    found = search.positions(table(spark, d, "documents"))
    return search.phrase(found, "under the").unionByName(search.phrase(found, "Of, the")).select("doc_id").distinct()


COSINE_SQL = """WITH q AS (SELECT embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id = 0)
SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q), 6) AS score FROM embeddings, q ORDER BY score DESC, vec_id LIMIT 10"""


def _query_vector(spark, d) -> list[float]:
    return [float(x) for x in table(spark, d, "embeddings").where("vec_id = 0").first().embedding]


@query(COSINE_SQL)
def embedding_topk(spark, d):
    return search.nearest(table(spark, d, "embeddings"), _query_vector(spark, d), 10)


@query(COSINE_SQL)
def vector_index_search(spark, d):
    """The same from stored vectors: cells that can't hold one of the best aren't read."""
    at = kept_folder(spark, "vectors", d)
    version = vector_index.synchronise(spark, at, table(spark, d, "embeddings"))
    return vector_index.search(spark, at, _query_vector(spark, d), 10, version=version)


@query(f"""WITH a AS ({BM25_SQL}), b AS ({COSINE_SQL}), r AS (
  SELECT doc_id, 1.0::DOUBLE / (60 + row_number() OVER (ORDER BY score DESC, doc_id)) AS r FROM a
  UNION ALL SELECT vec_id, 1.0::DOUBLE / (60 + row_number() OVER (ORDER BY score DESC, vec_id)) FROM b)
SELECT doc_id, round(sum(r), 9) AS score FROM r GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 10""")
def search_library(spark, d):
    """Both parts from their indexes, brought to what the tables hold now."""
    vectors = vector_index_search(spark, d).withColumnRenamed("vec_id", "doc_id")
    return search.fused([fts_index_search(spark, d), vectors], "doc_id", 10)


@query(r"""WITH t AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')) AS term FROM documents)
SELECT term, count(DISTINCT doc_id) AS df, count(*) AS n FROM t GROUP BY term""")
def fts_index_terms(spark, d):
    return search.postings(table(spark, d, "documents")).groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("n"))


# ---------------------------------------------------------------- refresh


@query("SELECT event_id, event_type FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAYS")
def incremental_refresh(spark, d):
    events = table(spark, d, "events").select("event_id", "event_type", "ts")
    newest = events.agg(F.max("ts").alias("t")).scalar()
    known = events.where(F.col("ts") < newest - F.expr("INTERVAL 1 DAYS"))
    return refresh.new_rows(events, known, "event_id").select("event_id", "event_type")


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def daily_event_counts(spark, d):
    days = refresh.daily_counts(table(spark, d, "events"), "ts", "event_type")
    return days.withColumn("day", F.date_format("day", "yyyy-MM-dd"))
