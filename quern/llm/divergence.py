"""How far the sources of a language part in their words, from joint histograms of term counts.

Each language keeps the terms of at least LEAST_DOCUMENTS of its documents. A source gives a kept term the smoothed
probability p, in billionths; two sources part by the sum of (p - q)^2 / (p + q) over all kept terms. Terms in which two
sources have the same two counts part them equally. So for each pair of sources the combinations of counts are tallied:
those of terms that both have from the lists of sources by term, in numpy batches; those with a zero, and of
two zeros, are implied by each source's own histogram and the number of kept terms. The formula is then evaluated once for each
combination, times its tally. All arithmetic is on whole numbers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_CHARS, text_slices, written

_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")  # of bytes, which all those of a character beyond ASCII match
#: Documents that a kept term is found in, terms reported for each group.
LEAST_DOCUMENTS, TOP = 10, 10
#: Pairs of counts that a task tallies at once, and combinations that it holds before it hands them on.
PAIRS, HELD = 1 << 18, 1 << 18
#: Terms of groups that a task counts before it hands them on (some 200 bytes each).
TERMS_HELD = 1 << 19
SCALE = 1_000_000_000
_CELL = "lang string, a string, b string, c bigint, d bigint, m bigint"
_NUMBERS = ["lang", "a", "b", "c", "d"]


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (text, lang, source) to (lang, source, term, n, docs): occurrences and documents of each term, combined over up to TERMS_HELD terms of groups."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            k = len(n)
            names = [pa.DictionaryArray.from_arrays(np.zeros(k, np.int32), pa.array([x], pa.string())).cast(pa.string()) for x in (lang, source)]
            terms = pa.array(list(n), pa.binary()).cast(pa.string())
            counts = [pa.array(np.fromiter(x, np.int64, k)) for x in (n.values(), map(docs.__getitem__, n))]
            yield from pa.table([*names, terms, *counts], names=["lang", "source", "term", "n", "docs"]).to_batches(max_chunksize=1 << 16)
        held.clear()

    for batch in batches:
        keys = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
        for texts in text_slices(batch.column(0)):
            for t in texts:
                n, docs = held.setdefault(next(keys), (Counter(), Counter()))
                data = t.encode("utf-8", "replace").lower()  # of bytes: A-Z alone
                if len(data) <= SLICE_CHARS:
                    words = _TERM.findall(data)
                    n.update(words)
                    docs.update(set(words))
                else:
                    own = Counter(m[0] for m in _TERM.finditer(data))
                    n.update(own)
                    docs.update(own.keys())
            if sum(len(n) for n, _ in held.values()) > TERMS_HELD:
                yield from out()
    yield from out()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, n, sources): the kept terms of each language, how often they occur, and in which sources how often.

    A null text, language or source is read as an empty one. Counts by group are combined in the tasks that read the texts, before they are
    shuffled; a term's list has an entry for each source that has it.
    """
    own = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))]
    each = docs.select(*own).mapInArrow(partial_counts, "lang string, source string, term string, n bigint, docs bigint")
    # dealt out once: both groupings follow it, and rows that their tasks have combined aren't combined again before
    counted = each.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = counted.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources"))
    return by_term.where(F.col("docs") >= least).select("lang", "term", "n", "sources")


def probability(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (n + 2 v)), in decimals where products grow large."""
    return F.lit(1) + F.call_function("div", (count.cast("decimal(20,0)") + F.lit(2)) * F.lit(SCALE), n + F.lit(2) * v)


def parting(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q))"""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _tallied(columns: list[np.ndarray]) -> pa.Table:
    table = pa.table(dict(zip([*_NUMBERS, "m"], columns, strict=True)))
    return table.group_by(_NUMBERS).aggregate([("m", "sum")]).rename_columns([*_NUMBERS, "m"])


def _merged(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by(_NUMBERS).aggregate([("m", "sum")]).rename_columns([*_NUMBERS, "m"])


def _pairs_of(langs: np.ndarray, row: np.ndarray, place: np.ndarray, code: np.ndarray, count: np.ndarray) -> Iterator[list[np.ndarray]]:
    """Pairs of entries of a row: ``row`` and ``place`` (of the source in their order) are ascending. At most PAIRS at once, or as many as one row has entries."""
    sizes = np.bincount(row)
    starts = np.r_[0, np.cumsum(sizes)]
    for k in np.unique(sizes[sizes > 1]).tolist():
        of = np.flatnonzero(sizes == k)
        for first in range(0, len(of), step := max(1, PAIRS // k)):
            some = of[first : first + step]
            at = starts[some][:, None] + np.arange(k)
            codes, counts, lang = code[at], count[at], langs[some]
            for shift in range(1, k):
                a, b = codes[:, :-shift].ravel(), codes[:, shift:].ravel()
                yield [np.repeat(lang, k - shift), a, b, counts[:, :-shift].ravel(), counts[:, shift:].ravel(), np.ones(len(a), np.int64)]


def joint_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (lang, sources) to tallies m of (lang, a, b, c, d): terms that source a has c times and b, which comes later, d times."""
    names: dict[str, int] = {}
    held: list[pa.Table] = []

    def out(table: pa.Table) -> list[pa.RecordBatch]:
        texts = pa.array(list(names), pa.string())
        said = {c: texts.take(table.column(c).combine_chunks()) for c in ("lang", "a", "b")}
        return pa.table(said | {c: table.column(c) for c in ("c", "d", "m")}).to_batches(max_chunksize=1 << 16)

    def codes(texts: pa.Array) -> np.ndarray:
        coded = texts.dictionary_encode()
        return np.array([names.setdefault(t, len(names)) for t in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()] if len(texts) else np.zeros(0, np.int64)

    for batch in batches:
        lists = batch.column(1)
        entries = lists.flatten()
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        source, count = entries.field(0), entries.field(1).to_numpy()
        place = np.unique(source.to_pylist(), return_inverse=True)[1] if len(source) else np.zeros(0, np.int64)  # in order of code points
        order = np.lexsort((place, row))
        code = codes(source)
        waiting, n = [], 0
        for part in _pairs_of(codes(batch.column(0)), row[order], place[order], code[order], count[order]):
            waiting.append(part)
            n += len(part[0])
            if n >= PAIRS:
                held.append(_tallied([np.concatenate(c) for c in zip(*waiting, strict=True)]))
                waiting, n = [], 0
        if waiting:
            held.append(_tallied([np.concatenate(c) for c in zip(*waiting, strict=True)]))
        if sum(t.num_rows for t in held) > HELD:
            held = [_merged(held)]
            if held[0].num_rows > HELD // 2:
                yield from out(held.pop())
    if held:
        yield from out(_merged(held))


def groups(docs: DataFrame, terms: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, n, lang_n, v): each group that has documents, its occurrences of kept terms, its language's, and the language's kept terms."""
    own = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]).distinct()
    sums = terms.select("lang", F.inline("sources").alias("source", "k")).groupBy("lang", "source").agg(F.sum("k").alias("n"))
    langs = terms.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count(F.lit(1)).alias("v"))
    zero = F.lit(0).cast("bigint")
    return own.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n", "lang_n", "v")])


def pair_values(terms: DataFrame, sized: DataFrame) -> DataFrame:
    """(lang, source, item, value): how far each two sources of a language part, both ways."""
    a = sized.select("lang", F.col("source").alias("a"), F.col("n").alias("n_a"), "v")
    b = sized.select("lang", F.col("source").alias("b"), F.col("n").alias("n_b"))
    pairs = written(a.join(b, "lang").where("a < b"), "pairs", narrow=True)  # as many as the result has rows
    joint = terms.select("lang", "sources").mapInArrow(joint_counts, _CELL).groupBy("lang", "a", "b", "c", "d").agg(F.sum("m").alias("m"))
    own = written(terms.select("lang", F.inline("sources").alias("source", "k")).groupBy("lang", "source", "k").agg(F.count(F.lit(1)).alias("m")), "histogram", narrow=True)

    def cells(*each: tuple[Column | int, Column | int, Column]) -> Column:
        return F.inline(F.array(*[F.struct(*[F.lit(x).cast("bigint").alias(n) for x, n in zip(e, ("c", "d", "m"), strict=True)]) for e in each]))

    c, d, m, k = (F.col(n) for n in ("c", "d", "m", "k"))
    key = ["lang", "a", "b"]
    # a term that both have is none of those that only one is taken to have, and one more that none is
    both = joint.select(*key, cells((c, d, m), (c, 0, -m), (0, d, -m), (0, 0, m)))
    first = pairs.join(own, (pairs.lang == own.lang) & (pairs.a == own.source)).select(pairs.lang, "a", "b", cells((k, 0, m), (0, 0, -m)))
    second = pairs.join(own, (pairs.lang == own.lang) & (pairs.b == own.source)).select(pairs.lang, "a", "b", cells((0, k, m), (0, 0, -m)))
    none = pairs.select(*key, cells((0, 0, F.col("v"))))
    tally = both.unionByName(first).unionByName(second).unionByName(none).groupBy(*key, "c", "d").agg(F.sum("m").alias("m")).where("m <> 0")
    valued = tally.join(pairs, key).select(*key, (m * parting(probability(c, F.col("n_a"), F.col("v")), probability(d, F.col("n_b"), F.col("v")))).alias("value"))
    sums = pairs.select(*key).join(valued.groupBy(*key).agg(F.sum("value").alias("value")), key, "left")
    ways = F.inline(F.array(*[F.struct(F.col(s).alias("source"), F.col(i).alias("item"), F.coalesce("value", F.lit(0).cast("bigint")).alias("value")) for s, i in (("a", "b"), ("b", "a"))]))
    return sums.select("lang", ways)


def term_values(terms: DataFrame, sized: DataFrame) -> DataFrame:
    """(lang, source, item, value): terms that a source has more often than its language, and how far it parts by them."""
    each = terms.select("lang", F.col("term").alias("item"), F.col("n").alias("total"), F.inline("sources").alias("source", "k")).join(sized, ["lang", "source"])
    rated = each.select("lang", "source", "item", probability(F.col("k"), F.col("n"), F.col("v")).alias("p"), probability(F.col("total"), F.col("lang_n"), F.col("v")).alias("q"))
    return rated.where("p > q").select("lang", "source", "item", parting(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) for every group (lang, source) of documents.

    Part ``pair`` ranks all other sources of the language by how far they part from this one, part ``term`` the ``top``
    terms that the source has more often than its language. Ranks begin with 1, largest value first, of equal ones the smallest item. Null and
    empty texts, languages and sources are read as empty ones; a group without terms is still a group, and parts by 0 where its
    language keeps no term. Repeated rows are documents of their own. Texts may have any length: a task holds one with its terms. An
    empty table gives an empty one. The result has a row for each two sources of a language, so sources are meant to be thousands at most.
    """
    terms = written(term_counts(docs, text, lang, source, least), "terms")
    sized = written(groups(docs, terms, lang, source), "groups", narrow=True)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    parts = [("pair", pair_values(terms, sized), None), ("term", term_values(terms, sized), top)]
    out = None
    for name, values, most in parts:
        ranked = values.select("lang", "source", F.lit(name).alias("part"), "item", "value", rank.alias("rank"))
        ranked = ranked if most is None else ranked.where(F.col("rank") <= most)
        out = ranked if out is None else out.unionByName(ranked)
    return out


ORACLE_SQL = r"""WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
w AS (SELECT i, lang, source, unnest(t) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 10),
x AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT g.lang, g.source, any_value(v.v) AS v, coalesce(sum(x.n), 0) AS n FROM g LEFT JOIN v USING (lang) LEFT JOIN x ON x.lang = g.lang AND x.source = g.source GROUP BY g.lang, g.source),
p AS (SELECT s.lang, s.source, k.term, coalesce(x.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(x.n, 0) + 2)) // (s.n + 2 * s.v) AS p FROM s JOIN k USING (lang) LEFT JOIN x ON x.lang = s.lang AND x.source = s.source AND x.term = k.term),
q AS (SELECT k.lang, k.term, 1 + (1000000000::HUGEINT * (k.total + 2)) // (v.n + 2 * v.v) AS q FROM k JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT p.lang, p.source, 'term', p.term, ((p - q) * (p - q)) // (p + q) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r) WHERE part = 'pair' OR rank <= 10"""
