"""The list of documents: facets, months, the kind by year matrix, order and cut-off."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from quern.functions import dates

# The order of the facets.
FACETS = ("source", "issuer", "country", "kind", "topic")


def facet_filter(docs: DataFrame, chosen: Mapping[str, Sequence | None]) -> DataFrame:
    """Documents that hold one of the chosen values of every facet; no value of a facet means all.

    An array column matches if it holds any of the values.
    """
    for name in sorted(chosen, key=lambda n: (FACETS.index(n) if n in FACETS else len(FACETS), n)):
        values = chosen[name]
        if values:
            if isinstance(docs.schema[name].dataType, ArrayType):
                docs = docs.where(F.arrays_overlap(F.col(name), F.array(*[F.lit(v) for v in values])))
            else:
                docs = docs.where(F.col(name).isin(*values))
    return docs


def facet_counts(docs: DataFrame, facet: str) -> DataFrame:
    """How many documents hold each value; an array counts once for each of its values."""
    column = F.explode(F.array_distinct(facet)) if isinstance(docs.schema[facet].dataType, ArrayType) else F.col(facet)
    return docs.select(column.alias(facet)).groupBy(facet).agg(F.count(F.lit(1)).alias("n"))


def top_values(docs: DataFrame, facet: str, k: int) -> DataFrame:
    """The k most frequent values in order, and whether there are more of them."""
    counts = facet_counts(docs, facet)
    first = counts.orderBy(F.desc("n"), F.col(facet).asc_nulls_last()).limit(k + 1)
    ranked = first.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), F.col(facet).asc_nulls_last())))
    more = F.max("place").over(Window.partitionBy(F.lit(0))) > k
    return ranked.withColumn("more", more).where(F.col("place") <= k)


def matrix(docs: DataFrame, kind: str, year: Column, years: Sequence[int]) -> DataFrame:
    """A row for each kind with a count for each year, zero where there is none."""
    rows = docs.select(F.col(kind), year.alias("_year")).groupBy(kind).pivot("_year", list(years)).agg(F.count(F.lit(1)))
    return rows.select(kind, *[F.coalesce(F.col(f"`{y}`"), F.lit(0)).alias(f"y{y}") for y in years])


def density(docs: DataFrame, kind: str, year: Column) -> DataFrame:
    """Counts by kind and year, and each as a share of its kind's largest."""
    cells = docs.select(F.col(kind), year.alias("year")).groupBy(kind, "year").agg(F.count(F.lit(1)).alias("n"))
    return cells.withColumn("density", F.round(F.col("n") / F.max("n").over(Window.partitionBy(kind)), 6))


def cell(docs: DataFrame, kind: str, value: str, date: str, year: int) -> DataFrame:
    """The documents behind one cell: a range of dates, which reaches the scan, rather than a function of them."""
    return docs.where((F.col(kind) == value) & (F.col(date) >= F.lit(f"{year}-01-01").cast("timestamp_ntz")) & (F.col(date) < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")))


def month_label(date: Column) -> Column:
    return F.concat(F.year(date).cast("string"), F.lit("년 "), F.month(date).cast("string"), F.lit("월"))


def months(docs: DataFrame, date: str) -> DataFrame:
    """Counts by month with the label, and whether it is the newest month, which is shown open."""
    counts = docs.where(F.col(date).isNotNull()).groupBy(F.year(date).alias("y"), F.month(date).alias("m")).agg(F.count(F.lit(1)).alias("n"))
    newest = F.max(F.col("y") * 12 + F.col("m")).over(Window.partitionBy(F.lit(0)))
    return counts.select("y", "m", F.concat(F.col("y").cast("string"), F.lit("년 "), F.col("m").cast("string"), F.lit("월")).alias("label"), "n", (F.col("y") * 12 + F.col("m") == newest).alias("open"))


def date_buckets(docs: DataFrame, date: str) -> DataFrame:
    """Counts by month, and by year where no month is known; ``date`` is a partial date."""
    day = F.col(date)
    rows = docs.where(day["y"].isNotNull()).groupBy(day["y"].alias("y"), day["m"].alias("m")).agg(F.count(F.lit(1)).alias("n"))
    bucket = F.struct(F.col("y").alias("y"), F.col("m").alias("m"), F.lit(None).cast("int").alias("d"))
    return rows.select("y", "m", dates.label(bucket).alias("label"), "n")


def with_link(docs: DataFrame, url: str = "url") -> DataFrame:
    """Documents that have an address."""
    return docs.where(F.coalesce(F.col(url), F.lit("")) != "")


def ordered(docs: DataFrame, date: str, key: str, newest: bool = True, k: int | None = None) -> DataFrame:
    """By date, newest or oldest first, then by key; the first k if asked for."""
    by = F.col(date).desc_nulls_last() if newest else F.col(date).asc_nulls_last()
    rows = docs.orderBy(by, F.col(key))
    return rows if k is None else rows.limit(k)


def years(docs: DataFrame, date: str) -> DataFrame:
    return docs.where(F.col(date).isNotNull()).select(F.year(date).alias("year")).distinct()


def recent(docs: DataFrame, date: str, days: int) -> DataFrame:
    """Documents of the last days before the newest one."""
    newest = docs.agg(F.max(date).alias("newest")).scalar()
    return docs.where(F.col(date) >= newest - F.expr(f"INTERVAL {int(days)} DAYS"))


def get_document(docs: DataFrame, doc_id: int) -> DataFrame:
    return docs.where(F.col("doc_id") == doc_id)


def corpus_stats(docs: DataFrame) -> DataFrame:
    """Documents and characters by source, by language and in all, in one pass."""
    rows = docs.groupingSets([["source"], ["lang"], []], "source", "lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"), F.grouping("source").alias("gs"), F.grouping("lang").alias("gl"))
    facet = F.when(F.col("gs") == 0, "source").when(F.col("gl") == 0, "lang").otherwise("all")
    return rows.select(facet.alias("facet"), F.coalesce("source", "lang").alias("value"), "n", "chars")


def counts_under_filters(docs: DataFrame, chosen: Mapping[str, Sequence | None]) -> DataFrame:
    """(facet, value, n): for every facet the counts of its values among documents that all other facets' filters let through.

    One pass: a document that fails two facets counts nowhere, one that fails one facet counts for that facet alone, and one that
    fails none for all. An array counts once for each distinct value. Filters with no values let everything through; null fails any other.
    """
    fails = F.filter(F.array(*[F.when(~F.coalesce(_passes(docs, f, v), F.lit(False)), F.lit(f)) for f, v in chosen.items()]), lambda x: x.isNotNull())
    named = lambda f: F.transform(_values(docs, f), lambda x: F.struct(F.lit(f).alias("facet"), x.alias("value")))
    values = F.flatten(F.array(*[named(f) for f in chosen]))
    near = docs.withColumn("_fails", fails).where(F.size("_fails") <= 1)
    each = near.select("_fails", F.inline(values)).where((F.size("_fails") == 0) | (F.get("_fails", F.lit(0)) == F.col("facet")))
    return each.groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


def _values(docs: DataFrame, facet: str) -> Column:
    """A facet's distinct values as an array of strings, without null."""
    own = F.col(facet)
    own = F.array_distinct(own.cast("array<string>")) if docs.schema[facet].dataType.typeName() == "array" else F.array(own.cast("string"))
    return F.filter(F.coalesce(own, F.array().cast("array<string>")), lambda x: x.isNotNull())


def _passes(docs: DataFrame, facet: str, values: Sequence | None) -> Column:
    if not values:
        return F.lit(True)
    return F.arrays_overlap(_values(docs, facet), F.array(*[F.lit(str(v)) for v in values]))
