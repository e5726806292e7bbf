"""Full-text and vector search, and both together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import catalogue_tokens, tokens

#: The usual constants of BM25 and of reciprocal ranks.
K1, B, RANK_SHIFT = 1.2, 0.75, 60


def idf(n: Column, df: Column) -> Column:
    """The weight of a term that df of n documents have."""
    return F.log(F.lit(1.0) + (n - df + F.lit(0.5)) / (df + F.lit(0.5)))


def bm25_part(weight: Column, tf: Column, length: Column, mean: Column) -> Column:
    """What a term adds to the score of a document of so many words; it grows with tf and falls with length."""
    tf = tf.cast("double")
    return weight * tf * F.lit(K1 + 1) / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * length / mean))


def postings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(term, doc_id, tf, length): the inverted index."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), tokens(F.col(text)).alias("t"))
    each = rows.select("doc_id", F.size("t").alias("length"), F.explode("t").alias("term"))
    return each.groupBy("term", "doc_id", "length").agg(F.count(F.lit(1)).alias("tf"))


def positions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(term, doc_id, at): where each term of :func:`catalogue_tokens` stands in each document, in order."""
    each = docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(catalogue_tokens(F.col(text))).alias("at", "term"))
    return each.groupBy("term", "doc_id").agg(F.sort_array(F.collect_list("at")).alias("at"))


def phrase(index: DataFrame, wanted: str) -> DataFrame:
    """(doc_id, n): documents of positions (term, doc_id, at) in which the phrase stands, and how often; the terms are a filter that reaches the scan.

    A phrase of Hangul or Han is found inside longer runs, as its pairs follow each other. A single sign of these is found in any pair that has it.
    """
    spark = index.sparkSession
    terms = spark.range(1).select(catalogue_tokens(F.lit(wanted)).alias("t")).first().t
    if not terms:
        return index.select("doc_id", F.lit(0).cast("long").alias("n")).limit(0)
    if len(terms) == 1:
        sign = len(terms[0]) == 1 and not terms[0].isascii()
        found = index.where(F.col("term").contains(terms[0]) if sign else F.col("term") == terms[0])
        return found.select("doc_id", F.explode("at").alias("at")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    asked = spark.createDataFrame(list(enumerate(terms)), "k int, term string")
    each = index.where(F.col("term").isin(*terms)).join(F.broadcast(asked), "term")  # as many rows as the phrase has terms
    starts = each.select("doc_id", "k", F.explode("at").alias("at")).groupBy("doc_id", (F.col("at") - F.col("k")).alias("start")).agg(F.count(F.lit(1)).alias("k"))
    return starts.where(F.col("k") == len(terms)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


def bm25(docs: DataFrame, terms: Sequence[str], k: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The k best documents (doc_id, score) for some terms; only counts of these terms leave the scan."""
    wanted = sorted(set(terms))
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    tfs = [F.when(low.contains(w), F.regexp_count(low, F.lit(rf"(?<![\p{{L}}\p{{N}}])\Q{w}\E(?![\p{{L}}\p{{N}}])"))).otherwise(F.lit(0)) for w in wanted]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.regexp_count(low, F.lit(r"[\p{L}\p{N}]+")).alias("length"), *[c.alias(f"tf{i}") for i, c in enumerate(tfs)])
    counts = [F.count(F.when(F.col(f"tf{i}") > 0, 1)).cast("double").alias(f"df{i}") for i in range(len(wanted))]
    stats = rows.agg(F.struct(F.count(F.lit(1)).cast("double").alias("n"), F.avg("length").alias("mean"), *counts).alias("s")).scalar()
    rows = rows.where(" or ".join(f"tf{i} > 0" for i in range(len(wanted)))).withColumn("s", stats)
    s, score = F.col("s"), F.lit(0.0)
    for i in range(len(wanted)):
        score = score + bm25_part(idf(s["n"], s[f"df{i}"]), F.col(f"tf{i}"), F.col("length"), s["mean"])
    return rows.select("doc_id", F.round(score, 6).alias("score")).orderBy(F.desc("score"), "doc_id").limit(k)


def cosine(vector: Column, query: Sequence[float]) -> Column:
    """Cosine in double precision; null for a zero vector."""
    q = F.array(*[F.lit(float(x)) for x in query])
    norm = sum(float(x) ** 2 for x in query) ** 0.5
    dot = F.aggregate(F.zip_with(vector, q, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    own = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return dot / F.nullif(own * F.lit(norm), F.lit(0.0))


def nearest(vectors: DataFrame, query: Sequence[float], k: int) -> DataFrame:
    """The k vectors (vec_id, score) with the largest cosine."""
    return vectors.select("vec_id", F.round(cosine(F.col("embedding"), query), 6).alias("score")).where("score is not null").orderBy(F.desc("score"), "vec_id").limit(k)


def fused(lists: Sequence[DataFrame], key: str, k: int) -> DataFrame:
    """Result lists (key, score) joined by the sum of reciprocal ranks; each list holds few rows."""
    out = None
    for one in lists:
        ranked = one.select(F.col(key), (F.lit(1.0) / (F.lit(RANK_SHIFT) + F.row_number().over(Window.orderBy(F.desc("score"), key)))).alias("r"))
        out = ranked if out is None else out.unionByName(ranked)
    return out.groupBy(key).agg(F.round(F.sum("r"), 9).alias("score")).orderBy(F.desc("score"), key).limit(k)
