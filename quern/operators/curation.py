"""Which documents belong to the catalogue, and which of their topics say more than their kind."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Topics that repeat the kind of a document.
KIND_TOPICS = ("윤리·규범", "법", "가이드라인", "표준")


# The colour of each kind of document.
KIND_COLOURS = {"law": "#1d4ed8", "bill": "#be123c", "admin": "#0369a1", "treaty": "#3d3a6e", "declaration": "#a16207", "guideline": "#0f766e", "strategy": "#c2410c", "report": "#474284", "standard": "#7c3aed", "institution": "#3f5340", "news": "#b44a58", "other": "#534f4a"}


def kind_colour(kind: Column) -> Column:
    """The colour of a kind; that of other kinds for a kind that isn't known, null for none."""
    known = F.create_map(*[F.lit(x) for pair in KIND_COLOURS.items() for x in pair])
    return F.when(kind.isNotNull(), F.coalesce(F.try_element_at(known, kind), F.lit(KIND_COLOURS["other"])))


def rule_score(text: Column, weights: Mapping[str, float]) -> Column:
    """The sum of the weights of the patterns found in a text."""
    score = F.lit(0.0)
    for pattern, weight in weights.items():
        score = score + F.when(text.rlike(pattern), F.lit(float(weight))).otherwise(F.lit(0.0))
    return score


def relevant(docs: DataFrame, decisions: DataFrame, weights: Mapping[str, float], least: float, text: str = "text") -> DataFrame:
    """Documents with a score of ``least`` or more that a curator's decision (doc_id, keep) doesn't turn down; adds ``score``."""
    scored = docs.withColumn("score", rule_score(F.col(text), weights)).where(F.col("score") >= least)
    against = decisions.where(~F.coalesce(F.col("keep"), F.lit(True))).select("doc_id")
    return scored.join(against, "doc_id", "left_anti")


def topics_without_kinds(topics: Column) -> Column:
    return F.array_except(topics, F.array(*[F.lit(t) for t in KIND_TOPICS]))


def words_from_table(rows: DataFrame, dictionary: DataFrame, key: str = "id", text: str = "title", longest: int = 8) -> DataFrame:
    """Adds ``replaced``: the text with the entries of ``dictionary`` (term, replacement) replaced, whole words only, leftmost first and of those the longest.

    Every stretch of up to ``longest`` words is looked up by equality, so the plan is the same for any number of entries. A stretch runs from word to word with
    what stands between them as it is. Of entries of one term the smallest replacement holds. ``key`` tells rows apart; rows without a match, or with a null key, keep their text.
    """
    word = r"[\p{L}\p{N}_]+"
    parts = rows.select(F.col(key).alias("_key"), F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(rf"{word}|[^\p{{L}}\p{{N}}_]+"), F.lit(0)).alias("parts")).where("_key is not null")
    at = F.filter(F.sequence(F.lit(1), F.size("parts")), lambda k: F.element_at("parts", k).rlike(f"^{word}"))
    starts = parts.where("size(parts) > 0").select("_key", "parts", F.explode(at).alias("at"))
    # word k of a stretch is 2 k parts on
    ends = F.filter(F.transform(F.sequence(F.lit(0), F.lit(longest - 1)), lambda k: 2 * k + 1), lambda n: F.col("at") + n - 1 <= F.size("parts"))
    each = starts.select("_key", "at", F.explode(F.transform(ends, lambda n: F.struct(n.alias("n"), F.array_join(F.slice("parts", F.col("at"), n), "").alias("term")))).alias("s"))
    known = dictionary.groupBy("term").agg(F.min("replacement").alias("replacement"))
    found = each.select("_key", "at", "s.n", "s.term").join(known, "term").groupBy("_key", "at").agg(F.max_by(F.struct("n", "replacement"), "n").alias("m"))
    matches = found.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("at", "m.n", "m.replacement"))).alias("matches"))  # as many as a title has words
    none = F.struct(F.lit("").alias("done"), F.lit(1).alias("next"))
    step = lambda s, m: F.when(m["at"] < s["next"], s).otherwise(
        F.struct(F.concat(s["done"], F.array_join(F.slice("parts", s["next"], m["at"] - s["next"]), ""), m["replacement"]).alias("done"), (m["at"] + m["n"]).alias("next"))
    )
    finish = lambda s: F.concat(s["done"], F.array_join(F.slice("parts", s["next"], F.greatest(F.size("parts") - s["next"] + 1, F.lit(0))), ""))
    made = parts.distinct().join(matches, "_key").select("_key", F.aggregate("matches", none, step, finish).alias("replaced"))
    return rows.join(made.dropDuplicates(["_key"]), F.col(key) == F.col("_key"), "left").withColumn("replaced", F.coalesce("replaced", text)).drop("_key")
