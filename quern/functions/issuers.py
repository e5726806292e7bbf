"""What an issuer's name tells: whether it is regional, what else it is, and its country."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns of names that are central though they look regional, then of regional ones.
CENTRAL = ["교육부.*교육청", "Ministry of Local Government"]
# Patterns of names of universities, laboratories and companies.
KINDS = {
    "university": ["대학교", r"\bUniversit(y|é|ät|at|e)\b", r"\bCollege\b", r"\bInstitute of Technology\b"],
    "lab": ["연구소", "연구원", r"\bLab(s|oratory|oratories)?\b", r"\bResearch (Institute|Center|Centre)\b"],
    "company": ["주식회사", r"\(주\)", r"\b(Inc|Corp|Corporation|Ltd|LLC|GmbH|PLC|Company)\b", r"\b(LG|CJ)\b"],
}
REGIONAL = ["교육청", "광역시", "특별시", "(State|City|County) of ", "Municipal", "(省|市)人民政府", "Provincial (People's )?Government", "Alberta"]


def _any(issuer: Column, patterns: list[str]) -> Column:
    found = F.lit(False)
    for p in patterns:
        found = found | issuer.rlike(p)
    return found


def level(issuer: Column) -> Column:
    """central for the exceptions, regional for regional names, university, lab or company for those, else central; null stays null."""
    out = F.when(issuer.isNull(), F.lit(None)).when(_any(issuer, CENTRAL), "central").when(_any(issuer, REGIONAL), "regional")
    for kind, patterns in KINDS.items():
        out = out.when(_any(issuer, patterns), kind)
    return out.otherwise("central")


def fill_country(docs: DataFrame, by_host: DataFrame, by_issuer: DataFrame, host: Column) -> DataFrame:
    """Fills blank countries from tables (host, country) and (issuer, country); what is known stays.

    Spark broadcasts a table only if its size is below the session's threshold.
    """
    hosts = by_host.select(F.col("host").alias("_host"), F.col("country").alias("_by_host")).dropDuplicates(["_host"])
    names = by_issuer.select(F.col("issuer").alias("_issuer"), F.col("country").alias("_by_issuer")).dropDuplicates(["_issuer"])
    known = F.nullif(F.trim("country"), F.lit(""))
    rows = docs.withColumn("_key", host).join(hosts, F.col("_key") == F.col("_host"), "left").join(names, docs["issuer"] == names["_issuer"], "left")
    rows = rows.withColumn("country", F.coalesce(known, "_by_host", "_by_issuer"))
    return rows.drop("_key", "_host", "_by_host", "_issuer", "_by_issuer")


def by_domain(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """(host, country) of hosts (host) by the longest entry of ``suffixes`` (suffix, country) that they are or end in, label by label.

    Every host is looked up by its labels from each on, so the table is joined by equality and may have any size. Of entries of one suffix the smallest country holds.
    """
    known = suffixes.select(F.lower(F.trim("suffix")).alias("suffix"), "country").groupBy("suffix").agg(F.min("country").alias("country"))
    labels = F.split("host", r"\.")
    ends = hosts.where("host <> ''").select("host").distinct().select("host", F.posexplode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))).alias("at", "suffix"))
    return ends.join(known, "suffix").groupBy("host").agg(F.min_by("country", "at").alias("country"))
