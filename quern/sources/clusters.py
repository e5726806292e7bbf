"""Clusters of records kept up by batches: new links are joined to stored labels, and only what they touch is written.

The folder holds, in segments by version, the label that each record had when it came and the clusters that have since gone into others. A batch adds its
records and the forwards that its links make; a label is read through the forwards. So what a batch writes is in proportion
to the batch, however large the clusters are that it unites. A version file makes a batch count once and whole.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.identity import components
from quern.sources import versions
from quern.sources.shared import dropped, written

EMPTY = {"version": 0, "last_batch": -1, "segments": [], "records": 0, "forwards": 0}


def _table(spark: SparkSession, folder: str, version: dict, table: str) -> DataFrame | None:
    parts = [spark.read.parquet(f"{folder}/segments/{s['name']}/{table}").withColumn("segment", F.lit(s["number"])) for s in version["segments"]]
    return reduce(DataFrame.unionByName, parts) if parts else None


def _roots(spark: SparkSession, folder: str, version: dict) -> DataFrame | None:
    """(cluster, root): where clusters that have gone are now; the newest segment that names one holds."""
    rows = _table(spark, folder, version, "forwards")
    return None if rows is None else rows.groupBy("cluster").agg(F.max_by("root", "segment").alias("root"))


def labels(spark: SparkSession, folder: str, version: dict | None = None) -> DataFrame | None:
    """(id, cluster) of all records of a version, by default the newest: the smallest id that each reaches. None before the first."""
    version = version or versions.load(spark, folder) or EMPTY
    own = _table(spark, folder, version, "labels")
    if own is None:
        return None
    roots = _roots(spark, folder, version)
    return own.select("id", "cluster").join(roots, "cluster", "left").select("id", F.coalesce("root", "cluster").alias("cluster"))


def refresh(spark: SparkSession, folder: str, nodes: DataFrame, edges: DataFrame, batch: int) -> dict:
    """Adds records (id) and links (a, b) as one batch; returns the version, with the numbers of labels and forwards written.

    Links may name new and stored records in any order; those with a record that is neither, or null, are left out. Records that are stored already aren't
    stored again. Batches have rising numbers, and one that has been applied is not applied again.
    """
    before = versions.load(spark, folder) or EMPTY
    if batch <= before["last_batch"]:
        return before
    number, name = before["version"] + 1, uuid.uuid4().hex
    at = f"{folder}/segments/{name}"
    known, new = labels(spark, folder, before), nodes.select("id").where("id is not null").distinct()
    # only the labels of what the batch names are asked for
    named = new.union(edges.select("a")).union(edges.select("b")).distinct()
    stored = None if known is None else written(known.join(named, "id", "left_semi"), "stored")
    new = new if stored is None else new.join(stored, "id", "left_anti")
    new = written(new.select("id", F.col("id").alias("cluster")), "new")
    now = new if stored is None else new.union(stored.select("id", "cluster"))
    links = edges.select("a", "b").distinct().join(now.select(F.col("id").alias("a"), F.col("cluster").alias("x")), "a").join(now.select(F.col("id").alias("b"), F.col("cluster").alias("y")), "b")
    links = written(links.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "links")
    moved = written(components(links.select(F.explode(F.array("a", "b")).alias("id")), links).where("id <> cluster"), "moved")
    placed = new.join(moved.select(F.col("id").alias("cluster"), F.col("cluster").alias("root")), "cluster", "left")
    placed.select("id", F.coalesce("root", "cluster").alias("cluster")).write.parquet(f"{at}/labels")
    # clusters that stored records were given forward: those that move now, and those that had gone to one that moves now
    gone = moved.join(new.select("id"), "id", "left_anti").select(F.col("id").alias("cluster"), F.col("cluster").alias("root"))
    roots = _roots(spark, folder, before)
    if roots is not None:
        again = roots.join(moved.select(F.col("id").alias("root"), F.col("cluster").alias("further")), "root")
        gone = gone.union(again.select("cluster", F.col("further").alias("root")))
    gone.write.parquet(f"{at}/forwards")
    wrote = [spark.read.parquet(f"{at}/{t}").count() for t in ("labels", "forwards")]
    dropped(*[t for t in (stored, new, links, moved) if t is not None])
    segments = [*before["segments"], {"number": number, "name": name}]
    return versions.commit(spark, folder, number, {"last_batch": batch, "segments": segments, "records": before["records"] + wrote[0], "forwards": before["forwards"] + wrote[1], "wrote": wrote})


def compact(spark: SparkSession, folder: str) -> dict:
    """Writes all labels as they are now as one segment without forwards; older versions stay readable."""
    before = versions.load(spark, folder)
    if before is None or len(before["segments"]) < 2:
        return before or EMPTY
    number, name = before["version"] + 1, uuid.uuid4().hex
    now = labels(spark, folder, before)
    now.write.parquet(f"{folder}/segments/{name}/labels")
    now.select("cluster", F.col("cluster").alias("root")).limit(0).write.parquet(f"{folder}/segments/{name}/forwards")
    return versions.commit(spark, folder, number, before | {"segments": [{"number": number, "name": name}], "forwards": 0})
