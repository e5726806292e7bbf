"""Vectors in partition folders by coarse cell, with residual codes, searched by reading the cells that matter.

Vectors are scaled to length one. Each goes to the cell of its nearest centroid; next to the vector stands its residual in one byte
a component. A search reads the codes of the cells nearest to the query (their folders alone), takes the rows whose approximate score may
be among the best, and ranks these by their own vectors. The largest residual of a cell and the rounding of codes bound what
an unread cell or row can score, so an exact search knows when nothing is missing; ``probes`` reads a fixed number of cells instead.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.search import cosine
from quern.sources import versions

#: Vectors and bytes that the centroids are fitted on, rounds of fitting, vectors of a cell, cells at most, steps of a code.
SAMPLED, SAMPLED_BYTES, ROUNDS, CELL, MOST_CELLS, STEPS = 1 << 16, 1 << 27, 8, 256, 4096, 127
SEED = 17


def _unit(vector: Column) -> Column:
    """The vector in doubles, scaled to length one; null for null, zero and vectors that aren't finite, which no cosine is defined for."""
    own = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(own, F.lit(0.0), lambda s, x: s + x * x))
    return F.when((norm > 0) & (norm < float("inf")) & ~F.isnan(norm), F.transform(own, lambda x: x / norm))


def fit(sample: np.ndarray, cells: int) -> np.ndarray:
    """Centroids of length one by rounds of spherical k-means."""
    rng = np.random.default_rng(SEED)
    at = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        own = np.concatenate([(sample[k : k + 4096] @ at.T).argmax(axis=1) for k in range(0, len(sample), 4096)])
        sums = np.zeros_like(at)
        np.add.at(sums, own, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        at = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), at)
    return at


def write(vectors: DataFrame, folder: str, vec_id: str = "vec_id", vector: str = "embedding") -> dict:
    """Writes a new version of the index of ``vectors``; returns it. Null, zero and not finite vectors are left out.

    Centroids are fitted on at most SAMPLED vectors and SAMPLED_BYTES bytes; every vector is stored. Repeated ids stay repeated. All vectors have one length.
    """
    spark = vectors.sparkSession
    before = versions.load(spark, folder) or {"version": 0}
    name = uuid.uuid4().hex
    at = f"{folder}/vectors/{name}"
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("embedding")).withColumn("unit", _unit(F.col("embedding"))).where("unit is not null")
    n, size = rows.agg(F.count(F.lit(1)), F.max(F.size("unit"))).first()
    said = {"name": name, "n": n, "fingerprint": fingerprint(vectors, vec_id, vector), "cells": []}
    if n:
        most = min(SAMPLED, SAMPLED_BYTES // (8 * size))
        # those with the smallest hashes: a cut on the hash, so that no task sends more than its share
        cut = rows if n <= most else rows.where(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(1 << 32)) < int((1 << 32) * most / n))
        sample = np.array([r.unit for r in cut.orderBy("vec_id", "embedding").select("unit").limit(2 * most).collect()]).reshape(-1, size)
        centroids = fit(sample if len(sample) else np.eye(1, size), min(MOST_CELLS, max(1, n // CELL)))
        known = spark.sparkContext.broadcast(centroids)

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.array(batch.column(2).to_pylist()).reshape(batch.num_rows, -1)
                cell = (x @ known.value.T).argmax(axis=1) if len(x) else np.zeros(0, np.int64)
                rest = x - known.value[cell]
                step = np.abs(rest).max(axis=1, initial=0) / STEPS
                code = np.rint(rest / np.where(step > 0, step, 1)[:, None]).astype(np.int8)
                codes = pa.array(list(code), pa.list_(pa.int8()))
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array(cell, pa.int32()), pa.array(np.linalg.norm(rest, axis=1)), pa.array(step), codes], names=["vec_id", "embedding", "cell", "residual", "step", "code"])

        kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
        coded = rows.mapInArrow(placed, f"vec_id {kinds['vec_id']}, embedding {kinds['embedding']}, cell int, residual double, step double, code array<tinyint>")
        coded.repartition("cell").sortWithinPartitions("cell", "vec_id").write.partitionBy("cell").parquet(at)
        # cells are at most MOST_CELLS
        stored = spark.read.parquet(at).groupBy("cell").agg(F.max("residual").alias("radius"), F.max("step").alias("step"), F.count(F.lit(1)).alias("n")).collect()
        said["cells"] = [{"cell": r["cell"], "radius": r["radius"], "step": r["step"], "n": r["n"], "centroid": centroids[r["cell"]].tolist()} for r in sorted(stored)]
    return versions.commit(spark, folder, before["version"] + 1, said)


def fingerprint(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> str:
    """The number of rows and a sum over all of them, by which a changed table is known."""
    return json.dumps([str(x) for x in vectors.agg(F.count(F.lit(1)), F.sum(F.xxhash64(vec_id, vector).cast("decimal(38,0)"))).first()])


def synchronise(spark: SparkSession, folder: str, vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> dict:
    """The version that holds what ``vectors`` holds now, written if there is none."""
    now = versions.load(spark, folder)
    return now if now and now["fingerprint"] == fingerprint(vectors, vec_id, vector) else write(vectors, folder, vec_id, vector)


def _product(code: Column, query: np.ndarray) -> Column:
    """The inner product of a code with the query."""
    q = F.array(*[F.lit(x) for x in query.tolist()])
    return F.aggregate(F.zip_with(code, q, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)


def search(spark: SparkSession, folder: str, query: Sequence[float], k: int, probes: int | None = None, version: dict | None = None, told: dict | None = None) -> DataFrame:
    """The k vectors (vec_id, score) with the largest cosine, of equal ones the smallest ids.

    Without ``probes`` the result is that of all vectors: cells are read until none that is left can have a better one. With it so many cells are read.
    ``told`` gets the cells there are and those read, and the files of both.
    """
    version = version or versions.load(spark, folder)
    q = np.asarray(query, float)
    none = spark.createDataFrame([], "vec_id long, score double")
    if not version or not version["cells"] or not np.isfinite(q).all() or not np.linalg.norm(q):
        return none
    q = q / np.linalg.norm(q)
    cells, table = version["cells"], spark.read.parquet(f"{folder}/vectors/{version['name']}")
    near = np.array([c["centroid"] for c in cells]) @ q
    # q x = q c + q (x - c), and the last is at most the residual's length
    bound = np.minimum(near + np.array([c["radius"] for c in cells]), 1.0)
    order = np.lexsort((np.arange(len(cells)), -near if probes else -bound)).tolist()
    first = order[: max(probes, 1)] if probes else order[: max(1, int(np.searchsorted(np.cumsum([cells[j]["n"] for j in order]), 4 * k)) + 1)]
    slack = 1e-6  # scores are told to six digits

    def best(some: list[int]) -> DataFrame:
        """The k best of some cells: by codes whoever may be among them, then by their vectors."""
        rows = table.where(F.col("cell").isin(*[cells[j]["cell"] for j in some]))
        about = F.create_map(*[x for j in some for x in (F.lit(cells[j]["cell"]), F.lit(float(near[j])))])[F.col("cell")]
        coarse = rows.select("vec_id", "cell", (about + F.col("step") * _product(F.col("code"), q)).alias("about"), (F.col("step") * F.lit(0.5 * float(np.abs(q).sum()))).alias("off"))
        lowest = coarse.select((F.col("about") - F.col("off")).alias("low")).orderBy(F.desc("low")).limit(k).agg(F.min("low")).scalar()
        picked = coarse.where(F.col("about") + F.col("off") + slack >= lowest).select("vec_id", "cell").distinct()
        exact = rows.join(picked, ["vec_id", "cell"]).select("vec_id", F.round(cosine(F.col("embedding"), query), 6).alias("score"))
        return exact.orderBy(F.desc("score"), "vec_id").limit(k)

    out, read = best(first), first
    if not probes:
        top = out.collect()
        least = top[-1].score if len(top) == k else -np.inf
        read = [j for j in order if j in set(first) or bound[j] + slack >= least]
        out = best(read) if len(read) > len(first) else out
    if told is not None:
        own = [f.rsplit("/", 2)[1] for f in table.inputFiles()]  # each file's folder
        told |= {"cells": len(cells), "cells_read": len(read), "files": len(own), "files_read": sum(own.count(f"cell={cells[j]['cell']}") for j in read)}
    return out
