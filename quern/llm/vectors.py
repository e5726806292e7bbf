"""Nearest neighbours by inner product: inverted lists scanned with adaptively sampled dimensions.

One more coordinate makes all vectors equally long, so the largest inner product is the smallest distance.
Vectors are rotated at random and scanned in blocks of columns: from the distance over the columns read
so far a hypothesis test decides whether the whole distance can still be among the best, and abandons
the candidate if not. Lists are fitted on a bounded sample, every distinct vector is indexed, and lists are
cut into blocks, so no list has to fit in a task. Equal vectors are one candidate with their smallest ids.
A query for which the tests leave too few neighbours is scanned again over all lists without them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Neighbours returned; rows of a block; columns read at once; the test's leniency.
NEAREST, BLOCK, COLUMNS, LENIENCY = 20, 8192, 16, 2.1
#: Most lists, sample rows for each and at most, rows of the sample that bound distances, coverage the probes are chosen for.
MAX_LISTS, ROWS_PER_LIST, MAX_SAMPLE, BOUNDING, COVERED = 16_384, 64, 262_144, 4096, 0.97
#: Bytes of the sample at most, and queries that one task holds against a block.
SAMPLE_BYTES, QUERIES = 1 << 27, 8192
#: Lists beyond which centroids are found and looked up in two levels; passes of k-means; numbers of a block of distances (8 bytes each).
ONE_LEVEL, PASSES, DISTANCES = 1024, 8, 1 << 22
SEED, SPARE = 5, 12
#: Vectors that the lists scanned first hold at least, for each neighbour wanted.
FIRST_ROWS = 32


@dataclass
class Index:
    """Rotation and centroids of the lengthened space, and what a query needs to choose its lists."""

    scale: float  # the largest component: vectors are divided by it, so that no square overflows
    square: float  # of the longest vector, divided
    rotation: np.ndarray
    centroids: np.ndarray
    probes: int
    bounding: np.ndarray  # rotated vectors of the sample, and the list of each
    lists: np.ndarray
    tops: np.ndarray | None = None  # centroids of groups of lists, and the group of each list, if there are two levels
    group: np.ndarray | None = None
    sizes: np.ndarray | None = None  # of the lists

    def rotated(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        vectors = vectors / self.scale
        extra = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.square - (vectors * vectors).sum(axis=1), 0))
        return np.c_[vectors, extra] @ self.rotation


    def list_of(self, points: np.ndarray) -> np.ndarray:
        """The list of each rotated vector: of the nearest centroid, with two levels among those of the nearest group."""
        if self.tops is None:
            return nearest_of(points, self.centroids)
        top, out = nearest_of(points, self.tops), np.zeros(len(points), np.int64)
        order = np.argsort(top, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(top[order])) + 1):
            if len(rows):
                lists = np.flatnonzero(self.group == top[rows[0]])
                out[rows] = lists[nearest_of(points[rows], self.centroids[lists])]
        return out


def nearest_of(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each point."""
    step = max(1, DISTANCES // len(centroids))
    parts = [distances(points[k : k + step], centroids).argmin(axis=1) for k in range(0, len(points), step)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def k_means(points: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """So many centroids, or as many as there are points."""
    centroids = points[rng.choice(len(points), min(count, len(points)), replace=False)]
    for _ in range(PASSES if len(centroids) > 1 else 0):
        own = nearest_of(points, centroids)
        sums, n = np.zeros_like(centroids), np.bincount(own, minlength=len(centroids))
        np.add.at(sums, own, points)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows."""
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * (a @ b.T), 0)


def fit(sample: np.ndarray, scale: float, square: float, total: int, nearest: int) -> Index:
    """Lists by k-means on the sample, and the probes that cover COVERED of the neighbours within it."""
    rng = np.random.default_rng(SEED)
    wide = sample.shape[1] + 1
    rotation = np.linalg.qr(rng.standard_normal((wide, wide)))[0]
    index = Index(scale, square, rotation, np.zeros((1, wide)), 1, np.zeros((0, wide)), np.zeros(0, np.int64))
    points = index.rotated(sample)
    lists = int(np.clip(min(np.sqrt(total), total // 64, len(sample) // 8), 1, MAX_LISTS))
    if lists > ONE_LEVEL:
        index.tops = k_means(points, int(np.sqrt(lists)), rng)
        top = nearest_of(points, index.tops)
        parts = [k_means(own, round(len(own) * lists / len(points)) or 1, rng) if len(own) else index.tops[k : k + 1] for k, own in ((k, points[top == k]) for k in range(len(index.tops)))]
        index.centroids, index.group = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    elif len(points):
        index.centroids = k_means(points, lists, rng)
    lists = len(index.centroids)
    index.bounding = points[:BOUNDING]
    index.lists = index.list_of(index.bounding) if len(points) else index.lists
    if lists > 1:
        asked = rng.choice(len(sample), min(256, len(sample)), replace=False)
        best = []
        for some in np.array_split(asked, -(-len(asked) // 16)):  # 16 rows of distances at once
            near = distances(index.rotated(sample[some], query=True), points)
            near[np.arange(len(some)), some] = np.inf
            best.append(np.argpartition(near, min(nearest, len(sample) - 1) - 1, axis=1)[:, :nearest])
        best = np.concatenate(best)
        own = index.list_of(points)
        order = distances(index.rotated(sample[asked], query=True), index.centroids).argsort(axis=1)
        rank = np.argsort(order, axis=1)[np.arange(len(asked))[:, None], own[best]]
        index.probes = int(np.quantile(rank, COVERED)) + 1
    return index


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def _lists_of(shared):
    def run(column: pa.Array) -> pa.Array:
        points = shared.value.rotated(_matrix(column)) if len(column) else np.zeros((0, 1))
        return pa.array(shared.value.list_of(points) if len(points) else [], pa.int32())

    return run


def _probes_of(shared, nearest: int):
    """For query vectors: the lists to probe, how many of them come first, and a distance within which twice ``nearest`` vectors lie.

    The first lists hold several times ``nearest`` vectors, and what is found in them bounds the rest.
    """
    bounding = 2 * nearest
    kind = pa.struct([("lists", pa.list_(pa.int32())), ("first", pa.int32()), ("bound", pa.float64())])

    def run(column: pa.Array) -> pa.Array:
        index, rows = shared.value, []
        step = max(1, min(512, DISTANCES // len(index.centroids)))
        for k in range(0, len(column), step):
            points = index.rotated(_matrix(column.slice(k, step)), query=True)
            order = distances(points, index.centroids).argsort(axis=1, kind="stable")
            held = np.cumsum(index.sizes[order], axis=1)
            first = np.minimum((held < FIRST_ROWS * nearest).sum(axis=1) + 1, order.shape[1])
            probes = np.maximum(index.probes, first)
            place = np.argsort(order, axis=1)
            near = np.where(place[:, index.lists] < probes[:, None], distances(points, index.bounding), np.inf)
            bound = np.partition(near, bounding - 1, axis=1)[:, bounding - 1] if near.shape[1] >= bounding else np.full(len(points), np.inf)
            rows += [{"lists": o[:p], "first": f, "bound": b} for o, p, f, b in zip(order, probes, first, bound, strict=True)]
        return pa.array(rows, kind)

    return run


def scan(queries: np.ndarray, vectors: np.ndarray, bounds: np.ndarray, keep: int, leniency: float = LENIENCY) -> tuple[np.ndarray, np.ndarray, int]:
    """(query, vector) positions of up to ``keep`` nearest vectors of each query, and the columns read of all pairs.

    ``bounds`` are squared distances beyond which a vector isn't wanted. With an infinite ``leniency`` only what a partial distance
    proves too far is abandoned.
    """

    def most(limit: np.ndarray, read: int) -> np.ndarray:
        """Partial distances up to which a candidate stays."""
        return limit if np.isinf(leniency) or read == wide else limit * read / wide * (1 + leniency / np.sqrt(read)) ** 2

    wide = queries.shape[1]
    limit = bounds * (1 + 1e-9) + 1e-12
    best_q, best_v, best_d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    read = 0
    step = max(64, 2_000_000 // max(1, len(queries)))
    for k in range(0, len(vectors), step):
        part = vectors[k : k + step]
        first = min(COLUMNS, wide)
        partial = distances(queries[:, :first], part[:, :first])
        read += partial.size * first
        q, v = np.nonzero(partial <= most(limit, first)[:, None])
        d = partial[q, v]
        for at in range(first, wide, COLUMNS):
            end = min(at + COLUMNS, wide)
            gap = queries[q, at:end] - part[v, at:end]
            d = d + np.einsum("ij,ij->i", gap, gap)
            read += len(q) * (end - at)
            live = d <= most(limit, end)[q]
            q, v, d = q[live], v[live], d[live]
        best_q, best_v, best_d = np.r_[best_q, q], np.r_[best_v, v + k], np.r_[best_d, d]
        order = np.lexsort((best_v, best_d, best_q))
        best_q, best_v, best_d = best_q[order], best_v[order], best_d[order]
        starts = np.searchsorted(best_q, np.arange(len(queries)))
        place = np.arange(len(best_q)) - starts[best_q]
        kept = place < keep
        full = np.flatnonzero(place == keep - 1)
        limit[best_q[full]] = np.minimum(limit[best_q[full]], best_d[full] * (1 + 1e-9) + 1e-12)
        best_q, best_v, best_d = best_q[kept], best_v[kept], best_d[kept]
    return best_q, best_v, read


def _search(shared, nearest: int, leniency: float):
    out = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(vectors) or not len(queries):
            return out.empty_table()
        index, x = shared.value, _matrix(vectors.column("embedding"))
        turned = index.rotated(x)
        parts = []
        for k in range(0, len(queries), 1024):
            asked = queries.slice(k, 1024)
            y = _matrix(asked.column("embedding"))
            q, v, _ = scan(index.rotated(y, query=True), turned, asked.column("bound").to_numpy(), nearest + SPARE, leniency)
            score = np.einsum("ij,ij->i", y[q], x[v])
            parts.append(pa.table([asked.column("h1").take(pa.array(q)), asked.column("h2").take(pa.array(q)), pa.array(score), vectors.column("ids").take(pa.array(v))], schema=out))
        return pa.concat_tables(parts)

    return run


def sampled(distinct: DataFrame, total: int, wanted: int) -> pa.Table:
    """Some ``wanted`` of ``total`` vectors in the order of their keys: those below a cut on a hash of the key, so that no task sends more than its share."""
    rows = distinct.select("h1", "h2", "embedding")
    if total > wanted:
        rows = rows.where(F.pmod(F.xxhash64(F.lit(2), "h1", "h2"), F.lit(1 << 32)) < int((1 << 32) * wanted / total))
    return rows.toArrow().sort_by([("h1", "ascending"), ("h2", "ascending")])


def nearest_neighbours(vectors: DataFrame, asked: DataFrame, nearest: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): for each of ``asked`` (vec_id) its nearest other rows of ``vectors`` (vec_id, embedding).

    score is the inner product in double precision, ties go to the smaller id, and a row of the query's own id is
    no candidate. Null ids, and vectors that are null, empty, zero or hold null or non-finite components take no
    part; neither do those of another length than most (of equally frequent ones, the longest). With fewer candidates,
    all are returned. Repeated rows of one id are candidates each. Scores of very long vectors may be infinite; ties, as ever, go to
    the smaller id. Other columns, whatever they are called, are not looked at. An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    x = F.col("embedding")
    known = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding")).where("vec_id is not null and embedding is not null")
    real = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists(x, lambda c: c != 0)
    known = known.where(real)
    shapes = known.groupBy(F.size("embedding").alias("wide")).agg(F.count(F.lit(1)).alias("n"), F.max(F.array_max(F.transform(x, lambda c: F.abs(c)))).alias("scale"))
    shape = shapes.orderBy(F.desc("n"), F.desc("wide")).first()
    kind = "query_id long, rank int, vec_id long, score double"
    if shape is None:
        return spark.createDataFrame([], kind)
    keys = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]
    usable = known.where(F.size("embedding") == shape.wide).select("vec_id", "embedding", *keys)
    # equal vectors: only the smallest ids can be among the nearest; limited before they are shuffled
    first = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    few = usable.withColumn("k", first).where(F.col("k") <= nearest + 1)
    distinct = few.groupBy("h1", "h2").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.first("embedding").alias("embedding"))
    distinct = written(distinct, "vectors")
    scale = float(shape.scale)
    length = F.aggregate("embedding", F.lit(0.0), lambda a, c: a + (c / F.lit(scale)) * (c / F.lit(scale)))
    total, square = distinct.agg(F.count(F.lit(1)), F.max(length)).first()
    sample = sampled(distinct, total, int(min(MAX_SAMPLE, SAMPLE_BYTES // (8 * max(shape.wide, 1)), max(ROWS_PER_LIST * np.sqrt(total), 4096))))
    index = fit(_matrix(sample.column("embedding")), scale, float(square), total, nearest + 1)
    assign = F.arrow_udf(_lists_of(spark.sparkContext.broadcast(index)), "int")
    assigned = written(distinct.withColumn("list", assign("embedding")), "lists")
    sizes = np.zeros(len(index.centroids), np.int64)
    for row in assigned.groupBy("list").count().collect():  # at most MAX_LISTS rows
        sizes[row["list"]] = row["count"]
    index.sizes = sizes
    shared = spark.sparkContext.broadcast(index)
    cut = spark.createDataFrame([(k, int(max(1, -(-n // BLOCK)))) for k, n in enumerate(sizes)], "list int, blocks int")
    cut = F.broadcast(cut)  # at most MAX_LISTS rows
    dealt = assigned.join(cut, "list").withColumn("block", F.pmod("h2", "blocks").cast("int")).drop("blocks")
    wanted = asked.select(F.col("vec_id").cast("long").alias("query_id")).where("query_id is not null").distinct()
    queries = usable.join(wanted, usable.vec_id == wanted.query_id).select("query_id", "h1", "h2").distinct()
    probe = F.arrow_udf(_probes_of(shared, nearest + 1), "struct<lists: array<int>, first: int, bound: double>")
    each = distinct.join(queries.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi").select("h1", "h2", "embedding", probe("embedding").alias("p"))
    each = written(each, "probes")

    def searched(asked: DataFrame, lists: Column, bound: Column, leniency: float = LENIENCY) -> DataFrame:
        one = asked.select("h1", "h2", "embedding", bound.alias("bound"), F.explode(lists).alias("list"))
        # a list that very many queries probe is given to several tasks, each with a part of the queries; one that none probes to none
        turns = F.broadcast(one.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("turns")))  # at most MAX_LISTS rows
        one = one.join(cut, "list").join(turns, "list").withColumn("turn", F.pmod("h1", "turns").cast("int"))
        one = one.select("h1", "h2", "embedding", "bound", "list", "turn", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        ours = dealt.join(turns, "list").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("turns")
        found = ours.groupBy("list", "block", "turn").cogroup(one.groupBy("list", "block", "turn"))
        return found.applyInArrow(_search(shared, nearest + 1, leniency), "h1 long, h2 long, score double, ids array<long>")

    lists, first = F.col("p")["lists"], F.col("p")["first"]
    # what the first lists hold bounds the distances worth keeping in the others, so these give few rows
    near = written(searched(each, F.slice(lists, F.lit(1), first), F.col("p")["bound"]), "near")
    place = F.row_number().over(Window.partitionBy("h1", "h2").orderBy(F.desc("score")))
    reached = near.withColumn("k", place).where(F.col("k") == nearest + 1).select("h1", "h2", F.col("score").alias("least"))
    bound = F.least(F.col("p")["bound"], length + F.lit(float(square)) - F.lit(2.0) * F.col("least") / F.lit(scale) / F.lit(scale))
    rest = F.slice(lists, first + 1, F.size(lists))
    found = near.unionByName(searched(each.join(reached, ["h1", "h2"], "left"), rest, bound))
    pools = written(pool_of(found, nearest), "pools")
    # a pool that lacks neighbours is made anew from all lists, by partial distances that prove and don't test
    short = each.join(pools.where(F.size("pool") > nearest), ["h1", "h2"], "left_anti")
    if short.limit(1).count():
        every = F.sequence(F.lit(0), F.lit(len(sizes) - 1))
        again = written(pool_of(searched(short, every, F.lit(float("inf")), float("inf")), nearest), "again")
        pools = pools.join(again, ["h1", "h2"], "left_anti").unionByName(again)
    pairs = queries.join(pools, ["h1", "h2"])
    others = F.slice(F.filter("pool", lambda p: p["id"] != F.col("query_id")), 1, nearest)
    return pairs.select("query_id", F.posexplode(others).alias("k", "p")).select("query_id", (F.col("k") + 1).alias("rank"), F.col("p")["id"].alias("vec_id"), (-F.col("p")["order"]).alias("score"))


def pool_of(found: DataFrame, nearest: int) -> DataFrame:
    """(h1, h2, pool): of each query vector the best candidates by score, then id, with one place to spare for the query itself."""
    by_score = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), F.get("ids", F.lit(0)))
    top = found.withColumn("k", F.row_number().over(by_score)).where(F.col("k") <= nearest + 1)
    each = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("order"), i.alias("id")))
    return top.groupBy("h1", "h2").agg(F.array_sort(F.flatten(F.collect_list(each))).alias("pool"))
