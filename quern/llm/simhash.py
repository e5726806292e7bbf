"""SimHash near-duplicates, found exactly with vantage-point trees.

A fingerprint has 64 bits; two link if at most three differ. Distances between unrelated fingerprints
crowd around 32 with a deviation of 4, so one tree over all 64 bits prunes little at a radius of three.
The forest therefore has one tree for each half: of three differing bits, one half holds at most one, so
every linked pair lies within radius one in the half of at least one tree. Each node of a tree has a
vantage point and a distance; by the triangle bound a partner of a point inside the distance can only be
outside if the point lies within the radius of the boundary, and such points are handed to the outer
branch as well. The upper levels, fitted on a bounded sample, deal fingerprints to shards; the lower ones
are grown inside each shard. Leaves compare all 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import OWN, drop_written, packed, per_text, unpacked, with_results, written

SEED, WORDS, BITS = 42, 3, 3
#: Fingerprints a shard is meant to hold, leaves with points of the sample, the largest sample (8 bytes each), and leaf size.
SHARD, SAMPLE_PER_SHARD, MAX_SAMPLE, LEAF = 8192, 16, 1_000_000, 256
LEAST_SHARDS = 16
#: A split must leave less than this share of the comparisons.
WORTH = 0.95
#: Shingles whose bits are counted at once.
COUNTED = 1 << 16


def fingerprint(text: str, words: int = WORDS) -> int:
    """The fingerprint of one text, as an unsigned number; zero without words."""
    w = text.encode("utf-8", "replace").lower().split()  # of bytes: A-Z alone, ASCII white space alone
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[k:] for k in range(words)), strict=False)) if len(w) >= words else iter([b" ".join(w)])
    n = max(1, len(w) - words + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for k in range(0, n, COUNTED):
        bits = np.unpackbits(hashes[k : k + COUNTED].view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(words: int):
    return per_text(lambda texts: pa.array(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)), pa.int64())


def with_fingerprint(docs: DataFrame, text: str = "text", words: int = WORDS, name: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint (long, its 64 bits as they are) of each whole text; a null text has no words."""
    return with_results(docs, {name: F.arrow_udf(_fingerprints(words), "bigint")(F.col(f"`{text}`").cast("string"))})


# ---------------------------------------------------------------- trees


def halves(points: np.ndarray) -> list[np.ndarray]:
    """The two halves of unsigned fingerprints: one tree is grown on each."""
    return [(points & np.uint64(0xFFFFFFFF)).astype(np.uint32), (points >> np.uint64(32)).astype(np.uint32)]


def choose(values: np.ndarray, rng: np.random.Generator, radius: int) -> tuple[np.uint32, int, np.ndarray] | None:
    """A vantage point, the distance that splits best, and all distances; None if no split saves comparisons.

    Both branches compare all pairs at worst, so a split pays if the squares of their sizes, copies included, come to
    less than the square of all; with that no order of splits costs more than comparing all pairs at once.
    """
    best = None
    for v in rng.choice(values, min(4, len(values)), replace=False):
        d = np.bitwise_count(values ^ v)
        at = int(np.median(d))
        for cut in (at - 1, at):
            cost = np.count_nonzero(d <= cut) ** 2 + np.count_nonzero(d.astype(np.int16) > cut - radius) ** 2
            if cost < WORTH * len(values) ** 2 and (best is None or cost < best[0]):
                best = (cost, v, cut, d)
    return best and best[1:]


def grow(values: np.ndarray, shards: int, radius: int, rng: np.random.Generator) -> list | int:
    """A tree as nested [vantage, cut, inner, outer], whose leaves are numbered in place by :func:`number`."""
    if shards <= 1 or len(values) < 2 * SAMPLE_PER_SHARD or not (found := choose(values, rng, radius)):
        return 0
    v, cut, d = found
    inner, outer = values[d <= cut], values[d > cut]
    return [int(v), cut, grow(inner, (shards + 1) // 2, radius, rng), grow(outer, shards // 2, radius, rng)]


def number(tree: list | int, first: int) -> tuple[list | int, int]:
    """The tree with its leaves numbered from ``first`` on, and the next number."""
    if not isinstance(tree, list):
        return first, first + 1
    inner, first = number(tree[2], first)
    outer, first = number(tree[3], first)
    return [tree[0], tree[1], inner, outer], first


def route(tree: list | int, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, leaf) of every leaf that a value belongs to or overlaps from inside a boundary."""
    at, leaf, todo = [], [], [(tree, np.arange(len(values)))]
    while todo:
        node, rows = todo.pop()
        if not isinstance(node, list):
            at.append(rows)
            leaf.append(np.full(len(rows), node, np.int32))
        elif len(rows):
            d = np.bitwise_count(values[rows] ^ np.uint32(node[0])).astype(np.int64)
            todo += [(node[2], rows[d <= node[1]]), (node[3], rows[d > node[1] - radius])]
    return np.concatenate(at), np.concatenate(leaf)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to n - 1, the smallest node that each reaches over the edges."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if (label == before).all():
            return label


def links_within(points: np.ndarray, half: int, radius: int = BITS // 2, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Edges (positions) that connect what is linked among distinct points, by a tree on one half grown down to leaves.

    Only a spanning star of what each leaf links is kept, never all pairs of a group.
    """
    values = halves(points)[half]
    rng = np.random.default_rng(len(points))
    edges_a, edges_b, todo = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) > LEAF and (found := choose(values[rows], rng, radius)):
            _, cut, d = found
            todo += [rows[d <= cut], rows[d.astype(np.int64) > cut - radius]]
            continue
        own = points[rows]
        label = np.arange(len(rows))
        for k in range(0, len(rows), LEAF):  # a leaf that no vantage point splits can be long
            i, j = np.nonzero(np.bitwise_count(own[k : k + LEAF, None] ^ own[None, k:]) <= bits)
            i, j = i[i < j] + k, j[i < j] + k
            if len(i):
                more = np.flatnonzero(label != np.arange(len(rows)))
                label = roots(len(rows), np.r_[i, more], np.r_[j, label[more]])
        moved = np.flatnonzero(label != np.arange(len(rows)))
        edges_a.append(rows[moved])
        edges_b.append(rows[label[moved]])
    return np.concatenate(edges_a), np.concatenate(edges_b)


# ---------------------------------------------------------------- the forest over shards


def fit(sample: np.ndarray, shards: int, radius: int = BITS // 2) -> list:
    """Two numbered trees over a sample of distinct fingerprints."""
    rng = np.random.default_rng(SEED)
    trees, first = [], 0
    for values in halves(sample):
        tree, first = number(grow(values, shards, radius, rng), first)
        trees.append((tree, first))
    return trees


def _shards_of(trees: list, radius: int):
    def run(column: pa.Array) -> pa.Array:
        points = column.to_numpy(zero_copy_only=False).view(np.uint64)
        at, leaf = zip(*(route(tree, values, radius) for (tree, _), values in zip(trees, halves(points), strict=True)), strict=True)
        at, leaf = np.concatenate(at), np.concatenate(leaf)
        order = np.argsort(at, kind="stable")
        counts = np.bincount(at, minlength=len(points))
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(leaf[order], pa.int32()))

    return run


def _links_of_shard(first_of_second_tree: int, bits: int):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        points = np.sort(table.column("fp").to_numpy().view(np.uint64))
        a, b = links_within(points, int(shard >= first_of_second_tree), bits // 2, bits)
        if len(a):  # one star for each group of the shard
            label = roots(len(points), a, b)
            a = np.flatnonzero(label != np.arange(len(points)))
            b = label[a]
        return pa.table({"a": points[a].view(np.int64), "b": points[b].view(np.int64)})

    return run


def links(fingerprints: DataFrame, bits: int = BITS) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints (column ``fp``, long) linked at ``bits`` or fewer.

    The sample that the shards' boundaries are fitted on is bounded; which pairs are found doesn't depend on it. It can tell
    some 30,000 shards a tree apart, which then hold about n / 30,000 fingerprints of 8 bytes: 30 MB for 100 billion.
    """
    n = fingerprints.count()
    shards = max(LEAST_SHARDS, -(-n // SHARD))
    wanted = min(MAX_SAMPLE, 2 * SAMPLE_PER_SHARD * shards)
    # a cut on a hash, so that no task sends more than its share
    some = fingerprints if n <= wanted else fingerprints.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 32)) < int((1 << 32) * wanted / n))
    trees = fit(np.sort(some.toArrow().column("fp").to_numpy().view(np.uint64)), shards, bits // 2)
    dealt = fingerprints.select("fp", F.explode(F.arrow_udf(_shards_of(trees, bits // 2), "array<int>")("fp")).alias("shard"))
    return dealt.groupBy("shard").applyInArrow(_links_of_shard(trees[0][1], bits), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge but the roots: root is the smallest node that it reaches.

    Each round gives the neighbours of a node, and itself, to the smallest of them, until nothing changes;
    minima are combined before they are shuffled, and every round is written to the shared folder. So are the minima:
    the join with them then has a shuffle on either side, and Spark splits the many edges of a hub.
    """
    edges = written(edges.where("a != b").distinct(), "links", narrow=True)
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least", narrow=True)
        moved = both.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        after = written(moved.where("a != b").distinct(), "links", narrow=True)
        drop_written(edges)
        drop_written(least)
        edges = after
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def grouped(coded: DataFrame, doc_id: str = "doc_id", bits: int = BITS, root: str | None = None) -> DataFrame:
    """Adds component_id to rows with a ``fingerprint``: the smallest id that a row reaches over links.

    ``root`` names a column for the smallest fingerprint of the component, which tells components apart
    even where ids repeat; it is left out by default.

    Every row stays. Rows with a null id take part, and get a null component only if no row of their
    component has an id; rows with a null fingerprint get a null component. Repeated rows share their
    component. An input column called component_id gives way. An empty table gives an empty one.
    """
    coded = written(coded, "fingerprints")
    distinct = coded.where("fingerprint is not null").groupBy(F.col("fingerprint").alias("fp"))
    distinct = written(distinct.agg(F.min(f"`{doc_id}`").alias("least")), "distinct", narrow=True)
    found = components(links(distinct.select("fp"), bits))
    rooted = distinct.join(found, distinct.fp == found.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("smallest"))
    label = rooted.join(smallest, "root").select(F.col("fp").alias(f"{OWN}fp"), F.col("smallest").alias(f"{OWN}component"), F.col("root").alias(f"{OWN}root"))
    out = coded.join(label, coded.fingerprint == F.col(f"{OWN}fp"), "left").drop(f"{OWN}fp")
    results = {"component_id": F.col(f"{OWN}component")} | ({root: F.col(f"{OWN}root")} if root else {})
    return with_results(out, results).drop(*[f"{OWN}{c}" for c in ("component", "root") if f"{OWN}{c}" != root])


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, bits: int = BITS) -> DataFrame:
    """Adds fingerprint (long) and component_id to whole documents, by :func:`with_fingerprint` and :func:`grouped`.

    Null and empty texts have no words and the fingerprint zero, which links like any other; a text of
    fewer words than a shingle is one shingle. Input columns called like the results give way. A task holds a text with its words; bits are counted
    65,536 shingles at a time.
    """
    return grouped(with_fingerprint(docs, text, words), doc_id, bits)


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, bits: int = BITS) -> DataFrame:
    """The columns of ``docs``, one row of each component: that with the smallest id.

    Of rows that share this id, the one with the smallest fingerprint, then text, stays. A component
    without any id keeps all its rows: nothing tells which to take. Columns may be called anything. An empty table gives an empty one.
    """
    coded = with_fingerprint(packed(docs, doc_id, text), text, words).drop(text)
    # who stays is decided on ids and fingerprints; whole rows are dealt out once, to meet the decision
    marked = grouped(coded.select(doc_id, "fingerprint"), doc_id, bits, root=f"{OWN}component_root")
    nameless = F.col("component_id").isNull()
    own = marked.where(nameless | (F.col(f"`{doc_id}`") == F.col("component_id")))
    least = own.groupBy(F.col(f"`{doc_id}`").alias(f"{OWN}id"), f"{OWN}component_root", F.when(nameless, F.col("fingerprint")).alias(f"{OWN}each"))
    keys = least.agg(F.min("fingerprint").alias(f"{OWN}fp")).drop(f"{OWN}component_root")
    # keys that can't be null: no filter against null computes the fingerprints once more, and the rank is taken where the join puts the rows
    id_key, names = lambda c: [F.coalesce(F.col(c).cast("string"), F.lit("")), F.col(c).isNull()], [f"{OWN}key{k}" for k in range(3)]
    rows = coded.select("*", *[c.alias(n) for c, n in zip([*id_key(f"`{doc_id}`"), F.coalesce("fingerprint", F.lit(0))], names, strict=True)])
    keys = keys.select(f"{OWN}each", *[c.alias(n) for c, n in zip([*id_key(f"{OWN}id"), F.col(f"{OWN}fp")], names, strict=True)])
    first = F.row_number().over(Window.partitionBy(*names).orderBy(F.col(f"{OWN}row")[text]))
    rows = rows.join(keys, names).withColumn(f"{OWN}n", first).where(F.col(f"{OWN}each").isNotNull() | (F.col(f"{OWN}n") == 1))
    return unpacked(rows, docs)


def digests(marked: DataFrame) -> DataFrame:
    """doc_id, fingerprint in hexadecimal digits, component_id."""
    return marked.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
