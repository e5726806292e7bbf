"""Placing documents in shards by a hierarchical weighted hash tree, with DataFrame functions alone.

A row descends three levels: region, rack, shard. At each node every child draws from a hash of the row's
key and the child's own name: ``-ln(u) / weight``, the smallest draw wins, and a child's chance is its
share of the weight. A child's draw depends on nothing but the key, its name and its weight, so a change
of weights moves rows only into (or out of) the subtrees whose weights change. Shards fill racks and racks
fill regions in order; a shard that opens a new region takes rows only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import OWN, let, with_results, written

#: Hexadecimal digits of a digest that make a draw: 52 bits, which a double holds.
DIGITS, STEPS = 13, float(1 << 52)
#: Parts of a shard that are ranked on their own; offsets are a table of shards times this many rows.
BINS = 1024


@dataclass(frozen=True)
class Tree:
    """``shards`` leaves in racks of ``per_rack`` and regions of ``per_region`` racks; ``weights`` by shard, 1 if not given."""

    shards: int
    per_rack: int = 2
    per_region: int = 4
    weights: tuple[float, ...] | None = None

    def shard_weights(self) -> list[float]:
        given = list(self.weights or [1.0] * self.shards)
        if len(given) != self.shards or min(given) < 0 or not sum(given):
            raise ValueError("a weight of zero or more for each shard, not all zero")
        return given

    def levels(self) -> list[tuple[str, int, list[float]]]:
        """(name, children of a node, weight of every node of the level), from the root down."""
        shard = self.shard_weights()
        racks = [sum(shard[k : k + self.per_rack]) for k in range(0, self.shards, self.per_rack)]
        regions = [sum(racks[k : k + self.per_region]) for k in range(0, len(racks), self.per_region)]
        return [("region", len(regions), regions), ("rack", self.per_region, racks), ("shard", self.per_rack, shard)]


def draw(key: Column, level: str, child: Column) -> Column:
    """A number in (0, 1) that only the key and the child's name decide."""
    digest = F.md5(F.concat(key, F.lit(f"/{level}/"), child.cast("string")))
    return (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long") + F.lit(0.5)) / F.lit(STEPS)


def child_drawn(key: Column, node: Column, level: str, fan: int, weights: list[float]) -> Column:
    """Of a node's children, the one with the smallest weighted draw; a child beyond the last has no weight."""
    table = F.array(*[F.lit(w) for w in [*weights, *[0.0] * fan]])

    def scored(child: Column) -> Column:
        weight = F.get(table, child)
        score = F.when(weight > 0, -F.log(draw(key, level, child)) / weight)
        return F.struct(score.isNull().alias("none"), score.alias("score"), child.alias("child"))

    first = (node * F.lit(fan)).cast("int")
    return F.array_min(F.transform(F.sequence(first, first + F.lit(fan - 1)), scored))["child"]


def descend(key: Column, tree: Tree) -> Column:
    """The shard of a key, which must not be null."""
    node = F.lit(0)
    for level, fan, weights in tree.levels():
        node = let(node, partial(lambda level, fan, weights, n: child_drawn(key, n, level, fan, weights), level, fan, weights))
    return node


def key_of(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def place(docs: DataFrame, tree: Tree, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds size, text_crc32, law, shard, slot and grown_shard to documents.

    size is the text's bytes in UTF-8 plus 8, text_crc32 their checksum (null text: as empty). shard is decided by the id
    and the tree alone, so repeated ids share a shard, and null ids share one. grown_shard is the shard under
    one more shard of weight 1; it differs from shard only where it is that shard if it opens a region, else
    only for rows of the last region. slot numbers a shard's rows from 0 without a gap, by a bin of the row's
    hash, then id (null first), checksum and size; equal rows take neighbouring slots. Input columns called
    like the results give way. An empty table gives an empty one.
    """
    grown = Tree(tree.shards + 1, tree.per_rack, tree.per_region, (*tree.shard_weights(), 1.0))
    key, crc = key_of(F.col(f"`{doc_id}`")), F.crc32(F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8"))
    sized = with_results(
        docs,
        {
            "size": (F.coalesce(F.octet_length(f"`{text}`"), F.lit(0)) + F.lit(8)).cast("long"),
            "text_crc32": crc,
            "law": F.lit("key"),
            "shard": descend(key, tree),
            "grown_shard": descend(key, grown),
        },
    )
    bin_ = F.conv(F.substring(F.md5(F.concat(key, F.lit("/"), F.col("text_crc32").cast("string"))), 1, 8), 16, 10).cast("long") % F.lit(BINS)
    return sized.withColumn(f"{OWN}bin", bin_)


def number(placed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Adds slot to what :func:`place` gives. Bins are ranked side by side, so no shard meets in one task."""
    bins = placed.groupBy("shard", f"{OWN}bin").agg(F.count(F.lit(1)).alias(f"{OWN}n"))
    before = Window.partitionBy("shard").orderBy(f"{OWN}bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bins.select("shard", f"{OWN}bin", F.coalesce(F.sum(f"{OWN}n").over(before), F.lit(0)).alias(f"{OWN}before"))
    within = Window.partitionBy("shard", f"{OWN}bin").orderBy(F.col(f"`{doc_id}`").asc_nulls_first(), "text_crc32", "size")
    ranked = placed.withColumn(f"{OWN}rank", F.row_number().over(within) - F.lit(1))
    # at most shards x BINS rows
    joined = ranked.join(F.broadcast(offsets), ["shard", f"{OWN}bin"])
    slot = (F.col(f"{OWN}rank") + F.col(f"{OWN}before")).cast("long")
    return with_results(joined, {"slot": slot}).drop(*[f"{OWN}{c}" for c in ("bin", "rank", "before")])


def shard_documents(docs: DataFrame, tree: Tree, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """:func:`place` and :func:`number`; what is placed is written once, so texts are read once."""
    return number(written(place(docs, tree, doc_id, text), "placed"), doc_id)


def oracle_sql(tree: Tree) -> str:
    """The same in DuckDB's SQL, over documents(doc_id, text)."""
    polynomial = 0xEDB88320
    table = list(range(256))
    for _ in range(8):
        table = [(x >> 1) ^ (polynomial if x & 1 else 0) for x in table]
    grown = Tree(tree.shards + 1, tree.per_rack, tree.per_region, (*tree.shard_weights(), 1.0))

    def steps(tree: Tree, out: str) -> str:
        sql, frm = "", "keyed"
        for level, fan, weights in tree.levels():
            of = "0" if level == "region" else "t.node"
            sql += (
                f", {out}_{level} AS (SELECT t.row, any_value(t.key) AS key, arg_min({of} * {fan} + c.k, -ln((('0x' || substr(md5(t.key || '/{level}/' || ({of} * {fan} + c.k)), 1, {DIGITS}))::BIGINT + 0.5) / {STEPS}) / w.w) AS node"
                f" FROM {frm} t, (SELECT unnest(range({fan})) AS k) c, (SELECT unnest(range({len(weights)})) AS n, unnest([{', '.join(map(str, weights))}]::DOUBLE[]) AS w) w"
                f" WHERE w.n = {of} * {fan} + c.k AND w.w > 0 GROUP BY t.row)"
            )
            frm = f"{out}_{level}"
        return sql

    return f"""
WITH keyed AS (SELECT row_number() OVER () AS row, doc_id, coalesce(doc_id::VARCHAR, '') AS key, coalesce(text, '') AS text FROM documents),
bytes AS (SELECT row, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT) AS b FROM keyed),
crc AS (SELECT row, len(b) + 8 AS size, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, x: xor(a >> 8, ([{", ".join(map(str, table))}]::BIGINT[])[(xor(a, x) & 255) + 1])), 4294967295) AS crc FROM bytes)
{steps(tree, "now")}{steps(grown, "then")},
placed AS (SELECT k.doc_id, c.size, c.crc, n.node AS shard, t.node AS grown, ('0x' || substr(md5(k.key || '/' || c.crc), 1, 8))::BIGINT % {BINS} AS bin
  FROM keyed k JOIN crc c USING (row) JOIN now_shard n USING (row) JOIN then_shard t USING (row))
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY bin, doc_id NULLS FIRST, crc, size) - 1 AS slot, grown::INTEGER AS grown_shard
FROM placed"""


def digests(placed: DataFrame) -> DataFrame:
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
