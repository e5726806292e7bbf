"""Near-duplicates by an LSH forest over shingle sets; whole sets decide every link.

The forest has TREES orders of one signature of minima: tree t begins with the minimum t * START and goes on in a circle. Sorted by
such an order, sets that agree in their first minima are neighbours, and a stretch whose neighbours have a common prefix
of START is a region. Any pair of a similarity of 0.8 shares a region of some tree with a probability of 0.9998. Sets
that reach each other over regions are candidates; the sets of such a group are held against each other whole, in one task if
they have at most HELD shingles.

Crowded groups are resolved by depth. A region that is too large is cut by a longer prefix, region by region, until what is left
fits a task, so the longest common prefixes are compared first; that links what is nearly alike. What then still
falls into several components is compared exactly: sets of the similarity share one of their first few shingles in any order, and
in the order of rarity these are shingles that few sets have. Around such a shingle sets of the component that has most of it need
not be held against each other, as they are linked; only those with the others are, in blocks. So no task holds a group,
and no link within a group is lost.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import OWN, per_text, written
from .simhash import components

SEED, WORDS, PERCENT = 42, 4, 80
TREES, START = 16, 4
#: Lengths of the prefixes that regions are cut by.
DEPTHS = (START, 6, 8, 12, 16, 24, 32, 48, 64)
#: Shingles whose minima are taken at once.
AT_ONCE = 4096
#: Shingles that one task holds (8 bytes each), unless two texts have more.
HELD = 1 << 20
#: Candidates that are broadcast (some 30 bytes each); more are joined by a shuffle. This decides speed, not results.
MOST_BROADCAST = 1 << 19
KEYS = [f"{OWN}key{k}" for k in range(3)]

_RNG = np.random.default_rng(SEED)
_FACTORS = _RNG.integers(0, 1 << 63, TREES * START, np.uint64) * np.uint64(2) + np.uint64(1)
_ADDED = _RNG.integers(0, 1 << 63, TREES * START, np.uint64)
_SKETCH = pa.struct([("key", pa.int64()), ("n", pa.int64()), ("minima", pa.list_(pa.int32()))])
_EDGE = "key long, root long"


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The distinct hashes of all windows of so many words, in order; a shorter text is one shingle, one without words has none."""
    w = text.encode("utf-8", "replace").lower().split()  # of bytes: A-Z alone, ASCII white space alone
    if not w:
        return np.zeros(0, np.uint64)
    grams = map(b" ".join, zip(*(w[k:] for k in range(words)), strict=False)) if len(w) >= words else iter([b" ".join(w)])
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(g, SEED) for g in grams), np.uint64, max(1, len(w) - words + 1)))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The signature of a set: the low halves of its minima under TREES * START mixings; empty without shingles."""
    least = np.full(TREES * START, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), AT_ONCE):
        np.minimum(least, (_FACTORS[:, None] * hashes[None, k : k + AT_ONCE] + _ADDED[:, None]).min(axis=1), out=least)
    return (least & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32) if len(hashes) else np.zeros(0, np.int32)


def _sketches(words: int):
    def run(texts: list[str]) -> pa.Array:
        sets = [shingles(t, words) for t in texts]
        keys = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
        return pa.StructArray.from_arrays([pa.array(keys), pa.array([len(s) for s in sets], pa.int64()), pa.array([minima(s) for s in sets], pa.list_(pa.int32()))], fields=list(_SKETCH))

    return per_text(run, _SKETCH)


def _sets(words: int):
    return per_text(lambda texts: pa.array([shingles(t, words).view(np.int64) for t in texts], pa.list_(pa.int64())), pa.list_(pa.int64()))


def _minima(sets: pa.Array) -> pa.Array:
    return pa.array([minima(s.values.to_numpy().view(np.uint64)) for s in sets], pa.list_(pa.int32()))


def linked(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """For each set the first that it reaches over pairs of the similarity or more.

    What is reached is only held against what isn't yet, so a large group of near copies takes few steps.
    """
    n = len(sets)
    size, label = np.array([len(s) for s in sets], np.int64), np.arange(n)
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1] if size.sum() else np.zeros(0, np.int64)
    starts = np.r_[0, np.cumsum(size)]
    has = np.zeros(len(codes) + 1, bool)
    left, flat, owner = np.arange(n), codes, np.repeat(np.arange(n), size)  # not reached, their shingles, and whose these are among them
    while len(left):
        first, todo = left[0], [left[0]]
        left, flat, owner = _rest(left, flat, owner, np.arange(len(left)) > 0)
        while todo and len(left):
            own = codes[starts[k := todo.pop()] : starts[k + 1]]
            has[own] = True
            common = np.bincount(owner[has[flat]], minlength=len(left))
            has[own] = False
            near = 100 * common >= percent * (size[k] + size[left] - common)
            if near.any():
                label[left[near]] = first
                todo += left[near].tolist()
                left, flat, owner = _rest(left, flat, owner, ~near)
    return label


def _rest(left: np.ndarray, flat: np.ndarray, owner: np.ndarray, stay: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    here = stay[owner]
    return left[stay], flat[here], (np.cumsum(stay) - 1)[owner[here]]


def _decided(percent: int):
    def run(table: pa.Table) -> pa.Table:
        keys, first = np.unique(table.column("key").to_numpy(), return_index=True)
        lists = table.column("shingles").combine_chunks()
        label = linked([lists[int(i)].values.to_numpy() for i in first], percent)
        moved = np.flatnonzero(label != np.arange(len(keys)))
        return pa.table({"key": keys[moved], "root": keys[label[moved]]})

    return run


# ---------------------------------------------------------------- the forest


def prefix(tree: Column | int, depth: int) -> Column:
    """The region of a tree at a depth: a hash of the first minima in the tree's order."""
    tree = F.lit(tree) if isinstance(tree, int) else tree
    return F.xxhash64(tree, F.slice(F.concat("minima", "minima"), tree * START + 1, depth))


def _same_once(rows: DataFrame, unit: str) -> DataFrame:
    """Of units (key, n, ``unit``) with the same sets one, and none with a single set."""
    same = rows.groupBy(unit).agg(F.count(F.lit(1)).alias("_sets"), F.sum("n").alias("_total"), F.bit_xor(F.xxhash64("key")).alias("_which"))
    once = same.where("_sets > 1").groupBy("_sets", "_total", "_which").agg(F.min(unit).alias(unit))
    return rows.join(once.select(unit, F.col("_total").alias("total")), unit)


def descended(members: DataFrame, held: int) -> DataFrame:
    """(key, unit): crowded sets (key, n, minima) by regions of a depth at which these fit a task.

    Sets that agree in their whole signature and still don't fit are parted by their key.
    """
    left, units = members.select("key", "n", "minima", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")), []
    for depth in DEPTHS:
        rows = written(_same_once(left.withColumn("unit", prefix(F.col("tree"), depth)), "unit").withColumn("large", F.col("total") > held), f"depth{depth}")
        units.append(rows.where("not large").select("key", F.xxhash64(F.lit(depth), "unit").alias("unit")))
        left = rows.where("large").select("key", "n", "minima", "tree")
        if left.isEmpty():
            break
    else:
        part = F.pmod(F.xxhash64("key"), F.ceil(F.col("total") / held))
        units.append(rows.where("large").select("key", F.xxhash64(F.lit(0), "unit", part).alias("unit")))
    return reduce(DataFrame.union, units)


def prefix_units(members: DataFrame, shingled: DataFrame, percent: int, held: int) -> DataFrame:
    """(key, unit): sets of members (key, n, root, label) that may be near others of their root with another label.

    Sets of the similarity share one of the first n - ceil(n * percent / 100) + 1 shingles of each, in any order; here the rarest come first.
    """
    own = members.join(shingled, "key").select("root", "key", "n", "label", F.explode("shingles").alias("shingle"))
    found = written(own.groupBy("root", "shingle").agg(F.count(F.lit(1)).alias("df")), "found")
    most = F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1
    ordered = own.join(found, ["root", "shingle"]).groupBy("root", "key", "n", "label").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("all"))
    first = ordered.select("root", "key", "n", "label", F.inline(F.slice("all", F.lit(1), most.cast("int")))).where("df > 1")
    rows = written(first.select("key", "n", "label", F.xxhash64("root", "shingle").alias("unit")), "firsts")
    # the label that has most around a shingle, and what the others have
    by_label = rows.groupBy("unit", "label").agg(F.sum("n").alias("n"))
    units = by_label.groupBy("unit").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("of_main"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("labels"))
    rows = rows.join(units.where("labels > 1"), "unit").select("unit", "key", "n", "main", "of_main", "all", (F.col("label") == F.col("main")).alias("is_main"))
    rows = written(_same_once(rows, "unit"), "around")
    small = rows.where(F.col("all") <= held).select("key", F.xxhash64(F.lit(1), "unit").alias("unit"))
    half = F.lit(held // 2)
    large = rows.where(F.col("all") > held).select("*", F.ceil((F.col("all") - F.col("of_main")) / half).cast("int").alias("others"), F.ceil(F.col("of_main") / half).cast("int").alias("mains"))
    block = lambda of: F.pmod(F.xxhash64(F.lit(1), "key"), F.col(of)).cast("int")
    each = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    named = lambda kind, i, j: F.xxhash64(F.lit(kind), "unit", i, j).alias("unit")
    ours = large.where("is_main").select("key", "unit", block("mains").alias("i"), each("others").alias("j"))
    theirs = large.where("not is_main")
    crossed = theirs.select("key", "unit", each("mains").alias("i"), block("others").alias("j"))
    among = theirs.select("key", "unit", block("others").alias("i"), each("others").alias("j")).select("key", "unit", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"))
    return small.union(ours.select("key", named(2, "i", "j"))).union(crossed.select("key", named(2, "i", "j"))).union(among.select("key", named(3, "i", "j")))


def crowded_roots(members: DataFrame, shingled: DataFrame, percent: int, held: int) -> DataFrame:
    """(key, root) of sets in groups too large for a task: the smallest key that each reaches, but for those that are it.

    ``members`` (key, n, minima, root) are the sets with the root of their group, ``shingled`` (key, shingles) their shingles.
    """
    decide = lambda units: units.join(shingled, "key").groupBy("unit").applyInArrow(_decided(percent), _EDGE)
    edges = written(decide(descended(members, held)), "deep", narrow=True)
    as_edges = lambda df: df.select(F.col("key").alias("a"), F.col("root").alias("b"))
    found = components(as_edges(edges)).select(F.col("node").alias("key"), F.col("root").alias("label"))
    labelled = members.select("key", "n", "root").join(found, "key", "left").withColumn("label", F.coalesce("label", "key"))
    labelled = written(labelled, "labelled", narrow=True)
    several = labelled.groupBy("root").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("root")
    several = written(several, "several", narrow=True)
    if several.isEmpty():
        return found.select("key", F.col("label").alias("root"))
    more = decide(prefix_units(labelled.join(several, "root"), shingled, percent, held))
    return components(as_edges(edges.union(more))).select(F.col("node").alias("key"), "root")


# ---------------------------------------------------------------- documents


def row_keys(doc_id: str, text_hash: str) -> list[Column]:
    """The columns KEYS, without null, that tell rows apart by an id that may be null and the hash of the text."""
    own = F.col(doc_id)
    return [c.alias(n) for c, n in zip([F.coalesce(own.cast("string"), F.lit("")), own.isNull(), F.col(text_hash)], KEYS, strict=True)]


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))


def sketched(docs: DataFrame, doc_id: str, text: str, words: int, *others: Column) -> DataFrame:
    """(id, th, key, n, minima, others) of every document, in the shared folder."""
    made = F.arrow_udf(_sketches(words), "struct<key: bigint, n: bigint, minima: array<int>>")
    rows = docs.select(*others, F.col(f"`{doc_id}`").alias("id"), text_hash(text).alias("th"), made(F.col(f"`{text}`").cast("string")).alias("s"))
    return written(rows.select(*[c for c in rows.columns if c != "s"], "s.key", "s.n", "s.minima"), "sketches")


def set_roots(docs: DataFrame, sketches: DataFrame, doc_id: str, text: str, words: int, percent: int, held: int) -> DataFrame:
    """(key, root): what each shingle set is linked to, directly or over others; sets that are alone or a root are left out."""
    sets = sketches.where("n > 0").groupBy("key").agg(F.min(F.struct("id", "th", "n", "minima")).alias("one"))
    sets = written(sets.select("key", "one.id", "one.th", "one.n", "one.minima"), "sets")
    regions = sets.select("key", F.explode(F.array(*[prefix(t, START) for t in range(TREES)])).alias("region"))
    shared = regions.groupBy("region").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least < most")
    near = regions.join(shared, "region").where("key > least").select(F.col("key").alias("a"), F.col("least").alias("b"))
    return decided_roots(docs, sets, near, doc_id, text, words, percent, held)


def decided_roots(docs: DataFrame, sets: DataFrame, near: DataFrame, doc_id: str, text: str, words: int, percent: int, held: int) -> DataFrame:
    """(key, root) as :func:`set_roots` has them, from candidates ``near`` (a, b) among ``sets`` (key, id, th, n, and minima if they are known).

    Candidates that reach each other are held against each other whole. Minima are only needed for groups too large for a task.
    """
    found = components(near)
    found = found.union(found.select("root", "root")).distinct().withColumnRenamed("node", "key")
    some = found.join(sets, "key").select("key", "root", "n", *row_keys("id", "th"))
    totals = some.groupBy("root").agg((F.sum("n") > held).alias("large"))
    some = written(some.join(totals, "root"), "candidates", narrow=True)
    n, crowd = some.agg(F.count(F.lit(1)), F.max(F.col("large").cast("int"))).first()
    known = F.broadcast(some) if n <= MOST_BROADCAST else some
    texts = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{doc_id}`").alias("id"), text_hash(text).alias("th")).select("text", *row_keys("id", "th"))
    whole = texts.join(known, KEYS).select("root", "large", "key", F.arrow_udf(_sets(words), "array<bigint>")("text").alias("shingles"))
    roots = whole.where("not large").select("root", "key", "shingles").groupBy("root").applyInArrow(_decided(percent), _EDGE)
    if crowd:
        # rows that share id and text hash have the same shingles
        shingled = written(whole.where("large").groupBy("key").agg(F.first("shingles").alias("shingles")), "shingles")
        known = sets if "minima" in sets.columns else shingled.select("key", F.size("shingles").cast("long").alias("n"), F.arrow_udf(_minima, "array<int>")("shingles").alias("minima"))
        members = some.where("large").select("key", "root").distinct().join(known.select("key", "n", "minima"), "key")
        roots = written(roots, "small").unionByName(crowded_roots(members, shingled, percent, held))
    return written(roots, "roots", narrow=True)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT, held: int = HELD) -> DataFrame:
    """The columns of ``docs`` without the text, and n_shingles, component_id and kept.

    Documents are linked where their sets of shingles (so many words, A-Z in lower case) have at least ``percent`` hundredths of
    their union in common. component_id is the smallest id that a document reaches, itself included, and kept whether it is its own. A text of
    fewer words than a shingle is one shingle. Null and empty texts, and those of white space alone, have no shingles and are linked with nothing.
    Every row stays. Rows with a null id take part; they are never kept, and have a null component only if no row that they reach has an
    id. Repeated rows share their component. Input columns called like the results give way. An empty table gives an empty one. A task
    holds a text with its words and shingles. Sets are told apart by 64 bits: among a billion different ones some 0.03 pairs would be taken for equal.
    """
    results = ("n_shingles", "component_id", "kept")
    others = [c for c in docs.columns if c.lower() not in (text.lower(), *results)]
    carried = F.struct(F.lit(0).alias(f"{OWN}0"), *[F.col(f"`{c}`") for c in others]).alias("carried")
    sketches = sketched(docs, doc_id, text, words, carried)
    roots = set_roots(docs, sketches, doc_id, text, words, percent, held)
    least = sketches.where("n > 0").groupBy("key").agg(F.min("id").alias("least")).join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = written(least, "least", narrow=True)
    smallest = least.groupBy("root").agg(F.min("least").alias("smallest"))
    labels = written(least.join(smallest, "root").select(F.col("key").alias("_key"), "smallest"), "labels", narrow=True)
    rows = sketches.join(labels, F.col("key") == F.col("_key"), "left")
    component = F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("id"))
    found = {"n_shingles": F.col("n"), "component_id": component, "kept": F.coalesce(F.col("id") == component, F.lit(False))}
    return rows.select(*[F.col("carried")[c].alias(c) for c in others], *[v.alias(k) for k, v in found.items()])


def digests(marked: DataFrame) -> DataFrame:
    return marked.select("doc_id", "n_shingles", "component_id", "kept")


ORACLE_SQL = r"""WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda k: array_to_string(w[k:k + 3], ' ')) END) AS g FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
e2 AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS place FROM d UNION SELECT r.doc_id, e2.b FROM r JOIN e2 ON e2.a = r.place),
m AS (SELECT doc_id, min(place) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)"""
