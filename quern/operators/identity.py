"""Which records describe one document, and what the document keeps of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import dates
from quern.functions import text as T
from quern.sources.shared import dropped, written


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, cluster): the smallest id that each node reaches over edges (a, b), in either direction.

    Every round links the larger neighbours of each node to the smallest of all, and then the smaller ones and the node itself to the smallest of these,
    until only stars are left. Neither step makes more edges than it gets, so a long chain takes more rounds but no more room. Minima are combined before
    they are shuffled, so a node with many edges is no burden. What a round has written goes with the next.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now, state = written(edges.where("a <> b").select(larger, smaller).distinct(), "edges"), None
    while not now.isEmpty():
        # written, so that the joins have a shuffle on either side and Spark can split the edges of a hub
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
        # an edge hangs its larger node on what is smallest around the smaller one
        hung = written(now.join(least.withColumnRenamed("a", "b"), "b").select("a", F.col("m").alias("b")).distinct(), "hung")
        dropped(now, least)
        least = written(hung.groupBy("a").agg(F.min("b").alias("m")), "least")
        after = hung.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.select("a", F.col("m").alias("b")))
        now, before = written(after.distinct(), "edges"), state
        dropped(hung, least)
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
    found = now.select(F.col("a").alias("id"), F.col("b").alias("cluster"))
    return nodes.select("id").distinct().join(found, "id", "left").select("id", F.coalesce("cluster", "id").alias("cluster"))


def star_edges(rows: DataFrame, key: str) -> DataFrame:
    """Edges from every record to the smallest one of the same key: n records make n edges, not all pairs."""
    keyed = rows.where(F.coalesce(F.col(key), F.lit("")) != "").select("id", key)
    least = keyed.groupBy(key).agg(F.min("id").alias("b"))
    return keyed.join(least, key).where("id <> b").select(F.col("id").alias("a"), "b")


#: How strong links are: given ones, those by address, those by title.
GIVEN, ADDRESS, TITLE = 3, 2, 1


def match_links(records: DataFrame, same: DataFrame | None = None) -> DataFrame:
    """Links (a, b, strength) between records (id, original_title, url) of one title or address, and those of ``same`` (a, b)."""
    keyed = records.select("id", T.title_key(F.col("original_title")).alias("title"), T.url_key(F.col("url")).alias("address"))
    links = star_edges(keyed, "title").withColumn("strength", F.lit(TITLE)).union(star_edges(keyed, "address").withColumn("strength", F.lit(ADDRESS)))
    return links if same is None else links.union(same.select("a", "b", F.lit(GIVEN)))


def match_edges(records: DataFrame, same: DataFrame | None = None) -> DataFrame:
    """Edges (a, b) of :func:`match_links`."""
    return match_links(records, same).select("a", "b").distinct()


def kept_apart(nodes: DataFrame, links: DataFrame, apart: DataFrame) -> DataFrame:
    """(id, cluster): components over links (a, b, strength), but no pair of ``apart`` (a, b) in one cluster, whatever leads from one to the other.

    Components without such a pair stay whole. In the others links are taken by strength, the strongest first. At each strength what isn't yet tied to a record that is to be
    kept apart from another goes, as the whole that it is so far, to the one that is fewest links away, of several to the smallest. Then clusters of
    such records unite, the pair with the smallest ids first, where none is to be kept apart from one of the other. What is left
    without such a record unites as usual. So the result doesn't depend on the order of rows, third records keep their strongest
    links, and only the weakest are cut. A cluster is named by its smallest id. Strengths are few; pairs with null or of a record with itself don't count.
    """
    plain = written(components(nodes, links), "plain")
    pairs = apart.where("a <> b").select("a", "b").distinct()
    at = plain.select(F.col("id").alias("a"), "cluster").join(pairs, "a").join(plain.select(F.col("id").alias("b"), F.col("cluster").alias("other")), "b")
    pairs = written(at.where("cluster = other").select("a", "b", "cluster"), "apart")
    if pairs.isEmpty():
        return plain
    split = pairs.select("cluster").distinct()
    seeds = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("seed", F.col("id"))
    # members of split components: the whole that each belongs to so far, and the record to be kept apart that this is tied to
    members = written(plain.join(split, "cluster", "left_semi").select("id", F.col("id").alias("whole")).join(seeds, "id", "left"), "members")
    inside = links.where("a <> b").join(members.select(F.col("id").alias("a")), "a", "left_semi").groupBy("a", "b").agg(F.max("strength").alias("strength"))
    inside = written(inside, "inside")
    for (strength,) in inside.select("strength").distinct().orderBy(F.desc("strength")).collect():
        own = lambda c: members.select(F.col("id").alias(c), F.coalesce("seed", "whole").alias(f"{c}_whole"), F.col("seed").alias(f"{c}_seed"))  # noqa: E731, B023
        here = inside.where(F.col("strength") == strength).join(own("a"), "a").join(own("b"), "b").where("a_whole <> b_whole")
        here = written(here.select("a_whole", "a_seed", "b_whole", "b_seed").distinct(), "here")
        if here.isEmpty():
            dropped(here)
            continue
        moved = _tied(here)
        united = _united(here, moved, pairs, members)
        free = here.where("a_seed is null and b_seed is null").select(F.col("a_whole").alias("a"), F.col("b_whole").alias("b"))
        free = free.join(moved.select(F.col("whole").alias("a")), "a", "left_anti").join(moved.select(F.col("whole").alias("b")), "b", "left_anti")
        joined = components(free.select(F.explode(F.array("a", "b")).alias("id")), free).select(F.col("id").alias("whole"), F.col("cluster").alias("next"))
        after = members.join(moved.select("whole", F.col("seed").alias("new_seed")), "whole", "left").withColumn("seed", F.coalesce("seed", "new_seed")).drop("new_seed")
        after = after.join(united, "seed", "left").withColumn("seed", F.coalesce("into", "seed")).join(joined, "whole", "left")
        after = written(after.select("id", F.coalesce("next", "whole").alias("whole"), "seed"), "members")
        dropped(members, here, moved, united)
        members = after
    group = F.coalesce("seed", "whole")
    least = members.groupBy(group.alias("group")).agg(F.min("id").alias("cluster"))
    found = members.select("id", group.alias("group")).join(least, "group").select("id", "cluster")
    found = written(plain.join(split, "cluster", "left_anti").select("id", "cluster").union(found), "found")
    dropped(members, inside, pairs, plain)
    return found


def _tied(here: DataFrame) -> DataFrame:
    """(whole, seed): wholes without a seed, tied to the seed that is fewest links away; of several the smallest."""
    ways = here.select(F.col("a_whole").alias("whole"), F.col("a_seed").alias("seed"), F.col("b_whole").alias("from"), F.col("b_seed").alias("from_seed"))
    ways = ways.union(here.select("b_whole", "b_seed", "a_whole", "a_seed"))
    ways = written(ways.where("seed is null").select("whole", "from", "from_seed"), "ways")
    tied = written(ways.where("from_seed is not null").groupBy("whole").agg(F.min("from_seed").alias("seed")), "tied")
    if tied.isEmpty():
        dropped(ways)
        return tied
    while True:
        near = ways.where("from_seed is null").join(tied.select(F.col("whole").alias("from"), "seed"), "from").join(tied.select("whole"), "whole", "left_anti")
        more = written(near.groupBy("whole").agg(F.min("seed").alias("seed")), "more")
        if more.isEmpty():
            dropped(ways, more)
            return tied
        after = written(tied.union(more), "tied")
        dropped(tied, more)
        tied = after


def _united(here: DataFrame, moved: DataFrame, apart: DataFrame, members: DataFrame) -> DataFrame:
    """(seed, into): seeds that go into another's cluster over links between their clusters, never together with one to be kept apart.

    In each round every pair that is the first allowed one of both its clusters unites: that is what taking all pairs one by one in order gives.
    """
    to = lambda c: F.coalesce(f"{c}_seed", f"{c}_new")
    new = lambda c: moved.select(F.col("whole").alias(f"{c}_whole"), F.col("seed").alias(f"{c}_new"))
    pairs = here.join(new("a"), "a_whole", "left").join(new("b"), "b_whole", "left").select(to("a").alias("x"), to("b").alias("y")).where("x <> y")
    pairs = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    pairs = written(pairs.withColumn("place", F.struct("x", "y")), "pairs")  # clusters change, the order of pairs doesn't
    if pairs.isEmpty():
        return pairs.select(F.col("x").alias("seed"), F.col("y").alias("into"))
    seed_of = members.where("seed is not null").select("id", "seed")
    of = lambda c, n: seed_of.select(F.col("id").alias(c), F.col("seed").alias(n))
    against = apart.select("a", "b").join(of("a", "x"), "a").join(of("b", "y"), "b").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    against = written(against, "against")
    into = written(pairs.select(F.explode(F.array("x", "y")).alias("seed")).distinct().withColumn("into", F.col("seed")), "into")
    while True:
        allowed = pairs.join(against, ["x", "y"], "left_anti")
        best = allowed.select(F.explode(F.array("x", "y")).alias("seed"), F.struct("place", "x", "y").alias("pair")).groupBy("seed").agg(F.min("pair").alias("pair"))
        taken = written(best.groupBy("pair").count().where("count = 2").select(F.col("pair.y").alias("old"), F.col("pair.x").alias("new")), "taken")
        if taken.isEmpty():
            dropped(pairs, against, taken)
            return into
        renamed = lambda df, c: df.join(taken.select(F.col("old").alias(c), "new"), c, "left").withColumn(c, F.coalesce("new", c)).drop("new")  # noqa: E731, B023
        order = lambda df: renamed(renamed(df, "x"), "y").where("x <> y").groupBy(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        after = [written(order(pairs).agg(F.min("place").alias("place")), "pairs"), written(order(against).agg(F.count(F.lit(1)).alias("n")).drop("n"), "against")]
        after.append(written(renamed(into, "into").select("seed", "into"), "into"))
        dropped(pairs, against, into, taken)
        pairs, against, into = after


def merge(clustered: DataFrame, priority: str = "priority") -> DataFrame:
    """One row for each cluster: the fields of its best record, and the sources of all.

    The record with the smallest ``priority`` wins, of equal ones that with the earliest date known to the day (column
    ``date``, text or a partial date, if there is one), then that with the smallest id; fields that it lacks come from the next that has them.
    """
    fields = [c for c in clustered.columns if c not in ("cluster", "id", "source", priority)]
    day = F.lit(None).cast("int")
    if "date" in clustered.columns:
        date = dates.parse(F.col("date")) if clustered.schema["date"].dataType.typeName() == "string" else F.col("date")
        day = F.when(dates.precision(date) == 3, dates.sort_key(date))
    order = F.struct(F.col(priority), day.isNull(), day, F.col("id"))
    kept = [F.min_by(F.struct(F.col(c).alias("v")), F.when(F.col(c).isNotNull(), order))["v"].alias(c) for c in fields]
    return clustered.groupBy("cluster").agg(F.min_by("id", order).alias("id"), *kept, F.array_sort(F.collect_set("source")).alias("sources"), F.count(F.lit(1)).alias("n_records"))


def best_dates(clustered: DataFrame, date: str = "date") -> DataFrame:
    """(cluster, date): the most exact date of each cluster's records, of equally exact ones the earliest."""
    exact = F.when(F.col(date)["d"].isNotNull(), 3).when(F.col(date)["m"].isNotNull(), 2).when(F.col(date)["y"].isNotNull(), 1)
    key = F.coalesce(F.col(date)["y"], F.lit(0)) * 10000 + F.coalesce(F.col(date)["m"], F.lit(0)) * 100 + F.coalesce(F.col(date)["d"], F.lit(0))
    return clustered.groupBy("cluster").agg(F.max_by(date, F.when(exact.isNotNull(), F.struct(exact, -key))).alias(date))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each text: its smallest id, its sources in order and how many documents have it."""
    by_text = docs.groupBy(F.xxhash64("text").alias("h1"), F.sha2("text", 256).alias("h2"))
    return by_text.agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources")).drop("h1", "h2")


def told_apart(docs: DataFrame) -> DataFrame:
    """Adds display_title: documents of one title get their bill number or, of several issuers, their issuer behind it."""
    # three numbers for each title, combined before the shuffle and joined back, so a common title fills no task
    titles = docs.where("title is not null").groupBy(F.col("title").alias("_title"))
    titles = titles.agg(F.count(F.lit(1)).alias("_n"), (F.min("issuer") != F.max("issuer")).alias("_several")).where("_n > 1")
    suffix = F.when(F.col("_n") > 1, F.when(F.col("bill_no").isNotNull(), F.col("bill_no")).when(F.col("_several"), F.col("issuer")))
    shown = F.when(suffix.isNotNull(), F.concat("title", F.lit(" ("), suffix, F.lit(")"))).otherwise(F.col("title"))
    return docs.join(titles, F.col("title") == F.col("_title"), "left").withColumn("display_title", shown).drop("_title", "_n", "_several")
