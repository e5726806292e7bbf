"""A full-text index of immutable segments, refreshed by batches and read by version.

A batch of changed and deleted documents becomes one segment: the postings of its texts in blocks, its documents with their
terms, and the ids that it takes out of all earlier segments. A version file lists the segments and the merged statistics. It is
put in place when all of its tables are written, so a search that has read a version never sees half of another, and a batch that
is handed in again changes nothing. Compaction writes what is alive as one segment.

A block holds a term's postings in one range of documents of like length, with the largest frequency and the smallest length
among them. That bounds the score of all its documents under any statistics, so a search for the k best scores the most
promising ranges first and then reads only those blocks that can still beat the k-th best.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.text import tokens
from quern.operators.search import bm25_part, idf
from quern.sources import versions
from quern.sources.shared import dropped, written

#: Documents of a range, about; ranges of the first round of a search.
RANGE_DOCUMENTS, FIRST_RANGES = 1024, 4
#: Ranges that a filter lists; more are joined.
LISTED = 4096
#: Ids that are broadcast (some 20 bytes each); more are joined by a shuffle. This decides speed, not results.
MOST_BROADCAST = 1 << 21
#: Words of the documents that one task makes into blocks (some 40 bytes each while they are sorted), unless a range has more.
WORDS_A_TASK = 1 << 22
EMPTY = {"version": 0, "last_batch": -1, "segments": [], "n": 0, "words": 0}


def changed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", deleted: str = "deleted", order: str | None = None) -> DataFrame:
    """(doc_id, text, deleted): one row for each id. Of several the one with the largest ``order`` holds, by default a deletion, else the largest text.

    ``docs`` is read twice: ids are counted first, and texts of those that come once are neither shuffled nor sorted.
    """
    gone = F.coalesce(F.col(deleted).cast("boolean"), F.lit(False)) if deleted in docs.columns else F.lit(False)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), gone.alias("deleted"), (F.col(order) if order else F.lit(0)).alias("_order")).where("doc_id is not null")
    repeated = written(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "repeated")
    n = repeated.count()
    if not n:
        dropped(repeated)
        return rows.drop("_order")
    some = few(repeated, n)
    last = F.max_by(F.struct("text", "deleted"), F.struct("_order", "deleted", "text")).alias("last")
    held = rows.join(some, "doc_id", "left_semi").groupBy("doc_id").agg(last).select("doc_id", "last.text", "last.deleted")
    return rows.drop("_order").join(some, "doc_id", "left_anti").unionByName(held)


def few(ids: DataFrame, n: int) -> DataFrame:
    """``ids``, n rows of one number, broadcast if they are few enough: then what they are joined with isn't shuffled."""
    return F.broadcast(ids) if n <= MOST_BROADCAST else ids


def _tables(spark: SparkSession, folder: str, segments: Sequence[dict], table: str) -> DataFrame | None:
    """A table of some segments, with the number of each."""
    parts = [spark.read.parquet(f"{folder}/segments/{s['name']}/{table}").withColumn("segment", F.lit(s["number"])) for s in segments]
    return reduce(DataFrame.unionByName, parts) if parts else None


def alive(rows: DataFrame, spark: SparkSession, folder: str, version: dict) -> DataFrame:
    """``rows`` (doc_id, segment) that no later segment has taken out."""
    later = [s for s in version["segments"] if s["taken"] and s["number"] > min(x["number"] for x in version["segments"])]
    if not later:
        return rows
    out = _tables(spark, folder, later, "taken").groupBy("doc_id").agg(F.max("segment").alias("_until"))
    return rows.join(out, "doc_id", "left").where("_until is null or segment >= _until").drop("_until")


def documents(spark: SparkSession, folder: str, version: dict | None = None) -> DataFrame | None:
    """(doc_id, length, text_hash, terms, segment) of all documents of a version, by default the newest; ``terms`` are all words in order."""
    version = version or versions.load(spark, folder) or EMPTY
    docs = _tables(spark, folder, version["segments"], "docs")
    return None if docs is None else alive(docs, spark, folder, version)


def _write_segment(docs: DataFrame, at: str) -> tuple[int, int]:
    """``docs`` (doc_id, text_hash, t) as documents and as blocks of postings; how many documents and words these are."""
    spark = docs.sparkSession
    docs.select("doc_id", F.size("t").alias("length"), "text_hash", F.col("t").alias("terms")).write.parquet(f"{at}/docs")
    sized = spark.read.parquet(f"{at}/docs").withColumn("class", F.floor(F.log2(F.col("length") + 1) * 4).cast("int"))
    classes = sized.groupBy("class").agg(F.ceil(F.count(F.lit(1)) / RANGE_DOCUMENTS).alias("ranges"), F.count(F.lit(1)).alias("n"), F.sum("length").alias("words"))
    counted = classes.collect()  # some 100 rows
    n, words = sum(r.n for r in counted), sum(r.words for r in counted)
    ranges = F.create_map(*[F.lit(x) for r in counted for x in (r["class"], r.ranges)])[F.col("class")] if counted else F.lit(1)
    # words hold no blank, and one text takes less room than an array
    ranged = sized.where("length > 0").select("doc_id", "length", F.array_join("terms", " ").alias("words"), (F.col("class") * F.lit(1 << 32) + F.pmod(F.xxhash64("doc_id"), ranges)).alias("range"))
    # documents are dealt out once, whole ranges to a task; words are counted and put together where they then are
    each = ranged.repartition(max(1, -(-words // WORDS_A_TASK)), "range").select("doc_id", "range", "length", F.explode(F.split("words", " ")).alias("term"))
    _write_blocks(each.groupBy("range", "term", "doc_id", "length").agg(F.count(F.lit(1)).alias("tf")), at)
    return n, words


def _write_blocks(each: DataFrame, at: str) -> None:
    """Postings (term, range, doc_id, length, tf), all of a range in one partition, as blocks: every file is sorted by term and range, so that a search reads a few pages of it."""
    blocks = each.groupBy("range", "term").agg(
        F.count(F.lit(1)).alias("n"), F.max("tf").alias("most"), F.min("length").alias("shortest"), F.collect_list(F.struct("doc_id", "tf", "length")).alias("postings")
    )
    blocks.select("term", "range", "n", "most", "shortest", "postings").sortWithinPartitions("term", "range").write.parquet(f"{at}/blocks")


def refresh(spark: SparkSession, folder: str, changes: DataFrame, batch: int) -> dict:
    """Applies changes (doc_id, text, and deleted if there is one) as one batch; returns the version that holds them.

    Batches have rising numbers; one that has been applied is not applied again. A new text replaces the old one, deleting what isn't there
    does nothing, and rows with a null id are left out. Two writers at once: the second gets :class:`versions.Conflict`, and applies its batch again.
    """
    before = versions.load(spark, folder) or EMPTY
    if batch <= before["last_batch"]:
        return before
    number, name = before["version"] + 1, uuid.uuid4().hex
    at = f"{folder}/segments/{name}"
    changes = changes.select("doc_id", "text", *[c for c in changes.columns if c == "deleted"])
    changes.write.parquet(f"{at}/changes")
    once = changed(spark.read.schema(changes.schema).parquet(f"{at}/changes"))
    added, added_words = _write_segment(once.where("not deleted").select("doc_id", F.xxhash64("text").alias("text_hash"), tokens(F.col("text")).alias("t")), at)
    old, n, words, taken = documents(spark, folder, before), 0, 0, False
    if old is not None:
        # what leaves: its ids hide it, its terms are counted out, so that a search needs no scan to know how many documents a term has
        gone = written(old.select("doc_id", "length").join(once.select("doc_id"), "doc_id"), "gone")
        n, words = gone.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
        if taken := n > 0:
            gone.select("doc_id").write.parquet(f"{at}/taken")
            lost = old.join(few(gone.select("doc_id"), n), "doc_id", "left_semi").select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
            lost.repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{at}/lost")
        dropped(gone)
    versions.remove(spark, f"{at}/changes")
    segments = [*before["segments"], {"number": number, "name": name, "taken": taken}]
    return versions.commit(spark, folder, number, {"last_batch": batch, "segments": segments, "n": before["n"] + added - n, "words": before["words"] + added_words - words})


def compact(spark: SparkSession, folder: str) -> dict:
    """Writes all living documents' postings as one segment; earlier versions stay readable until :func:`vacuum`."""
    before = versions.load(spark, folder)
    if before is None or len(before["segments"]) < 2:
        return before or EMPTY
    number, name = before["version"] + 1, uuid.uuid4().hex
    at = f"{folder}/segments/{name}"
    documents(spark, folder, before).drop("segment").write.parquet(f"{at}/docs")
    each = _tables(spark, folder, before["segments"], "blocks").select("term", "range", "segment", F.inline("postings"))
    # ranges of one class and number, whichever segment they come from, become one; they are cut again where they grow too large
    living = alive(each, spark, folder, before)
    parts = living.groupBy("range").agg(F.ceil(F.approx_count_distinct("doc_id") / RANGE_DOCUMENTS).alias("parts"))
    cut = living.join(parts, "range").withColumn("range", F.col("range") + (1 << 20) * F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.greatest("parts", F.lit(1))))
    _write_blocks(cut.drop("segment", "parts").repartition(max(1, -(-before["words"] // WORDS_A_TASK)), "range"), at)
    return versions.commit(spark, folder, number, before | {"segments": [{"number": number, "name": name, "taken": False}]})


def vacuum(spark: SparkSession, folder: str, keep: int = 1) -> None:
    """Removes all but the newest ``keep`` versions and the segments that none of these lists. Only when no writer and no older search runs."""
    known = versions.numbers(spark, folder)
    wanted = {s["name"] for v in known[-keep:] for s in versions.load(spark, folder, v)["segments"]}
    for v in known[:-keep]:
        versions.remove(spark, f"{folder}/versions/v{v:08d}.json")
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(f"{folder}/segments")
    for s in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at):
        if s.getPath().getName() not in wanted:
            versions.remove(spark, s.getPath().toString())


def synchronise(spark: SparkSession, folder: str, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> dict:
    """Brings the index to what ``docs`` holds now: only new, changed and vanished documents make a batch."""
    now = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    before = versions.load(spark, folder) or EMPTY
    known = documents(spark, folder, before)
    if known is not None:
        # hashes meet, texts don't; of an id that comes more than once every row goes into the batch
        known = known.select("doc_id", F.col("text_hash").alias("_known"), F.lit(True).alias("_there"))
        both = now.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("_hash")).join(known, "doc_id", "full")
        differ = written(both.where("_hash is null or _there is null or _hash <> _known").groupBy("doc_id").agg(F.max("_hash").isNull().alias("deleted")), "differ")
        n = differ.count()
        if not n:
            dropped(differ)
            return before
        texts = now.join(few(differ.where("not deleted").select("doc_id"), n), "doc_id", "left_semi").withColumn("deleted", F.lit(False))
        now = texts.unionByName(differ.where("deleted").select("doc_id", F.lit(None).cast("string").alias("text"), "deleted"))
    return refresh(spark, folder, now, before["last_batch"] + 1)


def as_batches(spark: SparkSession, folder: str) -> Callable[[DataFrame, int], None]:
    """A handler for ``foreachBatch`` that applies every batch of a stream once, whatever is replayed."""
    return lambda rows, batch: refresh(rows.sparkSession, folder, rows, batch) and None


def term_counts(spark: SparkSession, folder: str, version: dict, wanted: Sequence[str]) -> DataFrame:
    """(term, df): how many living documents have each of the wanted terms, from what blocks and segments say of themselves."""
    rows = _tables(spark, folder, version["segments"], "blocks").where(F.col("term").isin(*wanted)).select("term", "n")
    lost = [s for s in version["segments"] if s["taken"]]
    if lost:
        rows = rows.unionByName(_tables(spark, folder, lost, "lost").where(F.col("term").isin(*wanted)).select("term", (-F.col("n")).alias("n")))
    return rows.groupBy("term").agg(F.sum("n").cast("double").alias("df")).where("df > 0")


def search(spark: SparkSession, folder: str, terms: Sequence[str], k: int, version: dict | None = None, first: int = FIRST_RANGES, told: dict | None = None) -> DataFrame:
    """The k best documents (doc_id, score) of a version, by default the newest; exact, whatever blocks are left unread.

    Two rounds: the ``first`` most promising ranges give a k-th best score; then only ranges whose bound reaches it are
    read. The plan filters blocks by term and range. ``told`` gets the numbers of blocks stored for the terms and read.
    """
    version = version or versions.load(spark, folder) or EMPTY
    wanted = sorted(set(terms))
    none = spark.createDataFrame([], "doc_id long, score double")
    if not version["n"] or not wanted:
        return none
    n, mean = float(version["n"]), version["words"] / version["n"]
    df = {r.term: r.df for r in term_counts(spark, folder, version, wanted).collect()}  # a row for each term asked for
    wanted = [w for w in wanted if w in df]
    if not wanted:
        return none
    weight = F.create_map(*[x for w in wanted for x in (F.lit(w), idf(F.lit(n), F.lit(df[w])))])[F.col("term")]
    stored = _tables(spark, folder, version["segments"], "blocks").where(F.col("term").isin(*wanted))
    # the sum of the bounds of a range's blocks bounds every document in it; a little more, as sums of doubles depend on their order
    bound = bm25_part(weight, F.col("most"), F.col("shortest"), F.lit(mean))
    ranges = stored.groupBy("segment", "range").agg((F.sum(bound) * (1 + 1e-9)).alias("bound"), F.count(F.lit(1)).alias("blocks"))
    best = ranges.orderBy(F.desc("bound"), "segment", "range").limit(first).collect()

    def scored(blocks: DataFrame) -> DataFrame:
        each = alive(blocks.select("term", "segment", F.inline("postings")), spark, folder, version)
        part = bm25_part(weight, F.col("tf"), F.col("length"), F.lit(mean))
        return each.groupBy("doc_id").agg(F.sum(part).alias("exact"))

    def within(pairs: list[tuple[int, int]]) -> Column:
        return reduce(Column.__or__, [(F.col("segment") == s) & F.col("range").isin(*[r for x, r in pairs if x == s]) for s in sorted({s for s, _ in pairs})])

    found = scored(stored.where(within([(r.segment, r.range) for r in best])))
    top = found.orderBy(F.desc("exact"), "doc_id").limit(k).collect()
    least = top[-1].exact if len(top) == k else 0.0
    # scores are told to six digits and ties go to the smaller id, so what is equal to six digits counts too
    rest = ranges.where(F.col("bound") >= least - 1e-6)
    if told is not None:
        told |= {"stored": ranges.agg(F.sum("blocks")).first()[0], "read": rest.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]}
    # a filter on ranges reaches the scan; only for very many ranges they are joined
    few = rest.select("segment", "range").limit(LISTED + 1).collect()
    if not few:
        return none
    blocks = stored.where(within([(r.segment, r.range) for r in few])) if len(few) <= LISTED else stored.join(rest.select("segment", "range"), ["segment", "range"])
    return scored(blocks).select("doc_id", F.round("exact", 6).alias("score")).orderBy(F.desc("score"), "doc_id").limit(k)
