"""Quality rules with DataFrame functions alone: hashed n-gram log-likelihood ratios and counts of repetition.

Words and word pairs are hashed to buckets, whose number grows with the input. One pass over the whole corpus counts the
buckets for all documents (raw) and for trusted ones (target); a document scores the mean over its
n-grams of ``ln p_target - ln p_raw``, both smoothed so that a bucket the target never saw costs little
where it couldn't be expected to see it. A fixed threshold decides every document alike.

One lambda hashes the words of a text. N-grams are then rows of generated code: the hashes are zipped with themselves
shifted by one and exploded, to be counted or summed. All that is known of a text is kept by its hash, one
row for each distinct text, and joined to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import OWN, drop_written, let, packed, unpacked, with_results, written

#: Least number of buckets, smoothing in target counts, and the least mean ratio of a kept document.
BUCKETS, SMOOTHING, THRESHOLD = 1 << 18, 4.0, -0.15
#: Buckets grow as this power of the n-grams, one for so many of that; bytes of text that stand for one n-gram.
GROWTH, SHARED_BY, BYTES_A_GRAM = 0.75, 5, 3
#: Parts that ratios are rounded to.
UNIT = float(1 << 32)
#: Ratios that one array or broadcast holds (8 bytes each in the array); of more buckets the most frequent are broadcast and the others joined.
SLOTS = 10 << 20
#: Rows of texts that are broadcast; more are joined by a shuffle. This decides speed, not results.
MOST_BROADCAST = 1 << 19
#: Trusted documents that the target is counted on: of more so many are drawn by a hash of their ids (some 60 bytes each are broadcast).
MOST_TRUSTED = 1 << 20
#: N-grams that one task counts at most, unless the table is cut more coarsely; ratios gathered at once on the way to the array.
GRAMS_A_TASK, CHUNK = 1 << 26, 4096
LEAST_WORDS, MOST_REPEATED = 50, 50
WORD, SYMBOLS, WHITE_CHARS = r"[^\x20\x09-\x0D]+", "#*$%&|<>", " \t\n\x0b\x0c\r"

_TEXT, _HASHES = f"{OWN}text", f"{OWN}hashes"
_KEYS = [f"{OWN}text_key{k}" for k in range(2)]
_FACTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def indices(count: Column) -> Column:
    """0 to count - 1, or nothing."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def hashed(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the whole text, empty for null, and the hash of each of its words."""
    whole = docs.withColumn(_TEXT, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    return whole.withColumn(_HASHES, F.transform(F.regexp_extract_all(_TEXT, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)))


def windows(hashes: Column, words: int) -> Column:
    """The hash of every window of so many words."""

    def at(i: Column) -> Column:
        return F.xxhash64(*[F.get(hashes, i + F.lit(k)) for k in range(words)])

    return F.transform(indices(F.size(hashes) - F.lit(words - 1)), at)


def bucket_number(docs: DataFrame, text: str = "text") -> int:
    """Buckets for the n-grams of the corpus, by the bytes of all its texts: their number to the power GROWTH, a fifth of it."""
    return _buckets(text_bytes(docs, text))


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string"))).alias("n")).first().n or 0


def _buckets(size: int) -> int:
    return max(BUCKETS, int((size / BYTES_A_GRAM) ** GROWTH / SHARED_BY))


def repeated_words(hashes: Column, words: int = 3) -> Column:
    """How many words stand in windows that are found twice or more."""

    def covered(marked: Column) -> Column:  # marked: the windows' starts, in order
        last = F.size(marked) - F.lit(1)
        gaps = F.transform(indices(last), lambda k: F.least(F.lit(words), F.get(marked, k + F.lit(1)) - F.get(marked, k)))
        return F.when(last < 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(words), lambda a, g: a + g))

    def starts(ordered: Column) -> Column:
        def twin(x: Column, k: Column) -> Column:
            after = F.coalesce(F.get(ordered, k + F.lit(1))["h"] == x["h"], F.lit(False))
            return after | F.coalesce(F.get(ordered, k - F.lit(1))["h"] == x["h"], F.lit(False))

        return F.sort_array(F.transform(F.filter(ordered, twin), lambda x: x["i"]))

    def counted(all_: Column) -> Column:
        pairs = F.sort_array(F.arrays_zip(all_.alias("h"), indices(F.size(all_)).alias("i")))
        some = let(pairs, lambda p: let(starts(p), covered))
        return F.when(F.size(F.array_distinct(all_)) == F.size(all_), F.lit(0)).otherwise(some)

    return let(windows(hashes, words), counted)


def without_characters(text: Column, characters: str) -> Column:
    """The text without these characters, one replacement each: far faster than a translation, which asks a map for every character."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def duplicate_lines(text: Column) -> Column:
    """How many lines with a word equal an earlier line."""
    return let(F.filter(F.split(text, "\n"), lambda x: F.ltrim(x, F.lit(WHITE_CHARS)) != ""), lambda x: F.size(x) - F.size(F.array_distinct(x)))


def text_keys(text: Column) -> list[Column]:
    """96 bits that tell texts apart, a null text like an empty one."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    return [c.alias(n) for c, n in zip([F.xxhash64(whole), F.hash(whole)], _KEYS, strict=True)]


def _paired(hashes: str) -> Column:
    """A generator of (first, second): every word hash and the next one, null after the last."""
    h = F.col(hashes)
    return F.inline(F.arrays_zip(h.alias("first"), F.slice(h, F.lit(2), F.size(h)).alias("second")))


def _bucket(buckets: int, *hashes: str) -> Column:
    """The bucket of a word, or of a pair."""
    return F.pmod(F.col(hashes[0]) if len(hashes) == 1 else F.xxhash64(*hashes), F.lit(buckets))


def _each_bucket(pairs: DataFrame, buckets: int, *others: str) -> DataFrame:
    """A row for every n-gram: of a word, and of a pair where there is a next word."""
    both = F.array(_bucket(buckets, "first"), F.when(F.col("second").isNotNull(), _bucket(buckets, "first", "second")))
    return pairs.select(*others, F.explode(both).alias("bucket")).where("bucket is not null")


def _marked(docs: DataFrame, trusted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Texts, with a mark where the id is in ``trusted``. Texts stay where they are read: no more ids are sent to them than a task holds easily."""
    ids = trusted.select(F.col(f"`{doc_id}`").alias(f"{OWN}id")).where(f"{OWN}id is not null").distinct().withColumn(f"{OWN}trusted", F.lit(1))
    n = ids.count()
    if n > MOST_TRUSTED:
        ids = ids.where(F.pmod(F.xxhash64(f"{OWN}id"), F.lit(1 << 32)) < int((1 << 32) * MOST_TRUSTED / n))
    own = docs.select(F.col(f"`{doc_id}`").alias(f"{OWN}doc"), F.col(f"`{text}`").alias("text"))
    return own.join(F.broadcast(ids), F.col(f"{OWN}doc") == F.col(f"{OWN}id"), "left")


def bucket_counts(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, raw, target): n-grams of all documents and of those whose id is in ``trusted``.

    Counts are combined before they are shuffled, to at most ``buckets`` rows a task.
    """
    pairs = hashed(_marked(docs, trusted, doc_id, text)).select(f"{OWN}trusted", _paired(_HASHES))
    each = _each_bucket(pairs, buckets, f"{OWN}trusted")
    return each.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count(f"{OWN}trusted").alias("target"))


def _ratio(raw: Column, target: Column, share: float, smoothing: float = SMOOTHING) -> Column:
    """The ratio in whole parts of 1 / UNIT: sums up to two million are then exact in doubles, in whatever order rows come, so every run decides alike."""
    return F.round(F.log((target + F.lit(smoothing)) / (raw * F.lit(share) + F.lit(smoothing))) * F.lit(UNIT)) / F.lit(UNIT)


def _array(rated: DataFrame, buckets: int) -> DataFrame:
    """One row with an array: the weight of every bucket, in order, zero where none is known; gathered in parallel by chunks."""
    filled = rated.sparkSession.range(buckets).select(F.col("id").alias("bucket")).join(rated.select("bucket", "weight"), "bucket", "left")
    each = F.struct("bucket", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    chunks = filled.groupBy(F.floor(F.col("bucket") / CHUNK).alias("chunk")).agg(F.sort_array(F.collect_list(each))["weight"].alias("weights"))
    return chunks.agg(F.flatten(F.sort_array(F.collect_list(F.struct("chunk", "weights")))["weights"]).alias("weights"))


def _facts(docs: DataFrame, text: str) -> DataFrame:
    """For each document the keys of its text, its word hashes, and what the base rules count."""
    whole = F.col(_TEXT)
    facts = [
        F.size(_HASHES).cast("long"),
        F.length(without_characters(whole, WHITE_CHARS)).cast("long"),
        (F.octet_length(whole) - F.octet_length(without_characters(whole, SYMBOLS))).cast("long"),
        duplicate_lines(whole).cast("long"),
        repeated_words(F.col(_HASHES)).cast("long"),
    ]
    return hashed(docs.select(F.col(f"`{text}`").alias("text"))).select(*text_keys(whole), _HASHES, *[c.alias(n) for c, n in zip(facts, _FACTS, strict=True)])


def texts_scored(docs: DataFrame, trusted: DataFrame, doc_id: str, text: str, buckets: int | None, slots: int = SLOTS) -> DataFrame:
    """A row for every distinct text with words: its keys, the counts of the base rules, and llr."""
    size = text_bytes(docs, text)
    buckets = buckets or _buckets(size)
    # fewer tasks combine more of the counts before the shuffle, as long as every core has two
    tasks = max(2 * docs.sparkSession.sparkContext.defaultParallelism, size // BYTES_A_GRAM // GRAMS_A_TASK)
    counts = written(bucket_counts(docs.coalesce(tasks), trusted, doc_id, text, buckets), "counts", narrow=True)
    total = counts.agg(F.sum("raw").alias("n"), F.sum("target").alias("t")).first()
    rated = counts.select("bucket", "raw", _ratio(F.col("raw"), F.col("target"), (total.t or 0) / max(total.n or 0, 1)).alias("weight"))
    facts = _facts(docs, text)
    if buckets <= slots:
        array = written(_array(rated, buckets), "ratios")
        drop_written(counts)

        def weight(*hashes: str) -> Column:
            return F.get(array.scalar(), _bucket(buckets, *hashes).cast("int"))

        paired = F.col("second").isNotNull()
        weights = facts.select(*_KEYS, *_FACTS, _paired(_HASHES)).select(
            *_KEYS, *_FACTS, (weight("first") + F.when(paired, weight("first", "second")).otherwise(F.lit(0.0))).alias("sum"), F.when(paired, 2).otherwise(1).alias("n")
        )
    else:
        weights = _joined_weights(facts, rated, buckets, slots)
    own = [F.max(c).alias(c) for c in _FACTS]  # copies of a text agree in them, and in the mean
    return written(weights.groupBy(*_KEYS).agg(*own, F.round(F.sum("sum") / F.sum("n"), 9).alias("llr")), "texts", narrow=True)


def _joined_weights(facts: DataFrame, rated: DataFrame, buckets: int, slots: int) -> DataFrame:
    """Sums of weights where the table is larger than ``slots``: frequent buckets are broadcast, the others joined to what asks for them."""
    magnitude = F.floor(F.log2("raw")).cast("int")
    held, least = 0, 64
    for r in rated.groupBy(magnitude.alias("m")).count().orderBy(F.desc("m")).collect():  # at most 64 rows
        held += r["count"]
        if held > slots:
            break
        least = r["m"]
    hot = rated.where(magnitude >= least).select("bucket", "weight")
    each = _each_bucket(facts.select(*_KEYS, _paired(_HASHES)), buckets, *_KEYS).join(F.broadcast(hot), "bucket", "left")
    rare = each.where("weight is null").drop("weight").join(rated.where(magnitude < least).select("bucket", "weight"), "bucket")
    none = [F.lit(None).cast("long").alias(c) for c in _FACTS]
    sums = [x.groupBy(*_KEYS).agg(F.sum("weight").alias("sum"), F.count(F.lit(1)).alias("n")).select(*_KEYS, *none, "sum", "n") for x in (each.where("weight is not null"), rare)]
    own = facts.where("n_words > 0").select(*_KEYS, *_FACTS, F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n"))
    return own.unionByName(sums[0]).unionByName(sums[1])


def _verdict(n_words: Column, n_repeat_words: Column, llr: Column, threshold: float) -> tuple[Column, Column]:
    """Whether a text fails the base rules, and whether it is kept."""
    failed = (n_words < LEAST_WORDS) | (n_repeat_words * 100 > n_words * MOST_REPEATED)
    return failed, ~failed & (llr >= threshold)


def score(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr and kept to whole documents.

    ``trusted`` holds the ids (column ``doc_id``) of documents the target is counted on, about MOST_TRUSTED of them if there are more. A null text has no
    words; a document of fewer than 50 words, or with over half of them in repeated three-word windows, fails
    the base. A document without n-grams has the ratio zero, and so has every document where no trusted one
    is found. kept is false where the base fails, else whether llr reaches ``threshold``. Every row stays,
    repeated rows too; rows with a null id are scored like others. Input columns called like the results
    give way. An empty table gives an empty one. ``buckets`` follows :func:`bucket_number` unless given.
    """
    return _scored(docs, trusted, doc_id, text, buckets, threshold)


def _scored(docs: DataFrame, trusted: DataFrame, doc_id: str, text: str, buckets: int | None, threshold: float, slots: int = SLOTS) -> DataFrame:
    known = texts_scored(docs, trusted, doc_id, text, buckets, slots)
    known = known.select(*_KEYS, *[F.col(c).alias(f"{OWN}{c}") for c in (*_FACTS, "llr")])
    known = F.broadcast(known) if known.count() <= MOST_BROADCAST else known
    rows = docs.select("*", *text_keys(F.col(f"`{text}`"))).join(known, _KEYS, "left")
    found = {c: F.coalesce(f"{OWN}{c}", F.lit(0).cast("long")) for c in _FACTS} | {"llr": F.coalesce(f"{OWN}llr", F.lit(0.0))}
    failed, kept = _verdict(found["n_words"], found["n_repeat_words"], found["llr"], threshold)
    found |= {"base_failed": failed, "kept": kept}
    return with_results(rows, found).drop(*_KEYS, *[f"{OWN}{c}" for c in (*_FACTS, "llr")])


def kept_documents(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that :func:`score` keeps, with their own columns, whatever these are called.

    Rows with a null or empty text go, as the base rejects them; repeated rows stay or go together. An empty table gives an empty one.
    """
    known = texts_scored(docs, trusted, doc_id, text, buckets)
    kept = known.where(_verdict(F.col("n_words"), F.col("n_repeat_words"), F.col("llr"), threshold)[1]).select(*_KEYS)
    kept = F.broadcast(kept) if kept.count() <= MOST_BROADCAST else kept
    rows = packed(docs, text).select("*", *text_keys(F.col(f"`{text}`")))
    return unpacked(rows.join(kept, _KEYS, "left_semi"), docs)


def digests(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("llr", 6).alias("llr"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Labelled documents of good quality that aren't toxic."""
    return labels.where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
