"""Token counts without ids: pieces are counted once for each distinct pre-token.

A document is its pre-tokens and how often each occurs in it. Joining them to a table with the number of pieces of every
distinct pre-token and summing gives its tokens. The join is split by heat, as one pre-token may be a
third of all: pieces of pre-tokens that are frequent in a bounded sample, drawn over the whole table, are counted
on the driver and broadcast, and their frequencies are summed where the text is read. All others go through
the table of pieces, where each distinct one is counted once, and a sort-merge join whose large partitions
Spark splits; so a frequent pre-token that the sample lacks, or a long one, costs time but never fills one task.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Bpe, bpe_from
from .common import OWN, WHITE, text_slices, written

#: Documents of the sample (about), frequent pre-tokens that are broadcast, and the bytes of the longest: at most 6 MB.
SAMPLED, FREQUENT, LONGEST, SEED = 4_000, 1 << 18, 24, 3
LIMIT = 2048
#: A worker forgets what chunks fall into beyond so many chunks; their pieces are counted elsewhere, once.
REMEMBERED = 300_000
_CHUNK = re.compile(f"[^{WHITE}]+")


def pieces(bpe: Bpe, words: list[bytes]) -> list[int]:
    """The number of pieces of each pre-token."""
    return bpe.merge(words)[1].tolist() if words else []


class Falls:
    """What chunks (texts between white space) fall into: special strings, and pre-tokens in UTF-8."""

    def __init__(self, bpe: Bpe):
        self.bpe, self.known = bpe, {}

    def __call__(self, chunk: str) -> list[bytes | int]:
        if (parts := self.known.get(chunk)) is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            parts = self.bpe.pre_tokens(chunk)
            if len(chunk) <= 64:
                self.known[chunk] = parts
        return parts


def _frequencies(path: str):
    """Batches of texts to (pre-token, occurrences) of each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        falls = Falls(bpe_from(path))
        for batch in batches:
            chunks: Counter = Counter()
            for texts in text_slices(batch.column(0)):
                for t in texts:
                    chunks.update(_CHUNK.findall(t))
            counts: Counter = Counter()
            for chunk, n in chunks.items():
                for w in falls(chunk):
                    if isinstance(w, bytes) and len(w) <= LONGEST:
                        counts[w] += n
            yield pa.record_batch([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    return run


def frequent(docs: DataFrame, path: str, text: str = "text") -> dict[bytes, int]:
    """Pieces of at most FREQUENT pre-tokens of at most LONGEST bytes, the most frequent of some SAMPLED documents anywhere in the table."""
    n = docs.count()
    sample = docs.select(F.col(f"`{text}`").cast("string").alias("text")).sample(min(1.0, SAMPLED / max(n, 1)), SEED)
    counted = sample.mapInArrow(_frequencies(path), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = [bytes(r.word) for r in counted.orderBy(F.desc("n"), "word").limit(FREQUENT).select("word").collect()]
    return dict(zip(words, pieces(bpe_from(path), words), strict=True))


def _split(path: str, hot):
    """Texts to the pieces of their frequent pre-tokens and special strings, and the other pre-tokens with their frequencies."""
    kind = pa.struct([("n", pa.int64()), ("rest", pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))])

    def run(column: pa.Array) -> pa.Array:
        falls, known, sums, words, times, ends = Falls(bpe_from(path)), hot.value, [], [], [], [0]
        for texts in text_slices(column):
            for t in texts:
                total, rest = 0, Counter()
                for chunk, n in Counter(_CHUNK.findall(t)).items():
                    for w in falls(chunk):
                        k = 1 if isinstance(w, int) else known.get(w)
                        if k is None:
                            rest[w] += n
                        else:
                            total += k * n
                sums.append(total)
                words += rest.keys()
                times += rest.values()
                ends.append(len(words))
        rest = pa.StructArray.from_arrays([pa.array(words, pa.binary()), pa.array(times, pa.int64())], fields=list(kind[1].type.value_type))
        return pa.StructArray.from_arrays([pa.array(sums, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest)], fields=list(kind))

    return run


def _pieces(path: str):
    """Batches of distinct pre-tokens to their numbers of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_from(path)
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(pieces(bpe, batch.column(0).to_pylist()), pa.int64())], names=["word", "k"])

    return run


def count_tokens(docs: DataFrame, path: str, text: str = "text", result: str = "n_tokens") -> DataFrame:
    """The columns of ``docs`` without the text, and ``result``: the tokens of each whole text under the file
    at ``path``, as encoding it would give.

    A null or empty text has none. Every row stays, repeated rows too; an input column called like the
    result gives way. An empty table gives an empty one. Texts of any length are counted whole by the task that reads them; rare pre-tokens,
    sums and the other columns are written to the shared folder and dealt out.
    """
    hot = docs.sparkSession.sparkContext.broadcast(frequent(docs, path, text))
    others = [c for c in docs.columns if c.lower() not in (text.lower(), result.lower())]
    carried = F.struct(F.lit(0).alias(f"{OWN}0"), *[F.col(f"`{c}`") for c in others])
    split = F.arrow_udf(_split(path, hot), "struct<n: bigint, rest: array<struct<word: binary, n: bigint>>>")
    rows = docs.select(carried.alias("carried"), F.monotonically_increasing_id().alias("row"), split(F.col(f"`{text}`").cast("string")).alias("split"))
    rows = written(rows.select("carried", "row", "split.n", "split.rest"), "frequencies")
    rare = rows.select("row", F.inline("rest").alias("word", "times"))
    known = written(rare.select("word").distinct().mapInArrow(_pieces(path), "word binary, k long"), "pieces")
    sums = rare.join(known.hint("merge"), "word").groupBy("row").agg(F.sum(F.col("times") * F.col("k")).alias("more"))
    total = rows.select("carried", "row", "n").join(sums, "row", "left")
    return total.select(*[F.col("carried")[c].alias(c) for c in others], (F.col("n") + F.coalesce("more", F.lit(0))).alias(result))


def digests(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of documents(doc_id, text)."""
    sized = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    return count_tokens(sized, path).withColumn("over_limit", F.col("n_tokens") > limit)
