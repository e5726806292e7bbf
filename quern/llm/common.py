"""What several corpus operators share: names, shared storage, Arrow batches, gapless ranks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.sources.shared import shared_folder

#: The white space of every word contract: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = "\x20\t\n\x0b\x0c\r"
#: Characters that one Python step handles at once, so a batch of long texts stays small.
SLICE_CHARS = 2_000_000
#: Rows and bytes that Spark hands to a Python worker at once, unless the session asks for less: the defaults are made for short rows.
BATCH_ROWS, BATCH_BYTES = 2_000, 16 << 20
#: Prefix of every column that is only used inside an operator.
OWN = "__q_"


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to what a worker holds easily when texts are long.

    The settings stay lowered for what the session does later: plans ask for them when they run, not when they are made. Results don't depend on them.
    """
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key)
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns of these names, whatever their case."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def with_results(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds result columns; an input column of the same name, in any case, gives way."""
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in {n.lower() for n in columns}]
    return df.select(*kept, *[v.alias(k) for k, v in columns.items()])


def packed(df: DataFrame, *names: str) -> DataFrame:
    """The columns of these names, and all columns in one: results can then clash with none."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(f"{OWN}row"), *[F.col(f"`{n}`") for n in names])


def unpacked(df: DataFrame, like: DataFrame) -> DataFrame:
    """What :func:`packed` put into one column."""
    return df.select(*[F.col(f"{OWN}row")[c].alias(c) for c in like.columns])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Binds ``value`` once for ``body``; Spark would otherwise copy its expression to each use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hadoop(spark: SparkSession, path: str) -> tuple:
    """A path and its file system, as Hadoop's classes have them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def written(df: DataFrame, what: str, narrow: bool = False) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it again: computed once, and it outlives executors.

    Columns of types that Parquet lacks (void, intervals) fail, so they have to be cast or left out before. The table is removed
    by :func:`drop_written`, or when the session's process ends. A ``narrow`` table, a few numbers a row behind a shuffle, is written
    by two tasks a core at most, so that its files aren't many and tiny.
    """
    spark = df.sparkSession
    df = df.coalesce(2 * spark.sparkContext.defaultParallelism) if narrow else df
    at = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    path, files = _hadoop(spark, at)
    df.write.parquet(at)
    files.deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(at)


def drop_written(df: DataFrame) -> None:
    """Removes what :func:`written` wrote for ``df``."""
    for f in {x.rpartition("/")[0] for x in df.inputFiles()}:
        path, files = _hadoop(df.sparkSession, f)
        files.delete(path, True)


def text_slices(texts: pa.Array) -> Iterator[list[str]]:
    """The texts of an Arrow column (null: empty) in lists of about SLICE_CHARS bytes."""
    texts = texts.cast(pa.large_string())
    start, n = 0, len(texts)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    held = 0
    for i in range(n):
        held += int(sizes[i])
        if held >= SLICE_CHARS or i == n - 1:
            yield ["" if t is None else t for t in texts.slice(start, i + 1 - start).to_pylist()]
            start, held = i + 1, 0


def per_text(work: Callable[[list[str]], pa.Array], kind: pa.DataType) -> Callable[[pa.Array], pa.Array]:
    """An Arrow function over a text column from one over lists of texts."""

    def run(texts: pa.Array) -> pa.Array:
        parts = [work(part).cast(kind) for part in text_slices(texts)]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return run


def source_key(column: Column) -> Column:
    """A key without null for a text column that may hold null."""
    return F.when(column.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), column.cast("string")))

