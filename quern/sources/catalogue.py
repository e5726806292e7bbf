"""Declared schemas and readers of collections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING, STRINGS = T.StringType(), T.ArrayType(T.StringType())
#: A document of the catalogue; schemas are declared, never inferred.
DOCUMENT = T.StructType(
    [
        T.StructField("id", STRING),
        T.StructField("sources", STRINGS),
        *[T.StructField(c, STRING) for c in ("issuer", "issuer_level", "country", "kind")],
        *[T.StructField(c, STRINGS) for c in ("topics", "keywords")],
        *[T.StructField(c, STRING) for c in ("status", "title", "original_title", "summary", "url", "landing_url", "bill_no")],
        T.StructField("date", T.StructType([T.StructField(c, T.IntegerType()) for c in ("y", "m", "d")])),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_documents(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A corpus in JSON, one document a line or, with ``multi_line``, one array a file."""
    return spark.read.schema(DOCUMENT).option("multiLine", multi_line).json(path)


def unified(collections: Mapping[str, DataFrame]) -> DataFrame:
    """All collections one below the other, each with its name as ``source``; fields that one lacks are null."""
    out = None
    for name, rows in collections.items():
        rows = rows.withColumn("source", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise ValueError("no collection")
    return out


def read_checked(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT) -> DataFrame:
    """A corpus in JSON lines with what is wrong in each: the columns of ``schema``, ``line``, ``problem`` and ``rescued``.

    ``problem`` is null for a line that holds what the schema says; else it tells that the line is no JSON, no object, or which fields have another type, and
    these fields are null. ``rescued`` maps fields that the schema lacks, and those of another type, to their JSON. No line is left out but blank ones, so
    good and bad lines add up to all.
    """
    lines = spark.read.text(path).where(F.trim("value") != "").withColumnRenamed("value", "line")
    corrupt = "_corrupt"
    parsed = F.from_json("line", T.StructType([*schema.fields, T.StructField(corrupt, STRING)]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    value = F.try_parse_json("line")
    kind = F.when(value.isNull(), "not JSON").when(~F.schema_of_variant(value).startswith("OBJECT"), "not an object")
    rows = lines.select("line", parsed.alias("d"), kind.alias("kind"), F.when(kind.isNull(), F.json_object_keys("line")).alias("keys"))
    raw = lambda k: F.call_function("get_json_object", F.col("line"), F.concat(F.lit("$['"), k, F.lit("']")))
    given = lambda k: F.col(f"d.{k}").isNull() & (F.coalesce(raw(F.lit(k)), F.lit("null")) != "null")
    lost = F.filter(F.array(*[F.when(given(f.name), F.lit(f.name)) for f in schema.fields]), lambda x: x.isNotNull())
    rows = rows.withColumn("lost", F.when(F.col("kind").isNull(), lost))
    inner = F.col(f"d.{corrupt}").isNotNull()
    problem = F.coalesce("kind", F.when(F.size("lost") > 0, F.concat(F.lit("other type: "), F.array_join("lost", ", "))), F.when(inner, F.lit("other type inside a field")))
    unknown = F.filter("keys", lambda k: ~k.isin(*schema.fieldNames()))
    held = F.when(F.col("kind").isNull(), F.map_from_entries(F.transform(F.array_distinct(F.concat(unknown, "lost")), lambda k: F.struct(k, raw(k)))))
    return rows.select(*[F.when(F.col("kind").isNull(), F.col(f"d.{f.name}")).alias(f.name) for f in schema.fields], "line", problem.alias("problem"), held.alias("rescued"))
