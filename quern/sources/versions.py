"""Version files of a folder of tables: one small file a version, put in place by a rename, so that readers see all of a version or nothing."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has put this version in place first."""


def _context(spark: SparkSession, folder: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop, hadoop.FileContext.getFileContext(hadoop.Path(folder).toUri(), spark._jsc.hadoopConfiguration())


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """All versions that are in place, in order."""
    hadoop, files = _context(spark, folder)
    at = hadoop.Path(f"{folder}/versions")
    if not files.util().exists(at):
        return []
    names = [s.getPath().getName() for s in files.util().listStatus(at)]
    return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))


def load(spark: SparkSession, folder: str, number: int | None = None) -> dict | None:
    """What a version says, by default the newest; None where there is none."""
    if number is None:
        known = numbers(spark, folder)
        if not known:
            return None
        number = known[-1]
    rows = spark.read.text(f"{folder}/versions/v{number:08d}.json", wholetext=True).collect()  # one small file
    return json.loads(rows[0].value)


def commit(spark: SparkSession, folder: str, number: int, said: dict) -> dict:
    """Puts a version in place; :class:`Conflict` if there is one of this number."""
    hadoop, files = _context(spark, folder)
    to, by_way = hadoop.Path(f"{folder}/versions/v{number:08d}.json"), hadoop.Path(f"{folder}/versions/.{uuid.uuid4().hex}")
    gateway = spark.sparkContext._gateway
    said = said | {"version": number}
    files.mkdir(hadoop.Path(f"{folder}/versions"), hadoop.permission.FsPermission.getDirDefault(), True)
    local = to.getFileSystem(spark._jsc.hadoopConfiguration())
    out = local.create(by_way, False)
    out.write(bytearray(json.dumps(said).encode()))
    out.close()
    try:
        files.rename(by_way, to, gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0))  # never over a file
    except Exception as e:
        local.delete(by_way, False)
        if local.exists(to):
            raise Conflict(f"version {number} of {folder} is taken") from e
        raise
    return said


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop.Path(path), True)
