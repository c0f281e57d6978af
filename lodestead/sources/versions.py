"""Publications that a reader sees whole: results in folders of their own, and a manifest that is put in place last.

A folder holds ``data/<version>/...`` and ``manifests/<number>.json``.  The manifest with the
greatest number names the files of every result, so a writer that fails half-way
leaves the one before in force, and readers keep the files they began with.  A manifest is
written under another name and renamed, which doesn't replace an existing one: of two writers
that started from the same number one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Name of a slice's folder.
_SLICE = "_slice"


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    at, system = _files(spark, f"{folder}/manifests")
    names = [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, folder: str) -> tuple[int, dict]:
    """Number and content of the manifest in force; 0 and nothing before the first."""
    numbers = _numbers(spark, folder)
    if not numbers:
        return 0, {"results": {}}
    lines = spark.read.text(f"{folder}/manifests/{numbers[-1]}.json", wholetext=True).first()
    return numbers[-1], json.loads(lines[0])


def _put(spark: SparkSession, folder: str, after: int, content: dict) -> None:
    draft, system = _files(spark, f"{folder}/manifests/.{uuid.uuid4().hex}")
    out = system.create(draft)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    target, _ = _files(spark, f"{folder}/manifests/{after + 1}.json")
    if system.exists(target) or not system.rename(draft, target):
        system.delete(draft, False)
        raise RuntimeError(f"another publication in {folder} came first")


def _result(paths: dict[str, str], df: DataFrame) -> dict:
    return {"paths": paths, "schema": json.loads(df.schema.json())}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A result as last published; an unknown name is an error."""
    found = manifest(spark, folder)[1]["results"]
    if name not in found:
        raise ValueError(f"{folder} has no result {name}")
    schema, paths = StructType.fromJson(found[name]["schema"]), sorted(found[name]["paths"].values())
    reader = spark.read.schema(schema)
    return reader.parquet(*(f"{folder}/{p}" for p in paths)) if paths else spark.createDataFrame([], schema)


def publish(spark: SparkSession, builds: list[tuple[str, Callable[[dict[str, DataFrame]], DataFrame]]], folder: str) -> DataFrame:
    """Writes named results in order, each from a function of those before, and puts all in force at once; their row counts.

    Results that are not among them stay as they were.
    """
    before, content = manifest(spark, folder)
    version, done, results = f"data/{uuid.uuid4().hex}", {}, dict(content["results"])
    for name, build in builds:
        df = build(done)
        df.write.parquet(f"{folder}/{version}/{name}")
        results[name] = _result({"": f"{version}/{name}"}, df)
        done[name] = spark.read.schema(df.schema).parquet(f"{folder}/{version}/{name}")
    counts = spark.createDataFrame([(name, df.count()) for name, df in done.items()], "result string, rows long")
    _put(spark, folder, before, {"results": results})
    return counts


def replace_slices(df: DataFrame, folder: str, name: str, key: str = "run_id") -> None:
    """Puts the slices that ``df`` has in place of those in force, all at once; others stay.

    The manifest has an entry for each slice, a run's for instance.  Rows with a null key are a slice as well.
    """
    spark = df.sparkSession
    before, content = manifest(spark, folder)
    version = f"data/{uuid.uuid4().hex}/{name}"
    df.withColumn(_SLICE, F.col(key).cast("string")).write.partitionBy(_SLICE).parquet(f"{folder}/{version}")
    at, system = _files(spark, f"{folder}/{version}")
    made = {s.getPath().getName(): f"{version}/{s.getPath().getName()}" for s in system.listStatus(at) if s.isDirectory() and s.getPath().getName().startswith(_SLICE)}
    old = content["results"].get(name, {}).get("paths", {})
    _put(spark, folder, before, {"results": {**content["results"], name: _result({**old, **made}, df)}})


def remove_unused(spark: SparkSession, folder: str) -> list[str]:
    """Deletes the versions that the manifest in force doesn't name, when no reader is left that began before it."""
    used = {p.split("/")[1] for r in manifest(spark, folder)[1]["results"].values() for p in r["paths"].values()}
    at, system = _files(spark, f"{folder}/data")
    gone = [s.getPath() for s in system.listStatus(at) if s.getPath().getName() not in used] if system.exists(at) else []
    for path in gone:
        system.delete(path, True)
    return sorted(p.getName() for p in gone)
