"""Writing runs and slices so that a repeat leaves the same table."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DECISIONS = ("APPROVED", "REJECTED", "DEFERRED", "AUTO_CONSERVED")


def known_table(name: str, schemas: dict[str, StructType]) -> StructType:
    """The schema of a table to load; an unknown name is an error."""
    if name not in schemas:
        raise ValueError(f"no such table: {name}")
    return schemas[name]


def align(df: DataFrame, schema: StructType, run_id: int) -> DataFrame:
    """Columns of the schema, found by lower-cased, trimmed name; absent ones are null and the run is the given one."""
    names = [c.strip().lower() for c in df.columns]
    if repeated := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"columns of equal name: {', '.join(repeated)}")
    named = df.toDF(*names)
    if "run_id" in named.columns:
        named = named.drop("run_id")
    named = named.withColumn("run_id", F.lit(run_id))
    return named.select(*[(F.col(f.name) if f.name in named.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def replace_slices(df: DataFrame, path: str, *keys: str) -> None:
    """Writes the partitions that ``df`` has and leaves all others as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*(keys or ("run_id",))).parquet(path)


def pending_slices(wanted: DataFrame, loaded: DataFrame, *keys: str) -> DataFrame:
    return wanted.select(*keys).distinct().join(loaded.select(*keys).distinct(), list(keys), "left_anti")


def upsert(target: DataFrame, updates: DataFrame, *keys: str) -> DataFrame:
    """The target with the updates' rows in place of those with the same key.

    A key that the updates repeat has to have one row; which of several counts is not told.
    """
    doubled = updates.groupBy(*keys).count().where("count > 1")
    updates = updates.join(doubled.select(*keys, F.lit(True).alias("_doubled")), list(keys), "left")
    bad = F.raise_error(F.lit("updates repeat a key")).cast("boolean")
    updates = updates.where(F.when(F.col("_doubled"), bad).otherwise(F.lit(True))).drop("_doubled")
    return target.join(updates.select(*keys), list(keys), "left_anti").unionByName(updates, allowMissingColumns=True)


def valid_decisions(df: DataFrame, allowed: tuple[str, ...] = DECISIONS) -> DataFrame:
    """The rows unchanged; reading them fails at the first decision that is not allowed."""
    bad = F.raise_error(F.concat(F.lit("decision not allowed: "), F.coalesce("decision", F.lit("null"))))
    return df.withColumn("decision", F.when(F.col("decision").isin(*allowed), F.col("decision")).otherwise(bad))


def append_decisions(df: DataFrame, path: str) -> None:
    valid_decisions(df).write.mode("append").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def optional_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table, or no rows where the path does not exist; other errors are raised."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


#: Lines that a separator is told from, separators in order of preference, and the mark some files begin with.
SNIFFED_LINES, SEPARATORS, MARK = 200, ";,\t|", "\ufeff"


def sniffed_csv(lines: list[str]) -> tuple[str, bool]:
    """Separator of a file that begins with these lines, and whether a quoted field goes over a line's end.

    Separators inside quotes don't count.  The one wins that gives most records as many fields as
    the first has, then the one that gives more fields; the last record may be cut and is
    not looked at.  One column has the first separator.
    """
    text = "\n".join(lines).removeprefix(MARK)

    def split(separator: str) -> list[list[str]]:
        records = [r for r in csv.reader(io.StringIO(text), delimiter=separator) if r]
        return records[:-1] if len(records) > 2 else records

    def points(separator: str) -> tuple[float, int]:
        records = split(separator)
        wide = len(records[0]) if records else 0
        return (sum(len(r) == wide for r in records) / len(records), wide) if wide > 1 else (0.0, 0)

    best = max(SEPARATORS, key=points)
    return best, any("\n" in f for r in split(best) for f in r)


def read_csv_auto(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A CSV file with a header, its separator told by `sniffed_csv` from its first lines; quotes are doubled inside quotes."""
    separator, over_lines = sniffed_csv([r[0] for r in spark.read.text(path).limit(SNIFFED_LINES).collect()])
    reader = spark.read.option("header", True).option("sep", separator).option("encoding", "UTF-8").option("quote", '"').option("escape", '"').option("multiLine", over_lines)
    if schema is not None:
        return reader.schema(schema).csv(path)
    df = reader.csv(path)
    return df.toDF(*[c.removeprefix(MARK).strip('"') if k == 0 else c for k, c in enumerate(df.columns)])


def load_slices(slices: list, build, path: str, *keys: str) -> list[tuple[object, str]]:
    """Writes ``build(slice)`` for every slice, going on after a failure; the failed slices with their messages.

    ``slices`` are the work that is left (see `pending_slices`), so a second call resumes.
    """
    failed = []
    for s in slices:
        try:
            replace_slices(build(s), path, *keys)
        except Exception as error:  # noqa: BLE001  reported to the caller, with every other failure
            failed.append((s, str(error)[:MESSAGE_CHARS]))
    return failed


#: Characters of a message that are kept.
MESSAGE_CHARS = 4000


def cascaded(children: DataFrame, parents: DataFrame, *keys: str) -> DataFrame:
    """The children whose parent is still there."""
    return children.join(parents.select(*keys).distinct(), list(keys), "left_semi")


def run_event(spark: SparkSession, path: str, run_id: int, status: str, message: str | None = None) -> None:
    """Appends an event to the run ledger: running, success or failed."""
    row = spark.createDataFrame([(run_id, status, message[:MESSAGE_CHARS] if message else None)], "run_id int, status string, message string")
    row.withColumn("at", F.current_timestamp()).write.mode("append").parquet(path)


def run_status(events: DataFrame) -> DataFrame:
    """The last event of each run."""
    return events.groupBy("run_id").agg(F.max_by(F.struct("status", "message"), "at").alias("e")).select("run_id", "e.status", "e.message")


def publish(builds: list[tuple[str, object]], folder: str) -> DataFrame:
    """Writes named results in order, each from a function of those before, and returns their row counts."""
    done: dict[str, DataFrame] = {}
    spark = None
    for name, build in builds:
        df = build(done)
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        spark = df.sparkSession
        done[name] = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("result"), "rows") for name, df in done.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def export_pack(results: dict[str, DataFrame], folder: str) -> None:
    """A folder of CSV files for each result, and one with their row counts."""
    counts = None
    for name, df in results.items():
        export_csv(df, f"{folder}/{name}")
        own = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("result"), "rows")
        counts = own if counts is None else counts.unionByName(own)
    export_csv(counts, f"{folder}/metadata")


def write_report(df: DataFrame, path: str) -> None:
    """A report as JSON, nulls included."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
