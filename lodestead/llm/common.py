"""Shared pieces: the session's shared folder, written intermediate tables, batching.

Intermediate results that several jobs read are written as Parquet into the folder
named by ``spark.checkpoint.dir``, which driver and executors share, so that a lost
executor never costs more than the stage it was running.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestead.sources.shared import discard, shared_folder, written

__all__ = ["chunks", "crc32_sql", "discard", "hash_sampled", "held_out", "shared_folder", "table", "written"]

#: Text bytes that one numpy step works on; its arrays take about 60 times that.
CHUNK_BYTES = 500_000


def held_out(doc_id: Column | str) -> Column:
    """True for the fifth of the documents that no model learns from."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 5 == 0, F.lit(False))


def hash_sampled(key: Column, most: int, rows: int) -> Column:
    """True for about ``most`` of ``rows`` rows, chosen by 62 bits of a hash of their key.

    The share keeps its precision at any number of rows.
    """
    if most >= rows:
        return F.lit(True)
    return F.shiftrightunsigned(F.xxhash64(key, F.lit("sample")), 2) < F.lit((most << 62) // rows)


def crc32_sql(number: str) -> str:
    """DuckDB SQL for the unsigned crc32 of a number in decimal digits, which has no such function: a bit at a time."""
    bits = f"flatten([[(ascii(c) >> k) & 1 for k in range(0, 8)] for c in string_split(CAST({number} AS VARCHAR), '')])"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), lambda crc, bit: xor(crc >> 1, (xor(crc, bit) & 1) * 3988292384)), 4294967295)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``text`` column holds about ``limit`` bytes at most.

    A row is never split: one longer than the limit makes a slice of its own.  At the end
    the process, which serves further tasks, gives back the memory that it has no use for.
    """
    yield from _chunks(batches, text, limit)
    pa.default_memory_pool().release_unused()


def _chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = text_ends(batch.column(text))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = start + 1
            while stop < batch.num_rows and ends[stop] - base <= limit:
                stop += 1
            yield batch.slice(start, stop - start)
            start = stop


def text_ends(column: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    total, ends = 0, []
    for n in pc.fill_null(pc.binary_length(column), 0).to_pylist():
        total += n
        ends.append(total)
    return ends
