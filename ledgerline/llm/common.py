"""What the corpus operators share: written intermediate tables, hashes, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ledgerline.sources.files import Files
from ledgerline.sources.scratch import scratch_folder


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of a frame from a table in the shared folder.

    This cuts the lineage: a lost executor costs the reader nothing, and the
    rows are the same at every later use.
    """
    path = scratch_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing will read any more, because what they led to is written itself."""
    for table in tables:
        Files(table.sparkSession).delete(table.scratch_path)


#: Rows of a side that joins may send to every task; the tables it is used for have rows of at most 200 bytes.
SMALL_ROWS = 100_000


def if_small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A written table, marked for broadcast if it has few rows; a larger one is left to shuffle.

    `rows` is its number of rows, or a bound of it, where that is known.
    """
    count = df.count() if rows is None else rows
    return F.broadcast(df) if count <= SMALL_ROWS else df


#: Bytes of texts that a task works on at a time; a longer text is alone.
PORTION = 8 << 20


def portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch with texts in slices of a bounded size, so that what is made of them is bounded too."""
    at = batch.schema.get_field_index("text")
    if at < 0 or batch.nbytes <= PORTION:
        yield batch
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + PORTION, side="right")))
        yield batch.slice(start, end - start)
        start = end


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: pa.Schema
) -> DataFrame:
    """Run `work` over the Arrow batches of each task, those with texts in portions, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for portion in portions(batch):
                yield from work(portion)

    return df.mapInArrow(run, from_arrow_schema(schema))


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[str]:
    """The texts of a batch one at a time; a missing one is empty."""
    for value in batch.column(batch.schema.get_field_index(column)):
        yield value.as_py() or ""


def signed(value: int) -> int:
    """An unsigned 64-bit hash as Spark's long."""
    return value - (1 << 64) if value >> 63 else value
