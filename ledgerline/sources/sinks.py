"""SNK-01..SNK-07: table writers and the row audit of a published folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import named, quoted, to_milliseconds
from ledgerline.sources.files import replacing


def write_parquet(
    df: DataFrame, path: str, max_records_per_file: int | None = None, files: int | None = None
) -> None:
    """SNK-01, SNK-02: replace a table, once all of the new one is written.

    Until then readers have the old table, and keep it if the write fails; the
    rows may come from the old table itself.  The layout follows the plan's own partitions.  `files` spreads the rows
    evenly over that many files, for small tables that readers want in few
    files; `max_records_per_file` splits large ones without a shuffle.
    """
    writer = (df if files is None else df.repartition(files)).write
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    with replacing(df.sparkSession, path) as staged:
        writer.parquet(staged)


def write_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int) -> DataFrame:
    """Replace a table by one that is bucketed and sorted by a key, known to the catalog under a name.

    Tables with the same number of buckets join and group by the key without a
    shuffle, as long as they are read by name; the files below `path` are plain
    Parquet to any other reader.
    """
    spark, staging = df.sparkSession, f"{table}_{uuid.uuid4().hex}"
    with replacing(spark, path) as staged:
        spread = df.repartition(buckets, key)
        spread.write.bucketBy(buckets, key).sortBy(key).option("path", staged).saveAsTable(staging)
        spark.sql(f"DROP TABLE {named(staging)}")  # the name only: the files belong to the path
    columns = ", ".join(f"{named(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)
    by = named(key)
    spark.sql(f"DROP TABLE IF EXISTS {named(table)}")
    spark.sql(
        f"CREATE TABLE {named(table)} ({columns}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION {quoted(path)}"
    )
    return spark.table(named(table))


def write_partition(df: DataFrame, root: str, value: str, column: str = "source", files: int | None = None) -> None:
    """SNK-03: the directory of one value of a partition column; other values stay as they are."""
    write_parquet(df.drop(column), f"{root}/{column}={value}", files=files)


def write_partitions(df: DataFrame, root: str, column: str = "source") -> None:
    """SNK-03: the directories of all values that the frame holds, in one write; other values stay as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(root)


# The writers' default drops what is finer than a millisecond.
TEXT_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_csv(df: DataFrame, path: str) -> None:
    """SNK-04: CSV with a header."""
    with replacing(df.sparkSession, path) as staged:
        df.write.option("header", True).option("timestampFormat", TEXT_TIMESTAMP).csv(staged)


def write_parquet_ms(df: DataFrame, path: str, column: str = "timestamp") -> bool:
    """SNK-05: Parquet with millisecond timestamps; an empty table is not written."""
    if df.isEmpty():
        return False
    write_parquet(df.withColumn(column, to_milliseconds(F.col(column))), path)
    return True


def write_jsonl(df: DataFrame, path: str) -> None:
    """SNK-06: one JSON object per line, missing values written as null."""
    with replacing(df.sparkSession, path) as staged:
        df.write.option("ignoreNullFields", False).option("timestampFormat", TEXT_TIMESTAMP).json(staged)


def file_row_audit(df: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """SNK-07: data rows per file of a scanned table (a CSV header is not a row).

    With `files`, a frame of file paths, those without a row are listed too.
    """
    counted = df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("row_count"))
    if files is None:
        return counted
    listed = files.select("file_path", F.lit(0).cast("bigint").alias("row_count"))
    return counted.unionByName(listed).groupBy("file_path").agg(F.sum("row_count").alias("row_count"))
