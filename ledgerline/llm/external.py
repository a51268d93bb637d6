"""Two-pass external shuffle: rows dealt at random into shards of equal row counts.

Pass one scatters rows over buckets of a size that one task can hold, by a
seeded hash of each row's place in its file, so rows are spread whatever they
hold.  Pass two shuffles each bucket (Spark's `shuffle` is Fisher-Yates) and
writes it.  A bucket's rows take consecutive places in the shuffled order, so it
lands in one shard or two, and no shuffle by shard is needed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import written

#: Bytes of a bucket on average.  The hash spreads rows evenly, so a bucket exceeds it by little, but for single rows
#: that are longer themselves.  There is a task for each bucket: larger ones suit larger tables and executors.
BUCKET_BYTES = 8 << 20


def record_size(text: Column) -> Column:
    """UTF-8 bytes of a text (NULL: none) and eight more."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")))


def shard_of(place: Column, rows: int, shards: int) -> tuple[Column, Column]:
    """Shard and slot of a place in the shuffled order: shards in turn, the first ones a row longer."""
    each, longer = divmod(rows, shards)
    edge = longer * (each + 1)
    rest = max(each, 1)
    in_longer = place < edge
    shard = F.when(in_longer, place / (each + 1)).otherwise(longer + (place - edge) / rest)
    slot = F.when(in_longer, place % (each + 1)).otherwise((place - edge) % rest)
    return F.floor(shard).cast("int").alias("shard"), slot.cast("bigint").alias("slot")


def external_shuffle(
    docs: DataFrame,
    folder: str,
    shards: int = 24,
    seed: int = 7,
    keep: tuple[str, ...] = (),
    bucket_bytes: int = BUCKET_BYTES,
) -> None:
    """Write `doc_id`, `text` and the columns in `keep` as shards 0 to `shards` - 1 of a Parquet folder.

    Law `rows`: row counts of two shards differ by one at most, and `slot` counts
    a shard's rows from 0 without gaps.  NULL ids and texts are rows like others,
    and so is each of the rows that repeat one.  Other columns are left out;
    those in `keep` must be orderable, for a bucket is sorted before it is
    shuffled, so that a task that runs again gives the same order.  With fewer
    rows than shards the last shards have none; an empty table writes no shard.
    """
    spark = docs.sparkSession
    rows = _placed(docs.select("doc_id", "text", *keep))
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(record_size(F.col("text"))).alias("bytes")).first()
    n, tasks = totals["n"], int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Tasks follow the buckets, and a small table has enough of them to keep the cores busy.
    buckets = max(-(-(totals["bytes"] or 0) // bucket_bytes), tasks, 1)
    bucket = F.pmod(F.xxhash64(F.lit(seed), "row_place"), F.lit(buckets)).cast("int").alias("row_bucket")
    row = F.struct("doc_id", "text", *keep).alias("row")

    counts = rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
    # One row per bucket meets in this window, not one per document.
    order = Window.orderBy("row_bucket")
    before = counts.select("row_bucket", (F.sum("n").over(order) - F.col("n")).alias("before"))
    # What comes before a bucket travels with its rows, so the buckets need no join, however many they are.
    scattered = rows.select(bucket, row).unionByName(before, allowMissingColumns=True)
    shuffled = (
        scattered.repartition(buckets, "row_bucket")
        .groupBy("row_bucket")
        .agg(F.max("before").alias("before"), F.sort_array(F.collect_list("row")).alias("held"))
        .select("before", F.posexplode(F.shuffle("held", seed)).alias("at", "row"))
    )
    shard, slot = shard_of(F.col("before") + F.col("at"), n, shards)
    shuffled.select("row.*", shard, slot).write.partitionBy("shard").option("compression", "zstd").parquet(folder)


def _placed(rows: DataFrame) -> DataFrame:
    """The rows with a hash of their file and their place in it, the same in every scan and in every attempt.

    A frame that is no file scan is written first.  The names of its files differ
    from run to run, but for the number of the task.
    """
    place = F.col("_metadata.row_index")
    try:
        return rows.select("*", F.xxhash64("_metadata.file_path", place).alias("row_place"))
    except AnalysisException:
        part = F.regexp_extract(F.col("_metadata.file_name"), r"part-\d+", 0)
        return written(rows, "to-shuffle").select("*", F.xxhash64(part, place).alias("row_place"))


def read_shards(spark: SparkSession, folder: str, schema: str = "doc_id BIGINT, text STRING, slot BIGINT") -> DataFrame:
    """Rows of the shards with their `shard`; `schema` names the written columns."""
    return spark.read.schema(f"{schema}, shard INT").parquet(folder)
