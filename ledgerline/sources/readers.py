"""SRC-01..SRC-10: multi-format scans with per-source failure isolation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.project import lineage_columns, timestamp_normalize
from ledgerline.schemas import WIDE_SCHEMA
from ledgerline.sources.files import Files, recover
from ledgerline.sources.sinks import write_parquet
from ledgerline.sources.together import all_together, together

LOADED, EMPTY, MISSING, FAILED = "loaded", "empty", "missing", "failed"

STATUS_SCHEMA = "source string, status string, row_count bigint, malformed bigint, message string"

#: Column with the raw text of a record that does not fit its schema, and where such records go below the root.
MALFORMED, QUARANTINE = "_malformed", "_quarantine"

# Formats whose reader can keep a record that it cannot parse, and the name it has by default there.
_TEXT_RECORDS, _DEFAULT_CORRUPT = ("csv", "json", "jsonl"), "_corrupt_record"


@dataclass(frozen=True)
class SourceSpec:
    """Where a source lies and how to read it. Without a schema it is inferred."""

    format: str
    path: str | Sequence[str]
    schema: T.StructType | None = None
    multi_line: bool = False
    options: Mapping[str, object] = field(default_factory=dict)


class EmptySource(ValueError):
    """The source could be read but holds no rows."""


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """SRC-01..SRC-05: scan by format name; unknown names go to Spark's reader."""
    kind = spec.format.lower()
    reader = spark.read.format("json" if kind == "jsonl" else kind)
    if kind == "csv":
        # enforceSchema=False makes Spark compare the schema with the header.
        reader = reader.option("header", True)
        reader = reader.option("inferSchema", True) if spec.schema is None else reader.option("enforceSchema", False)
    elif kind == "json":
        reader = reader.option("multiLine", spec.multi_line)
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    path = spec.path if isinstance(spec.path, str) else list(spec.path)
    return reader.options(**spec.options).load(path)


class SchemaConflict(ValueError):
    """Parts of a dataset have a column with types that no wider type holds."""


# Parquet types that Spark reads as a wider one, without a loss, from the narrowest on.
_WIDER = ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.FloatType, T.DoubleType), (T.ByteType, T.ShortType, T.IntegerType, T.DoubleType))
_DIGITS = {T.ByteType: 10, T.ShortType: 10, T.IntegerType: 10, T.LongType: 20}


def wider_type(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The narrowest type that holds the values of both and that a Parquet scan can give for either; None if there is none.

    Structs have the fields of both, arrays and maps the wider elements.
    """
    if one == other:
        return one
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        return merged_schema({"one": one, "other": other})
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        element = wider_type(one.elementType, other.elementType)
        return element and T.ArrayType(element, True)
    if isinstance(one, T.MapType) and isinstance(other, T.MapType):
        key, value = wider_type(one.keyType, other.keyType), wider_type(one.valueType, other.valueType)
        return key and value and T.MapType(key, value, True)
    for kinds in _WIDER:
        if type(one) in kinds and type(other) in kinds:
            return max(one, other, key=lambda kind: kinds.index(type(kind)))
    if isinstance(other, T.DecimalType):
        one, other = other, one
    if isinstance(one, T.DecimalType):
        whole, scale = one.precision - one.scale, one.scale
        if isinstance(other, T.DecimalType):
            whole, scale = max(whole, other.precision - other.scale), max(scale, other.scale)
        elif type(other) in _DIGITS:
            whole = max(whole, _DIGITS[type(other)])
        else:
            return None
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def merged_schema(schemas: Mapping[str, T.StructType]) -> T.StructType:
    """SRC-09: all columns of all parts, each as the widest of its types; every column may be missing.

    Names differ by more than case, as they do to Spark, and the first spelling
    counts.  Types that nothing holds are an error that names the parts.
    """
    fields: dict[str, T.StructField] = {}
    origin: dict[str, str] = {}
    for part, schema in schemas.items():
        for field in schema.fields:
            key = field.name.lower()
            if key not in fields:
                fields[key], origin[key] = T.StructField(field.name, field.dataType, True), part
                continue
            known = fields[key]
            try:
                kind = wider_type(known.dataType, field.dataType)
            except SchemaConflict as inner:
                raise SchemaConflict(f"{known.name}: {inner}") from None
            if kind is None:
                raise SchemaConflict(
                    f"{known.name} is {known.dataType.simpleString()} in {origin[key]} and {field.dataType.simpleString()} in {part}"
                )
            fields[key] = T.StructField(known.name, kind, True)
    return T.StructType(list(fields.values()))


def part_schema(spark: SparkSession, path: str) -> T.StructType:
    """The merged schema of the files of one part; tasks read the footers."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path).schema
    except Exception as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        # Its files hold types that Spark's own merge does not widen.
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
        return merged_schema({row["path"]: spark.read.parquet(row["path"]).schema for row in files.toLocalIterator()})


def read_dataset(spark: SparkSession, *paths: str) -> DataFrame:
    """SRC-02, SRC-09: all parts of one or more Parquet directories as one table.

    The table has the columns of every part; where a part lacks one it is NULL,
    and where parts differ in a type the wider one holds.  The scan itself does
    that, so it stays one scan, with filters and columns pushed down.
    """
    schemas = all_together({path: partial(part_schema, spark, path) for path in paths})
    return spark.read.schema(merged_schema(schemas)).parquet(*paths)


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC-10: the single wide transaction table."""
    return read_source(spark, SourceSpec("csv", path, WIDE_SCHEMA))


def path_is_missing(error: Exception) -> bool:
    return isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"


def read_existing(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """SRC-08: Parquet tables by name, leaving out those whose path is absent.

    A table whose replacement was cut off between its renames is brought back first.
    """
    frames, files = {}, Files(spark)
    for name, path in paths.items():
        recover(spark, path)
        if files.exists(path):
            frames[name] = spark.read.parquet(path)
    return frames


def read_checked(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """SRC-01, SRC-03, SRC-04: a text source with the raw text of each record that does not fit, in `_malformed`.

    A record that fits has NULL there; one that does not keeps the fields that could be
    read, the others are NULL.  Without a schema the inferred one is what records
    must fit.  Other formats, and specs that choose their own `mode`, are read as
    they are.
    """
    options = {key.lower(): value for key, value in spec.options.items()}
    if spec.format.lower() not in _TEXT_RECORDS or "mode" in options or "columnnameofcorruptrecord" in options:
        return read_source(spark, spec)
    schema = spec.schema if spec.schema is not None else read_source(spark, spec).schema
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    if MALFORMED in schema.names:
        return read_source(spark, spec)
    # Inference gives a column of its own to lines that are no JSON.
    fields = [f for f in schema.fields if spec.schema is not None or f.name != _DEFAULT_CORRUPT]
    checked = T.StructType([*fields, T.StructField(MALFORMED, T.StringType())])
    kept = {**spec.options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    return read_source(spark, replace(spec, schema=checked, options=kept))


def extract(spark: SparkSession, name: str, spec: SourceSpec, checked: bool = False) -> DataFrame:
    """One source with lineage columns and zoned timestamps.

    SRC-07: reads one row to find an empty source (a small job).  `checked` adds
    `_malformed` to text sources.
    """
    frame = read_checked(spark, spec) if checked else read_source(spark, spec)
    if frame.isEmpty():
        raise EmptySource(f"Source {name} is empty")
    return timestamp_normalize(lineage_columns(frame, name))


def ingest(
    spark: SparkSession,
    specs: Mapping[str, SourceSpec],
    root: str | None = None,
    max_records_per_file: int | None = None,
    drop_malformed: bool = False,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """SRC-06: read every source of the registry; one bad source stops no other.

    With `root` each source is written there as Parquet in a single pass, and the
    returned frames read the written table.  Rows and malformed records are
    counted during the write.  A source with malformed records is scanned once
    more: they go, with their raw text and the fields that could be read, to
    `_quarantine` below the root, whose table of an earlier run is replaced or
    removed.  Bronze keeps their rows, missing fields NULL, unless
    `drop_malformed`.  The second result has one status row per source.
    """

    def load(name: str, spec: SourceSpec) -> tuple[DataFrame, int | None, int | None]:
        if root is None:
            return extract(spark, name, spec), None, None
        frame = extract(spark, name, spec, checked=True)
        target, aside = f"{root}/{name}", f"{root}/{QUARANTINE}/{name}"
        seen, counted = Observation(f"rows_{name}"), [F.count(F.lit(1)).alias("rows")]
        bad = F.col(MALFORMED).isNotNull()
        checked = MALFORMED in frame.columns
        counted += [F.count_if(bad).alias("malformed")] if checked else []
        table = frame.observe(seen, *counted)
        if checked:
            table = (table.filter(~bad) if drop_malformed else table).drop(MALFORMED)
        write_parquet(table, target, max_records_per_file)
        rows, malformed = seen.get["rows"], seen.get.get("malformed", 0)
        if malformed:
            # All columns are asked for, so a record is judged by all of them here too.
            write_parquet(frame.filter(bad), aside)
        else:
            Files(spark).delete(aside)
        return spark.read.parquet(target), rows - malformed if drop_malformed else rows, malformed

    loaded, errors = together({name: partial(load, name, spec) for name, spec in specs.items()})
    status = []
    for name in specs:
        if name in loaded:
            status.append((name, LOADED, *loaded[name][1:], None))
        elif isinstance(errors[name], EmptySource):
            status.append((name, EMPTY, 0, 0, str(errors[name])))
        else:
            kind = MISSING if path_is_missing(errors[name]) else FAILED
            status.append((name, kind, None, None, str(errors[name]).splitlines()[0]))
    frames = {name: found[0] for name, found in loaded.items()}
    return frames, spark.createDataFrame(status, STATUS_SCHEMA)
