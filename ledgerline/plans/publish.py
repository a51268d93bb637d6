"""JOB-08: publish source folders and audit the rows of every file."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.files import BINARY_BYTES, WHOLE_BYTES, Files, contents_of, copy_files, replacing
from ledgerline.sources.readers import SourceSpec, read_source
from ledgerline.sources.sinks import file_row_audit
from ledgerline.sources.together import all_together

AUDIT_SCHEMA = "source string, file_path string, row_count bigint"
TEXT_FORMATS = ("csv", "json", "jsonl")


def _as_is(spec: SourceSpec, path: str) -> SourceSpec:
    """CSV is read without a schema, for only its rows are counted."""
    if spec.format.lower() == "csv":
        return replace(spec, path=path, schema=None, options={**spec.options, "inferSchema": False})
    return replace(spec, path=path)


def _is_on(option: object) -> bool:
    return str(option).lower() == "true"


def publish(
    spark: SparkSession,
    source_root: str,
    target_root: str,
    specs: Mapping[str, SourceSpec],
    whole_bytes: int | None = None,
) -> DataFrame:
    """SNK-07: replace each target folder by its source and count rows per file.

    Paths in `specs` are relative to the roots; a missing folder is skipped.
    Files keep their names and bytes (`copy_files`).  A file beyond `whole_bytes`
    (by default 256 MB of lines, 1 GB of anything else) that cannot be copied by
    lines has its source written anew from what Spark reads; JSON over several lines has no such
    form, and is an error.  A target is replaced when its copy is complete.  Every file is in
    the audit, also without rows.
    """

    def copy(name: str, spec: SourceSpec) -> DataFrame | None:
        source, target, kind = f"{source_root}/{spec.path}", f"{target_root}/{spec.path}", spec.format.lower()
        if not Files(spark).exists(source):
            return None
        # A record of several lines may lie across two splits, so such files are only copied whole.
        lines = kind in TEXT_FORMATS and not (spec.multi_line or _is_on(spec.options.get("multiLine", False)))
        header = kind == "csv" and _is_on(spec.options.get("header", True))
        with replacing(spark, target) as staged:
            limit = whole_bytes or (WHOLE_BYTES if lines else BINARY_BYTES)
            if not copy_files(spark, source, staged, lines, header, limit):
                if kind in ("json", "jsonl"):
                    raise ValueError(f"{source} has a file of more than {limit} bytes whose records span lines")
                frame = read_source(spark, _as_is(spec, source))
                frame.write.options(**spec.options).format(kind).save(staged)
        # As the metadata of a scan spells them.
        paths = [(re.sub(r"^(\w+):///", r"\1:/", path),) for path in contents_of(spark, target).inputFiles()]
        listed = spark.createDataFrame(paths, "file_path string")
        audit = file_row_audit(read_source(spark, _as_is(spec, target)), listed)
        return audit.select(F.lit(name).alias("source"), "file_path", "row_count")

    copied = all_together({name: partial(copy, name, spec) for name, spec in specs.items()})
    audits = [audit for audit in copied.values() if audit is not None]
    if not audits:
        return spark.createDataFrame([], AUDIT_SCHEMA)
    return reduce(DataFrame.unionByName, audits)


def audit_totals(audit: DataFrame) -> DataFrame:
    """Files and rows of each source."""
    return audit.groupBy("source").agg(F.count("file_path").alias("file_count"), F.sum("row_count").alias("row_count"))
