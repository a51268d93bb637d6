"""A folder for tables a query must write before it can read them back."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, label: str, root: str | None = None) -> str:
    """A new path below `root`, or below the shared folder named by `spark.checkpoint.dir`.

    Executors on other machines must see the folder, so a machine-local one is
    used only by a plain local session that names none, as in tests.  Whoever
    names the folder owns it: nothing is deleted here, because a returned frame
    may be read at any later time; clean the folder once its session has ended.
    """
    shared = root or spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="ledgerline-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
