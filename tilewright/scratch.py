"""Folders for intermediate files that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a ``local[...]`` session (tests) may leave it unset; it then gets a
    temporary folder. On a cluster an unset folder is an error, because no
    machine-local path is visible to all executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="tilewright-"))
        atexit.register(shutil.rmtree, _own[0], True)
    return f"file://{_own[0]}"


def new_dir(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_dir(spark)}/tilewright/{label}-{uuid.uuid4().hex}"
