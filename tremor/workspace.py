"""Shared folders for intermediate tables, stream output and checkpoints; this package for the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}
_shipped: set[str] = set()


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets one temporary
    folder for its lifetime. On a cluster a machine-local folder would not be seen
    by the executors, so a missing setting is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tremor-")
    return _local_roots[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared root that no other run uses. Spark creates it on write."""
    return f"{shared_root(spark)}/tremor/{label}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """The executors get this package, once a session, unless they share its folder by PYTHONPATH."""
    root = Path(__file__).resolve().parents[1]
    context = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    archive = Path(tempfile.mkdtemp(prefix="tremor-package-")) / "tremor.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted((root / "tremor").rglob("*.py")):
            out.write(module, module.relative_to(root))
    context.addPyFile(str(archive))
