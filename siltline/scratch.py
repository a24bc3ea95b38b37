"""Where derived tables go.

On a cluster every executor must see the folder, so it is the one named by
``spark.checkpoint.dir``.  Only a local-mode session without that setting gets a
temporary folder of its own.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}
_written: dict[tuple[str, ...], str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder of this application for tables derived during a run."""
    app = spark.conf.get("spark.app.id", "app")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/siltline/{app}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder all executors can reach"
        )
    if app not in _local_roots:
        root = tempfile.mkdtemp(prefix="siltline-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        _local_roots[app] = root
    return f"file://{_local_roots[app]}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path nothing has been written to yet."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def write_once(spark: SparkSession, name: str, source: str, write: Callable[[str], None]) -> str:
    """Path of a table derived from ``source``, written at the first call of the application."""
    key = (scratch_root(spark), name, source)
    if key not in _written:
        path = new_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def discard_scratch(spark: SparkSession) -> bool:
    """Delete this application's derived tables (any Hadoop file system)."""
    root = scratch_root(spark)
    for key in [k for k in _written if k[0] == root]:
        del _written[key]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.delete(path, True)
