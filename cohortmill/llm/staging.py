"""Tables that cut lineage: written to the shared folder and read back, so a lost executor costs no recomputation."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path
from weakref import WeakSet

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: WeakSet = WeakSet()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. A folder of this machine only stands in for it in local
    mode; on a cluster an unset folder is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local") or "cluster" in spark.conf.get("spark.master"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-stages-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# For wide rows the writer looks at its sizes after every row, not every hundred: else a page holds a whole file, on the heap
# and in the codec's buffers outside it. Packed arrays are not compressed once more.
WIDE = {f"parquet.{part}.size.row.check.{end}": rows for part in ("page", "block") for end, rows in (("min", "1"), ("max", "10"))}
PACKED = WIDE | {"compression": "uncompressed"}


def staged(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """The rows of ``df`` from a table of their own."""
    path = fresh_path(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prepare(spark: SparkSession, rows: int = 2000, size: str | None = None) -> None:
    """Bounds Arrow batches to ``rows`` rows where the session still has Spark's default (whole texts are large), and
    ships this package where the workers would not find it by themselves (``PYTHONPATH``, working folder). ``size`` (``4m``)
    bounds them in bytes too, for rows that hold packed arrays: each task holds a batch in the JVM and in Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, "10000") == "10000":
        spark.conf.set(name, str(rows))
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if size is not None and spark.conf.get(name, None) is None:
        spark.conf.set(name, size)
    root = Path(__file__).resolve().parents[2]
    known = {Path(p).resolve() for p in [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()] if p}
    if root not in known and spark.sparkContext not in _SHIPPED:
        _SHIPPED.add(spark.sparkContext)
        spark.sparkContext.addPyFile(shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="ship-"), "cohortmill"), "zip", root, "cohortmill"))
