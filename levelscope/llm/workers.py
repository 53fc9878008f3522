"""Running Python code of this package on the executors."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import zipfile
from contextlib import suppress
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import levelscope


@lru_cache(maxsize=8)
def _ship(context) -> None:
    """Sends the package to the executors once per context, as ``--py-files`` does. The archive
    lies on the driver, from where Spark hands it out."""
    top = Path(levelscope.__file__).parent
    if top.parent.suffix == ".zip":  # it has come by --py-files itself
        return
    folder = tempfile.TemporaryDirectory(prefix="levelscope-")
    atexit.register(folder.cleanup)
    path = f"{folder.name}/levelscope-package.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(top.rglob("*.py")):
            archive.write(file, Path("levelscope") / file.relative_to(top))
    context.addPyFile(path)


def ship(spark: SparkSession) -> None:
    _ship(spark.sparkContext)


def _release() -> None:
    """Gives freed memory back to the system: a worker lives on, while others work."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # of the GNU library alone
        ctypes.CDLL(None).malloc_trim(0)


def mapped(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with this package at hand where it runs."""

    def task(batches):
        yield from run(batches)
        _release()

    ship(df.sparkSession)
    return df.mapInArrow(task, schema)
