"""The cluster's shared folder: tables and files that tasks write and read there."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once as a table in the shared folder (survives lost executors).

    A table rather than ``checkpoint()``: it is compressed, its real size guides the joins that follow, and
    nothing of the plan behind it is carried along, which matters in loops."""
    folder = new_folder(df.sparkSession, "table")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for sessions whose workers have no path to it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="plantlake-package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def new_folder(spark: SparkSession, kind: str) -> str:
    """URI of a new folder for ``kind`` of files under the shared checkpoint folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{kind}-{uuid.uuid4().hex}"


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def open_input(uri: str):
    store, path = _store(uri)
    return store.open_input_stream(path, compression=None)


class atomic_output:
    """A file that appears under its name only when it is whole: a repeated or speculative
    task writes a temp name of its own, and the last rename wins with the same content."""

    def __init__(self, uri: str):
        self.store, self.path = _store(uri)
        self.temp = f"{self.path}.{uuid.uuid4().hex}.part"

    def __enter__(self):
        self.store.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.store.open_output_stream(self.temp, compression=None)
        return self.out

    def __exit__(self, kind, *_):
        self.out.close()
        if kind is None:
            self.store.move(self.temp, self.path)
        else:
            self.store.delete_file(self.temp)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
