"""Intermediates in the folder all executors share, and small column helpers."""

from __future__ import annotations

import io
import posixpath
import uuid
import zipfile
from pathlib import Path

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; below the warehouse only where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder; Spark removes the files with the last reference."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """As cut(), but as Parquet: for larger tables of which later steps read few columns."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as --py-files would."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for path in sorted((root / "wakeline").rglob("*.py")):
            archive.write(path, path.relative_to(root))
    folder = new_folder(spark, "package")
    fs, base = open_folder(folder)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/wakeline.zip") as sink:
        sink.write(packed.getvalue())
    spark.sparkContext.addPyFile(f"{folder}/wakeline.zip")
    _SHIPPED.add(app)


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder, as tasks open it (a bare path is local)."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def publish(fs: pafs.FileSystem, temporary: str, final: str) -> None:
    """Move a finished file into place; a repeated task replaces what its first attempt left."""
    fs.create_dir(posixpath.dirname(final), recursive=True)
    fs.move(temporary, final)


def bytes_or_empty(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def columns_in_one(df: DataFrame, keep: list[str] | None = None) -> Column:
    """All columns (or those to keep) as one struct, so that no name can clash with a new one."""
    return F.struct(*(F.col(f"`{name}`") for name in (keep or df.columns)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
