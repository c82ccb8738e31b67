"""Small driver-side helpers on the session's file systems (listing, existence, removal)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when the folder is missing."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def has_files(spark: SparkSession, path: str, suffix: str) -> bool:
    """Whether a folder holds, at any depth, a file with the suffix; stops at the first."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return False
    files = fs.listFiles(hadoop_path, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(suffix):
            return True
    return False


def remove(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.delete(hadoop_path, True)


def rename(spark: SparkSession, path: str, target: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    if not fs.rename(hadoop_path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{path} cannot become {target}")


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file in one go."""
    fs, hadoop_path = _fs(spark, path)
    stream = fs.create(hadoop_path)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str | None:
    """First line of a text file; reads one buffer of it."""
    fs, hadoop_path = _fs(spark, path)
    jvm = spark._jvm
    stream = fs.open(hadoop_path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
            spark._jsc.hadoopConfiguration()
        ).getCodec(hadoop_path)
        plain = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(
            jvm.java.io.InputStreamReader(plain, "UTF-8")
        ).readLine()
    finally:
        stream.close()
