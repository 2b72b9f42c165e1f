"""Small-file and folder helpers over Hadoop's file system API.

They only touch names and files of a few kilobytes; data is always read and
written by Spark jobs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def layer_path(root: str, table: str, layer: str | None = None, default: str = "main") -> str:
    """Folder of a table: below its layer (raw, staging, mart), else the default."""
    return f"{root.rstrip('/')}/{(layer or default).strip()}/{table}"


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; empty when there is no folder."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that readers see whole or not at all; never replace one."""
    fs, target = _resolve(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(
        target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}"
    )
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if not fs.rename(draft, target):
        raise FileExistsError(path)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, from_path = _resolve(spark, source)
    if not fs.rename(from_path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder; nothing happens when there is none."""
    fs, target = _resolve(spark, path)
    fs.delete(target, True)
