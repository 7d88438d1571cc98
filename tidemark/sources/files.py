"""The few operations on the shared file system that Spark's readers and writers don't offer."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def child_folders(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column in one folder, newest first; the folder's own entries are listed, no files below."""
    folder, fs = _file_system(spark, path)
    if not fs.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in fs.listStatus(folder) if entry.isDirectory()]
    return sorted((n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}=")), reverse=True)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove an output folder, if there is one."""
    folder, fs = _file_system(spark, path)
    fs.delete(folder, True)


def write_whole(spark: SparkSession, path: str, text: str) -> None:
    """A small file that readers see whole or not at all: written beside its place, then renamed. Fails where there is one."""
    target, fs = _file_system(spark, path)
    draft, _ = _file_system(spark, f"{target.getParent()}/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise FileExistsError(path)


def read_whole(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None where there is none."""
    target, fs = _file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
