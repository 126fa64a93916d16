"""Folder questions answered by the Hadoop file system of the path."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True once a Spark write job has committed the folder."""
    return exists(spark, f"{path}/_SUCCESS")


def total_bytes(spark: SparkSession, path: str) -> int:
    fs, target = _open(spark, path)
    return fs.getContentSummary(target).getLength()


def numbered(spark: SparkSession, root: str, label: str) -> list[int]:
    """Sorted N of the `label=N` folders directly under root."""
    fs, target = _open(spark, root)
    if not fs.exists(target):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    prefix = f"{label}="
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))


def newest_complete(
    spark: SparkSession, root: str, label: str, before: int | None = None
) -> int | None:
    """Highest committed N (below `before`), or None."""
    for n in reversed(numbered(spark, root, label)):
        if (before is None or n < before) and is_complete(spark, f"{root}/{label}={n}"):
            return n
    return None


def complete_after(spark: SparkSession, root: str, label: str, reached: int) -> list[int]:
    """Committed N above `reached`, in order."""
    later = [n for n in numbered(spark, root, label) if n > reached]
    return [n for n in later if is_complete(spark, f"{root}/{label}={n}")]


def committed(spark: SparkSession, root: str, label: str) -> list[int]:
    """Sorted N of all committed `label=N` folders, from one listing of their marks."""
    fs, _ = _open(spark, root)
    marks = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{label}=*/_SUCCESS"))
    names = [mark.getPath().getParent().getName() for mark in marks or []]
    return sorted(int(n.removeprefix(f"{label}=")) for n in names)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly under a folder, from one listing; none if it does not exist."""
    fs, target = _open(spark, folder)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside its place and renamed, so that it is never seen in part.

    An existing file is replaced.
    """
    fs, target = _open(spark, path)
    beside = target.suffix(".unfinished")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(beside, target):
        raise OSError(f"cannot write {path}")


def data_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Path below the folder and size of every file in it, at any depth, without marks."""
    fs, target = _open(spark, folder)
    base = fs.makeQualified(target).toString().rstrip("/") + "/"
    listed, found = fs.listFiles(target, True), []
    while listed.hasNext():
        status = listed.next()
        path = status.getPath()
        if not path.getName().startswith(("_", ".")):
            found.append((path.toString().removeprefix(base), status.getLen()))
    return sorted(found)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def set_age(spark: SparkSession, folder: str, days: int) -> None:
    """Date the files of a folder `days` back, as copies that keep their date are."""
    fs, target = _open(spark, folder)
    then = int((time.time() - days * 86_400) * 1000)
    for status in fs.listStatus(target):
        fs.setTimes(status.getPath(), then, -1)
