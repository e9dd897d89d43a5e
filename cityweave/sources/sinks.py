"""Mart output."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _qualified(spark: SparkSession, path: str) -> str:
    """Full form of a path (scheme, host and absolute folder), so that two spellings compare equal."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/") + "/"


class Folders:
    """Renames and deletes in the file system of ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path))) if self.exists(path) else []

    def stamp(self, path: str) -> str:
        """Names, sizes and times of the data files of a folder."""
        files = [s for s in self._fs.listStatus(self._path(path)) if s.isFile() and s.getPath().getName()[0] not in "._"]
        return ";".join(sorted(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in files))

    def move(self, source: str, target: str) -> None:
        parent = self._path(target).getParent()
        self._fs.mkdirs(parent)
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot rename {source!r} to {target!r}")

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def write_mart(df: DataFrame, path: str, inputs: tuple[str, ...] = (), rows=None) -> int:
    """Publish a mart as parquet, replacing the previous one; returns its rows.

    The mart is written beside its place, its rows are counted there, and only
    then do two renames swap it in; the previous mart is deleted last.  A job
    that is killed while it writes leaves the previous mart as it was, and a
    failed swap puts it back.  ``rows`` is a number, or a function called after
    the write, that the count must equal.

    An output inside (or equal to) an input of the same job is refused.
    """
    spark = df.sparkSession
    out = _qualified(spark, path)
    for src in inputs:
        s = _qualified(spark, src)
        if s.startswith(out) or out.startswith(s):
            raise ValueError(f"output {path!r} overlaps input {src!r}")
    folders, place, run = Folders(spark, path), path.rstrip("/"), uuid.uuid4().hex
    staged, previous = f"{place}._staged-{run}", f"{place}._previous-{run}"
    try:
        df.write.parquet(staged)
        written = spark.read.schema(df.schema).parquet(staged).count()
        expected = rows() if callable(rows) else rows
        if expected is not None and written != expected:
            raise RuntimeError(f"{written} rows were written to {path!r}, {expected} expected")
        kept = folders.exists(place)
        if kept:
            folders.move(place, previous)
        try:
            folders.move(staged, place)
        except BaseException:
            if kept:
                folders.move(previous, place)
            raise
        if kept:
            folders.delete(previous)
    finally:
        folders.delete(staged)
    return written


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows for a look at the result (the reference's ``show``)."""
    return df.limit(n)
