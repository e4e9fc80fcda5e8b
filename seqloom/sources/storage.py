"""Paths on whatever file system the session reads."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path for plain file calls where it is on a disk; None on any other file system."""
    fs, p = _fs(spark, path)
    return p.toUri().getPath() if fs.getScheme() == "file" else None


def names(spark: SparkSession, path: str) -> list[str]:
    """Entry names of one folder (not recursive)."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole text, unless there is one: of several writers exactly one gets true.

    The text goes to a file of its own first, which then takes the name: by a hard link on a local disk, by a
    rename that never overwrites elsewhere (atomic on HDFS; an object store needs a file system with such a rename).
    """
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if fs.getScheme() == "file":
            _link(spark, draft, p)
        else:
            _rename(spark, draft, p)
        return True
    except Py4JJavaError as failed:
        if "FileAlreadyExists" in failed.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(draft, False)


def _link(spark: SparkSession, draft, path) -> None:
    local = lambda p: spark._jvm.java.io.File(p.toUri().getPath()).toPath()
    spark._jvm.java.nio.file.Files.createLink(local(path), local(draft))


def _rename(spark: SparkSession, draft, path) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    keep = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    hadoop.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, path, keep)
