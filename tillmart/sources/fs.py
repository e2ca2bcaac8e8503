"""File-system metadata helpers over Hadoop's FileSystem API.

Used only for O(files) metadata work on the driver (listing snapshot
directories, giving written files stable names).  Data never passes here.
Works for any scheme Spark is configured for (file:, hdfs:, s3a:, ...).
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(sc._jsc.hadoopConfiguration()), jpath


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme, in the file system's own spelling."""
    fs, p = _fs(spark, path)
    return str(fs.makeQualified(p).toString())


def list_dir(spark: SparkSession, path: str) -> list[tuple[str, bool, int]]:
    """(full path, is_directory, length) of the direct children of ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [(str(s.getPath().toString()), bool(s.isDirectory()), int(s.getLen())) for s in fs.listStatus(p)]


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _fs(spark, src)
    d = _path(spark, dst)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def touch(spark: SparkSession, path: str) -> None:
    """Create a zero-length file."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def delete(spark: SparkSession, path: str, recursive: bool = True) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, recursive)


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small metadata file."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small metadata file with its whole content, only if there is
    none of this name: True if this call made it.  A finished file is given the
    name in one step: a hard link on a local file system, elsewhere Hadoop's
    rename without overwriting (atomic on HDFS and the like; an object store
    whose rename copies needs a conditional put here instead)."""
    fs, target = _fs(spark, path)
    fs.mkdirs(target.getParent())
    draft = _path(spark, f"{target.getParent().toString()}/.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if str(fs.getScheme()) == "file":
            os.link(draft.toUri().getPath(), target.toUri().getPath())
            return True
        jvm = spark.sparkContext._jvm
        rename_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(draft, target, rename_options)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
            return False
        raise
    finally:
        fs.delete(draft, False)
