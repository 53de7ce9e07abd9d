"""Numbered publications: small files that appear whole, once, and never change."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    """The path and the file system that holds it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names of what lies in a folder; none where it does not exist."""
    path, fs = _store(spark, folder)
    try:
        return [s.getPath().getName() for s in fs.listStatus(path)]
    except Py4JJavaError as fault:
        if "FileNotFoundException" in fault.java_exception.getClass().getName():
            return []
        raise


def remove(spark: SparkSession, path: str) -> None:
    folder, fs = _store(spark, path)
    fs.delete(folder, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, replacing it."""
    file, fs = _store(spark, path)
    out = fs.create(file, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def get_text(spark: SparkSession, path: str) -> str:
    file, fs = _store(spark, path)
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def claim(spark: SparkSession, folder: str, number: int, text: str) -> bool:
    """Publish ``text`` under a number; False if the number was taken first.

    The file is written aside and then moved to its name in one step that fails where the name exists: a link in a local file
    system, a rename without overwriting elsewhere. So of several claims of a number one succeeds, and no reader sees a part.
    """
    jvm = spark._jvm
    aside, target = f"{folder}/.{uuid.uuid4().hex}", f"{folder}/{number:012d}"
    put_text(spark, aside, text)
    source, fs = _store(spark, aside)
    try:
        if fs.getUri().getScheme() == "file":
            local = [jvm.java.nio.file.Path.of(jvm.org.apache.hadoop.fs.Path(p).toUri().getPath(),
                                               spark._sc._gateway.new_array(jvm.java.lang.String, 0)) for p in (target, aside)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
            context.rename(source, _store(spark, target)[0], spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Py4JJavaError as fault:
        if "AlreadyExists" in fault.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(source, False)


def newest(spark: SparkSession, folder: str) -> tuple[int, str] | None:
    """The publication with the largest number."""
    numbers = [int(n) for n in names(spark, folder) if n.isdigit()]
    return (max(numbers), get_text(spark, f"{folder}/{max(numbers):012d}")) if numbers else None
