"""What lies under a path, in any file system Spark knows."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    files, found = _located(spark, path)
    return files.exists(found)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, by name in ascending order; nothing if there is no such folder."""
    files, found = _located(spark, path)
    if not files.exists(found):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(found))


def is_folder(spark: SparkSession, path: str) -> bool:
    files, found = _located(spark, path)
    return files.exists(found) and files.getFileStatus(found).isDirectory()


def delete(spark: SparkSession, path: str) -> None:
    files, found = _located(spark, path)
    files.delete(found, True)


def put_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file that holds ``text``, unless something of that name is there.

    The file appears with all of its text or not at all, and of several writers of one name
    exactly one is told that the file is theirs. The text is written beside it under a hidden
    name first, which only the last step reveals.
    """
    files, found = _located(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(found.getParent(), f".{found.getName()}.{uuid.uuid4().hex}")
    files.mkdirs(found.getParent())
    out = files.create(hidden, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if files.getScheme() == "file":
            return _linked(files, hidden, found)
        return _renamed(spark, hidden, found)
    finally:
        files.delete(hidden, False)


def _linked(files, hidden, found) -> bool:
    """On a local disk a rename replaces what is there; a link does not."""
    here, there = (unquote(urlparse(files.makeQualified(p).toString()).path) for p in (hidden, found))
    try:
        os.link(here, there)
    except FileExistsError:
        return False
    return True


def _renamed(spark: SparkSession, hidden, found) -> bool:
    """One step of the name node, which fails if the name is taken."""
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(found.toUri(), spark._jsc.hadoopConfiguration())
    options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(hidden, found, options)
    except Py4JJavaError as error:
        if context.util().exists(found):
            return False
        raise error
    return True
