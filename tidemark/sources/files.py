"""Files that one writer can create, on whatever store a path names."""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def of(spark: SparkSession, path: str):
    """The file system of a path, and its path object."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def create_once(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a file with ``text``; False if it is there already.  Of several writers one succeeds.

    Local disks get a hard link, which only one can make (their Hadoop class looks first
    and creates then); other stores refuse to overwrite."""
    fs, p = of(spark, path)
    fs.mkdirs(p.getParent())
    if fs.getUri().getScheme() == "file":
        own = urlparse(path).path if path.startswith("file:") else path
        made = f"{own}.{uuid.uuid4().hex}"
        with open(made, "w") as f:
            f.write(text)
        try:
            os.link(made, own)
        except FileExistsError:
            return False
        finally:
            os.unlink(made)
        return True
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def text_of(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None if there is none."""
    fs, p = of(spark, path)
    try:
        stream = fs.open(p)
    except Py4JJavaError as e:
        if "FileNotFound" in e.java_exception.getClass().getName():
            return None
        raise
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def take_away(spark: SparkSession, path: str, text: str) -> bool:
    """Remove a file that still has ``text``; of several that try, one succeeds."""
    fs, p = of(spark, path)
    away = f"{path}.{uuid.uuid4().hex}"
    _, q = of(spark, away)
    if text_of(spark, path) != text:
        return False
    try:
        if not fs.rename(p, q):
            return False
    except Py4JJavaError:
        return False  # someone else was faster
    found = text_of(spark, away)
    if found != text:  # another one took it and came back in between
        create_once(spark, path, found or "")
    fs.delete(q, False)
    return found == text
