"""Numbered files that only one of several writers can create.

A text is written under a name of its own and then moved to its number, which fails if
the number is taken. HDFS does that in one step; local folders and object stores
check and then move, so there two writers must not come within that moment.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _paths(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, where, where.getFileSystem(conf)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with a text; False, and nothing changes, if there is one already."""
    jvm, conf, where, fs = _paths(spark, path)
    fs.mkdirs(where.getParent())
    own = jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(own, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    none = spark.sparkContext._gateway.new_array(options, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri() if where.toUri().getScheme() else fs.getUri(), conf)
    try:
        context.rename(own, where, none)
        return True
    except Py4JJavaError as e:
        fs.delete(own, False)
        if fs.exists(where):
            return False
        raise e


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of a folder that are taken, in order."""
    _, _, where, fs = _paths(spark, folder)
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(int(n) for n in names if n.isdigit())


def claim(spark: SparkSession, folder: str, text: str = "") -> int:
    """Take the next free number of a folder."""
    n = max(numbers(spark, folder), default=0) + 1
    while not create_once(spark, f"{folder}/{n:08d}", text):
        n += 1
    return n


def text_of(spark: SparkSession, folder: str, n: int) -> str:
    """What a number's file says."""
    jvm, _, where, fs = _paths(spark, f"{folder}/{n:08d}")
    stream = fs.open(where)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
