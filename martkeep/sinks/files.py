"""Small files through Hadoop's file systems: listing, reading, and creating one only if it is not there."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object of ``path``."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return target.getFileSystem(conf), target


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text``; False, and nothing done, if it is there already.

    Exactly one of several callers succeeds, on file systems that create exclusively: HDFS,
    the local one, and object stores with conditional writes.
    """
    fs, target = file_system(spark, path)
    fs.mkdirs(target.getParent())
    try:
        if fs.getScheme() == "file":  # Hadoop looks first and creates then; the system does both at once
            local = spark.sparkContext._jvm.java.io.File(target.toUri().getPath())
            if not local.createNewFile():
                return False
            out = spark.sparkContext._jvm.java.io.FileOutputStream(local)
        else:
            out = fs.create(target, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def renew(spark: SparkSession, path: str) -> None:
    """Mark a file as changed now."""
    fs, target = file_system(spark, path)
    fs.setTimes(target, spark.sparkContext._jvm.System.currentTimeMillis(), -1)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = file_system(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def listed(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder and when they were last changed (epoch milliseconds); none if it is not there."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return {}
    return {status.getPath().getName(): status.getModificationTime() for status in fs.listStatus(target)}


def folders_with(spark: SparkSession, path: str, name: str) -> set[str]:
    """Names of the folders in ``path`` that hold a file ``name``, by one request."""
    fs, _ = file_system(spark, path)
    pattern = re.sub(r"([\\{}\[\]*?])", r"\\\1", path)
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{pattern}/*/{name}"))
    return {status.getPath().getParent().getName() for status in found or ()}


def delete(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)
