"""Small files and folders in shared storage, through the Hadoop file system of
the path: run ledgers and the pointer to the published version."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, ascending; none if it doesn't exist."""
    fs, path = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _at(spark, path)
    return fs.exists(jpath)


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _at(spark, path)
    fs.delete(jpath, True)


def read_json(spark: SparkSession, path: str) -> dict | None:
    """None if there is no such file."""
    fs, jpath = _at(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """Replaces the file in one step: readers see the old content or the new one."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    folder, name = path.rsplit("/", 1)
    fs, draft = _at(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(value).encode()))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = sc._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = sc._jsc.hadoopConfiguration()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, how)
