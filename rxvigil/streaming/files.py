"""Small files that appear whole and never replace one another, on any file system Spark can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _located(spark, path)
    return files.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    place, files = _located(spark, path)
    return [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    place, files = _located(spark, path)
    stream = files.open(place)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content, unless there is one of that name."""
    target, files = _located(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    draft = hadoop.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = files.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    # A rename that must not replace: the later of two writers fails.
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(draft, target, options)
    except Exception as failed:
        files.delete(draft, False)
        if "FileAlreadyExistsException" in str(failed):
            return False
        raise
    return True


def remove(spark: SparkSession, path: str) -> None:
    place, files = _located(spark, path)
    files.delete(place, True)
