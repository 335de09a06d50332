"""Small file operations through Hadoop's file systems, for whatever store a URI names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, uri: str):
    """Hadoop's file system and path of a URI, under the session's settings."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    path = jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(conf), path


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _file_system(spark, uri)
    return fs.exists(path)


def read_text(spark: SparkSession, uri: str) -> str | None:
    """A small file's text; None if there is no such file."""
    fs, path = _file_system(spark, uri)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, uri: str, text: str) -> None:
    """Replace a small file in one step: readers see the old text or the new one, never a part.

    The draft is renamed over the file.  That is one step in HDFS and local file systems; object stores
    put the renamed file as a whole.
    """
    fs, path = _file_system(spark, uri)
    fs.mkdirs(path.getParent())
    draft = _file_system(spark, f"{uri}.{uuid.uuid4().hex}.draft")[1]
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), fs.getConf())
    context.rename(context.makeQualified(draft), context.makeQualified(path), options)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a directory in another's place: what is there is removed first, then the name changes.

    A reader in between sees neither.
    """
    fs, to = _file_system(spark, target)
    fs.delete(to, True)
    fs.mkdirs(to.getParent())
    if not fs.rename(_file_system(spark, source)[1], to):
        raise OSError(f"{source} could not be moved to {target}")


def folders(spark: SparkSession, uri: str) -> list[str]:
    """The entries of a directory; none if it does not exist."""
    fs, path = _file_system(spark, uri)
    return [found.getPath().toString() for found in fs.listStatus(path)] if fs.exists(path) else []


def remove(spark: SparkSession, uri: str) -> None:
    """Remove a directory or file, if it is there."""
    fs, path = _file_system(spark, uri)
    fs.delete(path, True)


def remove_if_empty(spark: SparkSession, uri: str) -> bool:
    """Remove a directory that holds nothing; whether it is gone."""
    fs, path = _file_system(spark, uri)
    return not fs.exists(path) or (not fs.listStatus(path) and fs.delete(path, False))
