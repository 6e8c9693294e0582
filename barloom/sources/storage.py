"""Places that all machines of a cluster see, and the few file operations that Spark's readers and writers do not offer."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset, a local session (tests) gets a temporary folder of its
    own; on a cluster that would be a folder that other machines do not see, so it is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines see")
    app = spark.conf.get("spark.app.id", "")
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="barloom-")
    return "file://" + _local[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/barloom/{name}-{uuid.uuid4().hex}"


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: computed once, of known size, and there when executors are lost."""
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the files and folders that a pattern meets."""
    store, at = _file_system(spark, pattern)
    return sorted(f.getPath().getName() for f in (store.globStatus(at) or []))


def read_text(spark: SparkSession, path: str) -> str:
    store, at = _file_system(spark, path)
    stream = store.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def claim(spark: SparkSession, path: str, text: str) -> bool:
    """Puts a file with this text at `path` unless there is one; of several writers at once exactly one gets True.

    The text is written beside it first, so a file is never seen half written. A name is given by a hard link on a
    mounted folder and by a rename, which does not replace files, elsewhere.
    """
    store, at = _file_system(spark, path)
    store.mkdirs(at.getParent())
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    stream = store.create(_file_system(spark, beside)[1], False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if store.getScheme() != "file":
            return store.rename(_file_system(spark, beside)[1], at)
        try:
            os.link(_file_system(spark, beside)[1].toUri().getPath(), at.toUri().getPath())
            return True
        except FileExistsError:
            return False
    finally:
        store.delete(_file_system(spark, beside)[1], False)


def remove(spark: SparkSession, path: str) -> None:
    store, at = _file_system(spark, path)
    store.delete(at, True)


def part_value(folder: str) -> str | None:
    """The value in the name column=value of a folder that Spark wrote."""
    value = unquote(folder.partition("=")[2])
    return None if value == "__HIVE_DEFAULT_PARTITION__" else value
