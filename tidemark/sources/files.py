"""Files under a path, through the file system Spark uses for it."""

from __future__ import annotations

import json
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Files moved at once.
MOVERS = 16


@lru_cache(maxsize=1)
def _path_class(jvm):
    """Looked up once: each part of its name is a call to the JVM."""
    return jvm.org.apache.hadoop.fs.Path


def _path(spark: SparkSession, path: str):
    return _path_class(spark._jvm)(path)


def file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(_path(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(_path(spark, path), True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or directory to a path that does not exist yet."""
    fs = file_system(spark, source)
    to = _path(spark, target)
    fs.mkdirs(to.getParent())
    if fs.exists(to) or not fs.rename(_path(spark, source), to):
        raise OSError(f"Cannot rename {source} to {target}")


def copy(spark: SparkSession, source: str, target: str) -> None:
    """Copy a file or directory to a path that does not exist yet."""
    fs = file_system(spark, source)
    copier = spark._jvm.org.apache.hadoop.fs.FileUtil
    if not copier.copy(fs, _path(spark, source), fs, _path(spark, target), False, spark._jsc.hadoopConfiguration()):
        raise OSError(f"Cannot copy {source} to {target}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of a directory; none when it does not exist."""
    fs = file_system(spark, path)
    if not fs.exists(_path(spark, path)):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(_path(spark, path)))


def output_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files that readers see under a path, however many; none when it does not exist."""
    if not exists(spark, path):
        return []
    return sorted(list_outputs(spark, path).select("name").toArrow().column("name").to_pylist())


def rename_all(spark: SparkSession, moves: Iterable[tuple[str, str]]) -> None:
    """Move many files, several at a time: most of a move is waiting for the file system."""
    with ThreadPoolExecutor(MOVERS) as pool:
        for _ in pool.map(lambda move: rename(spark, *move), moves):
            pass


def write_text(spark: SparkSession, path: str, text: str) -> None:
    out = file_system(spark, path).create(_path(spark, path), True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_json(spark: SparkSession, path: str) -> dict | None:
    """A small JSON file, None when it does not exist."""
    if not exists(spark, path):
        return None
    stream = file_system(spark, path).open(_path(spark, path))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def list_outputs(spark: SparkSession, path: str) -> DataFrame:
    """All files under a path: name, full path, length, modification time.

    Only the listing is read, never the content.
    """
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    )
    return found.select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "path", "length", "modificationTime"
    )
