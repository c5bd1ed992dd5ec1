"""Folders and notes of a few values in the shared file system, without a Spark job."""

from __future__ import annotations

import json
import re

from pyspark.sql import SparkSession


def _file(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str, *, complete: bool = False) -> list[str]:
    """Names of the folders in a folder; with ``complete`` those whose writer finished."""
    place, files = _file(spark, path)
    if not files.exists(place):
        return []
    if complete:
        pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place, "*/_SUCCESS")
        return [f.getPath().getParent().getName() for f in files.globStatus(pattern)]
    return [f.getPath().getName() for f in files.listStatus(place) if f.isDirectory()]


def values(spark: SparkSession, path: str, key: str, *, complete: bool = False) -> list[str]:
    """The values V of the folders ``key=V``."""
    found = [re.fullmatch(rf"{key}=(.+)", name) for name in folders(spark, path, complete=complete)]
    return [m[1] for m in found if m]


def complete_numbers(spark: SparkSession, path: str, key: str) -> list[int]:
    """The numbers N of the folders ``key=N`` whose writer finished, ascending."""
    return sorted(int(n) for n in values(spark, path, key, complete=True))


def remove(spark: SparkSession, path: str) -> None:
    place, files = _file(spark, path)
    files.delete(place, True)


def write_note(spark: SparkSession, folder: str, number: int, note: dict) -> None:
    """Stores a few values under a number, in place of earlier ones; readers see all or nothing."""
    place, files = _file(spark, f"{folder}/{number}.json")
    draft, _ = _file(spark, f"{folder}/_{number}.json")
    stream = files.create(draft, True)
    stream.write(bytearray(json.dumps(note).encode()))
    stream.close()
    files.delete(place, False)
    if not files.rename(draft, place):
        raise OSError(f"cannot write {folder}/{number}.json")


def note_numbers(spark: SparkSession, folder: str) -> list[int]:
    """The numbers under which values are stored, ascending."""
    place, files = _file(spark, folder)
    if not files.exists(place):
        return []
    found = [re.fullmatch(r"(\d+)\.json", f.getPath().getName()) for f in files.listStatus(place)]
    return sorted(int(m[1]) for m in found if m)


def read_note(spark: SparkSession, folder: str, number: int) -> dict:
    place, files = _file(spark, f"{folder}/{number}.json")
    stream = files.open(place)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
