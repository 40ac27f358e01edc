"""Small text files on any Hadoop file system: markers, pinned schemas, progress."""

from __future__ import annotations

from pyspark.sql import SparkSession


def locate(spark: SparkSession, path: str):
    """File system and path object of `path`."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = locate(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing where there is none."""
    fs, target = locate(spark, path)
    fs.delete(target, True)


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """Entries of `folder` that are named by a number, ascending."""
    fs, target = locate(spark, folder)
    if not fs.exists(target):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    return sorted(int(name) for name in names if name.isdigit())


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = locate(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file under another name first, so that readers see all of it or nothing."""
    fs, target = locate(spark, path)
    _, draft = locate(spark, f"{path}.draft")
    stream = fs.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not fs.rename(draft, target):
        raise OSError(f"could not write {path}")


def newest(spark: SparkSession, folder: str) -> str | None:
    """Text of the file with the highest number, or None."""
    found = numbers(spark, folder)
    return read_text(spark, f"{folder}/{found[-1]}") if found else None


def add(spark: SparkSession, folder: str, text: str) -> None:
    """A file with the next number."""
    found = numbers(spark, folder)
    write_text(spark, f"{folder}/{found[-1] + 1 if found else 0}", text)
