"""Small file operations on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), there


def exists(spark: SparkSession, path: str) -> bool:
    system, there = _at(spark, path)
    return system.exists(there)


def children(spark: SparkSession, path: str) -> list[str]:
    """Paths directly below a folder, hidden ones left out; none if it is missing."""
    system, there = _at(spark, path)
    if not system.exists(there):
        return []
    found = [(str(s.getPath().getName()), str(s.getPath())) for s in system.listStatus(there)]
    return sorted(path for name, path in found if not name.startswith(("_", ".")))


def delete(spark: SparkSession, path: str) -> None:
    system, there = _at(spark, path)
    system.delete(there, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder or file, in one step; raises where the target is there already."""
    system, there = _at(spark, target)
    system.mkdirs(there.getParent())
    if system.exists(there) or not system.rename(_at(spark, source)[1], there):
        raise FileExistsError(target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one step: readers see the old text or the new."""
    system, there = _at(spark, f"{path}.new")
    out = system.create(there, True)
    out.write(bytearray(text.encode()))
    out.close()
    _, final = _at(spark, path)
    system.delete(final, False)
    system.rename(there, final)


def read_text(spark: SparkSession, path: str) -> str | None:
    system, there = _at(spark, path)
    if not system.exists(there):
        return None
    opened = system.open(there)
    try:
        return bytes(opened.readAllBytes()).decode()
    finally:
        opened.close()
