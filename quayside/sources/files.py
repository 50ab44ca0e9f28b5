"""Hadoop file system helpers; a listing that fails raises."""

from __future__ import annotations


def _fs(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename(spark, path: str, to: str) -> None:
    fs, p = _fs(spark, path)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} could not be renamed to {to}")


def total_bytes(spark, path: str, suffix: str = ".parquet") -> int:
    fs, p = _fs(spark, path)
    size, walk = 0, fs.listFiles(p, True)
    while walk.hasNext():
        f = walk.next()
        size += f.getLen() if f.getPath().getName().endswith(suffix) else 0
    return size


def list_files(spark, path: str, suffix: str = ".parquet") -> list[str]:
    """Paths (without scheme) of all files below ``path``."""
    fs, p = _fs(spark, path)
    found, walk = [], fs.listFiles(p, True)
    while walk.hasNext():
        f = walk.next().getPath().toUri().getPath()
        if f.endswith(suffix):
            found.append(f)
    return sorted(found)


def list_uris(spark, path: str, suffix: str = ".parquet") -> list[str]:
    """Full names, with scheme, of all files below ``path``."""
    fs, p = _fs(spark, path)
    found, walk = [], fs.listFiles(p, True)
    while walk.hasNext():
        f = walk.next().getPath().toString()
        if f.endswith(suffix):
            found.append(f.replace("file:/", "file:///", 1) if f.startswith("file:/") and not f.startswith("file:///") else f)
    return sorted(found)


def child_dirs(spark, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
