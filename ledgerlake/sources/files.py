"""Files of a folder as the file system lists them, whatever their first letter."""

from __future__ import annotations

import fnmatch
from collections.abc import Sequence

from pyspark.sql import SparkSession

from ledgerlake.session import scratch_dir

# What stands before the names of copies of files that Spark would not see.
SEEN = "seen"
# (path, name, bytes).
File = tuple[str, str, int]


def listed(spark: SparkSession, path: str, glob: str) -> list[File]:
    """The files of a folder, or of one file, that the pattern takes; in order of their paths."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    tops = files.globStatus(at) or []
    found = [(s.getPath(), s.getLen()) for top in tops for s in (files.listStatus(top.getPath()) if top.isDirectory() else [top]) if s.isFile()]
    return sorted((p.toString(), p.getName(), size) for p, size in found if fnmatch.fnmatchcase(p.getName(), glob))


def all_plain(spark: SparkSession, path: str, glob: str, most: int) -> bool:
    """Whether a folder surely has no hidden file that the pattern takes, and none of more than ``most`` bytes.

    The file system is asked three times, however many files there are: no name of a visible file comes to the driver.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at) or not files.getFileStatus(at).isDirectory() or files.getContentSummary(at).getLength() > most:
        return False
    hidden = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(at, "[_.]*")) or []
    return not any(s.isFile() and fnmatch.fnmatchcase(s.getPath().getName(), glob) for s in hidden)


def is_hidden(file: File) -> bool:
    """Whether Spark's readers pass over a file of this name."""
    return file[1].startswith(("_", "."))


def visible(spark: SparkSession, hidden: Sequence[File]) -> list[File]:
    """Copies of files, made in the scratch folder by the file system, under names that Spark reads."""
    folder, copies = scratch_dir(spark, "hidden"), []
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    for path, name, size in hidden:
        source, target = hadoop.Path(path), hadoop.Path(f"{folder}/{SEEN}{name}")
        hadoop.FileUtil.copy(source.getFileSystem(conf), source, target.getFileSystem(conf), target, False, conf)
        copies.append((target.toString(), f"{SEEN}{name}", size))
    return copies


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file; None for an empty file. No more of it is read."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
    try:
        java = spark._jvm.java.io
        return java.BufferedReader(java.InputStreamReader(stream, "UTF-8"), 4096).readLine()
    finally:
        stream.close()
