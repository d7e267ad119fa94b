"""Opening files by URI, on the driver or inside a task."""

from __future__ import annotations

import os
import posixpath
from fnmatch import fnmatch

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path; Spark writes local URIs with one slash."""
    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def location(uri: str) -> str:
    """One spelling of a place: no scheme for local files, no links, no empty or dot parts."""
    system, path = resolve(uri)
    if isinstance(system, fs.LocalFileSystem):
        return os.path.realpath(path)
    return f"{uri[:len(uri) - len(path)]}{posixpath.normpath(path)}"


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, name, length) of the files under a folder, or of one file; empty files too.

    Names are relative to the folder; hidden files and folders are skipped. The
    listing itself is small and made on the driver, as Spark's own is; the rows
    are dealt out by size, so that large files do not meet in one task.
    """
    path = path.rstrip("/")
    system, root = resolve(path)
    prefix = "" if isinstance(system, fs.LocalFileSystem) else path[:len(path) - len(root)]
    if system.get_file_info(root).type == fs.FileType.File:
        found = [system.get_file_info(root)]
    else:
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
    rows = []
    for f in found:
        name = f.path[len(root):].lstrip("/") or f.base_name
        hidden = any(p.startswith(("_", ".")) for p in name.split("/"))
        if f.type == fs.FileType.File and not hidden and fnmatch(f.base_name, glob):
            rows.append((prefix + f.path, name, f.size))
    rows.sort(key=lambda r: (-r[2], r[1]))
    tasks = max(1, min(len(rows), spark.sparkContext.defaultParallelism))
    dealt = [r for k in range(tasks) for r in rows[k::tasks]]
    schema = "path string, name string, length bigint"
    return spark.createDataFrame(spark.sparkContext.parallelize(dealt, tasks), schema)
