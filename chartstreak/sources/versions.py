"""Models and documents published as immutable versions, one line of versions per group.

``root/country=XX/version=<number>-<unique>/`` is written once and never changed.
When all of it is there, an empty file ``_PUBLISHED`` is created in it, which
the file system does in one step. Readers take the published version with the
highest name of each group, once, and read only that folder: a reader sees an old
version or a new one, never a mixture, and a writer that dies leaves a folder that
nobody reads. The newest ``keep`` published versions of a group stay for readers
that began before; older ones go, the mark first, and so do unpublished folders
older than those.

One writer publishes below a root at a time; readers may be many. The driver
lists groups x kept versions names, nothing else.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

MARK = "_PUBLISHED"
KEEP = 3


def _fs(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory()]
    return sorted(n for n in names if n.startswith(prefix))


def _escaper(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils


def group_folder(spark: SparkSession, root: str, by: str, value: str) -> str:
    """The folder of a group, named as a partition of a table."""
    return f"{root}/{by}={_escaper(spark).escapePathName(value)}"


def groups(spark: SparkSession, root: str, by: str) -> list[str]:
    return [_escaper(spark).unescapePathName(n[len(by) + 1:]) for n in _names(spark, root, f"{by}=")]


def is_published(spark: SparkSession, folder: str) -> bool:
    fs, jpath = _fs(spark, f"{folder}/{MARK}")
    return fs.exists(jpath)


def versions(spark: SparkSession, root: str, by: str, value: str) -> list[str]:
    """Names of a group's version folders, oldest first, published or not."""
    return _names(spark, group_folder(spark, root, by, value), "version=")


def next_version(spark: SparkSession, root: str, by: str) -> str:
    """A name above those of all versions below ``root``."""
    last = [int(n.removeprefix("version=").split("-")[0]) for g in groups(spark, root, by)
            for n in versions(spark, root, by, g)]
    return f"{max(last, default=0) + 1:012d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, root: str, by: str, value: str, version: str, keep: int = KEEP) -> None:
    """Make a written version the group's current one; versions beyond the newest ``keep`` go."""
    folder = group_folder(spark, root, by, value)
    fs, mark = _fs(spark, f"{folder}/version={version}/{MARK}")
    if not fs.exists(mark.getParent()):
        raise FileNotFoundError(f"nothing was written to {folder}/version={version}")
    fs.createNewFile(mark)
    names = versions(spark, root, by, value)
    kept = [n for n in names if is_published(spark, f"{folder}/{n}")][-max(1, keep):]
    for name in names:
        if name < kept[0]:
            for gone in (f"{folder}/{name}/{MARK}", f"{folder}/{name}"):
                fs.delete(_fs(spark, gone)[1], True)


def current(spark: SparkSession, root: str, by: str) -> dict[str, str]:
    """The folder of each group's current version; groups without a published one are left out."""
    found = {}
    for value in groups(spark, root, by):
        folder = group_folder(spark, root, by, value)
        for name in reversed(versions(spark, root, by, value)):
            if is_published(spark, f"{folder}/{name}"):
                found[value] = f"{folder}/{name}"
                break
    return found
