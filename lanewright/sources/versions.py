"""Numbered versions of a published snapshot.

A version is one small file whose name is its number; it says which run holds
the tables. A number is taken by creating its file only if there is none, so of
two publishers one gets it and the other sees the conflict. Readers list the
files; they never see a number before its run is whole.

Taking a number is atomic on a local or network file system (a hard link) and
on HDFS (a rename that does not replace). A store without such a rename needs
one publisher at a time.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession


class PublishConflict(RuntimeError):
    """Another version was published since the one this run was based on."""


@dataclass(frozen=True)
class Version:
    number: int
    run_id: str
    n_rows: dict[str, int] = field(default_factory=dict)
    # Schemas as JSON; a table without rows may have no file to tell its own.
    schemas: dict[str, str] = field(default_factory=dict)
    # Buckets per table with digests; 0 where the run has none.
    buckets: int = 0
    based_on: int | None = None
    published_at: float = 0.0


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _read(spark: SparkSession, fs, status) -> Version:
    stream = fs.open(status.getPath())
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Version(**json.loads(text))


def versions(spark: SparkSession, root: str) -> list[Version]:
    """All versions, newest first."""
    fs, folder = _file_system(spark, f"{root.rstrip('/')}/versions")
    if not fs.exists(folder):
        return []
    files = [s for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json")]
    return sorted((_read(spark, fs, s) for s in files), key=lambda v: -v.number)


def _create_if_absent(spark: SparkSession, root: str, version: Version) -> bool:
    folder = f"{root.rstrip('/')}/versions"
    fs, target = _file_system(spark, f"{folder}/{version.number:010d}.json")
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(asdict(version)).encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            try:
                os.link(draft.toUri().getPath(), target.toUri().getPath())
            except FileExistsError:
                return False
            return True
        return bool(not fs.exists(target) and fs.rename(draft, target))
    finally:
        fs.delete(draft, False)


def take_version(
    spark: SparkSession,
    root: str,
    run_id: str,
    n_rows: dict[str, int],
    schemas: dict[str, str] | None = None,
    buckets: int = 0,
    based_on: int | None = None,
) -> Version:
    """Make a finished run the newest version.

    With ``based_on``, the number of the version the run started from (0 for
    none), a newer one raises ``PublishConflict`` and the run stays unseen;
    without, the next free number is taken.
    """
    while True:
        newest = max((v.number for v in versions(spark, root)), default=0)
        if based_on is not None and newest != based_on:
            raise PublishConflict(f"based on version {based_on}, but {newest} is published")
        version = Version(newest + 1, run_id, n_rows, schemas or {}, buckets, based_on, time.time())
        if _create_if_absent(spark, root, version):
            return version


def vacuum(spark: SparkSession, root: str, keep: int = 2, older_than_hours: float = 24.0) -> list[str]:
    """Forget all but the ``keep`` newest versions and delete the runs none of them refers to.

    A run that was touched within the last hours may still be under way and
    stays. Returns the runs that were deleted.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    known = versions(spark, root)
    fs, _ = _file_system(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for version in known[keep:]:
        fs.delete(path(f"{root.rstrip('/')}/versions/{version.number:010d}.json"), False)
    kept = {v.run_id for v in known[:keep]}
    runs = path(f"{root.rstrip('/')}/runs")
    latest = (time.time() - older_than_hours * 3600) * 1000
    gone = []
    for status in fs.listStatus(runs) if fs.exists(runs) else []:
        name = status.getPath().getName()
        if name not in kept and status.getModificationTime() <= latest:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)
