"""Written tables: lineage cuts inside a run, and the published snapshot."""

from __future__ import annotations

import json
import tempfile
import threading
import uuid
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lanewright.operators.buckets import BUCKET, bucket_digests, by_bucket
from lanewright.operators.profile import column_profile
from lanewright.sources.versions import Version, take_version, versions
from lanewright.specs import TableSpec

_CHECKPOINT_KEY = "spark.checkpoint.dir"
# Jobs of one step that run at a time. The driver holds the plans of all of them, with what
# adaptive execution makes of each, so this bounds its memory however many tables there are.
CONCURRENT_JOBS = 2
# Spark then removes the shuffle files of a write when it ends. It reads this as a write
# begins; otherwise files stay until the driver happens to collect its garbage.
_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Folders of local sessions that name none; the setting cannot be changed later.
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it.

    Only a local session, as in tests, may fall back to a temporary folder.
    """
    named = spark.conf.get(_CHECKPOINT_KEY, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="lanewright-")
    return _local_folders[app]


_cleanup_lock = threading.Lock()
# Writes that run, and the setting as it was before the first of them.
_cleanup: dict[str, tuple[int, str | None]] = {}


@contextmanager
def without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """Writes started here leave no shuffle files, so disk holds those of running writes and
    not of all there were. Frames evaluated later make their own."""
    app = spark.sparkContext.applicationId
    with _cleanup_lock:
        running, before = _cleanup.get(app) or (0, spark.conf.get(_CLEANUP_KEY, None))
        _cleanup[app] = (running + 1, before)
        spark.conf.set(_CLEANUP_KEY, "true")
    try:
        yield
    finally:
        with _cleanup_lock:
            running, before = _cleanup[app]
            if running > 1:
                _cleanup[app] = (running - 1, before)
            else:
                del _cleanup[app]
                if before is None:
                    spark.conf.unset(_CLEANUP_KEY)
                else:
                    spark.conf.set(_CLEANUP_KEY, before)


class Stage:
    """Cuts lineage by writing a table to the shared folder and reading it back.

    A lost executor then costs the running step only, later steps read columns
    they need, and Spark knows the size of the table when it picks joins. As a
    context manager it deletes its tables at the end; nothing read from them may
    be used after that.
    """

    def __init__(self, spark: SparkSession, run_id: str | None = None):
        self.spark = spark
        self.run_id = run_id or uuid.uuid4().hex
        self.root = f"{shared_folder(spark)}/lanewright/{self.run_id}"

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *error) -> None:
        self.drop()

    def drop(self) -> None:
        """Delete what this run wrote, and nothing else."""
        self._delete(self.root)

    def forget(self, *names: str) -> None:
        """Delete tables of this run that nothing reads any more."""
        for name in names:
            self._delete(f"{self.root}/{name}")

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        with without_shuffle_files(self.spark):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def cut_all(
        self, tables: Mapping[str, DataFrame], at_once: int = CONCURRENT_JOBS
    ) -> dict[str, DataFrame]:
        """Cut tables that do not depend on each other, as Spark jobs ``at_once``."""
        with ThreadPoolExecutor(max_workers=at_once) as pool:
            jobs = {
                name: pool.submit(inheritable_thread_target(self.spark)(self.cut), df, name)
                for name, df in tables.items()
            }
            return {name: job.result() for name, job in jobs.items()}


def publish(
    tables: Mapping[str, DataFrame],
    root: str,
    run_id: str | None = None,
    specs: Mapping[str, TableSpec] | None = None,
    buckets: int = 64,
    based_on: int | None = None,
) -> dict[str, int]:
    """Write a full new snapshot, then make it the newest version.

    All tables are written, a few at a time, under ``root/runs/<run_id>``
    first. Taking the next version number is one small atomic step, so readers
    see the old snapshot whole until it lands, and a failed run leaves the old
    one in place. Rows are counted in the files written.

    With ``specs``, tables with a primary key are laid out in ``buckets`` of
    their key, and their digests and column profiles are stored, so that two
    versions can be compared by reading the buckets that differ. ``based_on``
    is the version the run started from; if another one landed since, the run
    stays unseen and ``PublishConflict`` is raised.
    """
    run_id = run_id or uuid.uuid4().hex
    root = root.rstrip("/")
    spark = next(iter(tables.values())).sparkSession
    folder = f"{root}/runs/{run_id}"
    keys = {n: specs[n].primary_key for n in tables if specs and n in specs and specs[n].primary_key}

    def write(name: str, df: DataFrame) -> tuple[int, str]:
        df = df.drop("index")
        if name in keys:
            df = by_bucket(df, keys[name], buckets)
            with without_shuffle_files(spark):
                df.write.mode("errorifexists").partitionBy(BUCKET).parquet(f"{folder}/{name}")
        else:
            with without_shuffle_files(spark):
                df.write.mode("errorifexists").parquet(f"{folder}/{name}")
        written = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
        if name in keys:
            facts = {
                "__buckets": bucket_digests(written),
                "__profiles": column_profile(written.drop(BUCKET), moments=True),
            }
            for kind, rows in facts.items():
                rows.coalesce(1).write.parquet(f"{folder}/{kind}/table_name={name}")
        return written.count(), df.schema.json()

    with ThreadPoolExecutor(max_workers=CONCURRENT_JOBS) as pool:
        jobs = {
            name: pool.submit(inheritable_thread_target(spark)(write), name, df)
            for name, df in tables.items()
        }
        done = {name: job.result() for name, job in jobs.items()}
    counts = {name: n for name, (n, _) in done.items()}
    schemas = {name: schema for name, (_, schema) in done.items()}
    take_version(spark, root, run_id, counts, schemas, buckets if keys else 0, based_on)
    return counts


def read_run(spark: SparkSession, root: str, version: Version, name: str) -> DataFrame:
    """A table of a version, with its buckets if it has them."""
    reader = spark.read
    if name in version.schemas:
        reader = reader.schema(StructType.fromJson(json.loads(version.schemas[name])))
    return reader.parquet(f"{root.rstrip('/')}/runs/{version.run_id}/{name}")


def read_published(
    spark: SparkSession, root: str, names: Sequence[str] | None = None, back: int = 0
) -> dict[str, DataFrame]:
    """The newest version, or the one published ``back`` versions before it."""
    known = versions(spark, root)
    if back >= len(known):
        raise LookupError(f"no snapshot {back} runs back under {root}")
    version = known[back]
    return {
        name: read_run(spark, root, version, name).drop(BUCKET)
        for name in version.n_rows
        if names is None or name in names
    }


def publish_jdbc(
    tables: Mapping[str, DataFrame], url: str, properties: Mapping[str, str] | None = None
) -> None:
    """Replace database tables, keeping their definitions.

    A database write is not atomic over tables. Publish to files first, so the
    old snapshot stays readable if this stops half-way.
    """
    for name, df in tables.items():
        writer = df.drop("index").write.format("jdbc").mode("overwrite")
        writer.options(url=url, dbtable=name, truncate="true", **(properties or {})).save()


def write_report(reports: Mapping[str, DataFrame], root: str) -> None:
    """Reconciliation details, one folder per kind, partitioned by table."""
    for kind, df in reports.items():
        df.write.mode("overwrite").partitionBy("table_name").parquet(f"{root.rstrip('/')}/{kind}")
