"""Named tables: reading, publishing and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def read_table(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """A Parquet table of a folder, or a table of the session's catalog."""
    return spark.table(name) if folder is None else spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_SETTING} must name a shared folder on a cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cohortair-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def publish(
    df: DataFrame, name: str, folder: str, cluster_by: tuple[str, ...] = ()
) -> DataFrame:
    """Write the rows as a new table of a folder and return the stored table.

    The stored table has no lineage, so later flows that use it several times
    read it instead of computing it again, and a lost executor costs no more
    than a re-read. It lies at `<folder>/<name>.parquet`; the folder must be one
    that all executors reach, such as a new one under `shared_folder`. A table
    that is there already is never overwritten, as the rows may come from it:
    Spark raises before anything is written, and callers take a new folder per
    run. `cluster_by` sorts each file by these columns, so that a filter on
    them skips row groups.
    """
    path = f"{folder.rstrip('/')}/{name}.parquet"
    out = df.sortWithinPartitions(*cluster_by) if cluster_by else df
    out.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def new_folder(spark: SparkSession) -> str:
    """A folder of its own for one run, under the shared one."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def publish_table(
    df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 0
) -> DataFrame:
    """Write the rows as a new catalog table and return it.

    Tables that are joined by one key again and again (people, visits,
    conditions by `person_id`; readings by `aqs_site_id`) can be stored in
    buckets of that key: joins and groupings by it then need no shuffle. As
    with `publish`, a table of that name is never overwritten (the rows may
    come from it): Spark raises before anything is written; take a new name
    per run.
    """
    writer = df.write.mode("errorifexists").format("parquet")
    if bucket_by is not None:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
