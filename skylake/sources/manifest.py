"""Files that a committed batch has read, and their deletion.

A manifest is a table of (path, length, modified) collected from the rows a batch read, so a file that lands later is in none. The
manifests of a target are its log: `<log>/batch=K`, K = 0, 1, 2 and on. A batch writes its data to a folder of the same number,
overwriting what a failed run left there, then its manifest, which commits it; its files are deleted after that. A run that finds a committed
batch first deletes what is left of that batch's files, so after a failure between the two steps nothing is read twice or lost.

Files without a line are read by no row: they stay.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "path string, length bigint, modified bigint"
BLOCK = 10_000  # entries the driver holds at once

FILE_COLUMNS = ("file_path", "file_length", "file_modified")


def with_file(df: DataFrame) -> DataFrame:
    """Add the file of each row of a file scan: path, length and modification time in milliseconds. Spark gives the path as an address,
    with escapes (`%20`); it is kept plain."""
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return df.select("*", plain.alias("file_path"), F.col("_metadata.file_size").alias("file_length"),
                     F.unix_millis("_metadata.file_modification_time").alias("file_modified"))


def of_rows(rows: DataFrame) -> DataFrame:
    """The manifest of rows with the columns of `with_file`. Rows of a file are made one before they are shuffled."""
    return rows.select(*(F.col(c).alias(n.split()[0]) for c, n in zip(FILE_COLUMNS, MANIFEST.split(", ")))).distinct()


def _path(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def committed(spark: SparkSession, log: str, kind: str = "batch") -> int:
    """Number of committed batches."""
    n = 0
    while True:
        done, system = _path(spark, f"{log}/{kind}={n}/_SUCCESS")
        if not system.exists(done):
            return n
        n += 1


def commit(files: DataFrame, log: str, batch: int) -> None:
    files.write.mode("overwrite").parquet(f"{log}/batch={batch}")


def read(spark: SparkSession, log: str, batch: int) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{log}/batch={batch}")


def next_batch(spark: SparkSession, log: str) -> int:
    """Number of the batch to write; the deletions of the last committed one are finished first."""
    n = committed(spark, log)
    if n:
        delete(spark, read(spark, log, n - 1))
    return n


def _folders(manifest: DataFrame) -> Iterator[tuple[str, dict[str, tuple[int, int]]]]:
    """Entries by folder, in blocks of BLOCK at most."""
    cut = manifest.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), F.regexp_extract("path", "[^/]*$", 0).alias("name"), "length", "modified")
    folder, held = None, {}
    for r in cut.orderBy("folder", "name").toLocalIterator():
        if held and (r.folder != folder or len(held) == BLOCK):
            yield folder, held
            held = {}
        folder = r.folder
        held[r.name] = (r.length, r.modified)
    if held:
        yield folder, held


def delete(spark: SparkSession, manifest: DataFrame) -> int:
    """Delete the files of a manifest that are as they were read, and say how many; a file that was written anew since is left.

    A block of a folder's entries is met with one listing of that folder and goes in the store's bulk deletions, as many files a call as it
    takes. The driver does it, a block at a time: only the JVM has the store's client, and Python tasks cannot reach it.
    """
    jvm, deleted = spark.sparkContext._jvm, 0
    for folder, held in _folders(manifest):
        root, system = _path(spark, folder)
        if not system.exists(root):
            continue
        bulk = system.createBulkDelete(root)
        page = jvm.java.util.ArrayList()
        listed = system.listStatusIterator(root)
        while True:
            more = listed.hasNext()
            if more:
                status = listed.next()
                if held.get(status.getPath().getName()) != (status.getLen(), status.getModificationTime()):
                    continue
                page.add(status.getPath())
            if page.size() and (not more or page.size() >= bulk.pageSize()):
                failed = bulk.bulkDelete(page)
                if failed.size():
                    raise RuntimeError(f"{failed.size()} files could not be deleted, the first: {failed.get(0)}")
                deleted += page.size()
                page = jvm.java.util.ArrayList()
            if not more:
                break
        bulk.close()
    return deleted
