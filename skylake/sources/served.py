"""The served archive: one version per key, kept up to date month by month.

Layout: `<served>/version=V/yyyymm=M/`, and a log `<served>-log/version=V` with a row for each load folder that the version knows: its month,
a mark of its files, and the version that holds the month. A refresh compares the load folders of the archive with the log; months with a
new, replaced or removed folder are merged and written below the new version, all others stay as the files they are. The log is written last: until
then readers see the version before, whole.

Next to it `<served>-sums/version=V/yyyymm=M/` keeps the exact sums of each date and region, taken from the month as it was merged. So a later
version of a row, a replaced load and a removed one change the sums as they change the rows, and a region's history reads the sums only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylake import schemas
from skylake.functions.numeric import SUM_PARTS, exact_sums
from skylake.session import remove
from skylake.sources import archive, files, manifest

SUMMED = ("dates", "reg_name")
LOG = "extraction_date string, part string, yyyymm string, mark bigint, held int"


def _log(served: str) -> str:
    return f"{served.rstrip('/')}-log"


def _sums(served: str) -> str:
    return f"{served.rstrip('/')}-sums"


def _with_month(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("extraction_date", T.DateType()), T.StructField("yyyymm", T.StringType())])


def _committed(spark: SparkSession, served: str, version: int) -> DataFrame:
    if version < 0:
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).parquet(f"{_log(served)}/version={version}")


def newest(spark: SparkSession, served: str) -> int:
    """Number of the newest complete version, -1 without one."""
    return manifest.committed(spark, _log(served), "version") - 1


def load_folders(spark: SparkSession, root: str) -> DataFrame:
    """(extraction_date, part, yyyymm, mark) of the archive's load folders; the mark follows from their files' names, sizes and times."""
    listed = files.list_files(spark, root, ".parquet")
    place = lambda name: F.regexp_extract("path", f"/{name}=([^/]*)/", 1).alias(name)
    mark = (F.xxhash64("name", "length", "modified") % 1_000_000_007).cast("bigint")
    return listed.select(place("extraction_date"), place("part"), place("yyyymm"), mark.alias("mark")) \
        .groupBy("extraction_date", "part", "yyyymm").agg(F.sum("mark").alias("mark"))


def refresh(spark: SparkSession, root: str, served: str, schema: T.StructType = schemas.ARCHIVED_DATA) -> list[str]:
    """Bring the served archive and its sums up to the archive below `root`; the months that were written. Equal to a full compaction."""
    last = newest(spark, served)
    before, now = _committed(spark, served, last), load_folders(spark, root)
    keys = ["extraction_date", "part", "yyyymm"]
    both = now.join(before.withColumnRenamed("mark", "old"), keys, "full")
    # A row per month: there are twelve a year.
    months = both.groupBy("yyyymm").agg(F.max((~F.col("mark").eqNullSafe(F.col("old"))).cast("int")).alias("touched"),
                                        F.count("mark").alias("loads"), F.max("held").alias("held")).collect()
    touched = sorted(m.yyyymm for m in months if m.touched)
    if not touched:
        return []
    rewritten = [m.yyyymm for m in months if m.touched and m.loads]
    rows = archive.latest(archive.read_archive(spark, root, schema).where(F.col("yyyymm").isin(rewritten)))
    archive.by_month(rows).write.mode("overwrite").partitionBy("yyyymm").parquet(f"{served}/version={last + 1}")
    merged = spark.read.schema(_with_month(schema)).parquet(f"{served}/version={last + 1}")
    # At most a row per day and region in a month.
    merged.groupBy("yyyymm", *SUMMED).agg(*[s for m in schemas.HISTORY_MEASURES for s in exact_sums(m, m)]).repartition("yyyymm") \
        .write.mode("overwrite").partitionBy("yyyymm").parquet(f"{_sums(served)}/version={last + 1}")
    held = F.create_map(*[F.lit(x) for m in months if m.loads for x in (m.yyyymm, last + 1 if m.touched else m.held)]) if any(m.loads for m in months) \
        else F.lit(None).cast("map<string,int>")
    now.select(*keys, "mark", F.element_at(held, F.col("yyyymm")).cast("int").alias("held")).coalesce(1) \
        .write.mode("overwrite").parquet(f"{_log(served)}/version={last + 1}")
    return touched


def held_months(spark: SparkSession, served: str, version: int | None = None) -> DataFrame:
    """(yyyymm, held): the version that holds each month."""
    return _committed(spark, served, newest(spark, served) if version is None else version).select("yyyymm", "held").distinct()


def _held(spark: SparkSession, served: str, root: str, whole: T.StructType) -> DataFrame:
    """The months below `root`, each from the version that holds it."""
    paths = [f"{root}/version={m.held}/yyyymm={m.yyyymm}" for m in held_months(spark, served).collect()]
    if not paths:
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", root).parquet(*paths).drop("version")


def read(spark: SparkSession, served: str, schema: T.StructType = schemas.ARCHIVED_DATA) -> DataFrame:
    """The newest complete version, with `extraction_date` (date) and `yyyymm` (text). A filter on months reads only their folders."""
    return _held(spark, served, served, _with_month(schema))


def region_sums(spark: SparkSession, served: str) -> DataFrame:
    """The exact sums (`numeric.exact_sums`) of each date and region in the newest complete version, with `yyyymm` (text)."""
    keys = [T.StructField("dates", T.DateType()), T.StructField("reg_name", T.StringType())]
    parts = [T.StructField(f"{m}_{part}", kind) for m in schemas.HISTORY_MEASURES for part, kind in SUM_PARTS]
    return _held(spark, served, _sums(served), T.StructType([*keys, *parts, T.StructField("yyyymm", T.StringType())]))


def vacuum(spark: SparkSession, served: str) -> list[str]:
    """Remove month folders that the newest version does not hold, when no reader uses an earlier one any more; what was removed."""
    last, gone = newest(spark, served), []
    held = {(m.yyyymm, m.held) for m in held_months(spark, served, last).collect()}
    for version in range(last):
        for m in held_months(spark, served, version).where(F.col("held") == version).collect():
            if (m.yyyymm, version) not in held:
                for root in (served, _sums(served)):
                    remove(spark, f"{root}/version={version}/yyyymm={m.yyyymm}")
                gone.append(f"version={version}/yyyymm={m.yyyymm}")
    return gone
