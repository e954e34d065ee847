"""Session helpers: building a session and locating the shared checkpoint folder.

Lineage is cut only by writing tables into the folder named by
``spark.checkpoint.dir`` (a shared folder on a cluster).
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one partition are joined by hash up to this size, by sorting beyond.
HASH_JOIN_BYTES = "64m"
# Bytes of input files for which a dealt table has a bucket: more input makes more buckets, not larger ones.
INPUT_PER_BUCKET = 2 << 20
# Buckets that a task of a dealt table keeps open at once; a task with more sorts its rows by bucket.
OPEN_BUCKETS = "16"
# Bytes of input files whose rows one write of a dealt table moves at once; more input is written in several goes.
INPUT_PER_WRITE = 512 << 20
# Settings of every write: what its exchanges left on disk goes when it is over.
_WRITES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Columns of tables between jobs are packed closely, since they lie beside each other on the shared disk.
_CODEC = "zstd"


def get_spark(master: str | None = None, app: str = "sylva", shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library is tuned for."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # join by hash where every partition of the smaller side is known to be small, by sorting elsewhere
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.driver.memory", os.environ.get("SYLVA_DRIVER_MEMORY", "16g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for checkpoints and tables between jobs.

    It is the one named by ``spark.checkpoint.dir``. Where that is unset, as in
    tests, a folder in the session's warehouse directory is used, which the
    driver and all executors share; a machine-local temporary folder never is.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    sc.setCheckpointDir(configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/sylva-checkpoints")
    return sc.getCheckpointDir()


_DEALT = "sylva_dealt_"


def _table_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sylva-tables"


def new_table_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder for a file or table that one job writes and reads back."""
    return f"{_table_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, tag: str = "table", apart: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table to the shared folder and read it back.

    This cuts lineage in one columnar pass, and the table outlives a lost
    executor. :func:`drop_tables` deletes all tables of the application.
    Rows with different values in the column ``apart`` lie in files of their own, so a filter on it reads no others.
    """
    spark = df.sparkSession
    path = new_table_path(spark, tag)
    with settings(spark, _WRITES):
        df.write.parquet(path, compression=_CODEC, partitionBy=apart)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_at = path
    return table


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings of the session for the plans that are made inside."""
    old = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def by_document(spark: SparkSession):
    """Let joins on (document, node) use rows that are dealt by document alone, and hash joins where partitions are small.

    Dealt tables are read by bucket even below a union, where Spark would not look for the use of it.
    """
    return settings(spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false",
                            "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
                            "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": HASH_JOIN_BYTES})


def bucket_count(df: DataFrame) -> int:
    """Buckets for rows made from ``df``: as many as its dealt table has, or else by the size of the files it reads.

    There are at least as many as a shuffle has partitions.
    """
    if hasattr(df, "dealt"):
        return df.dealt
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), _input_bytes(df) // INPUT_PER_BUCKET)


def _input_bytes(df: DataFrame) -> int:
    files = df.inputFiles()
    size = df.sparkSession.read.format("binaryFile").load(files).agg({"length": "sum"}).first()[0] if files else 0
    return size or 0


def _goes(df: DataFrame) -> int:
    """In how many goes a dealt table is written, each with the rows of some keys.

    One, unless ``df`` has exchanges of its own over much input. A filter on the key goes down to the scans, except below
    Python code, which would run again in each go.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "Exchange hashpartitioning" not in plan or re.search(r"Python|Pandas|InArrow|Scala|Serialize", plan):
        return 1
    return writes_for(df)


def writes_for(df: DataFrame) -> int:
    """Goes in which rows made from ``df`` are moved, by the size of the files it reads."""
    return max(1, -(-_input_bytes(df) // INPUT_PER_WRITE))


def union_dealt(parts: list[DataFrame], key: str = "doc_id") -> DataFrame:
    """``unionByName`` of rows that are dealt by ``key`` alike, which stay so.

    Spark tells that all sides of a union are dealt alike by comparing their key columns together with the names of the
    tables they come from; a fresh name for the key has no table's name.
    """
    fresh = f"_dealt_{key}"
    return reduce(DataFrame.unionByName, [p.withColumnRenamed(key, fresh) for p in parts]).withColumnRenamed(fresh, key)


def deal_table(df: DataFrame, tag: str = "table", key: str = "doc_id", buckets: int | None = None,
               apart: str | None = None) -> DataFrame:
    """:func:`write_table`, with the rows dealt to ``buckets`` (default: as many as a shuffle has partitions) by ``key``.

    Spark reads a bucketed table as rows that are dealt by ``key`` already: aggregates and joins on it (with more
    columns: see :func:`by_document`) need no exchange. Rows that come dealt are not moved for the write either.
    A task of the write has one bucket: tasks of many buckets sort, and spill, all their rows to write them.
    Rows with different values in the column ``apart`` lie in files of their own, so a filter on it reads no others.
    Much input is written in several goes (:func:`_goes`), so that the disk holds the exchanges of one go at a time.
    The number of buckets stands in the result's ``dealt``.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{_DEALT}{tag}_{uuid.uuid4().hex}"
    wanted = {"spark.sql.maxConcurrentOutputFileWriters": OPEN_BUCKETS, "spark.sql.shuffle.partitions": str(n),
              "spark.sql.adaptive.coalescePartitions.enabled": "false", **_WRITES}
    with settings(spark, wanted), by_document(spark):
        goes = _goes(df)
        for go in range(goes):
            rows = df if goes == 1 else df.where(F.pmod(F.xxhash64(key), F.lit(goes)) == go)
            write = (rows.repartition(n, key).write.format("parquet").mode("append").bucketBy(n, key)
                     .option("path", f"{_table_folder(spark)}/{name}").option("compression", _CODEC))
            (write.partitionBy(apart) if apart else write).saveAsTable(name)
    table = spark.table(name)
    table.dealt, table.dealt_name = n, name
    return table


def drop_table(table: DataFrame) -> None:
    """Delete a table of :func:`write_table` or :func:`deal_table` that nothing still to be computed reads."""
    spark = table.sparkSession
    name = getattr(table, "dealt_name", None)
    if name:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # its files are the folder's, and go below
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_table_folder(spark)}/{name}" if name else table.written_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_tables(spark: SparkSession) -> None:
    """Delete the tables that :func:`write_table` made; frames that still read them can no longer be computed."""
    for t in spark.catalog.listTables(pattern=f"{_DEALT}*"):
        spark.sql(f"DROP TABLE IF EXISTS {t.name}")
    path = spark._jvm.org.apache.hadoop.fs.Path(_table_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
