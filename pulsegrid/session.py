"""Session set-up and the shared folder for checkpoints and intermediate tables."""

import atexit
import contextlib
import hashlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_dirs = {}


def local_session(app_name="pulsegrid", cores=None, driver_memory="8g", **conf):
    """A local session for tests and the benchmark; a cluster job brings its own session."""
    cores = str(cores or "*")
    partitions = cores if cores.isdigit() else str(os.cpu_count() or 8)
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark):
    """Event times are UTC texts, so every job runs with the session zone UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark):
    """The folder all executors reach: ``spark.checkpoint.dir``; made up only for a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="pulsegrid-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


_made = []


def new_dir(spark, name):
    """A fresh folder name below the shared folder; nothing is created yet. A job's last step is ``remove_made``."""
    folder = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(folder)
    return folder


def remove_made(spark):
    """Removes the folders that ``new_dir`` has named in this process: intermediate tables, which nobody reads after the job."""
    while _made:
        _remove(spark, _made.pop())


def _remove(spark, folder):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Where jobs on a local master keep what must outlast them, if ``spark.checkpoint.dir`` is not set.
LOCAL_STATE = "pulsegrid-state"


def job_dir(spark, *names):
    """A folder that a job finds again after a restart: its name follows from ``names`` alone.

    It lies below ``spark.checkpoint.dir``, or for a local master without that setting in the working folder: progress, dead letters
    and rows set aside must not go with the session's own temporary folder.
    """
    mark = hashlib.sha256("|".join(map(str, names)).encode()).hexdigest()[:16]
    kept = spark.conf.get("spark.checkpoint.dir", None)
    if not kept and spark.sparkContext.master.startswith("local"):
        kept = os.path.abspath(LOCAL_STATE)
    return f"{(kept or shared_dir(spark)).rstrip('/')}/{names[0]}-{mark}"


def stored(df, name):
    """``df`` written once to the shared folder and read back.

    For rows that several jobs pass over: lineage ends here, and a lost executor costs a read, not a rerun.
    """
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def stored_meanwhile(df, name, by=()):
    """``stored`` for the block only, then the folder is removed: for the batches of a stream, which has no end.

    Rows lie in a folder per value of the columns ``by``, so that a reader of some values opens no others.
    """
    path = new_dir(df.sparkSession, name)
    try:
        df.write.partitionBy(*by).parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        _remove(df.sparkSession, path)
        if path in _made:
            _made.remove(path)
