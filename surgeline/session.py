"""Session helpers."""

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cpus=8, partitions=8):
    """A session for tests and the bench; on a cluster the submitted one is used as it is."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("surgeline")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SURGELINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark):
    """The folder all executors see: ``spark.checkpoint.dir`` of the session.

    Only where the session names none and runs in one process (tests) a temporary folder is set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="surgeline-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark, label):
    """A path nobody has used yet inside the shared folder."""
    return f"{shared_dir(spark)}/surgeline-{label}-{uuid.uuid4().hex}"


def remove(spark, path):
    """Delete a folder that no later plan reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def written(df, label, **options):
    """Write ``df`` once to the shared folder and read it back, which also cuts its lineage."""
    path = new_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_small(df, label):
    """As ``written``, packed closer, and the shuffle files of the write go when it has ended."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        return written(df, label, compression="zstd")
    finally:
        conf.set(name, before)


def dropped(*tables):
    """Delete what ``written`` wrote, once nothing reads it any more."""
    for df in tables:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            remove(df.sparkSession, folder)


def shipped(spark):
    """Send this package to the workers once per application, so that they need no path to it."""
    context = spark.sparkContext
    if getattr(context, "_surgeline_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = f"{tempfile.mkdtemp(prefix='surgeline-package-')}/surgeline-{uuid.uuid4().hex[:8]}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for at, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(at, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)  # served by the driver, which reads the file as long as it runs
    context._surgeline_shipped = True
