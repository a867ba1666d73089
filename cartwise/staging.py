"""Where intermediate results that are read many times are kept."""
import re
import tempfile
import uuid
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target


def shared_folder(spark):
    """Folder every executor can reach, as named by spark.checkpoint.dir.

    Without that setting only a local master, where driver and executors are one process,
    gets a folder of its own; on a cluster it is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or own_folder(sc.master))
    return sc.getCheckpointDir()


def own_folder(master):
    if not re.fullmatch(r"local(\[[^]]*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    return tempfile.mkdtemp(prefix="cartwise-")


def checkpointed(df):
    """Compute once and keep the rows in the shared folder.

    Iterative fits read the same customers many times; a lost executor must not send
    them back to the invoice lines.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df, name):
    """The rows written to the shared folder as compressed columns, and read back.

    For lines, of which a checkpoint would write several times as much.
    """
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def new_folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def run_together(spark, function, items, threads=5):
    """function(item) for independent fits, a few at a time: their Spark jobs overlap."""
    items = list(items)
    with ThreadPool(min(threads, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(function), items)
