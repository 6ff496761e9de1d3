"""Written copies of tables that are read more than once, and the folder they are in."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(session: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir. Only a local
    session may do without; a cluster needs a folder that executors share."""
    folder = session.sparkContext.getCheckpointDir() or session.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not session.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="newsloom-")
        session.sparkContext.setCheckpointDir(folder)
    return folder


def new_place(session: SparkSession, ending: str = ""):
    """A path in the shared folder that nothing else uses, the same for Hadoop, and its file system."""
    path = f"{shared_folder(session)}/newsloom-{uuid.uuid4().hex}{ending}"
    target = session.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path, target, target.getFileSystem(session.sparkContext._jsc.hadoopConfiguration())


def checkpointed(df: DataFrame) -> DataFrame:
    """Write `df` as Parquet into the shared folder and go on from the written
    copy. Cuts the lineage and survives lost executors; the copy is removed when
    it is `released`, or the application ends."""
    path, target, files = new_place(df.sparkSession)
    df.write.parquet(path)
    files.deleteOnExit(target)
    copy = df.sparkSession.read.schema(df.schema).parquet(path)
    copy._place = target, files
    return copy


def released(copy: DataFrame) -> None:
    """Remove a `checkpointed` copy that nothing will read any more, such as the last round's in a loop."""
    target, files = copy._place
    files.delete(target, True)


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """The same for the length of a block; its end removes the copy."""
    path, target, files = new_place(df.sparkSession)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        files.delete(target, True)
