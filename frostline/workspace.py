"""Where jobs may put files: one folder that every executor can reach."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_scratch: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder. A local session without one gets a scratch folder that goes when Python ends."""
    root = spark.conf.get(_SETTING, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError(f"{_SETTING} must name a shared folder on a cluster")
    if context.applicationId not in _scratch:
        _scratch[context.applicationId] = tempfile.mkdtemp(prefix="frostline-")
        atexit.register(shutil.rmtree, _scratch[context.applicationId], ignore_errors=True)
    return _scratch[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other job has used."""
    return f"{shared_root(spark)}/frostline/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made below the shared folder."""
    if "/frostline/" not in path:
        raise ValueError(f"{path} is not a work folder of this library")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def enable_checkpoints(spark: SparkSession) -> None:
    """Give long iterative fits a reliable checkpoint folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_root(spark)}/frostline/checkpoints")
