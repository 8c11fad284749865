"""Session, table access and durable intermediate tables."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_HERE = os.path.dirname(os.path.abspath(__file__))
_own_scratch: str | None = None


def build_session(app: str = "kinesift", master: str | None = None, cores: int = 8) -> SparkSession:
    """A session with the settings the operators are tuned for. Without ``master`` the submitter's one holds."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master).config("spark.sql.shuffle.partitions", str(cores)).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    # workers on this machine find the package wherever the driver was started; on a cluster install it, or call ``ship``
    os.environ["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([os.path.dirname(_HERE), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]))
    return (
        b.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Sends this package to the workers of a cluster where it isn't installed. Once a session."""
    folder = tempfile.mkdtemp(prefix="kinesift-code-")  # Spark serves the file to executors from here
    atexit.register(shutil.rmtree, folder, True)
    with zipfile.ZipFile(f"{folder}/kinesift.zip", "w") as z:
        for at, _, names in os.walk(_HERE):
            for n in (n for n in names if n.endswith(".py")):
                z.write(os.path.join(at, n), os.path.join("kinesift", os.path.relpath(os.path.join(at, n), _HERE)))
    spark.sparkContext.addPyFile(f"{folder}/kinesift.zip")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only where that is unset (tests, a laptop) a folder of this process is made and removed at exit.
    """
    global _own_scratch
    if there := spark.conf.get("spark.checkpoint.dir", None):
        return there.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*])?", spark.sparkContext.master):  # local-cluster[...] has several machines' worth of executors
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_scratch is None:
        _own_scratch = tempfile.mkdtemp(prefix="kinesift-")
        atexit.register(shutil.rmtree, _own_scratch, True)
    return f"file://{_own_scratch}"


_run = f"kinesift-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Removes all intermediate tables of this process from the shared folder. Results that weren't read yet are lost."""
    _delete(spark, f"{scratch_dir(spark)}/{_run}")


class Durable:
    """Intermediate tables of one operator run, written as Parquet into the shared folder.

    Writing cuts the lineage, so neither a lost executor nor a second reader makes the work run again.
    ``keep`` writes a table; ``drop`` removes one that a later round replaced; what results still read stays until
    ``release``, which also runs where the process ends with its session open.
    """

    _watched: set[int] = set()

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{scratch_dir(spark)}/{_run}/{uuid.uuid4().hex}"
        self.n = 0
        if id(spark) not in self._watched:
            self._watched.add(id(spark))
            atexit.register(self._last, spark)

    @staticmethod
    def _last(spark: SparkSession) -> None:
        try:
            if spark.sparkContext._jsc is not None:
                release(spark)
        except Exception:  # noqa: BLE001 - the session is gone, and with it the way to its storage
            pass

    def keep(self, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:04d}"
        w = df.write
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._kinesift_path = path  # type: ignore[attr-defined]
        return out

    def drop(self, df: DataFrame | None) -> None:
        if path := getattr(df, "_kinesift_path", None):
            _delete(self.spark, path)
