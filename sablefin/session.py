"""Session construction and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "sablefin", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # the JVM does not compile methods over 8,000 bytes: wide rows are better off in separate operators
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.codegen.maxFields", "30")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers: once a context, as a zip that Spark hands out.

    Skipped where workers are known to inherit a path that has it.
    """
    sc, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(sc, "_sablefin_shipped", False):
        return
    sc._sablefin_shipped = True
    inherited = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if sc.master.startswith("local") and (str(root) in inherited or Path.cwd() == root):
        return
    archive = Path(tempfile.mkdtemp(prefix="sablefin-")) / "sablefin.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted((root / "sablefin").rglob("*.py")):
            z.write(f, f.relative_to(root))
    sc.addPyFile(str(archive))


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only in local mode, where driver and executors are one process, a temporary one is made if none is named; it is recorded
    in the context, so that later calls find it. A cluster without one is an error: a machine's own folder would be lost with it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="sablefin-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def settled_paths(spark: SparkSession) -> list[str]:
    """Paths that ``settled_path`` gave out in this context and that aren't forgotten, oldest first."""
    sc = spark.sparkContext
    if not hasattr(sc, "_sablefin_settled"):
        sc._sablefin_settled = []
    return sc._sablefin_settled


def settled_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{scratch_dir(spark)}/settled/{name}-{uuid.uuid4().hex}"
    settled_paths(spark).append(path)
    return path


def settled_under(df: DataFrame) -> list[str]:
    """Paths of the settled tables whose files ``df`` reads."""
    files = df.inputFiles()
    return [p for p in settled_paths(df.sparkSession) if any(f"{p.split(':', 1)[-1]}/" in f for f in files)]


def forget(spark: SparkSession, paths: list[str]) -> None:
    """Delete settled tables that no plan reads any more; other paths are refused."""
    known = settled_paths(spark)
    for path in paths:
        known.remove(path)
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    It cuts the lineage durably (a lost executor costs no recomputation of what came before),
    stores columns compressed, and gives later joins real sizes to plan with. Texts can be among the
    columns, hence the denser codec.
    """
    spark = df.sparkSession
    ship(spark)
    path = settled_path(spark, name)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of input files to a partition of ``spread``.
PART = 4 << 20


def pieces(df: DataFrame, part: int = PART) -> int:
    """As many partitions as the input files of ``df`` have ``part`` bytes; 0 if the session's number will do. Only sizes of files are looked at."""
    spark = df.sparkSession
    conf, paths = spark._jsc.hadoopConfiguration(), [spark._jvm.org.apache.hadoop.fs.Path(f) for f in df.inputFiles()]
    n = sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths) // part
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else 0


def spread(df: DataFrame, *keys: str, part: int = PART) -> DataFrame:
    """``df`` by ``keys``, in as many partitions as its input files have ``part`` bytes, the session's number at least.

    So what a task sorts and holds doesn't grow with the input.
    """
    n = pieces(df, part)
    return df.repartition(n, *keys) if n else df.repartition(*keys)
