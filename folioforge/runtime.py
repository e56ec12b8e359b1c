"""Session helpers shared by every operator: table loading, the shared scratch folder, bounded broadcasts."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only below this many rows; beyond it the join is left to the optimizer (shuffle).
BROADCAST_ROWS = 100_000
#: And below this many bytes of text and fixed-size values.
BROADCAST_OCTETS = 64 << 20


def build_session(app: str = "folioforge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and a UTC clock; cluster settings come from the caller's environment."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for k, v in (defaults | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once a context; they need not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_folioforge_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="folioforge-code-")
    atexit.register(_remove_local, folder)
    target = Path(folder, "folioforge_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent).as_posix())
    sc.addPyFile(str(target))
    sc._folioforge_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`. A temporary one only in local mode, where it is unset."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = getattr(sc, "_folioforge_dir", None)
        if base is None:
            base = "file://" + tempfile.mkdtemp(prefix="folioforge-")
            sc._folioforge_dir = base
            atexit.register(_remove_local, base[len("file://"):])
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def _remove_local(path: str) -> None:
    import shutil

    shutil.rmtree(path, ignore_errors=True)


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read again, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folioforge_path = path
    return out


def release(spark: SparkSession, *done: DataFrame) -> None:
    """Delete staged tables that nothing will read again and let the driver drop the shuffle files of finished stages.

    Spark keeps shuffle files until the driver's collector finds their plans unreachable, which a short query never sees.
    """
    jvm = spark.sparkContext._jvm
    for df in done:
        path = jvm.org.apache.hadoop.fs.Path(df._folioforge_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    jvm.System.gc()


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS, octets: int = BROADCAST_OCTETS) -> DataFrame:
    """`broadcast(df)` if it has at most `limit` rows and `octets` bytes, counted, else `df` unhinted (a shuffle join follows)."""
    sizes = [F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType.typeName() in ("string", "binary") else F.lit(16) for f in df.schema]
    rows, size = df.select(*[x.cast("long").alias(f"s{i}") for i, x in enumerate(sizes)]).limit(limit + 1).agg(F.count("*"), F.sum(sum((F.col(f"s{i}") for i in range(len(sizes))), F.lit(0)))).first()
    return F.broadcast(df) if rows <= limit and (size or 0) <= octets else df
