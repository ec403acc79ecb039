"""Where the operators keep what they read twice: the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: list[str] = []
_SHIPPED: set[str] = set()


#: Rows of an Arrow batch where the session has Spark's default of 10,000: long texts make batches of tens of megabytes, which
#: the executor and its Python worker both hold, going in and coming out.
BATCH_ROWS = 2_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application; the driver serves the file. Also lowers the rows of an Arrow
    batch to BATCH_ROWS in a session that leaves them at the default."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="sparkmart-code-")) / "sparkmart.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; in a single local process, where it may be unset, a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="sparkmart-llm-"))
    return _LOCAL[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back, which cuts the lineage and survives a lost executor."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of df has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


#: Rows of one id each up to which a table of ids is sent to every task; some 60 bytes a row there.
SENT_IDS = 1_000_000


def sent_if_small(ids: DataFrame, limit: int = SENT_IDS) -> DataFrame:
    """A written table of ids, marked for broadcast if its rows are few enough; else the join is left to Spark."""
    return F.broadcast(ids) if ids.count() <= limit else ids


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
