"""Registry of example queries and the frames they start from."""

from __future__ import annotations

import atexit
import functools
import hashlib
import shutil
import tempfile
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gallery.standins import RAW, TABLES
from sparkmart.plans import entities, spec
from sparkmart.sources.tables import freed, staging_folder


@dataclass(frozen=True)
class Example:
    name: str
    covers: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


EXAMPLES: dict[str, Example] = {}


def example(covers: str, sql: str | None = None, name: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under its name, with the SQL that must agree."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        label = name or fn.__name__
        if label in EXAMPLES:
            raise ValueError(f"{label} is registered twice")
        EXAMPLES[label] = Example(label, covers, lambda spark, folder: fn(Tables(spark, folder)), sql)
        return fn

    return register


_WRITTEN: set[str] = set()


@functools.cache
def _process_folder() -> str:
    folder = tempfile.mkdtemp(prefix="sparkmart-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch(spark: SparkSession) -> str:
    """Where written tables go: the shared folder the session names, or, in one local process, a folder of that process."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return staging_folder(spark, "")
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _process_folder()


def files_state(spark: SparkSession, folder: str) -> str:
    """A digest of the names, sizes and times of a folder's table files, from its listing; no job is run."""
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(top, True)
    found = []
    while files.hasNext():
        file = files.next()
        path = file.getPath().toString()
        if path.endswith(".parquet"):
            found.append(f"{path}|{file.getLen()}|{file.getModificationTime()}")
    return hashlib.md5(";".join(sorted(found)).encode()).hexdigest()


class Tables:
    """The test tables of one folder, the raw entities derived from them, and their cleansed rows."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def derive(self, entity: str) -> DataFrame:
        """A raw entity computed from its test tables."""
        text = RAW[entity]
        used = {t: self.table(t) for t in TABLES if f"{{{t}}}" in text}
        return self.spark.sql(text, **used)

    def raw(self, entity: str) -> DataFrame:
        """A raw entity as the raw layer holds it: text columns, of which a query derives those that it reads and writes none."""
        return self.derive(entity)

    def clean(self, entity: str) -> DataFrame:
        return spec.normalise(self.raw(entity), entities.ENTITIES[entity])

    def cleansed(self, entity: str) -> DataFrame:
        return spec.admit(self.clean(entity), entities.ENTITIES[entity])

    def counted(self, entity: str, packed: Sequence[str] = ()) -> DataFrame:
        """The cleansed rows, keys counted first: a row that is alone with its key is neither ranked nor shuffled."""
        clean, described = self.clean(entity), entities.ENTITIES[entity]
        return spec.admit(clean, described, spec.repeated(clean, described, packed), packed=packed)

    def dealt(self, entity: str, by: str, hot: Mapping, packed: Sequence[str] = ()) -> DataFrame:
        """The cleansed rows, ranked where their packed id ``by`` sends them, for a join on it; ranked by their whole key if an id is heavy.

        The other ids of ``packed`` are moved packed too; where an id is heavy they stay text, as ranking sorts by their text.
        """
        if hot:
            return spec.admit(self.clean(entity), entities.ENTITIES[entity], packed=(by,))
        return spec.admit(self.clean(entity), entities.ENTITIES[entity], within=(by,), packed=(by, *packed))

    @functools.cached_property
    def state(self) -> str:
        """Which files there were when this object first wrote or read a derived table."""
        return files_state(self.spark, self.folder)

    def place(self, name: str) -> str:
        """Where this session keeps a written table derived from these files; other files, another place."""
        context = self.spark.sparkContext.applicationId
        source = hashlib.md5(f"{self.folder}|{self.state}".encode()).hexdigest()[:12]
        return f"{scratch(self.spark)}/sparkmart-{context}-{source}/{name}"

    def once(self, name: str, write: Callable[[str], None]) -> str:
        """Let ``write`` fill a folder the first time it is asked for; returns the folder. What it shuffles is freed as each step ends."""
        path = self.place(name)
        if path not in _WRITTEN:
            with freed(self.spark):
                write(path)
            _WRITTEN.add(path)
        return path

    def published(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table as the warehouse publishes it: written once per session and state of the files, then read.

        Facts read dimensions and reports read facts, so neither is built again for every query. A written table also survives lost
        executors.
        """
        path = self.once(f"table_{name}", lambda folder: build().write.mode("overwrite").option("compression", "zstd").parquet(folder))
        return self.spark.read.parquet(path)

    def published_entity(self, entity: str) -> DataFrame:
        return self.published(f"cleansed_{entity}", lambda: self.cleansed(entity))
