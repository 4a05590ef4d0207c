"""Session settings, input tables and per-run working folders."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str | None = None, app: str = "millrace", **conf) -> SparkSession:
    """A session with the settings every job here relies on.

    On a cluster leave ``master`` unset and size ``spark.sql.shuffle.partitions``
    to the data; AQE coalesces what turns out too small and splits skewed
    join partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Where ``spark.checkpoint.dir`` is unset, a folder in the session's
    warehouse, which all executors reach as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/millrace-scratch"


class Workspace:
    """A new folder, and on demand a new database, for the files of one run."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.id = uuid.uuid4().hex[:12]
        self.root = f"{shared_folder(spark)}/run-{self.id}"
        self._database: str | None = None
        self._kept = 0
        self._paths: dict[str, list[str]] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str, **options) -> DataFrame:
        """``df`` as a written table: computed once, and safe when executors are lost; ``options`` are the writer's."""
        self._kept += 1
        path = self.path(f"{name}-{self._kept}")
        df.write.options(**options).parquet(path)
        self._paths.setdefault(name, []).append(path)
        return self.spark.read.parquet(path)

    def drop(self, *names: str) -> None:
        """Remove kept tables by the names they were kept under; only for tables that nothing reads any more."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            for path in self._paths.pop(name, []):
                folder = jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(conf).delete(folder, True)

    @property
    def database(self) -> str:
        """A database located in the workspace, so managed tables land on shared storage."""
        if self._database is None:
            name = f"millrace_{self.id}"
            self.spark.sql(f"CREATE DATABASE {name} LOCATION '{self.path('db')}'")
            self._database = name
        return self._database

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"


class Tables:
    """The parquet tables of one data folder, read on attribute access."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def view(self, name: str) -> str:
        """Register a table as a temporary view and return the view's name."""
        getattr(self, name).createOrReplaceTempView(f"millrace_{name}")
        return f"millrace_{name}"

    def workspace(self) -> Workspace:
        return Workspace(self.spark)
