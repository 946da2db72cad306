"""Reading the driver's parquet tables.

Each table is one parquet file/folder under an ``sf`` directory. Reads are lazy;
callers select only the columns they need so the scan's ReadSchema stays narrow
and filters are pushed into the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).customer`` is a DataFrame.

    ``memo`` holds DataFrame *definitions* (lazy plans) derived from these
    tables, so a job that needs the same derived table twice builds its plan
    once. It lives and dies with the accessor: a new one sees the files as they
    are then. No data is cached.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.memo: dict = {}

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def exists(self, name: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(self.path(name))
        fs = hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(hpath))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.read(name)
        raise AttributeError(name)
