"""Session set-up, the shared folder, local tables and joins on hot keys."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

_local_folders: dict[str, str] = {}


def build_session(app: str = "nightglass", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench. On a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only a local session may fall back to a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="nightglass-")
    return _local_folders[app]


def run_folder(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the shared folder for one run."""
    return f"{shared_folder(spark)}/nightglass/{name}-{uuid.uuid4().hex}"


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of driver rows. Sent as Arrow it is a local relation whose size Spark knows."""
    names = [f.name for f in _parsed(schema).fields]
    if not rows:
        return spark.createDataFrame([], _parsed(schema))
    columns = {n: [r[i] for r in rows] for i, n in enumerate(names)}
    return spark.createDataFrame(pa.table(columns, schema=to_arrow_schema(_parsed(schema))), _parsed(schema))


@lru_cache(maxsize=None)
def _parsed(schema: str) -> StructType:
    return StructType.fromDDL(schema)


def salted_join(big: DataFrame, side: DataFrame, keys: list[str], how: str, spread: list[str], salts: int = 1) -> DataFrame:
    """Equi-join of `big` with `side`; inner, left, left_semi or left_anti.

    As it stands Spark plans it, and adaptive execution splits skewed partitions. A caller who knows that keys are hot beyond
    that asks for `salts`: rows of a key are spread over so many tasks by the `spread` columns, and the side is
    repeated as often. No job runs to find out.
    """
    if salts <= 1:
        return big.join(side, keys, how)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    copies = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def spread_out(df: DataFrame) -> DataFrame:
    """Rows dealt over the cores if the input is a single split; more than one split's bytes are never shuffled."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if df.rdd.getNumPartitions() == 1 else df
