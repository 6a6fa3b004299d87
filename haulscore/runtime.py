"""How operators join small tables and cut lineage on a cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when its rows, written as JSON text, are measured to stay below this size.
BROADCAST_BYTES = 64 * 1024 * 1024
# Copies of a lookup side, and slices of each hot key, once it is too large to broadcast.
SALTS = 16
# Bytes of the look-ups that this process has measured, by application, plan and size of the files behind it.
_MEASURED: dict[tuple[str, int, str, str], int] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared scratch folder. Only a local session may fall back on a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="haulscore-"))
    return spark.sparkContext.getCheckpointDir()


def settle(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and go on from the written table.

    Later reads prune columns and rows, and a lost executor costs a re-read, not a re-run.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/haulscore/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def write_observed(frame: DataFrame, write: Callable[[DataFrame], None], **measures: Column) -> dict[str, object]:
    """Write a frame and give aggregates of its rows, measured in the tasks that write them: no second scan.

    ``write`` runs one action on the frame it is given.
    """
    seen = Observation()
    write(frame.observe(seen, *[measure.alias(name) for name, measure in measures.items()]))
    return seen.get


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a written folder another name in the same file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(path(target)):
        raise FileExistsError(target)
    if not files.rename(path(source), path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_settled(spark: SparkSession) -> None:
    """Delete the tables that this application has settled. Call it when none of their readers is needed any more."""
    remove(spark, f"{shared_folder(spark).rstrip('/')}/haulscore/{spark.sparkContext.applicationId}")


def fits_broadcast(frame: DataFrame, max_bytes: int | None = None) -> bool:
    """Measure a frame with one distributed aggregate. Give it scans or settled frames, not long plans.

    A session measures the same look-up once; a plan of another text, or over files of another size, is another look-up.
    """
    limit = BROADCAST_BYTES if max_bytes is None else max_bytes
    plans = frame._jdf.queryExecution()
    size = str(plans.optimizedPlan().stats().sizeInBytes())
    key = (frame.sparkSession.sparkContext.applicationId, frame.semanticHash(), plans.analyzed().canonicalized().toString(), size)
    if key not in _MEASURED:
        _MEASURED[key] = frame.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes")).first()["bytes"] or 0
    return _MEASURED[key] <= limit


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    max_bytes: int | None = None,
) -> DataFrame:
    """Join a large frame to a lookup table on equally named columns (``inner`` or ``left``).

    A lookup measured as small is broadcast: the fact rows stay where they are, so a hot key does no harm.
    A larger one is shuffled with the fact's keys salted, so that a hot key spreads over SALTS tasks. Its copies are never broadcast:
    Spark would judge them by the compressed files behind one of them, and gather all on the driver.
    """
    keys = {key: f"_key_{i}" for i, key in enumerate(on)}
    right = lookup.withColumnsRenamed(keys)
    temporary = list(keys.values())
    condition = None
    for key, renamed in keys.items():
        equal = F.col(key).eqNullSafe(F.col(renamed)) if null_safe else F.col(key) == F.col(renamed)
        condition = equal if condition is None else condition & equal
    if fits_broadcast(lookup, max_bytes):
        right = F.broadcast(right)
    else:
        fact = fact.withColumn("_salt", F.pmod(F.xxhash64(*fact.columns), F.lit(SALTS)).cast("int"))
        right = right.withColumn("_salt_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
        condition = condition & (F.col("_salt") == F.col("_salt_copy"))
        temporary += ["_salt", "_salt_copy"]
    return fact.join(right, condition, how).drop(*temporary)
