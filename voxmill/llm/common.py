"""What the corpus operators share: the shared folder, table reading, small expressions."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

# Fixed value: the white space of the contracts, [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the session has none and runs in one process (as in tests) is one made; on a cluster that is an error.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or f"file://{tempfile.mkdtemp(prefix='voxmill-')}")
    return sc.getCheckpointDir()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again.

    It cuts the lineage: a lost executor costs later stages nothing but a new read. The table is deleted when
    the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def without_space(text: Column) -> Column:
    """``text`` less every character of ``SPACE``."""
    for ch in SPACE:
        text = F.replace(text, F.lit(ch), F.lit(""))
    return text


def pick(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that extra columns of any name can't clash."""
    return docs.select(*[docs[f"`{n}`"] for n in names])


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number of its own for each row, and the name of that column; a decision about rows is joined back by it.

    Where ids are whole numbers and none is null or repeats, the number is the id; else the rows are stored once with numbers.
    """
    name = "_row"
    while name in [c.lower() for c in docs.columns]:
        name += "_"
    ids = docs.select(docs["`doc_id`"].alias("id"))
    if isinstance(ids.schema["id"].dataType, IntegralType) and not ids.groupBy("id").count().where("count > 1 OR id IS NULL").limit(1).count():
        return docs.withColumn(name, docs["`doc_id`"].cast("long")), name
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def ranges_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 500, size: int = 4 << 20) -> None:
    """Arrow batches of whole texts stay small: about ``size`` bytes and at most ``rows`` rows each.

    The bounds hold for the session's Python stages, unless it has bounds of its own.
    """
    for key, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        name = f"spark.sql.execution.arrow.{key}"
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, str(most))


def boosted(train: DataFrame, rounds: int = 20, depth: int = 3, weight: str | None = None):
    """Gradient-boosted trees on ``features`` (a vector) and ``label``, rows counting as the column ``weight`` says; None unless both labels occur."""
    from pyspark.ml.classification import GBTClassifier

    if train.select("label").distinct().count() < 2:
        return None
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=7, maxBins=32, minInstancesPerNode=3)
    return (trees.setWeightCol(weight) if weight else trees).fit(train)
