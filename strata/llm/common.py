"""Helpers that the training-data operators share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import checkpoint_dir

# Rows handed to Python at once. Texts can be long, so far fewer than Spark's
# default of 10,000; the memory of a Python worker follows from it.
ARROW_ROWS = 512


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """The columns ``out_name=source_name`` of ``df``, found by exact name.

    Other columns cannot clash: they are dropped by position, also those that
    differ from a wanted one only in case."""
    place = {}
    for i, name in enumerate(df.columns):
        place.setdefault(name, i)
    missing = [s for s in wanted.values() if s not in place]
    if missing:
        raise ValueError(f"columns {missing} not found in {df.columns}")
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"c{place[s]}").alias(out) for out, s in wanted.items()])


def python_ready(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Let tasks import this package, and hand Python at most ``rows`` rows at
    once unless the session has a smaller limit."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))
    context = spark.sparkContext
    if getattr(context, "_strata_sent", False):
        return
    package = Path(__file__).resolve().parent.parent
    if package.is_dir():  # else it is imported from an archive that Spark has already
        archive = os.path.join(tempfile.mkdtemp(prefix="strata-code-"), f"{package.name}.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for f in sorted(package.rglob("*.py")):
                out.write(f, f.relative_to(package.parent))
        context.addPyFile(archive)  # served by the driver
    context._strata_sent = True


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/strata-llm/{label}-{uuid.uuid4().hex}"


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut of the
    lineage that survives the loss of any executor."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``keep`` wrote and nothing reads now."""
    spark = df.sparkSession
    mine = f"{checkpoint_dir(spark).rstrip('/')}/strata-llm/".split(":", 1)[-1].lstrip("/")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if mine in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def uri_of(spark: SparkSession, path: str) -> str:
    """``path`` as a URI that pyarrow's file systems understand."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(jpath).toString()
    return "file://" + full[len("file:"):] if full.startswith("file:/") and not full.startswith("file://") else full


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def by_size(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs ``[a, b)`` of consecutive rows whose sizes add up to ``most`` at
    most; a larger row is a run of its own."""
    a, total = 0, 0
    for b, size in enumerate(np.asarray(sizes).tolist()):
        if b > a and total + size > most:
            yield a, b
            a, total = b, 0
        total += size
    if len(sizes):
        yield a, len(sizes)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
