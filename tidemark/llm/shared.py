"""Small helpers that several operators of this subpackage use."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words, as a regular expression.
SPACES = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder that the session names; on a local master a temporary one where none is set, as in tests.

    Executors on other machines wouldn't see a temporary folder: on a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-checkpoint-"))
    return context.getCheckpointDir()


def cut(frame: DataFrame) -> DataFrame:
    """The frame, written as a table below the shared checkpoint folder and read from there.

    Unlike a checkpoint of the plan, a table starts a plan of its own: in loops, what the
    optimizer derives from earlier rounds doesn't pile up.
    """
    folder = f"{shared_dir(frame.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each context, so that their functions can import it."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tidemark-code-")) / "tidemark_code.zip"
    with zipfile.ZipFile(archive, "w") as made:
        for file in sorted(top.rglob("*.py")):
            made.write(file, file.relative_to(top.parent))
    context.addPyFile(str(archive))
    context._tidemark_shipped = True


def words(text: Column) -> Column:
    """Words of a text as an array; none for a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
