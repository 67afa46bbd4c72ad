"""Shared helpers of the training-data operators.

Words are maximal runs of anything but ASCII white space, which is exactly
what ``bytes.split()`` gives on UTF-8, so texts travel to Python as bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.sources.tables import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
# Stands for "no id" where ids are compared: it is larger than any id.
NO_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FILES_A_CORE = 4


def written(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, lineage
    cut, and readable after the loss of any executor.

    ``narrow``: a few numbers a row and little work for each.  Such a table
    gets a few files for each core of the cluster, not one for each shuffle
    partition (adaptive execution may be told not to join partitions): every
    file of a local folder costs the executor two short processes."""
    path = scratch_path(df.sparkSession, name)
    if narrow:
        df = df.coalesce(FILES_A_CORE * df.sparkSession.sparkContext.defaultParallelism)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column(name: str) -> Column:
    """The column of that name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame) -> Column:
    """All columns as one struct ``row``: operators that hand rows through
    work beside it, so no column of the input can clash with theirs."""
    return F.struct(*[column(c) for c in df.columns]).alias("row")


_SPACE = re.compile(rb"[ \t-\r]")
BLOCK = 1 << 20  # bytes of a text taken apart at a time


def word_blocks(text: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a text, those of about ``size`` bytes at a time: a very
    long text never becomes one list."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            space = _SPACE.search(text, end)
            end = space.start() if space else len(text)
        if words := text[at:end].split():
            yield words
        at = end


def utf8(values: pa.Array) -> Iterator[bytes]:
    """Texts as bytes, null as empty."""
    for value in values.cast(pa.binary()):
        yield value.as_py() or b""
