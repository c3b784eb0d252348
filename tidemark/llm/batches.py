"""Small helpers shared by the operators that work on Arrow batches of texts."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.session import work_dir

BATCH_BYTES = 16 << 20
#: The writer's option for rows in a row group.
ROW_GROUPS = "parquet.block.row.count.limit"
ROOT = str(Path(__file__).resolve().parents[2])
#: Words of the contracts: everything but space and \x09-\x0D (``bytes.split`` splits there), or
#: everything but ASCII that is no letter or digit.
BLANKS = r"[\x20\x09-\x0D]+"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Lower-cases A-Z and turns the ASCII characters of NO_WORD into spaces; others stay.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)
WORD_OF_TEXT = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and text columns alone, as ``doc_id`` and ``text``; a null text is empty."""
    bound_batches(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def bound_batches(spark) -> None:
    """Close Arrow batches at so many bytes, so that long rows never pile up in one.

    Workers also look for this package where the driver found it, in case it is not installed.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), ROOT])


def rows_of(batches: Iterator[pa.RecordBatch], size: int = 512) -> Iterator[tuple[pa.Array, list]]:
    """(ids, texts) of pieces of at most ``size`` rows, so that Python strings stay few."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            piece = batch.slice(at, size)
            yield piece.column(0), piece.column(1).to_pylist()


def kept(df: DataFrame, purpose: str, **options: int) -> DataFrame:
    """Write a table that several readers need to the shared folder and read it back.

    Rows of many megabytes need the writer's option ``ROW_GROUPS``: writer and reader hold a row group.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.options(compression="zstd", **options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.kept_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Remove tables that ``kept`` has written and that nothing will read again."""
    for table in tables:
        spark, path = table.sparkSession, table.kept_at
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
