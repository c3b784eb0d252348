"""Reading extracts, stamping lineage, writing layers and reports."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.context import RunContext
from tidemark.sources.extracts import SourceSpec


Keep = Callable[[DataFrame, str], DataFrame]


def as_is(df: DataFrame, name: str) -> DataFrame:
    """Leave a table lazy; the counterpart of writing it and reading it back."""
    return df


DAMAGED = "_damaged"


def read_source(spark: SparkSession, spec: SourceSpec, folder: str) -> DataFrame | None:
    """Read one extract with its declared schema; a missing file is reported and skipped.

    The file may be a single file or a folder of parts. Its header must name the declared columns in
    their order, else the job stops. A line with a cell that does not parse, or with too few or too
    many cells, keeps what could be read and has the whole line in ``_damaged``.
    """
    path = f"{folder.rstrip('/')}/{spec.file}"
    reader = spark.read.schema(f"{spec.schema}, {DAMAGED} STRING").option("header", True)
    try:
        return reader.option("enforceSchema", False).option("columnNameOfCorruptRecord", DAMAGED).csv(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"{spec.file} not found, skipped", stacklevel=2)
        return None


def _line(raw: DataFrame) -> Column:
    """The damaged line. Spark parses only the cells that a query asks for, and refuses to read lines for
    their damage alone; a hash, which is never below its least value, makes it read all of them."""
    cells = [F.col(f"`{c}`") for c in raw.columns if c != DAMAGED]
    return F.when(F.hash(*cells) >= -(2**31), F.col(DAMAGED))


def whole_lines(raw: DataFrame) -> DataFrame:
    """The rows of an extract whose line was read in full."""
    return raw.filter(_line(raw).isNull()).drop(DAMAGED)


def damaged_lines(raw: DataFrame) -> DataFrame:
    """The other rows, with their line."""
    return raw.filter(_line(raw).isNotNull())


def with_lineage(
    df: DataFrame, run: RunContext, source_file: str, source_system: str | None = None
) -> DataFrame:
    """Stamp batch id, load time, source file and source system.

    The system defaults to the upper-cased first word of the file name.
    """
    system = source_system or source_file.split("_")[0].upper()
    return df.withColumns(
        {
            "_batch_id": F.lit(run.batch_id),
            "_load_ts": run.loaded,
            "_source_file": F.lit(source_file),
            "_source_system": F.lit(system),
        }
    )


def ingest(
    spark: SparkSession, specs: Iterable[SourceSpec], folder: str, run: RunContext
) -> dict[str, DataFrame]:
    """Bronze tables of a domain by name, without the extracts that are missing and without damaged
    lines; ``ingest_damaged`` has those."""
    return _ingest(spark, specs, folder, run, whole_lines)


def ingest_damaged(
    spark: SparkSession, specs: Iterable[SourceSpec], folder: str, run: RunContext
) -> dict[str, DataFrame]:
    """The damaged lines of a domain's extracts by bronze table."""
    return _ingest(spark, specs, folder, run, damaged_lines)


def _ingest(spark, specs, folder: str, run: RunContext, part: Callable[[DataFrame], DataFrame]) -> dict[str, DataFrame]:
    tables = {}
    for spec in specs:
        raw = read_source(spark, spec, folder)
        if raw is not None:
            tables[spec.table] = with_lineage(part(raw), run, spec.file)
    return tables


def write_table(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    partition_by: Sequence[str] = (),
    incremental: bool = False,
) -> str:
    """Write a layer table as Parquet and return its path.

    The table is replaced as a whole. With ``incremental`` only the partitions present in
    ``df`` are replaced, which makes a daily load small and safe to repeat.
    """
    path = f"{root.rstrip('/')}/{layer}/{name}"
    writer = df.write
    if partition_by:
        # Rebalancing puts a partition value's rows together but splits an oversized one.
        writer = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
        mode = "dynamic" if incremental else "static"
        writer = writer.option("partitionOverwriteMode", mode)
    writer.mode("overwrite").parquet(path)
    return path


def publish_view(df: DataFrame, name: str) -> None:
    """Make a table available to SQL callers."""
    df.createOrReplaceTempView(name)


def write_json(df: DataFrame, path: str) -> None:
    """Write report rows (scorecards, model cards, audit rows) as JSON lines."""
    df.write.mode("overwrite").json(path)


def table_stats(
    df: DataFrame, name: str, conditions: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row: table name, row count and one conditional count per entry, in a single pass."""
    extra = [F.count_if(c).alias(n) for n, c in (conditions or {}).items()]
    return df.agg(F.count("*").alias("row_count"), *extra).select(
        F.lit(name).alias("table_name"), "row_count", *(conditions or {})
    )


def schema_snapshot(df: DataFrame, table: str, run: RunContext) -> DataFrame:
    """(table_name, batch_id, position, column_name, data_type, is_nullable, filled_rows): the
    schema of a batch as data, with the number of rows that have a value, in one pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(run.batch_id).alias("batch_id"),
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.nullable).alias("is_nullable"),
            F.col(f"n{i}").alias("filled_rows"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def schema_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns added, removed or retyped between two snapshots."""
    old = before.select(
        "column_name", F.col("data_type").alias("old_type"), F.col("filled_rows").alias("old_rows")
    )
    new = after.select(
        "column_name", F.col("data_type").alias("new_type"), F.col("filled_rows").alias("new_rows")
    )
    return (
        old.join(new, "column_name", "full")
        .withColumn(
            "change",
            F.when(F.col("old_type").isNull(), "added")
            .when(F.col("new_type").isNull(), "removed")
            .when(F.col("old_type") != F.col("new_type"), "retyped"),
        )
        .filter("change IS NOT NULL")
    )
