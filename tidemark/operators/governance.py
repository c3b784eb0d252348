"""Masking, policy views and lineage traces."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import masking


@dataclass(frozen=True)
class Mask:
    """How one column is shown: ``hash``, ``pseudonym``, ``partial`` or ``drop``."""

    rule: str
    salt: str = ""
    prefix: str = "P"
    visible: int = 4


def mask(df: DataFrame, policy: Mapping[str, Mask]) -> DataFrame:
    """Apply the policy; columns it does not name are kept as they are."""
    out = []
    for column in df.columns:
        m = policy.get(column)
        if m is None:
            out.append(F.col(column))
        elif m.rule == "hash":
            out.append(masking.salted_hash(F.col(column), m.salt).alias(column))
        elif m.rule == "pseudonym":
            out.append(masking.pseudonym(F.col(column), m.salt, m.prefix).alias(column))
        elif m.rule == "partial":
            out.append(masking.keep_tail(F.col(column), m.visible).alias(column))
        elif m.rule != "drop":
            raise ValueError(f"unknown masking rule {m.rule!r} for {column}")
    return df.select(*out)


@dataclass(frozen=True)
class RolePolicy:
    """What a role sees: columns (None: all), a row condition, and masks."""

    columns: Sequence[str] | None = None
    row_filter: str | None = None
    masks: Mapping[str, Mask] | None = None


def policy_view(df: DataFrame, role: RolePolicy) -> DataFrame:
    """Row filter first, then columns, then masks. Who may use the view is the catalog's job."""
    out = df.filter(role.row_filter) if role.row_filter else df
    out = out.select(*role.columns) if role.columns else out
    return mask(out, role.masks) if role.masks else out


def forbidden_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Columns that must not exist in a product but do."""
    present = {c.lower() for c in df.columns}
    return [n for n in names if n.lower() in present]


@dataclass(frozen=True)
class Hop:
    """One step towards the source: table name, table, key there, and columns to carry."""

    name: str
    table: DataFrame
    key: str
    carry: Sequence[str] = ()


def trace(start: DataFrame, key: str, chain: Sequence[Hop]) -> DataFrame:
    """``start`` rows with, per hop, whether the key was found and the carried columns.

    Each hop is reduced to one row per key, so the trace never multiplies rows. A NULL
    ``<hop>_found`` cannot occur; a broken chain shows as 0.
    """
    out = start
    for hop in chain:
        carried = [F.max(c).alias(c) for c in hop.carry]
        found = hop.table.groupBy(F.col(hop.key).alias(key)).agg(
            F.count("*").alias(f"{hop.name}_rows"), *carried
        )
        out = (
            out.join(found, key, "left")
            .withColumn(f"{hop.name}_found", F.when(F.col(f"{hop.name}_rows") > 0, 1).otherwise(0))
            .drop(f"{hop.name}_rows")
        )
    return out


def batch_dictionary(df: DataFrame, batch: str = "_batch_id") -> DataFrame:
    """(bucket, names): the batches of a table in order, so many names a bucket as a bitmap has bits.

    The list of batches is numbered in one task; it has a row per load, not per row.
    """
    numbered = df.select(F.col(batch).alias("name")).dropna().distinct().withColumn(
        "number", F.row_number().over(Window.orderBy("name"))
    )
    named = numbered.withColumn("bucket", F.expr("bitmap_bucket_number(number)"))
    return named.groupBy("bucket").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("number", "name"))), lambda x: x["name"]
        ).alias("names")
    )


def numbered_batches(df: DataFrame, dictionary: DataFrame, batch: str = "_batch_id") -> DataFrame:
    """``df`` with ``_bucket`` and ``_bit``, the place of its batch in the dictionary."""
    places = dictionary.select("bucket", F.posexplode("names").alias("bit", "name")).select(
        F.col("bucket").alias("_bucket"), F.col("bit").cast("bigint").alias("_bit"), F.col("name").alias(batch)
    )
    return df.join(places, batch, "left")


def batches_of() -> Column:
    """Aggregate of ``_bit`` per group and ``_bucket``: the batches that took part, one bit each."""
    return F.bitmap_construct_agg("_bit").alias("_batches")


def merged_batches(column: str = "_batches") -> Column:
    """Aggregate of bitmaps of one bucket, for products made from products."""
    return F.bitmap_or_agg(column).alias("_batches")


def batch_names(df: DataFrame, dictionary: DataFrame, column: str = "_batches") -> DataFrame:
    """``df`` with ``batch_ids``: the names behind each row's bitmap; the bitmap columns go."""
    byte = lambda i: F.conv(F.hex(F.substring(F.col(column), i.cast("int"), F.lit(1))), 16, 10).cast("int")

    def is_set(bit: Column) -> Column:
        mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (bit % 8 + 1).cast("int"))
        return F.coalesce(byte(F.floor(bit / 8) + 1).bitwiseAND(mask) > 0, F.lit(False))

    joined = df.join(dictionary, F.col("_bucket") == F.col("bucket"), "left")
    bits = F.sequence(F.lit(0), F.size("names") - 1)
    kept = F.filter(bits, is_set)
    names = F.transform(kept, lambda i: F.element_at("names", i + 1))
    return joined.withColumn("batch_ids", F.coalesce(names, F.array().cast("array<string>"))).drop(
        "bucket", "names", "_bucket", column
    )
