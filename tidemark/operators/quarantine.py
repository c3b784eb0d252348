"""Rejected rows as a ledger: why, since which batch, and whether they have been taken back.

A row is screened by rules and by references to parent keys. What fails goes into the ledger with its
content, so nothing is lost unseen. Every later batch screens the open rows again: one whose parent has
arrived, or whose day has come, is replayed once and marked with the batch that took it.

After every batch: rows accepted + rows open in the ledger = rows received.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.context import RunContext

LEDGER = (
    "fingerprint string, batch_id string, reasons array<string>, copies bigint, day date, payload string, "
    "status string, resolved_batch string"
)
OPEN, REPLAYED = "open", "replayed"
UNREADABLE = "unreadable"


@dataclass(frozen=True)
class Parent:
    """The key of a row must be among the keys of a parent table."""

    reason: str
    key: str
    table: DataFrame
    parent_key: str


def screened(df: DataFrame, rules: Mapping[str, Column], parents: Sequence[Parent] = ()) -> DataFrame:
    """``df`` with ``reject_reasons``: the rules and references that a row breaks, empty for good rows.

    A rule that evaluates to NULL counts as broken, a NULL key has no parent.
    """
    reasons = [F.when(F.coalesce(ok, F.lit(False)), None).otherwise(F.lit(name)) for name, ok in rules.items()]
    out = df
    for i, parent in enumerate(parents):
        known = parent.table.select(F.col(parent.parent_key).cast("string").alias(f"_key{i}")).distinct()
        known = known.withColumn(f"_known{i}", F.lit(True))
        out = out.join(known, F.col(parent.key).cast("string") == F.col(f"_key{i}"), "left")
        reasons.append(F.when(F.col(f"_known{i}").isNull(), F.lit(parent.reason)))
    broken = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return out.withColumn("reject_reasons", broken).select(*df.columns, "reject_reasons")


def rejects(
    rows: DataFrame, content: Sequence[str], run: RunContext, day: Column | None = None
) -> DataFrame:
    """Open ledger rows of a screened batch. Equal rows share one entry with their number.

    ``content`` names the columns that tell rows apart; the payload holds all columns.
    """
    columns = [c for c in rows.columns if c != "reject_reasons"]
    told = F.to_json(F.struct(*sorted(content)), {"ignoreNullFields": "false"})
    entry = rows.filter(F.size("reject_reasons") > 0).select(
        F.sha2(told, 256).alias("fingerprint"), F.col("reject_reasons").alias("reasons"),
        (F.lit(None).cast("date") if day is None else day).alias("day"),
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("payload"),
    )
    return entry.groupBy("fingerprint", "reasons", "day").agg(
        F.count("*").alias("copies"), F.min("payload").alias("payload")
    ).select(
        "fingerprint", F.lit(run.batch_id).alias("batch_id"), "reasons", "copies", "day", "payload",
        F.lit(OPEN).alias("status"), F.lit(None).cast("string").alias("resolved_batch"),
    )


def unreadable(damaged: DataFrame, line: str, run: RunContext) -> DataFrame:
    """Open ledger rows of lines that could not be read; the payload has the line itself."""
    marked = damaged.withColumn("reject_reasons", F.array(F.lit(UNREADABLE)))
    return rejects(marked, [line, *[c for c in damaged.columns if not c.startswith("_")]], run)


def restored(entries: DataFrame, schema) -> DataFrame:
    """The rows of ledger entries as they were received, repeated rows repeated."""
    again = entries.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    return again.select(F.from_json("payload", schema).alias("_r")).select("_r.*")


def settled(
    ledger: DataFrame, schema, rules: Mapping[str, Column], parents: Sequence[Parent], run: RunContext
) -> DataFrame:
    """The ledger with its open rows screened again; those that pass now are marked as replayed.

    An open row that still fails keeps its batch and gets its present reasons. Unreadable lines wait
    for a corrected delivery.
    """
    is_open = (F.col("status") == OPEN) & ~F.array_contains("reasons", UNREADABLE)
    waiting = ledger.filter(is_open).select(
        F.struct(*ledger.columns).alias("_entry"), F.from_json("payload", schema).alias("_r")
    )
    again = screened(waiting.select("_entry", "_r.*"), rules, parents).select("_entry.*", "reject_reasons")
    good = F.size("reject_reasons") == 0
    return ledger.filter(~is_open).unionByName(
        again.select(
            "fingerprint", "batch_id", F.when(good, F.col("reasons")).otherwise(F.col("reject_reasons")).alias("reasons"),
            "copies", "day", "payload", F.when(good, REPLAYED).otherwise(OPEN).alias("status"),
            F.when(good, run.batch_id).alias("resolved_batch"),
        )
    )


def replayed(ledger: DataFrame, batch_id: str) -> DataFrame:
    """Entries that a batch has taken back."""
    return ledger.filter((F.col("status") == REPLAYED) & (F.col("resolved_batch") == batch_id))


def account(ledger: DataFrame, received: DataFrame, accepted: DataFrame) -> DataFrame:
    """One row: received, accepted, open, replayed, and whether the three agree."""
    one = F.lit(1).cast("bigint").alias("copies")
    sides = (
        received.select(F.lit("received").alias("side"), one)
        .unionByName(accepted.select(F.lit("accepted").alias("side"), one))
        .unionByName(ledger.select(F.col("status").alias("side"), "copies"))
    )
    sums = {"received": "received", "accepted": "accepted", "open_rejects": OPEN, "replayed": REPLAYED}
    counted = sides.agg(
        *[F.coalesce(F.sum(F.when(F.col("side") == side, F.col("copies"))), F.lit(0)).alias(n) for n, side in sums.items()]
    )
    return counted.withColumn("complete", F.col("received") == F.col("accepted") + F.col("open_rejects"))
