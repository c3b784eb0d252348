"""SimHash near-duplicates through covering locality-sensitive hashing.

A fingerprint has 64 bits; texts are linked where four or fewer bits differ. Every bit position i is
given a vector m(i) of five bits that is not zero, and every v of the 31 such vectors gives a table
whose mask holds the bits with <m(i), v> = 1. Bits that differ put at most four linear conditions
on v, so some table's mask leaves all of them out: a pair within the radius is sure to collide there.

Every mask holds at least 32 bits. A bucket of one table is compared in one task as long as it has
at most 2^16 fingerprints; the members of a larger one are dealt again by 31 masks made the same way
over the bits that are still free. After that at most 16 bits are free, so no bucket can hold more
than 2^16 fingerprints: the bound needs no cap and loses no pair. Within a bucket, members are
gathered around the first of their component, so links grow with the members, not with the pairs.

Copies share a fingerprint and are one node. Texts without words have fingerprint zero and are
linked like any other; null texts are empty; a null id never names a component; repeated rows give
repeated result rows; an empty table an empty result.

Joins are merges, by hint: Spark sizes written tables by their compressed files and exploded ones by what
was exploded, so of a million rows it would broadcast many times its limit through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.batches import kept, rows_of, texts_of
from tidemark.llm.graph import components

SHINGLE = 4
RADIUS = 4
SEED = 42
BUCKET = 1 << 16
ALL_BITS = (1 << 64) - 1


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bit i is set where over half of the shingles' hashes have it."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), parts), "<u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; the 64 bits are in a signed bigint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches):
            found = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, fp bigint")


def covering_masks(positions: list[int], radius: int = RADIUS) -> list[int]:
    """One mask over the given bit positions for every vector of radius + 1 bits but zero."""
    top = (1 << (radius + 1)) - 1
    vector = {p: i % top + 1 for i, p in enumerate(positions)}
    return [
        sum(1 << p for p, m in vector.items() if (m & v).bit_count() % 2)
        for v in range(1, top + 1)
    ]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def free_bits(mask: int) -> list[int]:
    return [i for i in range(64) if not mask >> i & 1]


def keyed(fp: Column, masks: list[int]) -> Column:
    """An array with the bucket of ``fp`` in every table."""
    return F.array(
        *[
            F.struct(F.lit(i).alias("place"), fp.bitwiseAND(F.lit(signed(m))).alias("key"))
            for i, m in enumerate(masks)
        ]
    )


def star_links(fps: np.ndarray, radius: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Members and centres of the components, of more than one, among distinct fingerprints."""
    members, centres = [], []
    rest = np.sort(fps)
    while len(rest) > 1:
        centre, rest = rest[0], rest[1:]
        open_ones = [centre]
        while open_ones and len(rest):
            near = np.bitwise_count(rest ^ open_ones.pop()) <= radius
            if near.any():
                new = rest[near]
                rest = rest[~near]
                members.append(new)
                centres.append(np.full(len(new), centre))
                open_ones.extend(new)
    return members, centres


def _bucket_links(radius: int):
    """Over rows sorted by bucket: a bucket is closed when the next one begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["place", "sub", "key"]
        current, held = None, []

        def emit(found):
            members, centres = found
            if members:
                columns = [pa.array(np.concatenate(x).view(np.int64)) for x in (members, centres)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

        for batch in batches:
            keys = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names])
            fps = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            members, centres = [], []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fps)], strict=True):
                if a == b:
                    continue
                key = tuple(keys[:, a].tolist())
                if key != current:
                    if len(held):
                        more = star_links(np.concatenate(held), radius)
                        members += more[0]
                        centres += more[1]
                    current, held = key, []
                held.append(fps[a:b])
            yield from emit((members, centres))
        if held:
            yield from emit(star_links(np.concatenate(held), radius))

    return run


def near_links(classes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect the fingerprints ``fp`` within the radius of one another."""
    masks = covering_masks(list(range(64)), radius)
    fp = F.col("fp")
    placed = classes.select("fp", F.explode(keyed(fp, masks)).alias("t")).select("fp", "t.place", "t.key")
    sizes = placed.groupBy("place", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Spark takes 31 rows a fingerprint for one, and would send them to the driver as a small table.
    together = placed.join(sizes.hint("merge"), ["place", "key"])
    again = F.array(
        *[
            F.array(*[F.lit(signed(m | sub)).cast("bigint") for sub in covering_masks(free_bits(m), radius)])
            for m in masks
        ]
    )
    own = F.array(F.struct(F.lit(-1).alias("sub"), F.col("key").alias("key")))
    dealt = F.transform(
        F.element_at(again, F.col("place") + 1),
        lambda m, i: F.struct(i.alias("sub"), fp.bitwiseAND(m).alias("key")),
    )
    buckets = together.select(
        "fp", "place", F.explode(F.when(F.col("n") <= bucket, own).otherwise(dealt)).alias("t")
    ).select("fp", "place", "t.sub", "t.key")
    ordered = buckets.repartition("place", "sub", "key").sortWithinPartitions("place", "sub", "key")
    return ordered.mapInArrow(_bucket_links(radius), "a bigint, b bigint")


def named_classes(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET,
    id_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, component_id) of every fingerprint."""
    prints = kept(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = kept(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = components(near_links(classes, radius, bucket))
    found = roots.join(classes.hint("merge"), F.col("node") == F.col("fp"))
    linked = kept(found.select("fp", "root", "first_id"), "linked")
    named = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    moved = linked.join(named.hint("merge"), "root").select("fp", "component_id")
    names = classes.join(moved.hint("merge"), "fp", "left").select(
        "fp", F.coalesce("component_id", "first_id").alias("component_id")
    )
    return prints, names


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, fp, component_id) of every row; the component is named by its smallest doc_id."""
    prints, names = named_classes(docs, **options)
    return prints.join(names.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def hex_of(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of every component, all columns unchanged: that of its smallest doc_id.

    Of rows that share this doc_id the one with the greatest text stays. Rows without an id can
    neither represent others nor be told apart, so all of them stay.
    """
    _, names = named_classes(docs, id_col=id_col, text_col=text_col, **options)
    first = names.select(F.col("component_id").alias("__id")).dropna().distinct()
    named = docs.join(first.hint("merge"), F.col(id_col).cast("bigint") == F.col("__id"))
    order = Window.partitionBy("__id").orderBy(F.col(text_col).desc_nulls_last())
    one = named.withColumn("__place", F.row_number().over(order)).filter("__place = 1")
    unnamed = docs.filter(F.col(id_col).isNull())
    return one.select(*docs.columns).unionByName(unnamed)
