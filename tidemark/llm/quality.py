"""Quality rules as a bitmask ledger: every rule is evaluated once, policies read the bits.

``measure`` computes the figures of a text in one pass, ``ledger`` turns them into one failure bit
per rule, ``apply_policy`` and ``ablation`` need only those bits: a policy is a mask of rules with a
version, so a new policy or a report about one costs no second look at the texts.

Null texts count as empty, an empty text fails ``few_words``; repeated rows are measured each for
itself; extra columns are not looked at. An empty table gives an empty ledger.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.batches import bound_batches, rows_of, texts_of

WINDOW = 8
FIGURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
    "n_lower", "n_echoes",
)
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))


@dataclass(frozen=True)
class Rule:
    """A named test; its place in the list of rules is its bit."""

    name: str
    fails: str


#: Bits are positions: add rules at the end only, so that stored ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines AND n_lines >= 4"),
    Rule("word_length", "word_chars > 25 * n_words OR word_chars < 2 * n_words"),
    Rule("shouting", "n_upper > 2 * n_lower AND n_upper >= 20"),
    Rule("echoes", "2 * n_echoes > n_words"),
)
BASE = ("few_words", "repeated_windows")
#: Policy versions: the rules that reject a document.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols", "shouting"),
    "v2": tuple(r.name for r in RULES),
}


def mask_of(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    places = {rule.name: i for i, rule in enumerate(rules)}
    return sum(1 << places[name] for name in names)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more; hashes select, the words themselves decide."""
    n = len(words)
    if n <= window:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    places = n - window + 1
    total = np.zeros(places, np.uint64)
    for i in range(window):
        total = total * np.uint64(0x94D049BB133111EB) + mixed[i : i + places]
    order = np.sort(total)
    again = order[1:][order[1:] == order[:-1]]
    if not len(again):
        return 0
    at = np.flatnonzero(np.isin(total, again))
    keys = [ids[i : i + window].tobytes() for i in at]
    times = Counter(keys)
    marks = np.zeros(n + 1, np.int64)
    for i, key in zip(at.tolist(), keys, strict=True):
        if times[key] > 1:
            marks[i] += 1
            marks[i + window] -= 1
    return int((np.cumsum(marks)[:n] > 0).sum())


def figures(text: str) -> tuple[int, ...]:
    data = text.encode()
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    gaps = len(data) - len(data.translate(None, b" \t\n\r\x0b\x0c"))
    return (
        len(words),
        len(text) - gaps,
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(data) - len(data.translate(None, UPPER)),
        len(data) - len(data.translate(None, LOWER)),
        sum(map(eq, words, islice(words, 1, None))),
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in rows_of(batches):
        table = np.array([figures(t) for t in texts], np.int64).reshape(len(texts), len(FIGURES))
        columns = [pa.array(table[:, i]) for i in range(len(FIGURES))]
        yield pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", *FIGURES])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of figures per row of ``docs``."""
    schema = "doc_id bigint, " + ", ".join(f"{name} bigint" for name in FIGURES)
    return texts_of(docs, id_col, text_col).mapInArrow(_measure, schema)


def failure_bits(rules: tuple[Rule, ...] = RULES) -> Column:
    bits = F.lit(0).cast("bigint")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(0).cast("bigint"))
    return bits


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, **columns: str) -> DataFrame:
    """Figures and ``fail_bits``: bit i is set where rule i fails."""
    return measure(docs, **columns).withColumn("fail_bits", failure_bits(rules))


def fails(mask: int) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask)) != 0


def apply_policy(
    rows: DataFrame, version: str = "v2", policies: dict[str, tuple[str, ...]] = POLICIES
) -> DataFrame:
    """Add ``policy`` and ``kept``: no rule of the policy fails."""
    mask = mask_of(policies[version])
    return rows.withColumns({"policy": F.lit(version), "kept": ~fails(mask)})


def ablation(
    rows: DataFrame,
    policies: dict[str, tuple[str, ...]] = POLICIES,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Per policy and rule: rows it rejects, rejects alone, and rows kept if it were left out.

    Rows are first counted per pattern of bits, of which there are at most 2^rules.
    """
    patterns = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    cases = [
        (version, name, mask_of(names), mask_of((name,)))
        for version, names in policies.items()
        for name in names
    ]
    each = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(v).alias("policy"), F.lit(r).alias("rule"),
                    F.lit(m).cast("bigint").alias("mask"), F.lit(b).cast("bigint").alias("bit"),
                )
                for v, r, m, b in cases
            ]
        )
    )
    hit = F.col("fail_bits").bitwiseAND(F.col("c.mask"))
    bit = F.col("c.bit")
    count = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    return (
        patterns.select("fail_bits", "n", each.alias("c"))
        .groupBy("c.policy", "c.rule")
        .agg(
            count(hit.bitwiseAND(bit) != 0).alias("rejects"),
            count(hit == bit).alias("rejects_alone"),
            count(hit == 0).alias("kept"),
            count((hit == 0) | (hit == bit)).alias("kept_without"),
        )
    )


def keep_good(docs: DataFrame, version: str = "v2", **columns: str) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, all columns unchanged.

    The bits are computed beside each row, so rows that share an id are judged one by one.
    """
    bound_batches(docs.sparkSession)
    text = columns.get("text_col", "text")
    mask = mask_of(POLICIES[version])
    rule_bits = failure_bits()
    names = docs.columns

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = names.index(text)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                rows = [figures(t or "") for t in piece.column(place).to_pylist()]
                table = np.array(rows, np.int64).reshape(len(rows), len(FIGURES))
                figs = pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(len(FIGURES))], FIGURES)
                row = pa.StructArray.from_arrays(piece.columns, [f"c{i}" for i in range(len(names))])
                yield pa.RecordBatch.from_arrays([row, figs], ["row", "figures"])

    inner = ", ".join(f"c{i}: {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    figs = ", ".join(f"{name}: bigint" for name in FIGURES)
    judged = docs.mapInArrow(judge, f"row struct<{inner}>, figures struct<{figs}>")
    good = judged.select("row", "figures.*").withColumn("fail_bits", rule_bits).filter(~fails(mask))
    return good.select(*[F.col(f"row.c{i}").alias(name) for i, name in enumerate(names)])
