"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Everything is a DataFrame expression. Per kind: a pattern, a test of the match (number ranges, digit
counts, Luhn for cards, mod-97 for account numbers), a score, and words that raise it when they
stand near: within 60 characters of the text on either side, whatever else matches there. Spans of the four basic kinds stay whatever their score; the others need ``THRESHOLD``.

The patterns match the leftmost, non-overlapping places of the plain forms given beside them; a
start inside a run is only tried where the run begins or the last match ended, so long runs cost one
pass.

Null and empty texts have no spans; rows are judged each for itself, so repeated ids do no harm;
other columns of a table given to ``redact`` stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.matches import let, places, replaced

THRESHOLD = 0.7
CONTEXT = 0.3

#: Lengths of account numbers by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22,
    "BR": 29, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20,
    "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27,
    "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30,
    "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22,
    "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29,
    "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
    "TN": 24, "TR": 26, "VG": 24,
}


def iban_pattern() -> str:
    by_length: dict[int, list[str]] = {}
    for country, length in IBAN_LENGTHS.items():
        by_length.setdefault(length, []).append(country)
    forms = [
        rf"(?:{'|'.join(names)})[0-9]{{2}}(?:[ -]?[A-Z0-9]){{{length - 4}}}"
        for length, names in sorted(by_length.items())
    ]
    return rf"(?<![A-Za-z0-9])(?:{'|'.join(forms)})(?![A-Za-z0-9])"


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def at_most_255(match: Column) -> Column:
    """Every dotted part is at most 255, however many zeros lead it."""
    part = lambda p: F.ltrim(p, F.lit("0"))
    small = lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255)
    return F.forall(F.split(match, r"\."), small)


def luhn(number: Column) -> Column:
    """From the right, every second digit doubled, its digits summed: the total ends in 0."""
    turned = F.reverse(number)

    def add(total, i):
        d = F.substring(turned, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add)
    return total % 10 == 0


def mod97(number: Column) -> Column:
    """The first four characters moved to the end, letters as 10 to 35: the remainder is 1."""
    plain = F.regexp_replace(number, "[ -]", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest, i):
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        value = F.when(code >= 65, code - 55).otherwise(code - 48)
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def count_between(match: Column, low: int, high: int) -> Column:
    return F.length(digits(match)).between(low, high)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    gate: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    score: float
    words: str
    base: bool = False


def has(*parts: str) -> Callable[[Column], Column]:
    def test(text: Column) -> Column:
        found = F.contains(text, F.lit(parts[0]))
        for part in parts[1:]:
            found = found & F.contains(text, F.lit(part))
        return found

    return test


def anything(_: Column) -> Column:
    return F.lit(True)


LOCAL = "A-Za-z0-9._%+-"
KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind(
        "email", rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        has("@", "."), anything, 0.8, "mail|contact|write to|reach", True,
    ),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
    Kind(
        "ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        has("."), at_most_255, 0.6, "address|host|server|login|client", True,
    ),
    # [0-9]([\x20-]?[0-9])+, 16 to 19 digits passing Luhn
    Kind(
        "card", r"(?:\G|(?<![0-9]))[0-9](?:[ -]?[0-9])++", anything,
        lambda m: F.when(count_between(m, 16, 19), luhn(digits(m))).otherwise(False),
        0.8, "card|credit|debit|visa|payment", True,
    ),
    # \+[0-9][\x20().0-9-]+[0-9], 8 to 15 digits
    Kind(
        "phone", r"\+[0-9][ ().0-9-]+[0-9]", has("+"),
        lambda m: count_between(m, 8, 15), 0.6, "call|phone|tel|mobile|fax", True,
    ),
    Kind("iban", iban_pattern(), anything, mod97, 0.9, "iban|account|bank|transfer"),
    Kind(
        "secret", r"(?<![A-Za-z0-9])[0-9a-f]{32,}+(?![A-Za-z0-9])", anything,
        anything, 0.5, "token|secret|password|passwd|api[_ -]?key|private",
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", has("-"),
        lambda m: ~m.rlike("^(000|666|9)|-00-|0000$"), 0.5, "social|ssn|security number|tax",
    ),
)


def scored(kind: Kind, before: Column, after: Column) -> Column:
    near = F.lower(F.concat(before, F.lit(" "), after)).rlike(kind.words)
    return F.lit(kind.score) + F.when(near, F.lit(CONTEXT)).otherwise(F.lit(0.0))


def stays(kind: Kind, match: Column, before: Column, after: Column) -> Column:
    valid = kind.valid(match)
    return valid if kind.base else F.when(valid, scored(kind, before, after) >= THRESHOLD).otherwise(False)


def score_of(kind: Kind, match: Column, before: Column, after: Column) -> Column:
    """The score of a match that ``stays``, null for others; what is near is only read for valid ones."""
    enough = lambda s: s if kind.base else F.when(s >= THRESHOLD, s)
    return F.when(kind.valid(match), let(scored(kind, before, after), enough))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """(doc_id, spans): spans are structs (kind, start, end, score) by kind, then start.

    Starts and ends count code points from 0, the end is exclusive; the score is at most 1.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))

    def spans(kind: Kind) -> Column:
        found = places(text, kind.pattern, kind.gate, lambda *x: score_of(kind, *x))
        good = F.filter(found, lambda x: x["score"].isNotNull())
        return F.transform(
            good,
            lambda x: F.struct(
                F.lit(kind.name).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                F.least(F.lit(1.0), x["score"]).alias("score"),
            ),
        )

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.concat(*map(spans, kinds)).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; other columns stay.

    Kinds are taken one after another, the longer forms first, so where spans of two kinds overlap
    the part that the first leaves is judged again.
    """
    order = ("email", "iban", "card", "phone", "ip", "secret", "ssn")
    text = F.col(text_col)
    for kind in sorted(kinds, key=lambda k: order.index(k.name) if k.name in order else len(order)):
        tagged = lambda *x, k=kind: stays(k, *x)
        text = replaced(text, kind.pattern, kind.gate, tagged, f"<{kind.name.upper()}>")
    return docs.withColumn(text_col, text)


def digests(found: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Counts and digests of ``find``'s rows."""
    base = [k.name for k in kinds if k.base]
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
    of = lambda name: F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("bigint")
    return found.select(
        "doc_id", *[of(name).alias(f"n_{name}") for name in base],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
