import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

ODD_TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (4, "word"), (5, "Word  word\x1cword x"),
    (None, "no id at all"), (6, "one two three four five"), (7, "ONE two three four five"),
    (8, "é 日本語 🙂 mail me@x.org or +1 (212) 555-0100, 4111 1111 1111 1111 at 10.0.0.255"),
    (9, "a b c d e f g h " * 40), (10, "x" * 60_000), (11, "1.2.3.4.5 a@b.c_d@e.f 256.1.1.1"),
    (12, "MIT License and the Apache-License,\nVersion 2.0 under CC BY cc-by 4.0"),
    (-3, "one two three four five six seven eight nine ten eleven"), (2**40, "far away id"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank and long texts, ties, repeats, null ids and columns with clashing names."""
    rows = [(d, t, None, "s", 0, -1, "x", 7) for d, t in ODD_TEXTS]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
        "fp bigint, ids string, n_words int",
    )


@pytest.fixture(scope="session")
def odd_rows():
    return ODD_TEXTS


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
