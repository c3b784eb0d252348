"""The registered queries over the whole small tables, against SQL or a literal reading."""

import oracle
import plain
import public_tokenizers
import pytest
import zlib

from tidemark.llm.queries import QUERIES, SQL


def result(spark, sf_dir, name):
    return [tuple(r) for r in QUERIES[name](spark, sf_dir).collect()]


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, sf_dir, con, name):
    assert oracle.differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


def test_every_operator_has_a_query():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13


def test_language_model(spark, sf_dir, documents):
    got = sorted(result(spark, sf_dir, "op1_maxent_lm"))
    for row, want in zip(got, sorted(plain.base_scores(documents)), strict=True):
        assert row[:5] == want[:5]
        assert row[5] == pytest.approx(want[5], rel=1e-9)
        assert row[6] < 0
    unseen = [r for r in got if r[1]]
    assert sum(r[6] for r in unseen) > sum(r[5] for r in unseen)


def test_byte_bpe(spark, sf_dir, documents):
    coder = plain.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    want = []
    for d, text in documents:
        ids = coder.encode_ordinary(text or "")
        want.append((d, len(ids), plain.sha(" ".join(map(str, ids))), plain.sha((text or "").encode())))
    assert sorted(result(spark, sf_dir, "op2_piece_bpe")) == sorted(want)


def test_near_duplicates(spark, sf_dir, documents):
    assert sorted(result(spark, sf_dir, "op3_simhash_cover")) == sorted(plain.components(documents))


def test_licences(spark, sf_dir, documents):
    want = {d: plain.phrases(t) for d, t in documents}
    for row in result(spark, sf_dir, "op6_license_rules"):
        assert row[1:6] == want[row[0]]
        assert {*row[5].split(",")} <= {*row[6].split(","), ""}
        assert 0 <= row[7] <= 1


def test_token_shards(spark, sf_dir, documents):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, start = [], 0
    for d, text in sorted(documents):
        ids = coder.encode(text or "", add_special_tokens=False).ids + [0]
        data = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((d, start, len(ids), zlib.crc32(data)))
        start += len(ids)
    assert sorted(result(spark, sf_dir, "op7_token_mph")) == want


def test_personal_data(spark, sf_dir, documents):
    want = {d: plain.personal(t) for d, t in documents}
    for row in result(spark, sf_dir, "op10_pii_spans"):
        base = want[row[0]]
        assert row[5] == plain.sha(",".join(base))
        assert row[1:5] == tuple(sum(s.startswith(k) for s in base) for k in plain.FORMS)
        assert {*base} <= {*row[6].split(",")}
