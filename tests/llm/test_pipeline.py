"""The pipeline, stage by stage, against literal readings of each stage's own input."""

import plain
import public_tokenizers

import corpus_pipeline
from tidemark.llm import pii, quality
from tidemark.llm.batches import kept

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(kept(stage(spark, seen[-1], sf_dir), "stage"))
    assert all(df.columns == COLUMNS for df in seen[:-1])
    raw, good, single, clean, private = [{r.doc_id: r for r in df.collect()} for df in seen[:-1]]

    mask = quality.mask_of(quality.POLICIES["v2"])
    bits = {r.doc_id: r.fail_bits for r in quality.ledger(docs).collect()}
    assert set(good) == {d for d, b in bits.items() if not b & mask}
    for d in good:
        n, _, _, _, repeated = plain.quality(raw[d].text)
        assert n >= 20 and 100 * repeated <= 30 * n

    found = plain.components([(d, r.text) for d, r in good.items()])
    assert set(single) == {c for _, _, c in found}

    leaks = plain.leaks([(d, r.text) for d, r in single.items()], items)
    assert set(clean) == {row[0] for row in leaks if not row[5]}

    assert set(private) == set(clean)
    for d, row in private.items():
        assert plain.personal(row.text) == [] and row.n_chars == len(row.text)
        if not plain.personal(clean[d].text) and "token" not in clean[d].text:
            assert row.text == clean[d].text

    coder = plain.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for row in seen[-1].collect():
        text = private[row.doc_id].text
        assert row.ids == coder.encode_ordinary(text) and row.decoded_sha256 == plain.sha(text)
    assert seen[-1].count() == len(private)


def test_run_is_the_stages(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    assert pii.KINDS[0].name == "email"
