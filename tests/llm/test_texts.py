"""Operators over odd rows and small made-up cases."""

import math

import numpy as np
import plain
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontam, graph, licenses, lm, pii, quality, shards, simhash
from tidemark.llm.pretokens import Known

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def key(x):
    return str(x)


def test_quality_of_odd_rows(odd, odd_rows):
    got = rows(quality.measure(odd).select("doc_id", *quality.FIGURES[:5]))
    assert got == sorted(((d, *plain.quality(t)) for d, t in odd_rows), key=key)
    assert quality.ledger(odd.limit(0)).count() == 0


def test_kept_rows_are_unchanged(odd, spark):
    good = " ".join(f"word{i}" for i in range(30))
    both = odd.union(spark.createDataFrame([(77, good, "en", "s", 1, 2, "q", 3)], odd.schema))
    assert rows(quality.keep_good(both)) == [(77, good, "en", "s", 1, 2, "q", 3)]


def test_ablation_counts_bits(spark):
    ledger = spark.createDataFrame([(0,), (1,), (3,), (4,), (4,)], "fail_bits bigint")
    found = {(r.policy, r.rule): r[2:] for r in quality.ablation(ledger).collect()}
    assert found["base", "few_words"] == (2, 1, 3, 4)
    assert found["v1", "symbols"] == (2, 2, 1, 3)
    assert quality.apply_policy(ledger, "base").filter("kept").count() == 3


def test_language_model_of_odd_rows(odd, odd_rows):
    got = rows(lm.score(odd, chunk_tokens=50))
    want = sorted(plain.base_scores(odd_rows), key=key)
    for row, expected in zip(sorted(got, key=lambda r: (str(r[0]), r[2])), sorted(want, key=lambda r: (str(r[0]), r[2])), strict=True):
        assert row[:5] == expected[:5]
        assert row[5] == pytest.approx(expected[5], abs=1e-9)
    assert lm.score(odd.limit(0)).count() == 0


def test_model_probabilities_sum_to_one():
    import numpy as np

    tokens = np.zeros(lm.SYMBOLS)
    distinct = np.zeros(lm.SYMBOLS)
    tokens[:3], tokens[lm.HEAD + 5], distinct[lm.HEAD + 5] = (9, 4, 2), 6, 3
    lexicon = lm.Lexicon(21, 6, np.array([1, 2, 3], np.uint64), tokens, distinct)
    model = lm.Model(lexicon, np.random.default_rng(1).normal(size=(lm.CLASS_ROWS + lm.MEMBER_ROWS) * lm.WIDTH).astype(np.float32))
    target = np.arange(lm.SYMBOLS)
    before = [np.full(lm.SYMBOLS, s) for s in (3, lm.START, 700)]
    of_class, of_member = model.features(before, target)
    c, m = target // lm.WIDTH, target % lm.WIDTH
    logs = lm.log_softmax(model.classes, of_class, model.class_base, c)
    logs += lm.log_softmax(model.members, of_member, model.member_base[c], m)
    assert np.exp(logs.astype(float)).sum() == pytest.approx(1, abs=1e-4)
    cell = lm.HEAD + 5
    shares = lexicon.share(np.array([cell] * 4), np.array([1, 2, 3, 0]))
    assert np.exp(shares).sum() == pytest.approx(1)


def test_byte_bpe_of_odd_rows(odd, odd_rows):
    pattern = public_tokenizers.PATTERN
    coder = plain.encoding(RANKS, pattern)
    found = bpe.decode(bpe.encode(odd, RANKS, pattern), RANKS, pattern)
    want = [(d, coder.encode_ordinary(t or ""), bytearray((t or "").encode())) for d, t in odd_rows]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)


def test_what_is_known_is_bounded():
    asked = []
    known = Known(lambda m: asked.append(m) or [len(m)], 3)
    for match in ("a", "b", "c", "a", "d", "a", "b", "e", "f", "a"):
        known[match]
    assert len(known) <= 3 and len(known.former) <= 3
    assert asked[:4] == ["a", "b", "c", "d"]


def test_near_duplicates_of_odd_rows(odd, odd_rows):
    found = simhash.near_duplicates(odd).select("doc_id", simhash.hex_of(), "component_id")
    assert rows(found) == sorted(plain.components(odd_rows), key=key)
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def test_masks_cover_every_close_pair():
    import itertools
    import random

    masks = simhash.covering_masks(list(range(64)))
    assert len(masks) == 31 and min(m.bit_count() for m in masks) >= 32
    pick = random.Random(3)
    for _ in range(3000):
        bits = pick.sample(range(64), 4)
        assert any(not any(m >> b & 1 for b in bits) for m in masks)
    for m in masks[:5]:
        again = simhash.covering_masks(simhash.free_bits(m))
        assert all(64 - (m | a).bit_count() <= 16 for a in again)
        for bits in itertools.islice(itertools.combinations(simhash.free_bits(m), 4), 0, None, 97):
            assert any(not any(a >> b & 1 for b in bits) for a in again)


def test_large_buckets_are_dealt_again(spark):
    import random

    pick = random.Random(5)
    base = pick.getrandbits(64)
    prints = {base}
    for _ in range(150):
        x = pick.choice(sorted(prints))
        for b in pick.sample(range(64), pick.randint(1, 6)):
            x ^= 1 << b
        prints.add(x)
    values = sorted(prints)
    near = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4]
    want = {}
    for i, root in enumerate(plain.union(len(values), near)):
        want.setdefault(root, set()).add(values[i])
    table = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in values], "fp bigint")
    for bucket in (2, 1 << 16):
        links = simhash.near_links(table, bucket=bucket).collect()
        place = {x: i for i, x in enumerate(values)}
        pairs = [(place[r.a % (1 << 64)], place[r.b % (1 << 64)]) for r in links]
        got = {}
        for i, root in enumerate(plain.union(len(values), pairs)):
            got.setdefault(root, set()).add(values[i])
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_near_copies_are_not_broadcast(spark, odd):
    """Spark takes rows exploded or well compressed for few, so size alone must not send them to the driver."""
    links = simhash.near_links(spark.createDataFrame([(1,), (3,), (1 << 40,)], "fp bigint"))
    stars = graph.small_star(graph.large_star(graph.oriented(links)))
    for df in (links, stars, simhash.near_duplicates(odd), simhash.keep_representatives(odd)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_one_row_of_each_group_stays(odd):
    left = simhash.keep_representatives(odd)
    assert left.columns == odd.columns
    ids = [r.doc_id for r in left.collect()]
    assert ids.count(None) == 1 and ids.count(1) == 1 and 2 not in ids and 3 not in ids and ids.count(4) == 1


def test_licences_of_odd_rows(odd, odd_rows):
    found = licenses.scan(odd)
    got = rows(found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"))
    assert got == sorted(((d, *plain.phrases(t)) for d, t in odd_rows), key=key)
    one = found.filter("doc_id = 12").first()
    assert one.labels == "apache,apache-2.0,cc-by,cc-by-4.0,mit"
    assert licenses.scan(odd.limit(0)).count() == 0


def test_contained_detections_give_way(spark):
    text = (
        "// SPDX-License-Identifier: GPL-2.0-or-later\n"
        "Licensed under the terms of the GNU General Public License, version 3. All rights reserved."
    )
    table = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    row = licenses.scan(table).first()
    found = [d.label for d in row.detections]
    assert found == ["gpl-2.0-or-later", "gpl-3.0", "all-rights-reserved"] and row.score == 1.0
    first = row.detections[0]
    assert text[first.start : first.end].lower().endswith("gpl-2.0-or-later")


def test_every_rule_holds_its_keyword():
    from tidemark.llm.license_rules import rules

    assert len(rules()) > 300
    for rule in rules():
        assert " " not in rule.keyword
        letters = "".join(c for c in rule.keyword if c.isalnum())
        plain_pattern = "".join(c for c in rule.pattern if c.isalnum())
        assert letters[:5] in plain_pattern or "?" in rule.pattern, rule


def examples(parsed):
    """Texts that a pattern matches: every alternative and character of a class, optional parts in and out."""
    found = [""]
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            new = [chr(arg)]
        elif name == "IN":
            ranges = [(v, v) if str(o) == "LITERAL" else v for o, v in arg if str(o) in ("LITERAL", "RANGE")]
            blank = any(str(o) == "CATEGORY" for o, _ in arg)
            new = ["\n"] if blank else [chr(a) for a, _ in ranges]
        elif name == "BRANCH":
            new = [x for branch in arg[1] for x in examples(branch)]
        elif name == "SUBPATTERN":
            new = examples(arg[3])
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, inner = arg
            once = examples(inner)
            new = ["", *once] if least == 0 else [x * least for x in once]
        else:
            assert name in ("AT", "ASSERT", "ASSERT_NOT"), name
            new = [""]
        # Alternatives are not multiplied with each other: one that differs from the first at a time.
        found = [f + new[0] for f in found] + [found[0] + x for x in new[1:]]
    return found


def test_keywords_lose_no_alternative(spark):
    import dataclasses
    import re

    from tidemark.llm.license_rules import rules

    by_text = {}
    for rule in rules():
        for text in examples(re._parser.parse(rule.pattern)):
            assert re.search(rule.pattern, text), (rule, text)
            by_text.setdefault(text, rule)
            assert rule.keyword in text, (rule, text)
    texts = [t for t, rule in by_text.items() if rule.tier in (2, 4) and not rule.label.startswith("cc-")]
    texts += ["the modified BSD license", "a new bsd licence", "Unauthorised use of it\nis strictly prohibited"]
    clause = (
        "Neither the name of the copyright holder nor\n * the names of its contributors\n"
        " * may be used to endorse or\n * promote products derived"
    )
    texts = [*texts[::12], *texts[-3:], clause]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    open_rules = tuple(dataclasses.replace(rule, keyword="") for rule in rules())
    gated = {r.doc_id: r for r in licenses.scan(table).collect()}
    assert gated == {r.doc_id: r for r in licenses.scan(table, open_rules).collect()}
    last = [gated[len(texts) - n].labels.split(",") for n in (4, 3, 2, 1)]
    assert ["bsd-3-clause" in x for x in last] == [True, True, False, True]
    assert "proprietary" in last[2]


def test_shards_of_odd_rows(spark, odd, odd_rows, tmp_path):
    path = str(tmp_path / "shards")
    shards.write_shards(odd, path, public_tokenizers.path("byte_bpe_50k.json"), shard_ids=20)
    found = shards.read_back(spark, path).orderBy("start").collect()
    coder = plain.encoding(RANKS, public_tokenizers.PATTERN)
    want = [(d, len(coder.encode_ordinary(t or "")) + 1) for d, t in odd_rows]
    assert sorted([(r.doc_id, r.n_tokens) for r in found], key=key) == sorted(want, key=key)
    assert [r.doc_id for r in found] == sorted((d for d, _ in want), key=lambda d: (d is not None, d))
    assert [r.start for r in found] == [sum(r.n_tokens for r in found[:i]) for i in range(len(found))]
    near = shards.look_up(spark, path, [4, 8, 12345])
    assert sorted((r.doc_id, r.ids) for r in near.collect()) == sorted(
        (d, coder.encode_ordinary(t) + [0]) for d, t in odd_rows if d in (4, 8)
    )


def test_added_tokens_are_those_of_the_library(spark, tmp_path):
    from tokenizers import AddedToken, Tokenizer

    end = "<|endoftext|>"
    texts = [
        end, f"one {end} two", f"{end}{end}", f"a  {end}  b\n{end}\n", f"é日本{end}🙂 x", "<|endoftext|", f"<{end}>",
        "plain text  ", f"it{end}'s  {end}", "<|ENDOFTEXT|>", f"<|endof{end}text|>", "<|a|> <|ab|> <|abc|>" + end,
    ]
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = [(d, library.encode(t, add_special_tokens=False).ids + [0]) for d, t in enumerate(texts)]
    assert 50256 in want[0][1]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    shards.write_shards(table, out := str(tmp_path / "added"), path)
    got = shards.look_up(spark, out, list(range(len(texts)))).collect()
    assert sorted((r.doc_id, r.ids) for r in got) == want
    for stripped in (False, True):
        more = Tokenizer.from_file(path)
        more.add_tokens([AddedToken("<|a|>", normalized=True), AddedToken("<|ab", normalized=True), AddedToken("<|ab|>", rstrip=stripped)])
        more.save(file := str(tmp_path / f"more{stripped}.json"))
        coder = shards.Tokens(file)
        for text in texts:
            ids = b"".join(i.to_bytes(4, "little") for i in more.encode(text, add_special_tokens=False).ids)
            assert coder.encode(text) == ids, text


def test_minimal_hash_is_a_bijection():
    import numpy as np

    for n in (0, 1, 2, 1000):
        keys = np.random.default_rng(n).choice(1 << 40, n, replace=False).astype(np.int64) - (1 << 39)
        assert sorted(shards.MinimalHash.of(keys).slots(keys).tolist()) == list(range(n))


def test_leaks_of_odd_rows(spark, odd, odd_rows):
    items = [(1, "One, two... THREE"), (2, None), (3, ""), (1, "x11"), (10, "ten eleven"), (4, "two three four five six seven eight nine ten eleven"), (5, "one two three four five six seven eight nine ten eleven twelve")]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    want = sorted(plain.leaks(odd_rows, items), key=key)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    for block in (decontam.BLOCK_CHARS, 10):
        found = decontam.summary(decontam.contamination(odd, table, block_chars=block))
        assert rows(found.select(*columns)) == want
    spans = found.filter("doc_id = 7").first().spans
    assert [(s.start, s.end) for s in spans] == [(0, 13)]
    clean = decontam.drop_contaminated(odd, table)
    assert clean.columns == odd.columns and clean.count() == sum(not w[5] for w in want)
    assert decontam.contamination(odd, table.limit(0)).count() == len(odd_rows)


def test_items_without_an_id_count(spark):
    docs = spark.createDataFrame(
        [(1, "say alpha beta now"), (2, "gamma delta"), (3, "alpha beta, gamma delta"), (4, "clean"), (5, "alpha beta epsilon")],
        "doc_id bigint, text string",
    )
    items = spark.createDataFrame(
        [(None, "Alpha beta"), (7, "gamma delta"), (None, "epsilon"), (0, "alpha beta epsilon")], "item_id bigint, text string"
    )
    one = plain.sha("7")
    want = [
        (1, 4, 2, 1, plain.sha(""), True), (2, 2, 2, 1, one, True), (3, 4, 4, 2, one, True),
        (4, 1, 0, 0, plain.sha(""), False), (5, 3, 3, 2, plain.sha("0"), True),
    ]
    for block in (decontam.BLOCK_CHARS, 10):
        found = decontam.contamination(docs, items, block_chars=block)
        assert rows(decontam.summary(found).drop("spans")) == want
        assert {r.doc_id: r["items"] for r in found.collect()} == {1: [None], 2: [7], 3: [7, None], 4: [], 5: [0, None]}
    assert [r.doc_id for r in decontam.drop_contaminated(docs, items).collect()] == [4]


def test_personal_data_of_odd_rows(odd, odd_rows):
    got = rows(pii.digests(pii.find(odd)).select("doc_id", "base_sha256"))
    assert got == sorted(((d, plain.sha(",".join(plain.personal(t)))) for d, t in odd_rows), key=key)
    assert pii.find(odd.limit(0)).count() == 0


def test_checksums_and_context(spark):
    texts = [
        "Transfer to GB82 WEST 1234 5698 7654 32 AND more", "GB82 WEST 1234 5698 7654 33",
        'secret token = "59b79a44c83160ff605db5295c3f1b8f59a30bf7"', "59b79a44c83160ff605db5295c3f1b8f59a30bf7",
        "social security 123-45-6789", "part 123-45-6789", "4111-1111-1111-1112",
    ]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: [(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.spans] for r in pii.find(table).collect()}
    assert found == {
        0: [("iban", "GB82 WEST 1234 5698 7654 32")], 1: [],
        2: [("secret", "59b79a44c83160ff605db5295c3f1b8f59a30bf7")], 3: [],
        4: [("ssn", "123-45-6789")], 5: [], 6: [],
    }


def test_context_reaches_across_other_matches(spark):
    long = "0123456789abcdef" * 9
    keys = [f"{i:032x}" for i in range(3)]
    texts = [
        "social security numbers: 123-45-6789, 234-56-7890, 345-67-8901",
        "123-45-6789, 234-56-7890, 345-67-8901 are social security numbers",
        f"api_key {keys[0]} {keys[1]} {keys[2]}", f"secret {long}", "numbers: 123-45-6789, 234-56-7890",
        "ssn " + "x" * 56 + " 123-45-6789", "ssn " + "x" * 54 + " 123-45-6789, 234-56-7890",
        "ssn 123-45-6789 " + "é🙂" * 14 + " 000-45-6789 1 234-56-7890",
    ]
    want = {
        0: texts[0][25:].split(", "), 1: texts[1][:37].split(", "),
        2: keys[:2], 3: [long], 4: [], 5: [], 6: ["123-45-6789"], 7: ["123-45-6789", "234-56-7890"],
    }
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for row in pii.find(table).collect():
        assert [texts[row.doc_id][s.start : s.end] for s in row.spans] == want[row.doc_id], row
        assert all(s.score == pytest.approx(0.8) for s in row.spans)
    for row in pii.redact(table).collect():
        left = texts[row.doc_id]
        for found in want[row.doc_id]:
            left = left.replace(found, "<SSN>" if "-" in found else "<SECRET>")
        assert row.text == left


def test_redaction_keeps_the_rest(odd):
    left = pii.redact(odd)
    assert left.columns == odd.columns
    text = left.filter("doc_id = 8").first().text
    assert text == "é 日本語 🙂 mail <EMAIL> or <PHONE>, <CARD> at <IP>"
    assert left.filter("doc_id = 1").first().text is None
    changed = left.alias("l").join(odd.alias("o"), "doc_id").filter(F.col("l.text") != F.col("o.text"))
    assert {r.doc_id for r in changed.collect()} == {8, 11}


def test_sums_over_runs_and_scores_far_apart():
    rng = np.random.default_rng(3)
    x = rng.random((50, lm.WIDTH)).astype(np.float32)
    sizes = np.array([1, 2, 3, 1, 700, 64, 1, 5, 8, 1])
    rows, starts = rng.integers(0, 50, sizes.sum()), np.cumsum(sizes) - sizes
    assert np.allclose(lm.run_sums(x, rows, starts), np.add.reduceat(x[rows], starts, axis=0), rtol=1e-5)
    weights = np.zeros((2, lm.WIDTH), np.float32)
    weights[0, 3] = 500.0
    rows, base = np.array([[0], [1]]), np.zeros(lm.WIDTH, np.float32)
    found = lm.log_softmax(weights, rows, base, np.array([3, 3]))
    assert np.allclose(found, [0.0, -math.log(lm.WIDTH)], atol=1e-5)
    sums = np.zeros((2, lm.WIDTH))
    lm.add_expected(sums, weights, rows, base)
    assert np.allclose(sums.sum(axis=1), 1, atol=1e-5) and abs(sums[0, 3] - 1) < 1e-6
