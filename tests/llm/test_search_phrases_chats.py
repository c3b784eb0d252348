"""Ranked search, phrases and chat formatting against literal readings, with odd rows."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import plain
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings, strategies as st

from tidemark.llm import chat, lexical, phrases

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def best(docs, items, k):
    """(item, rank, doc, score) of every item row by the formula of the contract."""
    words = [(d, TERM.findall(plain.lower(t))) for d, t in docs]
    words = [(d, w) for d, w in words if w]
    n_docs, n_words = len(words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    for item, text in items:
        asked = set(TERM.findall(plain.lower(text)))
        scored = []
        for d, w in words:
            m, tf = 50 + (50 * len(w) * n_docs) // n_words, Counter(w)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1000000000 * tf[t]) // (1000 * tf[t] + 20 * m))
                for t in asked if tf[t]
            )
            if score > 0:
                scored.append((-score, d is None, d or 0))
        for rank, (score, unnamed, d) in enumerate(sorted(scored)[:k], 1):
            yield item, rank, None if unnamed else d, -score


ITEMS = [(1, "word five MIT license"), (2, None), (2, "one two three"), (None, "é a b c"), (3, "zzz"), (1, "word five MIT license")]


@pytest.mark.parametrize("query_bytes", [lexical.QUERY_BYTES, 8])
def test_search_is_exact_for_odd_rows(spark, odd, odd_rows, query_bytes):
    items = spark.createDataFrame([(*r, 0) for r in ITEMS], "item_id bigint, text string, doc_id int")
    got = lexical.search(odd, items, k=3, query_bytes=query_bytes).select("item_id", "rank", "doc_id", "score")
    want = list(best(odd_rows, ITEMS, 3))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_search_of_empty_tables(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert lexical.search(odd.limit(0), items).count() == 0
    assert lexical.search(odd, items.limit(0)).count() == 0


def test_blocks_are_skipped_and_nothing_is_lost():
    """Documents of many topics: a query of one topic leaves the blocks of others unread."""
    make = np.random.default_rng(7)
    rows = []
    for d in range(6000):
        topic = d % 20
        own = make.choice(40, 8, replace=False) + 40 * topic
        rows.append(np.unique(np.concatenate([own, make.integers(800, 820, 6)])))
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    terms = np.concatenate(rows).astype(np.int32)
    tfs = make.integers(1, 4, len(terms))
    df = np.bincount(terms, minlength=820)
    weights = np.floor(1000 * np.log((2 * 6000 + 2) / (2 * df + 1))).astype(np.int64)
    corpus = lexical.Corpus(6000, 6000 * 100, weights)
    impacts = corpus.impacts(tfs, np.full(len(terms), 100))
    shard = lexical.Shard.build(np.arange(6000), np.zeros(6000, bool), at, terms, impacts, corpus, block=32)
    assert any(len(b[0]) > 10 for b in shard.blocks.values())
    scored = 0
    for topic in range(20):
        query = np.concatenate([np.arange(40 * topic, 40 * topic + 6), np.arange(800, 806)]).astype(np.int32)
        found = lexical.Best.empty(10)
        lexical.search_shard(shard, query, corpus, found)
        full = np.zeros(820, np.int64)
        full[query] = weights[query]
        score = np.add.reduceat(full[terms] * impacts, at[:-1])
        want = np.lexsort((np.arange(6000), -score))[:10]
        assert found.ids.tolist() == want.tolist() and found.score.tolist() == score[want].tolist()
        scored += found.scored
    touched = sum((np.isin(terms, np.arange(800, 806))).sum() for _ in range(1))
    assert scored < 20 * touched / 3


def mined(rows, least):
    """The contract's phrases by counting every run of words."""
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", plain.lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    count[lang or "und"][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in count.items():
        found = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        rows_of_lang = []
        for g, a in found.items():
            inside = any(
                len(h) > len(g) and 100 * b >= 80 * a
                and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
                for h, b in found.items()
            )
            if not inside:
                cuts = [((2000000 * a) // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g))]
                score, k = min(cuts)
                rows_of_lang.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_of_lang), 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


PHRASE_ROWS = [
    ("en", "of the of the of the. Of the end; of the end of the day"), ("en", "a a a a a a a"), (None, "x y x y x y z"),
    ("en", None), ("de", ""), (None, " \t "), ("en", "the end of the day, the end of the day"), ("en", "Ä b\x1cc Ä b\x1cc\x0bÄ b\x1cc"),
    ("en", "lone " * 30), ("und", "x y z. . .. x y"),
]


@pytest.mark.parametrize("size", [4, 1 << 20])
def test_phrases_equal_a_count_of_everything(spark, size):
    docs = spark.createDataFrame([(*r, 1, 2) for r in PHRASE_ROWS * 2], "lang string, text string, n int, shard int")
    got = phrases.collocations(docs.repartition(3), least=3, size=size)
    assert sorted(map(tuple, got.collect())) == mined(PHRASE_ROWS * 2, 3)


def test_shards_are_held_one_at_a_time(spark, monkeypatch):
    """Whoever reads or writes a file of shards holds a row group of it, so that has one shard."""
    groups, write = [], phrases.kept

    def watched(df, purpose, **options):
        out = write(df, purpose, **options)
        if purpose in ("shards", "bwt"):
            for file in Path(out.kept_at).glob("*.parquet"):
                found = pq.ParquetFile(file).metadata
                groups.extend(found.row_group(i).num_rows for i in range(found.num_row_groups))
        return out

    monkeypatch.setattr(phrases, "kept", watched)
    docs = spark.createDataFrame([("en", "a b c a b")] * 40, "lang string, text string")
    assert phrases.collocations(docs.coalesce(1), least=3, size=4).count() > 0
    assert len(groups) == 80 and set(groups) == {1}


@pytest.mark.parametrize("rows", [3, 10_000])
def test_places_come_before_their_shard(spark, rows):
    """However rows fall into batches, a shard has its own places; one without places is left out."""
    own = [(shard, place, 100 * shard + place) for shard in range(6) if shard != 2 for place in range(1, 8 + shard)]
    places = spark.createDataFrame(own, "shard bigint, place int, id bigint")
    contents = spark.createDataFrame([(shard, [shard] * 5) for shard in range(6)], "shard bigint, words array<int>")

    def told(batches):
        for shard, place, ids, words in phrases._shards(batches):
            own = repr(sorted(zip(place.tolist(), ids.tolist(), strict=True)))
            yield pa.RecordBatch.from_pydict({"shard": [shard], "p": [own], "w": [words.tolist()]})

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        got = phrases.with_places(contents, places).mapInArrow(told, "shard bigint, p string, w array<bigint>").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = [(s, repr([(p, i) for t, p, i in own if t == s]), [s] * 5) for s in (0, 1, 3, 4, 5)]
    assert sorted(map(tuple, got)) == want


def test_phrases_of_an_empty_table(spark, odd):
    assert phrases.collocations(odd.limit(0)).count() == 0
    assert phrases.collocations(odd).filter("a < 30").count() == 0


@given(st.lists(st.integers(0, 5), min_size=2, max_size=60))
@settings(max_examples=60, deadline=None)
def test_index_enumerates_every_phrase(words):
    text = np.array([0, *words, 0], np.int32)
    index = phrases.Index(phrases.truncated_bwt(text))
    names = {i: (i,) for i in range(1, 6)}
    for n in range(2, 5):
        first, last, counts = index.extend()
        grams = [names[a] + names[b][-1:] for a, b in zip(first.tolist(), last.tolist())]
        runs = [tuple(text[i : i + n].tolist()) for i in range(len(text) - n + 1)]
        assert dict(zip(grams, counts.tolist())) == dict(Counter(r for r in runs if 0 not in r))
        names = dict(enumerate(grams, 1))


PIECES = st.lists(st.sampled_from(["#", "##", "###", "\\", "</turn>", "</turn", ">", ": ", ":", " ", "é", "日", "\n", "a", ""]), max_size=8).map("".join)


@given(st.lists(st.tuples(st.integers(0, 2), PIECES, PIECES), min_size=1, max_size=12))
@settings(max_examples=200, deadline=None)
def test_assembled_bytes_read_back(rows):
    rows.sort(key=lambda r: r[0])
    ids, roles, texts = (pa.array(c) for c in zip(*rows))
    heads = chat.heads_of(ids)
    out, start, end = chat.assemble(roles, texts, heads)
    back = [turn for text in out.to_pylist() for turn in chat.turns_of(text)]
    assert back == [(r, t) for _, r, t in rows]
    owner = np.searchsorted(heads, np.arange(len(rows)), side="right") - 1
    for i, (_, role, text) in enumerate(rows):
        inside = out[int(owner[i])].as_py()[start[i] : end[i]]
        assert chat.unescaped(inside) == text and "###" not in inside and "</turn>" not in inside


def digests(rows):
    found = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, _, role, text in sorted(rows, key=key):
        n, turns, lost = found.get(conv, (0, "", ""))
        role, text = role or "", text or ""
        found[conv] = n + 1, f"{turns}{role}\n{text}\n", lost + text * (role == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return sorted(((c, n, sha(t), len(x), sha(x)) for c, (n, t, x) in found.items()), key=str)


CHATS = [
    (1, 0, "user", "hi ### there"), (1, 1, "assistant", None), (1, 1, "assistant", "a\\b </turn>"), (1, 1, "assistant", "a\\b </turn>"),
    (2, None, None, ""), (2, 0, "sys: tem", "é" * 3000), (None, 3, "assistant", "x"), (None, 1, "user", "y"), (2**40, -5, "assistant", "日本"),
] + [(9, i, ("user", "assistant")[i % 2], f"turn {i} \\ ") for i in range(400)]


@pytest.mark.parametrize("part,rows", [(chat.PART, 10_000), (1, 7), (2000, 50)])
def test_chats_of_odd_rows(spark, part, rows):
    turns = spark.createDataFrame([(*r, "z") for r in CHATS], "conv_id bigint, turn bigint, role string, text string, loss string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        got = chat.round_trip(turns, part=part).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(map(tuple, got), key=str) == digests(CHATS)


def test_chats_of_an_empty_table(spark):
    turns = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.round_trip(turns).count() == 0
