"""The registered queries of this package, one per operator, and the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.catalog import Tables
from tidemark.llm import (
    bpe, chat, decontam, lexical, licenses, lm, phrases, pii, quality, shards, simhash, urls, warc,
)
from tidemark.llm.batches import kept
from tidemark.session import work_dir

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"

# The canonical form of an address, as ``urls.canonical`` spells it.
CANONICAL_SQL = r"""
    parts AS (SELECT page_id, url, html,
      CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    cut AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(?:\?([^#]*))?', 1) AS query FROM parts),
    named AS (SELECT *, regexp_replace(regexp_replace(host, ':(80|443)?$', ''), '^www\.(.)', '\1') AS h,
      array_to_string(list_sort(list_filter(string_split(query, '&'),
        lambda p: p <> '' AND NOT regexp_matches(p, '^(?:utm_[^=]*|fbclid|gclid|ref)(?:=|$)'))), '&') AS q FROM cut),
    addressed AS (SELECT *, CASE WHEN h <> '' THEN h || regexp_replace(path, '/+$', '') || CASE WHEN q = '' THEN '' ELSE '?' || q END END AS address
      FROM named)"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return build

    return register


@query("op1_maxent_lm")
def op1_maxent_lm(t: Tables) -> DataFrame:
    return lm.score(t.documents)


@query("op2_piece_bpe")
def op2_piece_bpe(t: Tables) -> DataFrame:
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    return bpe.digests(bpe.decode(bpe.encode(t.documents, path, pattern), path, pattern))


@query("op3_simhash_cover")
def op3_simhash_cover(t: Tables) -> DataFrame:
    found = simhash.near_duplicates(t.documents)
    return found.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")


# The figures and failure bits of every text.
LEDGER_SQL = r"""
    WITH texts AS (SELECT row_number() OVER () AS r, doc_id, COALESCE(text, '') AS t FROM documents),
    split AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM texts),
    wins AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS k
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM split)),
    twice AS (SELECT r, i FROM wins QUALIFY COUNT(*) OVER (PARTITION BY r, k) > 1),
    inside AS (SELECT r, COUNT(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r),
    m AS (SELECT doc_id, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars,
      len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
      len(ls) - len(list_distinct(ls)) AS n_dup_lines, COALESCE(n, 0) AS n_repeat_words,
      len(ls) AS n_lines, len(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
      len(regexp_replace(t, '[^a-z]', '', 'g')) AS n_lower,
      len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_echoes
      FROM split LEFT JOIN inside USING (r)),
    bits AS (SELECT *, (n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
      + 4 * (10 * n_symbols > 3 * n_words)::INT + 8 * (100 * n_dup_lines > 50 * n_lines AND n_lines >= 4)::INT
      + 16 * (word_chars > 25 * n_words OR word_chars < 2 * n_words)::INT
      + 32 * (n_upper > 2 * n_lower AND n_upper >= 20)::INT + 64 * (2 * n_echoes > n_words)::INT AS f FROM m)"""


@query(
    "op5_rule_ledger",
    LEDGER_SQL
    + """
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
      CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
      CAST(n_repeat_words AS BIGINT) AS n_repeat_words, f & 3 <> 0 AS base_failed, f = 0 AS kept,
      CAST(f AS BIGINT) AS fail_bits, 'v2' AS policy FROM bits""",
)
def op5_rule_ledger(t: Tables) -> DataFrame:
    rows = quality.apply_policy(quality.ledger(t.documents), "v2")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality.fails(quality.mask_of(quality.BASE)).alias("base_failed"), "kept", "fail_bits", "policy",
    )


@query(
    "rule_ablation",
    LEDGER_SQL
    + """,
    rules(rule, bit) AS (VALUES ('few_words', 1), ('repeated_windows', 2), ('symbols', 4), ('repeated_lines', 8), ('word_length', 16), ('shouting', 32), ('echoes', 64)),
    policies(policy, mask) AS (VALUES ('base', 3), ('v1', 39), ('v2', 127)),
    cases AS (SELECT policy, rule, bit, mask FROM policies JOIN rules ON bit & mask <> 0)
    SELECT policy, rule, COUNT(*) FILTER (f & bit <> 0) AS rejects, COUNT(*) FILTER (f & mask = bit) AS rejects_alone,
      COUNT(*) FILTER (f & mask = 0) AS kept, COUNT(*) FILTER (f & mask IN (0, bit)) AS kept_without
    FROM cases, bits GROUP BY policy, rule""",
)
def rule_ablation(t: Tables) -> DataFrame:
    """The ledger written once; every policy and rule judged from its stored bits."""
    return quality.ablation(kept(quality.ledger(t.documents), "ledger"))


@query("op7_token_mph")
def op7_token_mph(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "tokens")
    shards.write_shards(t.documents, path, public_tokenizers.path(TOKENIZER))
    return shards.read_back(t.spark, path)


@query(
    "op8_ahocorasick_leaks",
    r"""
    WITH texts AS (SELECT row_number() OVER () AS r, doc_id,
      list_filter(regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM documents),
    items AS (SELECT item_id,
      list_filter(regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM benchmark),
    pats AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i:i + 9], ' ') AS k
      FROM (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS i FROM items WHERE len(ws) > 0)),
    sizes AS (SELECT DISTINCT n FROM pats),
    wins AS (SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS k
      FROM (SELECT r, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM texts, sizes WHERE len(ws) >= n)),
    found AS (SELECT r, i, n, item_id FROM wins JOIN pats USING (n, k)),
    hit AS (SELECT r, COUNT(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
    named AS (SELECT r, COUNT(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
      FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
      sha256(COALESCE(names, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
    FROM texts LEFT JOIN hit USING (r) LEFT JOIN named USING (r)""",
)
def op8_ahocorasick_leaks(t: Tables) -> DataFrame:
    return decontam.summary(decontam.contamination(t.documents, t.benchmark)).drop("spans")


@query("op10_pii_spans")
def op10_pii_spans(t: Tables) -> DataFrame:
    return pii.digests(pii.find(t.documents))


@query("op6_license_rules")
def op6_license_rules(t: Tables) -> DataFrame:
    return licenses.scan(t.documents).drop("detections")


def captures_of(pages: DataFrame) -> DataFrame:
    """The pages as a crawl: a full response a minute apart each, a 304 revisit a day later.

    The revisit asks by the entity tag of its own page, under another spelling of the address. Where
    pages share an address, only the latest one's tag is still valid.
    """
    tag = F.md5(F.col("html").cast("binary"))
    first = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("page_id") * 60)
    again = first + F.expr("INTERVAL 1 DAY")
    stamp = lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss")
    headers = lambda *pairs: F.create_map(*[x if not isinstance(x, str) else F.lit(x) for x in pairs])
    full = headers(
        "etag", F.concat(F.lit('"'), tag, F.lit('"')), "last-modified", stamp(first), "date", stamp(first),
        "content-type", "text/html", "content-length", F.octet_length("html").cast("string"),
        "cache-control", "max-age=60",
    )
    short = headers(
        "etag", F.concat(F.lit('W/"'), tag, F.lit('"')), "date", stamp(again), "content-length", "0",
        "cache-control", "max-age=600",
    )
    one = lambda k, at, kind, status, head, url: F.struct(
        (F.col("page_id") * 2 + k).alias("capture_id"), url.alias("url"), at.alias("captured_at"),
        F.lit(kind).alias("type"), F.lit(status).alias("status"), head.alias("headers"),
    )
    both = F.array(
        one(0, first, "response", 200, full, F.col("url")),
        one(1, again, "revisit", 304, short, F.concat("url", F.lit("#again"))),
    )
    return pages.select(F.explode(both).alias("c")).select("c.*")


@query(
    "op4_warc_revisits",
    "WITH" + CANONICAL_SQL + r""",
    timed AS (SELECT *, page_id * 60 AS at, page_id * 60 + 86400 AS again, md5(html) AS tag FROM addressed),
    ranked AS (SELECT b.page_id, b.address, b.tag, b.again, a.page_id AS r, a.tag AS r_tag, a.at AS r_at, a.html AS r_html,
      row_number() OVER (PARTITION BY b.page_id ORDER BY a.at DESC, a.page_id DESC) AS place
      FROM timed b LEFT JOIN timed a ON a.address = b.address AND a.at < b.again),
    checked AS (SELECT *, CASE WHEN r IS NULL THEN 'no_response' WHEN tag = r_tag THEN 'resolved' ELSE 'mismatch' END AS verdict
      FROM ranked WHERE place = 1)
    SELECT page_id, address, r AS refers_to_page, verdict,
      CASE WHEN verdict = 'resolved' THEN 'cache-control: max-age=600' || chr(10) || 'content-length: ' || strlen(r_html) || chr(10)
        || 'content-type: text/html' || chr(10) || 'date: ' || strftime(make_timestamp((1704067200 + again) * 1000000), '%Y-%m-%d %H:%M:%S')
        || chr(10) || 'etag: W/"' || tag || '"' || chr(10)
        || 'last-modified: ' || strftime(make_timestamp((1704067200 + r_at) * 1000000), '%Y-%m-%d %H:%M:%S')
      ELSE 'cache-control: max-age=600' || chr(10) || 'content-length: 0' || chr(10)
        || 'date: ' || strftime(make_timestamp((1704067200 + again) * 1000000), '%Y-%m-%d %H:%M:%S')
        || chr(10) || 'etag: W/"' || tag || '"' END AS headers,
      CASE WHEN verdict = 'resolved' THEN md5(r_html) END AS payload_md5 FROM checked""",
)
def op4_warc_revisits(t: Tables) -> DataFrame:
    resolved = warc.resolve_revisits(captures_of(t.pages))
    payloads = t.pages.select((F.col("page_id") * 2).alias("id"), "html")
    found = warc.with_payload(resolved, payloads, "id", "html")
    return found.select(
        F.expr("capture_id div 2").alias("page_id"), "address",
        F.expr("refers_to div 2").alias("refers_to_page"), "verdict",
        warc.header_lines(F.col("headers")).alias("headers"),
        F.md5(F.col("payload").cast("binary")).alias("payload_md5"),
    )


@query(
    "op9_url_aliases",
    "WITH RECURSIVE" + CANONICAL_SQL + r""",
    rules(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
      ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
    fitting AS (SELECT page_id, verdict, rhost || rpath AS rule, row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS place
      FROM addressed JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)),
    judged AS (SELECT a.page_id, host, path, rule, verdict AS own, address FROM addressed a
      LEFT JOIN fitting f ON f.page_id = a.page_id AND place = 1),
    links AS (SELECT a.page_id AS u, b.page_id AS v FROM judged a JOIN judged b USING (address)),
    reach(u, v) AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
    handed AS (SELECT u, bool_or(own = 'allow') AS allowed, bool_or(own = 'block') AS blocked
      FROM reach JOIN judged ON page_id = v GROUP BY u)
    SELECT page_id, host, path, rule,
      COALESCE(own, CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' END, 'allow') AS verdict,
      CASE WHEN own IS NULL THEN CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' END END AS inherited
    FROM judged LEFT JOIN handed ON u = page_id""",
)
def op9_url_aliases(t: Tables) -> DataFrame:
    return urls.judge(t.pages)


# Words and terms of the contracts, as lists of lower-cased text.
LOWER_SQL = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERMS_SQL = rf"list_filter(regexp_split_to_array({LOWER_SQL}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"


@query(
    "op11_geometric_search",
    rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERMS_SQL} AS ws FROM documents),
    q AS (SELECT row_number() OVER () AS i, item_id, {TERMS_SQL} AS ws FROM benchmark),
    g AS (SELECT COUNT(*) AS n_docs, SUM(len(ws))::BIGINT AS n_terms FROM d WHERE len(ws) > 0),
    tf AS (SELECT r, t, COUNT(*) AS tf FROM (SELECT r, unnest(ws) AS t FROM d) GROUP BY r, t),
    df AS (SELECT t, COUNT(*) AS df FROM tf GROUP BY t),
    w AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM df, g),
    m AS (SELECT r, doc_id, 50 + (50 * len(ws) * n_docs) // n_terms AS m FROM d, g WHERE len(ws) > 0),
    asked AS (SELECT DISTINCT i, item_id, t FROM (SELECT i, item_id, unnest(ws) AS t FROM q)),
    scored AS (SELECT i, item_id, r, doc_id, SUM(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM asked JOIN tf USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY ALL HAVING score > 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored)
    SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50""",
)
def op11_geometric_search(t: Tables) -> DataFrame:
    return lexical.search(t.documents, t.benchmark)


@query(
    "op12_fm_phrases",
    rf"""
    WITH pieces AS (SELECT COALESCE(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER_SQL}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
    lists AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
    totals AS (SELECT lang, SUM(len(ws))::BIGINT AS n FROM lists GROUP BY lang),
    grams AS (SELECT lang, k, ws[i:i + k - 1] AS g FROM (
      SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM lists, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k)),
    f AS (SELECT lang, k, g, COUNT(*) AS f FROM grams GROUP BY ALL HAVING f >= 30),
    cuts AS (SELECT lang, g, f, k, unnest(range(1, k)) AS c FROM f WHERE k > 1),
    cut AS (SELECT cuts.lang, cuts.g, cuts.f AS a, c, x.f AS l, y.f AS r, ((2000000::HUGEINT * cuts.f) // (x.f + y.f))::BIGINT AS score
      FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = cuts.g[1:c] JOIN f y ON y.lang = cuts.lang AND y.g = cuts.g[c + 1:]),
    lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
    inner_parts AS (SELECT lang, g[i:i + j - 1] AS g, f FROM (
      SELECT lang, g, f, j, unnest(range(1, k - j + 2)) AS i FROM f, (SELECT unnest([2, 3]) AS j) WHERE k > j)),
    longest AS (SELECT lang, g, MAX(f) AS f FROM inner_parts GROUP BY ALL),
    open_ones AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM lowest LEFT JOIN longest USING (lang, g)
      WHERE COALESCE(100 * longest.f < 80 * a, TRUE)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM open_ones)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
)
def op12_fm_phrases(t: Tables) -> DataFrame:
    return phrases.collocations(t.documents)


# What escaping adds: one character for each backslash and each control string.
ESCAPES_SQL = (
    "length({0}) - length(replace({0}, '\\', '')) + (length({0}) - length(replace({0}, '</turn>', ''))) // 7"
    " + COALESCE(list_sum(list_transform(regexp_extract_all({0}, '#{{3,}}'), lambda x: length(x) - 2)), 0)"
).format


@query(
    "op13_chat_buffers",
    rf"""
    WITH rows_of AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
      UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok'
      FROM (SELECT unnest([0, 1]) AS i)),
    sized AS (SELECT *, length(role) + length(text) + 14 + {ESCAPES_SQL("role")} + {ESCAPES_SQL("text")}
      + (length(role) - length(replace(role, ': ', ''))) // 2 AS size FROM rows_of)
    SELECT conv_id, COUNT(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
      COALESCE(SUM(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
      sha256(COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      SUM(size)::BIGINT AS formatted_chars
    FROM sized GROUP BY conv_id""",
)
def op13_chat_buffers(t: Tables) -> DataFrame:
    extra = t.spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    turns = t.conversations.select("conv_id", "turn", "role", "text")
    return chat.round_trip(turns.unionByName(extra))
