"""Literal readings of the operators, for comparison on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import tiktoken
import xxhash

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def union(n, pairs):
    """The smallest member of each one's component."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def base_scores(docs):
    tokens = [(d, BLANK_WORD.findall(lower(t)) + [""]) for d, t in docs]
    out = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in docs]
    counts = Counter(w for (_, ws), o in zip(tokens, out) if not o for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    for (d, ws), o in zip(tokens, out):
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws)
        yield d, o, len(ws), sum(counts[w] > 0 for w in ws), total, base


def encoding(path, pattern):
    import base64

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def fingerprint(text):
    words = BLANK_WORD.findall(lower(text))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(docs, radius=4):
    prints = [fingerprint(t) for _, t in docs]
    near = [
        (i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= radius
    ]
    roots = union(len(docs), near)
    first = {}
    for (d, _), root in zip(docs, roots):
        if d is not None:
            first[root] = min(d, first.get(root, d))
    return [(d, format(p, "016x"), first.get(r)) for (d, _), p, r in zip(docs, prints, roots)]


def quality(text):
    words = BLANK_WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if BLANK_WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)


PHRASES = {
    "gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by",
    "mit license": "mit",
}


def phrases(text):
    words = WORD.findall(lower(text))
    starts, labels = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                starts.append(i)
                labels.add(label)
    ends = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), *ends, ",".join(sorted(labels))


def leaks(docs, items):
    patterns = {}
    for item, text in items:
        words = WORD.findall(lower(text))
        for i in range(max(1, len(words) - 9) if words else 0):
            patterns.setdefault(tuple(words[i : i + 10]), set()).add(item)
    for d, text in docs:
        words = WORD.findall(lower(text))
        hit, found = set(), set()
        for pattern, ids in patterns.items():
            for i in range(len(words) - len(pattern) + 1):
                if tuple(words[i : i + len(pattern)]) == pattern:
                    hit.update(range(i, i + len(pattern)))
                    found |= ids
        yield d, len(words), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text):
    spans = []
    for kind, form in FORMS.items():
        for m in re.finditer(form, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append(f"{kind}:{m.start()}:{m.end()}")
    return spans
