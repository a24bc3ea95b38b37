"""The operators by definition, for small inputs."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import xxhash

from siltline.llm import decontaminate, quality_rules, secrets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


# --- quality rules ---


def base(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    ws = words(text)
    windows = [tuple(ws[i : i + 8]) for i in range(len(ws) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
    )


def histograms(text, lang):
    text = text or ""
    kinds = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\n\x0b\x0c\r",
             quality_rules.SYMBOLS, quality_rules.POINTS]
    chars = [sum(c in k for c in text) for k in kinds]
    chars.append(len(text) - sum(chars))
    common = quality_rules.COMMON_WORDS.get(lang)
    if common is None:
        return chars, None
    import regex

    plain = regex.split(r"[^\p{L}]+", text.lower())
    hits = [plain.count(w) for w in common]
    return chars, [*hits, max(len(words(text)) - sum(hits), 0)]


def distance(p, q):
    if not p or not q or not sum(p) or not sum(q):
        return 0.0
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    total = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        total += (a * math.log2(a / m) if a else 0) / 2 + (b * math.log2(b / m) if b else 0) / 2
    return math.sqrt(max(total, 0))


def verdicts(docs):
    """{doc_id: (base..., base_failed, kept)} of (doc_id, text, lang) rows."""
    sums = {}
    for _, text, lang in docs:
        if len(words(text)) >= quality_rules.CHAR_GUARD:
            key = lang if lang in quality_rules.COMMON_WORDS else None
            for k, h in enumerate(histograms(text, lang)):
                if h:
                    parts = [math.floor(1_000_000 * x / max(sum(h), 1)) for x in h]
                    old = sums.get((key, k), [0] * len(h))
                    sums[key, k] = [x + y for x, y in zip(old, parts)]
    out = {}
    for doc_id, text, lang in docs:
        counts = base(text)
        n, repeated = counts[0], counts[4]
        failed = n < 20 or 100 * repeated > 30 * n
        key = lang if lang in quality_rules.COMMON_WORDS else None
        chars, bins = histograms(text, lang)
        far = n >= quality_rules.CHAR_GUARD and distance(chars, sums.get((key, 0))) > quality_rules.MAX_CHAR_DISTANCE
        far = far or (
            n >= quality_rules.WORD_GUARD and distance(bins, sums.get((key, 1))) > quality_rules.MAX_WORD_DISTANCE
        )
        out[doc_id] = (*counts, failed, not failed and not far)
    return out


# --- SimHash ---


def fingerprint(text):
    ws = words((text or "").translate(LOWER))
    shingles = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] if len(ws) >= 3 else [" ".join(ws)] if ws else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes) > 0)


def components(nodes, radius=3):
    """{node: smallest node reachable} of distinct numbers."""
    nodes = sorted(nodes)
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = np.array(nodes, np.uint64)
    for i, x in enumerate(nodes):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= radius):
            a, b = root(x), root(nodes[i + 1 + int(j)])
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


def near_duplicates(docs, radius=3):
    """{doc_id: (fingerprint, component_id)} of (doc_id, text) rows."""
    prints = {d: fingerprint(t) for d, t in docs}
    roots = components(set(prints.values()), radius)
    least = {}
    for d, f in prints.items():
        least[roots[f]] = min(d, least.get(roots[f], d))
    return {d: (f, least[roots[f]]) for d, f in prints.items()}


# --- decontamination ---


def shingles(text):
    import regex

    ws = words(regex.sub(r"[^\p{L}\p{N}\x20\x09-\x0D]+", "", (text or "").lower()))
    return [tuple(ws[i : i + 5]) for i in range(max(len(ws) - 4, 1))] if ws else []


def leaks(docs, items):
    """{(doc_id, item_id): highest similarity} over all windows of the item's length."""
    told = [(i, shingles(t)) for i, t in items]
    texts = {tuple(s) for _, s in told}
    holders = Counter(x for s in texts for x in set(s))
    out = {}
    for doc_id, text in docs:
        have = shingles(text)
        for item_id, s in told:
            if not set(s) & set(have):  # no window can resemble the item
                continue
            want = Counter(s)
            best = 0.0
            for at in range(max(len(have) - len(s) + 1, 1)):
                seen = Counter(have[at : at + len(s)])
                both = sum(min(n, seen[x]) / holders[x] for x, n in want.items())
                either = sum(max(n, seen[x]) / holders[x] for x, n in want.items())
                either += sum(n for x, n in seen.items() if x not in want)
                best = max(best, both / either)
            if best >= decontaminate.SIMILARITY:
                out[doc_id, item_id] = best
    return out


# --- secrets ---


def base_spans(text):
    """Sorted (start, end, kind) of strong candidates."""
    found = []
    for kind, pattern, group, least in (
        ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
        ("access", r"AKIA[A-Z0-9]+", 0, 16),
        ("hex", r"[0-9a-f]+", 0, 32),
    ):
        for m in re.finditer(pattern, text or "", re.A):
            if len(m[group]) >= least:
                found.append((m.start(), m.end(), secrets.KINDS.index(kind)))
    return sorted(found)


def all_spans(text):
    """All spans: weak candidates count if a scope holds a secret and what completes it."""
    text = text or ""
    strong = base_spans(text)
    weak = [
        (m.start(), m.end(), secrets.KINDS.index(kind))
        for kind, pattern in secrets.WEAK.items()
        for m in re.finditer(pattern, text, re.A)
    ]
    half = secrets.SCOPE // 2
    scopes = lambda s: {s[0] // half, s[0] // half - 1}
    is_secret = lambda s: secrets.KINDS[s[2]] in secrets.SECRETS
    inside = lambda some: set().union(*map(scopes, some)) if some else set()
    met = inside([s for s in strong + weak if is_secret(s)]) & inside([s for s in strong + weak if not is_secret(s)])
    return sorted(strong + [w for w in weak if scopes(w) & met])


def masked(text):
    out, at = [], 0
    for start, end, _ in all_spans(text):
        if start > at or not out:
            out.append(text[at:start] if start > at else "")
        at = max(at, end)
    return secrets.MASK.join([*out, text[at:]]) if out else text
