"""Plain Python versions of the contracts, for comparison on small tables."""

import hashlib
import re
from collections import Counter

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACE_WORDS = re.compile(r"[^\x20\t-\r]+")
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs, items):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)} of (doc_id, text) and (item_id, text) rows."""
    windows = {}
    for item, text in items:
        words = ITEM_WORDS.findall((text or "").translate(LOWER))
        if item is None or not words:
            continue
        m = min(13, len(words))
        for i in range(len(words) - m + 1):
            windows.setdefault(tuple(words[i : i + m]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        words = ITEM_WORDS.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for m in lengths:
            for i in range(len(words) - m + 1):
                got = windows.get(tuple(words[i : i + m]))
                if got:
                    found |= got
                    hit.update(range(i, i + m))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc] = (len(words), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(words))
    return out


def line_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed of one text."""
    text = text or ""
    words = SPACE_WORDS.findall(text)
    lines = [x for x in text.split("\n") if SPACE_WORDS.search(x)]
    threes = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if threes[tuple(words[i : i + 3])] > 1 for k in range(3)}
    n = len(words)
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def lines_verdict(rows, least=20, left=30):
    """kept of every (host, text) row."""
    texts = {(h, t) for h, t in rows if SPACE_WORDS.search(t or "")}
    norm = lambda x: " ".join(SPACE_WORDS.findall(x.translate(LOWER)))
    found = Counter()
    for h, t in texts:
        found.update({(h, norm(x)) for x in t.split("\n") if norm(x)})
    out = []
    for h, t in rows:
        words = SPACE_WORDS.findall(t or "")
        gone = sum(
            len(norm(x).split(" ")) for x in (t or "").split("\n")
            if norm(x) and found[h, norm(x)] > least
        )
        out.append(not line_counts(t)[5] and 100 * (len(words) - gone) >= left * len(words))
    return out


def shingles(text):
    words = SPACE_WORDS.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def similar_components(docs):
    """{doc_id: (n_shingles, component_id)} by comparing every pair of sets."""
    sets = {d: shingles(t) for d, t in docs}
    label = {d: d for d in sets}
    order = sorted(sets)
    links = [
        (a, b) for i, a in enumerate(order) for b in order[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    while True:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return {d: (len(sets[d]), label[d]) for d in sets}


def level_targets(sizes, weights=(5, 2, 1), limit=3):
    """{source: target} by resharing the excess step by step."""
    sources = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    total = sum(sizes.values())
    target, full = {}, set()
    while True:
        rest = total - sum(limit * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in sources if s not in full)
        for s in sources:
            target[s] = limit * sizes[s] if s in full else rest * weight[s] / open_weight
        more = {s for s in sources if s not in full and target[s] > limit * sizes[s]}
        if not more:
            return target
        full |= more
