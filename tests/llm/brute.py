"""The operators again, one row at a time, as their contracts state them."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


def held_out(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds == 0


def exact_duplicates(rows):
    """rows: (doc_id, text); sorted (doc_id, keep_id, group_size, kept, sha256)."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [x for x in ids if x is not None]
        keep = min(known) if known else None
        stays = False
        for doc_id in ids:
            kept = doc_id == keep and not stays
            stays |= kept
            out.append((doc_id, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return out


def shingle_set(text, size):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) or frozenset([tuple(w)])


def jaccard_components(rows, size, num, den):
    """{doc_id: (n_shingles, component_id)} for rows with distinct ids."""
    sets = {doc_id: shingle_set(text, size) for doc_id, text in rows}
    parent = {doc_id: doc_id for doc_id in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for doc_id, own in sets.items():
        for shingle in own:
            where[shingle].append(doc_id)
    seen = Counter()
    for ids in where.values():
        for k, a in enumerate(ids):
            for b in ids[:k]:
                seen[a, b] += 1
    for (a, b), both in seen.items():
        if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {doc_id: (len(own), root(doc_id)) for doc_id, own in sets.items()}


def base_scores(rows):
    """{doc_id: (n_tokens, n_known, train_tokens, base_score)}, with "\0" as the end token."""
    tokens = {doc_id: [*words(text), "\0end"] for doc_id, text in rows}
    counts = Counter(x for doc_id, own in tokens.items() if not held_out(doc_id, 10) for x in own)
    n, v = sum(counts.values()), len(counts)
    return {
        doc_id: (
            len(own),
            sum(counts[x] > 0 for x in own),
            n,
            sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in own),
        )
        for doc_id, own in tokens.items()
    }
