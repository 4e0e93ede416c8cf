"""Plain single-process versions of the text operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def substring(docs: list[tuple], size: int = 35) -> list[tuple]:
    """docs: (doc_id, text); rows: (doc_id, n_words, n_removed, kept_sha256)."""
    all_words = [words(t) for _, t in docs]
    seen = Counter(tuple(w[i:i + size]) for w in all_words for i in range(len(w) - size + 1))
    out = []
    for (doc_id, _), w in zip(docs, all_words):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i:i + size])] > 1:
                gone[i:i + size] = [True] * size
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((doc_id, len(w), sum(gone), sha(" ".join(kept))))
    return out


def suffix(docs: dict, size: int = 100) -> dict:
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256)."""
    seen, out = set(), {}
    for doc_id in sorted(docs):
        data = (docs[doc_id] or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - size + 1):
            if data[i:i + size] in seen:
                gone[i:i + size] = b"\1" * size
            else:
                seen.add(data[i:i + size])
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc_id] = (len(data), sum(gone), spans, sha(bytes(x for x, g in zip(data, gone) if not g)))
    return out


def quality_counts(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text, w, seen, again = text or "", words(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    found = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = [False] * len(w)
    for i in range(len(w) - 7):
        if found[tuple(w[i:i + 8])] > 1:
            inside[i:i + 8] = [True] * 8
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, sum(inside),
            len(w) < 20 or 100 * sum(inside) > 30 * len(w))


def shingle_set(text: str | None) -> set:
    w = words((text or "").translate(LOWER))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def jaccard(docs: dict) -> dict:
    """doc_id -> (n_shingles, component_id)."""
    sets, lists, parent = {k: shingle_set(t) for k, t in docs.items()}, defaultdict(list), {k: k for k in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k in sorted(sets):
        shared = Counter()
        for s in sets[k]:
            shared.update(lists[s])
            lists[s].append(k)
        for other, n in shared.items():
            if 100 * n >= 75 * (len(sets[k]) + len(sets[other]) - n):
                a, b = sorted((root(k), root(other)))
                parent[b] = a
    return {k: (len(sets[k]), root(k)) for k in docs}


ASCII_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def license_shingles(text: str | None) -> list:
    w = [x.lower() for x in ASCII_WORD.findall((text or "").encode())]
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]


def licenses(text: str | None, templates: tuple, containment: float = 0.75) -> list[str]:
    """Every window of two blocks against every template."""
    have, out = license_shingles(text), set()
    for name, template in templates:
        want = license_shingles(template)
        stride = 1 << (len(want) - 1).bit_length()
        for at in range(0, len(have), stride):
            if len(set(want) & set(have[at:at + 2 * stride])) >= containment * len(set(want)):
                out.add(name)
    return sorted(out)


def targets(sizes: dict, weights: tuple = (3, 1, 2), budget: float = 1.5, epochs: float = 2) -> dict:
    """Water-filling by rounds: clamp what is above its cap, share the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    open_, out, left = set(names), {}, budget * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / total > epochs * sizes[s] + 1e-9]
        if not above:
            return out | {s: left * weight[s] / total for s in open_}
        for s in above:
            out[s] = float(epochs * sizes[s])
        left -= sum(out[s] for s in above)
        open_ -= set(above)
    return out
