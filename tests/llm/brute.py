"""What the operators must return, computed the plain way in memory."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def lower(text):
    return (text or "").translate(LOWER)


def marked(sequences, width):
    """For each sequence, which symbols are covered by a window that also starts elsewhere."""
    count = Counter(s[i : i + width] for s in sequences for i in range(len(s) - width + 1))
    out = []
    for s in sequences:
        hit = [False] * len(s)
        for i in range(len(s) - width + 1):
            if count[s[i : i + width]] > 1:
                hit[i : i + width] = [True] * width
        out.append(hit)
    return out


def byte_repeats(texts, width):
    """n_bytes, n_removed, n_spans, kept bytes of each text."""
    bodies = [(t or "").encode() for t in texts]
    out = []
    for body, hit in zip(bodies, marked(bodies, width), strict=True):
        kept = bytes(b for b, h in zip(body, hit, strict=True) if not h)
        spans = sum(h and not p for h, p in zip(hit, [False, *hit], strict=False))
        out.append((len(body), sum(hit), spans, kept))
    return out


def word_repeats(texts, width):
    """n_words, n_removed, kept text of each text."""
    bodies = [tuple(SPACED.findall(t or "")) for t in texts]
    return [
        (len(b), sum(hit), " ".join(w for w, h in zip(b, hit, strict=True) if not h))
        for b, hit in zip(bodies, marked(bodies, width), strict=True)
    ]


def contamination(texts, items, width):
    """n_words, n_hit, ids of hit items of each text."""
    patterns = defaultdict(set)
    for item, text in items:
        words = WORDS.findall(lower(text))
        n = min(width, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            patterns[tuple(words[i : i + n])].add("" if item is None else str(item))
    sizes = {len(p) for p in patterns}
    out = []
    for text in texts:
        words = WORDS.findall(lower(text))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (ids := patterns.get(tuple(words[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= ids
        out.append((len(words), len(hit), sorted(found)))
    return out


def shingles(text, n=5):
    words = SPACED.findall(lower(text))
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def classes(texts):
    """For each text the index of the first text of its component, by links of J >= 0.75."""
    sets = [shingles(t) for t in texts]
    where = defaultdict(list)
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, mine in enumerate(sets):
        shared = Counter(j for s in mine for j in where[s])
        for j, both in shared.items():
            if 100 * both >= 75 * (len(mine) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for s in mine:
            where[s].append(i)
    return [root(i) for i in range(len(texts))]


def base_places(text, base):
    """Places and labels of the base phrases of the license scan, and the number of words."""
    words = WORDS.findall(lower(text))
    places, labels = [], set()
    for phrase, label in base:
        for i in range(len(words) - len(phrase) + 1):
            if tuple(words[i : i + len(phrase)]) == phrase:
                places.append(i)
                labels.add(label)
    return len(words), sorted(places), sorted(labels)


def likeness(a, b):
    """Generalised Jaccard similarity of the word counts of two texts."""
    x, y = (Counter(re.split(r"[ \n\t\r]+", t or "")) for t in (a, b))
    return sum((x & y).values()) / sum((x | y).values())


def license_spans(text, templates, k, drift, cover):
    """(first word, last word, label, share of the template's runs) of each span, sorted."""
    words = WORDS.findall(lower(text))
    out = []
    for label, body in templates:
        template = WORDS.findall(lower(body))
        n = len(template) - k + 1
        votes = defaultdict(list)
        for i in range(len(words) - k + 1):
            for t in range(n):
                if words[i : i + k] == template[t : t + k]:
                    votes[i - t].append((i, t))
        bands = []
        for diagonal in sorted(votes):
            if bands and diagonal - bands[-1][-1] <= drift:
                bands[-1].append(diagonal)
            else:
                bands.append([diagonal])
        for band in bands:
            found = sum(len({t for _, t in votes[d]}) for d in band)
            places = [i for d in band for i, _ in votes[d]]
            share = min(1.0, found / n)
            if share >= cover and max(places) - min(places) < 2 * n + 2 * k:
                out.append((min(places), max(places) + k - 1, label, share))
    return sorted(out)
