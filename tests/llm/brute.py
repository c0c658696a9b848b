"""Plain Python versions of the corpus contracts, for comparison on small tables."""
from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return (text or "").translate(UPPER)


def quality_counts(text):
    text = text or ""
    words = BLANK.findall(text)
    lines = [line for line in text.split("\n") if BLANK.search(line)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in lines:
        repeated += line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(hit)


def fingerprint(text):
    words = BLANK.findall(lowered(text))
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: dict, radius=2):
    parent = {k: k for k in prints}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {k: top(k) for k in keys}


def removed(texts: list, length=400):
    """(bytes, removed, spans, sha256 of the rest) for each text."""
    bodies = [(t or "").encode() for t in texts]
    counts = Counter(b[s:s + length] for b in bodies for s in range(len(b) - length + 1))
    out = []
    for body in bodies:
        covered = bytearray(len(body))
        for s in range(len(body) - length + 1):
            if counts[body[s:s + length]] > 1:
                covered[s:s + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(covered)))
        rest = bytes(c for c, gone in zip(body, covered) if not gone)
        out.append((len(body), sum(covered), spans, hashlib.sha256(rest).hexdigest()))
    return out


def contamination(texts: list, items: list, window=13):
    """(words, hit words, item ids) for each text; `items` are (id, text)."""
    wanted = {}
    for item, text in items:
        words = ALNUM.findall(lowered(text))
        n = min(window, len(words))
        for s in range(len(words) - n + 1 if n and item is not None else 0):
            wanted.setdefault(tuple(words[s:s + n]), set()).add(str(item))
    sizes = {len(w) for w in wanted}
    out = []
    for text in texts:
        words, hit, found = ALNUM.findall(lowered(text)), set(), set()
        for n in sizes:
            for s in range(len(words) - n + 1):
                ids = wanted.get(tuple(words[s:s + n]))
                if ids:
                    hit.update(range(s, s + n))
                    found |= ids
        out.append((len(words), len(hit), sorted(found)))
    return out


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def license_base(text):
    words = ALNUM.findall(lowered(text))
    places = sorted((i, label) for phrase, label in PHRASES.items() for i in range(len(words))
                    if words[i:i + len(phrase.split())] == phrase.split())
    return (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
            sorted({label for _, label in places}))


def license_labels(text, signatures):
    """Labels of the spans that are left, by the rules of the scan."""
    line = " ".join(ALNUM.findall(lowered(text)))
    spans = sorted((m.start(), -m.end(), priority, -confidence, label) for label, priority, keyword, confidence, pattern in signatures
                   if keyword in line for m in re.finditer(pattern, line))
    kept = []
    for start, back, priority, doubt, label in spans:
        if kept and -back <= kept[-1][1] and priority >= kept[-1][2]:
            continue
        if kept and start < kept[-1][1] and priority != kept[-1][2]:
            if priority > kept[-1][2]:
                continue
            kept.pop()
        kept.append((start, -back, priority, label, -doubt))
    return kept
