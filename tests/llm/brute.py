"""Plain Python versions of the corpus operators, for small tables."""

from __future__ import annotations

import hashlib
import re

SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def contained(documents, items, percent, n):
    out = []
    for doc, text in documents:
        own = shingles(text, n)
        for item, wanted in items:
            need = shingles(wanted, n)
            shared = len(own & need)
            if need and 100 * shared >= percent * len(need):
                out.append((doc, item, len(need), shared))
    return out


def components(documents, percent, n):
    """{id: (size, component)} for unique ids."""
    sets = {doc: shingles(text, n) for doc, text in documents}
    label = {doc: doc for doc in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {doc: (len(sets[doc]), root(doc)) for doc in ids}


def without_repeats(documents, window):
    words = [WORD.findall(text or "") for _, text in documents]
    seen = {}
    for w in words:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for (doc, _), w in zip(documents, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def without_lines(documents, min_docs, min_chars, keep_first=False):
    lines = [(doc, (text or "").split("\n")) for doc, text in documents]
    keys = [[line.strip(" \t\n\x0b\x0c\r").translate(LOWER) for line in ls] for _, ls in lines]
    docs = {}
    for (doc, _), ks in zip(lines, keys, strict=True):
        for k in ks:
            docs.setdefault(k, set()).add(doc)
    first = {}
    for (doc, _), ks in sorted(zip(lines, keys, strict=True), key=lambda x: (x[0][0] is not None, x[0][0] or 0)):
        for i, k in enumerate(ks):
            first.setdefault(k, (doc, i))
    out = []
    for (doc, ls), ks in zip(lines, keys, strict=True):
        gone = {
            i
            for i, k in enumerate(ks)
            if len(k) >= min_chars and len(docs[k]) >= min_docs and not (keep_first and first[k] == (doc, i))
        }
        out.append((doc, len(ls), len(gone), sha("\n".join(x for i, x in enumerate(ls) if i not in gone))))
    return out


def exact(documents):
    groups = {}
    for doc, text in documents:
        groups.setdefault(SPACE.sub("", text or ""), []).append((-len(text or ""), doc is None, doc or 0, doc))
    out = []
    for norm, rows in groups.items():
        rows.sort(key=lambda r: r[:3])
        out += [(row[3], rows[0][3], len(rows), i == 0, sha(norm)) for i, row in enumerate(rows)]
    return out
