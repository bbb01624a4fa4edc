"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import re

import numpy as np
import pyarrow as pa

from estrato.llm import bagminhash, linetemplates
from estrato.llm.common import word_hashes

WORD = r"[^\x20\x09-\x0D]+"

PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text: str | None) -> list[str]:
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def repeated_passages(rows, length=35):
    words = [re.findall(WORD, t or "") for _, t in rows]
    seen = collections.Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        out.append((doc, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def near_classes(rows, words=5, similarity=0.8):
    """(doc_id, class_id) from all pairs that share a shingle."""
    doc, hashes, weights = bagminhash.bags(pa.array([t for _, t in rows], pa.string()), words)
    bags = [bagminhash.elements(hashes[doc == i], weights[doc == i]).tolist() for i in range(len(rows))]
    parent, postings = list(range(len(rows))), collections.defaultdict(list)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, bag in enumerate(bags):
        common = collections.Counter(j for x in bag for j in postings[x])
        for j, both in common.items():
            if both >= similarity * (len(bag) + len(bags[j]) - both) - 1e-9:
                parent[find(i)] = find(j)
        for x in bag:
            postings[x].append(i)
    members = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        members[find(i)].append(d)
    return [(d, min((x for x in members[find(i)] if x is not None), default=None) if bags[i] else d) for i, (d, _) in enumerate(rows)]


def without_lines(rows, depth=3, texts=20, constant=0.6, short=5, least=2, long=20, copies=2):
    """(doc_id, kept text, lines gone) by an in-memory tree of words."""

    def masked(line):
        return tuple("0" if re.search("[0-9]", w) else w for w in line)

    first_id = {}
    for doc, text in rows:
        if text is not None:
            known = [x for x in (first_id.get(text), doc) if x is not None]
            first_id[text] = min(known, default=None)
    lines = {(t, i): re.findall(WORD, line) for t in first_id for i, line in enumerate(t.split("\n"))}
    lines = {at: words for at, words in lines.items() if words}
    groups = collections.defaultdict(list)
    for at, words in lines.items():
        groups["equal", tuple(words)].append(at)
    leaves = collections.defaultdict(list)
    for at, words in lines.items():
        leaves[len(words), masked(words[:depth])].append(at)
    for leaf, members in leaves.items():
        if leaf[0] <= max(short, depth) or len({t for t, _ in members}) < texts:
            continue
        often = collections.Counter((p, w) for at in members for p, w in enumerate(masked(lines[at])))
        shapes = {at: tuple(w if often[p, w] >= texts else None for p, w in enumerate(masked(lines[at])))[depth:] for at in members}

        def enough(words):
            return sum(w is not None for w in words) >= constant * (leaf[0] - depth) and sum(w not in (None, "0") for w in words) >= least

        shapes = {at: s for at, s in shapes.items() if enough(s)}
        counts = collections.Counter(shapes.values())
        head = _hashes(leaf[1])
        found = []
        for shape in sorted(counts, key=lambda s: (-counts[s], head + _hashes(s))):
            shared = [tuple(a if a == b else None for a, b in zip(t, shape)) for t in found]
            best = max(range(len(found)), key=lambda i: (enough(shared[i]), sum(w is not None for w in shared[i]), -i), default=None)
            if best is not None and enough(shared[best]):
                found[best] = shared[best]
            else:
                found.append(shape)
        for at, shape in shapes.items():
            fits = [t for t in found if all(a is None or a == b for a, b in zip(t, shape))]
            groups["template", leaf, max(fits, key=lambda t: sum(w is not None for w in t))].append(at)
    gone = collections.defaultdict(set)
    for (kind, *key), members in groups.items():
        where = {t for t, _ in members}
        if len(where) >= (copies if kind == "equal" and len(key[0]) >= long else texts):
            first = min(where, key=lambda t: (first_id[t] is None, first_id[t] or 0, hashlib.md5(t.encode()).digest()))
            for text, number in members:
                if text != first:
                    gone[text].add(number)

    def kept(text):
        return text if text not in gone else "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone[text])

    return [(d, kept(t), len(gone.get(t, ()))) for d, t in rows]


def _hashes(words):
    """Only to order shapes that are as frequent: the operator has no words, but their hashes."""
    out = []
    for w in words:
        data = np.frombuffer((w or "").encode(), np.uint8)
        known = {None: linetemplates.VARIABLE, "0": linetemplates.WILD}
        out.append(known[w] if w in known else int(word_hashes(data, np.array([0]), np.array([len(data)])).view(np.int64)[0]))
    return out


def top(ids, rows, query_ids, k, score):
    """{query: [(id, score)]} by comparing with everything."""
    out = {}
    for q in query_ids:
        values = score(rows, rows[list(ids).index(q)])
        order = [j for j in np.lexsort((ids, -values)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), values[j]) for j in order]
    return out
