"""Plain single-process versions of the operators, for comparison."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall(text or "")


def simhash(text, k=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = words_of(text)
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def components(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_duplicates(rows, k=3, radius=2):
    fps = {i: simhash(t, k) for i, t in rows}
    ids = sorted(fps)
    pairs = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:] if bin(fps[a] ^ fps[b]).count("1") <= radius]
    root = components(pairs, ids)
    return sorted((i, f"{fps[i]:016x}", root[i]) for i in ids)


def without_repeats(rows, window=35):
    """(id, n_words, n_removed, kept words) per row, in the order given."""
    places = Counter()
    split = [(i, words_of(t)) for i, t in rows]
    for _, words in split:
        places.update(tuple(words[j:j + window]) for j in range(len(words) - window + 1))
    out = []
    for i, words in split:
        gone = set()
        for j in range(len(words) - window + 1):
            if places[tuple(words[j:j + window])] > 1:
                gone.update(range(j, j + window))
        out.append((i, len(words), len(gone), " ".join(w for j, w in enumerate(words) if j not in gone)))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def multiset_similarity(a, b):
    a, b = Counter(a), Counter(b)
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


__all__ = ["components", "defaultdict", "multiset_similarity", "near_duplicates", "sha", "simhash", "without_repeats",
           "words_of"]


def cheapest_repair(rows):
    """(cost, audit, repaired (role, text) rows) of rows in order, each
    (role, text, fault); fault is "", "blank", "duplicate" or "truncated".
    Costs to the end by relaxing all edits until nothing changes, then the
    least letter that keeps the cost, one at a time."""
    turn = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def edits(i, state):
        for role in ("user", "assistant"):
            if (state, role[0]) in turn:
                yield "I", 3, (i, turn[state, role[0]]), (role, "")
        if i == len(rows):
            return
        role, text, fault = rows[i]
        yield "D", 4, (i + 1, state), None
        if fault in ("blank", "duplicate"):
            return
        extra = 3 * (fault == "truncated")
        for new in ("user", "assistant"):
            if (state, new[0]) in turn:
                yield "R", 3 + extra, (i + 1, turn[state, new[0]]), (new, text)
        if role == "" or (state, role[0]) in turn:
            yield "K", extra, (i + 1, turn[state, role[0]] if role else state), (role, text)

    to_end = {(i, s): 0 if i == len(rows) and s in ("", "a") else 10 ** 9 for i in range(len(rows) + 1) for s in ("", "s", "u", "a")}
    for i in reversed(range(len(rows) + 1)):
        for _ in range(4):
            for s in ("", "s", "u", "a"):
                to_end[i, s] = min([to_end[i, s], *(c + to_end[to] for _, c, to, _ in edits(i, s))])
    at, audit, out = (0, ""), "", []
    while to_end[at] or at[0] < len(rows):
        letter, _, at, row = min(((a, c, to, r) for a, c, to, r in edits(*at) if c + to_end[to] == to_end[at]), key=lambda e: e[0])
        audit, out = audit + letter, out + [row] * (row is not None)
    return to_end[0, ""], audit, out


def repair_of(rows):
    """Expected row of the report for one conversation's damaged rows
    (turn, role, text)."""
    blanks = " \t\n\v\f\r"
    rows = sorted(((t, r or " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, marked = set(), []
    for t, role, text in rows:
        bare = text.strip(blanks)
        fault = ("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
        marked.append((role, text, fault))
    turns = [t for t, _, _ in rows if t is not None]
    faults = [f for _, _, f in marked]
    cost, audit, out = cheapest_repair(marked)
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:])),
            "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()}
