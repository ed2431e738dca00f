"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACES = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = float("inf")


def place(i):
    """Null ids sort after all others."""
    return LAST if i is None else i


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def line_dedup(rows, min_chars=10):
    """rows: (id, text) -> list of (id, n_lines, n_dropped, kept)."""
    key = lambda line: line.strip(SPACES).translate(LOWER)
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                held[key(line)].add(place(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(held[key(x)]) >= 2 and place(i) != min(held[key(x)]))]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, r = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), r,
            n < 10 or 100 * r > 20 * n)


def shingles(text, words):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < words:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)}


def link_groups(rows, words, pct):
    """rows: (id, text) -> list of (id, n_shingles, component_id), one per row."""
    sets = [shingles(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= pct * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        low[find(k)] = min(low.get(find(k), LAST), place(i))
    return [(i, len(sets[k]), None if low[find(k)] == LAST else low[find(k)]) for k, (i, _) in enumerate(rows)]


def remove_repeats(rows, length):
    """rows: (id, text) -> list of (id, n_bytes, n_removed, n_spans, sha), one per row."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            first[w] = min(first.get(w, LAST), place(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < place(i):
                gone[p:p + length] = b"\x01" * length
        runs = len(re.findall(b"\x01+", bytes(gone)))
        out.append((i, len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    return out


def targets(sizes: dict, weights=(5, 2, 1), repeat=3):
    """Water filling, one source at a time."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(repeat * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        if not open_:
            break
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > repeat * sizes[s]]
        if not over:
            break
        capped |= set(over)
    return {s: float(repeat * sizes[s]) if s in capped else share[s] for s in names}


def bag(rows):
    return Counter(tuple(r) for r in rows)


def judged(rows):
    """rows: (id, text, host) -> list of (verdict of the host, kept), in order."""
    facts = []
    for _, text, host in rows:
        n, chars, symbols, dup, _, base = quality(text)
        facts.append((host, n, chars, symbols, dup, base, base or 100 * symbols > 10 * chars or 100 * dup > 30 * n))
    hosts = defaultdict(list)
    for f in facts:
        hosts[f[0]].append(f[-1])
    docs, failed = len(facts), sum(f[-1] for f in facts)
    mean = failed / docs
    between = sum(sum(x) ** 2 / len(x) for x in hosts.values()) / docs - mean ** 2 - mean * (1 - mean) * len(hosts) / docs
    most = max(1.0, docs / len(hosts))
    strength = min(most, max(1.0, mean * (1 - mean) / between - 1)) if between > 0 else most
    verdict = {}
    for h, x in hosts.items():
        rate = (sum(x) + mean * strength) / (len(x) + strength)
        sd = (rate * (1 - rate) / (len(x) + strength + 1)) ** 0.5
        verdict[h] = "clean" if rate + 2 * sd < 0.5 * mean else "bad" if rate - 2 * sd > 2 * mean else "usual"
    out = []
    for host, n, chars, symbols, dup, base, _ in facts:
        k = {"clean": 0, "usual": 100, "bad": 200}[verdict[host]]
        out.append((verdict[host], not (base or k * symbols > 10 * chars or k * dup > 30 * n)))
    return out
