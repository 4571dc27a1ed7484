"""Plain versions of the operators, for comparison on small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality_counts(text):
    text = text or ""
    own = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(own[i:i + 5]) for i in range(len(own) - 4)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return (len(own), sum(map(len, own)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(inside))


def line_dedup(rows, run=2, least_chars=60):
    """{key: (lines, removed, text)} for unique keys."""
    seen, gone = set(), defaultdict(set)
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        own = [(i, x) for i, x in enumerate((text or "").split("\n")) if words(x)]
        for s in range(len(own) - run + 1):
            part = tuple(x for _, x in own[s:s + run])
            if part in seen:
                gone[key].update(i for i, _ in own[s:s + run])
            seen.add(part)
        for i, x in own:
            if len(x) >= least_chars:
                if x in seen:
                    gone[key].add(i)
                seen.add(x)
    out = {}
    for key, text in rows:
        lines = [] if text is None else text.split("\n")
        left = None if text is None else "\n".join(
            x for i, x in enumerate(lines) if i not in gone[key])
        out[key] = (len(lines), len(gone[key]), left)
    return out


def near_duplicates(rows, percent=85):
    """{key: (set size, component)} for unique keys."""
    sets = {}
    for key, text in rows:
        own = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
        sets[key] = frozenset(
            [tuple(own[i:i + 5]) for i in range(len(own) - 4)] if len(own) >= 5
            else [tuple(own)] if own else [])
    above = {k: k for k in sets}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    keys = sorted(k for k in sets if sets[k])
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = top(a), top(b)
                above[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), top(k)) for k in sets}


def repeats(rows, window=100):
    """{key: (bytes, removed, runs, bytes left)} for unique keys."""
    seen, out = {}, {}
    for key, text in sorted(rows):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for i in range(len(data) - window + 1):
            part = data[i:i + window]
            if part in seen:
                covered[i:i + window] = b"\1" * window
            seen.setdefault(part, (key, i))
        left = bytes(x for x, c in zip(data, covered, strict=True) if not c)
        runs = sum(1 for i, c in enumerate(covered) if c and not (i and covered[i - 1]))
        out[key] = (len(data), len(data) - len(left), runs, left)
    return out


def chat(turns):
    """{conversation: (turns, digest, loss length, loss digest)}."""
    grouped = defaultdict(list)
    for conv, turn, role, text in turns:
        grouped[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, own in grouped.items():
        own.sort()
        whole = "".join(f"{r}\n{t}\n" for _, r, t in own)
        loss = "".join(t for _, r, t in own if r == "assistant")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
        out[conv] = (len(own), sha[0], len(loss), sha[1])
    return out
