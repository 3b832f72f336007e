"""Brute-force user-wise k-anonymity (test oracle for the iterative loop).

Plain Python over (user, course) rows, written from the operator semantics:
course sets, rare sets (< k users), candidate drops of n positions scored by
entropy loss over the rare users, greedy application, then deletion of the
users still rare.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import combinations


def _entropy(counts) -> float:
    counts = [c for c in counts if c > 0]
    total = sum(counts)
    return -sum(c / total * math.log2(c / total) for c in counts) if total else 0.0


def user_k_anonymity(rows, k, strategy="single", max_comb=1, shadow_k=False):
    """Returns (kept rows after deleting still-rare users, tally per course)."""
    sets = {}
    for user, course in rows:
        if user is not None:
            sets.setdefault(user, set())
            if course is not None:
                sets[user].add(course)
    courses = sorted({c for s in sets.values() for c in s})
    current = {u: frozenset(s) for u, s in sets.items()}
    dropped = set()
    n_comb = 1
    while True:
        counts = Counter(s for s in current.values() if s)
        flagged = {c: n for c, n in counts.items() if n < k}
        if not flagged:
            break
        safe = {c for c, n in counts.items() if n >= k}
        h_before = _entropy(flagged.values())
        best = None
        for positions in combinations(range(len(courses)), n_comb):
            d = frozenset(courses[i] for i in positions)
            post = Counter()
            for c, n in flagged.items():
                post[c - d] += n
            loss = h_before - _entropy(post.values())
            accepted = {c for c in flagged if c & d and (
                post[c - d] >= ((len(c & d) - 1) if shadow_k else k) or (c - d) in safe)}
            if not accepted:
                continue
            if strategy == "multi" and not (1e-9 < loss < 99):
                continue
            key = (round(loss, 9), positions)
            if best is None or key < best[0]:
                best = (key, d, accepted)
        if best is None:
            if strategy == "multi" and n_comb < max_comb:
                n_comb += 1
                continue
            break
        _, d, accepted = best
        for u, s in current.items():
            if s in accepted:
                dropped.update((u, c) for c in s & d)
                current[u] = s - d
    final = Counter(s for s in current.values() if s)
    kept = [(u, c) for u, c in rows if (u, c) not in dropped
            and (u is None or final.get(current[u], 0) >= k)]
    tally = Counter(c for u, c in rows if (u, c) in dropped)
    return kept, dict(tally)
