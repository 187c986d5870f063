"""Plain models of the operators, for small inputs."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=True):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def shingles(text):
    w = words(text)
    span = min(5, len(w))
    return frozenset(tuple(w[k:k + span]) for k in range(len(w) - span + 1)) if w else frozenset()


def similar(a, b):
    both = len(a & b)
    return bool(a and b) and 100 * both >= 80 * (len(a) + len(b) - both)


def components(rows):
    """Smallest id reachable by links, for (id, text) rows."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for x in range(len(sets)):
        for y in range(x):
            if similar(sets[x][1], sets[y][1]):
                parent[find(x)] = find(y)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, len(s), least[find(k)]) for k, (i, s) in enumerate(sets))


def measures(text):
    text = text or ""
    w = words(text, lower=False)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    counts, covered = Counter(windows), set()
    for k, x in enumerate(windows):
        if counts[x] > 1:
            covered |= {k, k + 1, k + 2}
    return (len(w), sum(map(len, w)), sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(covered))


PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def personal(text):
    out = []
    for n, (kind, pattern) in enumerate(PERSONAL.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                out.append((m.start(), n, m.end(), kind))
    return [(kind, s, e) for s, _, e, kind in sorted(out)]


def secrets(text):
    out = []
    assign = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for n, (kind, pattern, ok) in enumerate((
            ("assign", assign, lambda m: len(m[1]) >= 12), ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
            ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16))):
        out += [(m.start(), n, m.end(), kind) for m in re.finditer(pattern, text or "", re.ASCII) if ok(m)]
    return [(kind, s, e) for s, _, e, kind in sorted(out)]
