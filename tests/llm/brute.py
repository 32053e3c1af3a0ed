"""Plain Python forms of what the operators return, for comparing."""

import hashlib
import re
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
HEX = lambda s: hashlib.sha256(s.encode()).hexdigest()


def described(spans, kinds):
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(spans, key=lambda x: (x[0], kinds.index(x[1]))))


def line_base(text):
    text = text or ""
    words = WORDS.findall(text)
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i : i + 8])].append(i)
    covered = {p for found in at.values() if len(found) > 1 for i in found for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed)


def secrets(text):
    text = text or ""
    kinds, spans = ("assign", "access", "hex"), []
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans += [(m.start(), "assign", m.end()) for m in re.finditer(assign, text, re.A) if len(m[2]) >= 6]
    spans += [(m.start(), "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    n = Counter(k for _, k, _ in spans)
    return (n["assign"], n["access"], n["hex"], HEX(described(spans, kinds)))


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text):
    text = text or ""
    kinds, spans = ("email", "ip", "card", "phone"), []
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    spans += [(m.start(), "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            spans.append((m.start(), "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            spans.append((m.start(), "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m[0])) <= 15:
            spans.append((m.start(), "phone", m.end()))
    n = Counter(k for _, k, _ in spans)
    return (*(n[k] for k in kinds), HEX(described(spans, kinds)))


def shingles(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def components(rows):
    """doc_id -> (set size, smallest doc_id reachable) for rows of (doc_id, text)."""
    sets = [(d, shingles(t)) for d, t in rows]
    holders = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(i)
    common = Counter()
    for found in holders.values():
        for a in range(len(found)):
            for b in range(a + 1, len(found)):
                common[found[a], found[b]] += 1
    parent = list(range(len(sets)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a][1]) + len(sets[b][1]) - n):
            parent[top(a)] = top(b)
    least = {}
    for i, (d, s) in enumerate(sets):
        if d is not None and s:
            least[top(i)] = min(d, least.get(top(i), d))
    return [(d, len(s), least.get(top(i)) if s else d) for i, (d, s) in enumerate(sets)]


def links(rows):
    """Pairs of places whose sets are similar."""
    sets = [shingles(t) for _, t in rows]
    pairs = ((a, b) for a in range(len(sets)) for b in range(a) if sets[a] and sets[b])
    return {(b, a) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
