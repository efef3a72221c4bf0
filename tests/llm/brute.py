"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import re

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def ascii_lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def valid(kind, match):
    number = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        return 12 <= len(number) <= 19 and luhn(number)
    if kind == "phone":
        return 9 <= len(number) <= 15
    return True


def base_spans(text):
    found = [
        (m.start(), k, m.end(), kind)
        for k, (kind, pattern) in enumerate(BASE.items())
        for m in pattern.finditer(text or "")
        if valid(kind, m.group())
    ]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def shingle_set(text):
    words = SPACE.findall(ascii_lower(text))
    if not words:
        return set()
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def roots(ids, edges):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_duplicates(rows, percent=85):
    """{id: (n_shingles, component)} of [(id, text)] with unique ids"""
    sets = {i: shingle_set(t) for i, t in rows}
    ids = sorted(sets)
    edges = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                edges.append((a, b))
    component = roots(ids, edges)
    return {i: (len(sets[i]), component[i]) for i in ids}


def contamination(text, items, window=13):
    """(n_words, hit positions, items) with items [(id, text)]"""
    words = ALNUM.findall(ascii_lower(text))
    hit, found = set(), set()
    for name, item in items:
        tokens = ALNUM.findall(ascii_lower(item))
        size = min(window, len(tokens))
        if not size:
            continue
        windows = {tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(name)
    return len(words), hit, found
