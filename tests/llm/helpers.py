"""Small plain versions of what the operators compute, written for clarity alone."""

import random
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return [w.decode() for w in WORD.findall((text or "").encode())]


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def shingles(text, size=5):
    found = words(lower(text))
    if not found:
        return set()
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))}


def components(texts, percent=75):
    """{id: (shingles, component, links)} of (id, text) rows with different ids."""
    sets = {i: shingles(t) for i, t in texts}
    links = {i: set() for i in sets}
    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a != b and common and 100 * common >= percent * len(sets[a] | sets[b]):
                links[a].add(b)
    result = {}
    for start in sets:
        reached, pending = {start}, [start]
        while pending:
            for other in links[pending.pop()] - reached:
                reached.add(other)
                pending.append(other)
        result[start] = (len(sets[start]), min(reached), len(links[start]))
    return result


def without_repeats(texts, window=50):
    """{id: (words, removed, kept words)} of (id, text) rows with different ids."""
    split = {i: words(t) for i, t in texts}
    first = {}
    for i in sorted(split):
        for at in range(len(split[i]) - window + 1):
            first.setdefault(tuple(split[i][at : at + window]), i)
    result = {}
    for i, found in split.items():
        gone = set()
        for at in range(len(found) - window + 1):
            if first[tuple(found[at : at + window])] < i:
                gone.update(range(at, at + window))
        result[i] = (len(found), len(gone), [w for n, w in enumerate(found) if n not in gone])
    return result


def prose(seed, count, vocabulary=3000):
    pick = random.Random(seed)
    return [f"w{pick.randrange(vocabulary)}" for _ in range(count)]


def varied(tokens, seed, changes):
    pick, copy = random.Random(seed), list(tokens)
    for _ in range(changes):
        copy[pick.randrange(len(copy))] = f"x{pick.randrange(10**6)}"
    return copy
