"""Plain versions of the operators on pairs, for tests on small tables."""

import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, n):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lower)
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def components(rows, n, percent):
    """(doc_id, set size, least id of the class) of each (doc_id, text), all pairs compared."""
    sets = [shingles(t, n) for _, t in rows]
    class_of = list(range(len(rows)))

    def find(i):
        while class_of[i] != i:
            i = class_of[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                class_of[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(rows[i][0], len(sets[i]), least.get(find(i))) for i in range(len(rows))]


def normal_words(text):
    spaced = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in (text or "").lower())
    return spaced.encode().split()


def leaks(text, items):
    """{item number: best similarity} over all windows of an item's size, 0.8 or more."""
    words, found = normal_words(text), {}
    held = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    for number, item in enumerate(items):
        wanted = normal_words(item)
        size = len(wanted)
        if size < 5:
            continue
        target = Counter(tuple(wanted[i : i + 5]) for i in range(size - 4))
        if held.isdisjoint(target):
            continue
        for start in range(max(1, len(words) - 4)):
            window = words[start : start + size]
            got = Counter(tuple(window[i : i + 5]) for i in range(len(window) - 4))
            shared = (target & got).total()
            if shared >= 0.8 * (target.total() + got.total() - shared) and shared:
                score = shared / (target | got).total()
                found[number] = max(found.get(number, 0), score)
    return found
