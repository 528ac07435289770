"""Small documents with the awkward cases, and plain re-computations of what operators return."""

import random
import re
from collections import Counter

SCHEMA = "doc_id long, text string, source string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(rng, n):
    return " ".join("".join(rng.choice(("th", "er", "on", "an", "re", "è", "in")) for _ in range(rng.randint(1, 4))) for _ in range(n))


def documents(seed=0, copies=True):
    """Rows (doc_id, text, source): nulls, blanks, copies, near copies, shared passages, repeats, one very long text."""
    rng = random.Random(seed)
    passage, other = sentence(rng, 60), sentence(rng, 130)
    rows = [(i, sentence(rng, rng.randint(1, 90)), "web") for i in range(30)]
    rows += [(100 + i, f"{sentence(rng, 15)} {passage}\n{sentence(rng, 12)}", "hot") for i in range(8)]
    rows += [(200 + i, f"{sentence(rng, 3)}\t{other}  {sentence(rng, 5)}\n", None) for i in range(4)]
    rows += [(300 + i, None if i % 2 else ("" if i % 4 else " \n\t "), "x") for i in range(6)]
    rows += [(400, "aa " * 500, "junk"), (401, "xyz" * 700, "junk"), (402, "one line here\n" * 40, "junk"), (403, "#$% &*|<> " * 9, "junk")]
    rows += [(500, " ".join(sentence(rng, 2000).split()) + " " + passage, "long"), (501, "A B\x0bC\x0cD\r\nE  f \x1c g h", "odd")]
    rows += [(None, passage, "no id"), (None, None, "no id")]
    if copies:
        rows += [(600 + i, rows[3][1], "copy") for i in range(3)] + [rows[5], rows[5]]
    return rows


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def stats(text):
    w = words(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    repeated = {k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated))


def in_id_order(rows):
    """By id, null ids last, equal ids by text."""
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, (r[1] or "").encode()))


def without_repeats(rows, window=20):
    """For each row, in id order: its words and which of them repeat an earlier window."""
    seen, out = set(), []
    for row in in_id_order(rows):
        w, gone = words(row[1]), set()
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        out.append((row, w, gone))
    return out


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]
