"""Small tables and brute-force components for the tests of this folder."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, rows, extra=()):
    """rows of (doc_id, text[, lang, source]); ``extra`` names string columns whose names clash with inner ones."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1]) if r[1] is not None else None, *["x"] * len(extra))
            for r in rows]
    return spark.createDataFrame(full, DOCS + "".join(f", `{c}` string" for c in extra))


def classes(items, linked):
    """Smallest item reachable from each, over all pairs for which ``linked`` holds."""
    parent = {i: i for i in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted(items)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in items}


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    return " ".join("w" + str(rng.randrange(vocabulary)) for _ in range(words))


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join("e" + str(rng.randrange(10**6)) if rng.random() < share else w for w in text.split(" "))
