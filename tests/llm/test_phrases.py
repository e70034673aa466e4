import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import docs_frame
from tidemark.llm import phrases as ph
from tidemark.llm.double_array import DoubleArray


def brute(rows, longest=3, least=10, share=50, top=2000):
    counts = {}
    for text, lang in rows:
        mine = counts.setdefault("und" if lang is None else lang, Counter())
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall("[^ \t]+", piece)
            for k in range(1, longest + 1):
                mine.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n, found = sum(c for w, c in f.items() if len(w) == 1), []
        good = {w: c for w, c in f.items() if len(w) > 1 and c >= least}
        for w, a in good.items():
            if any(len(x) > len(w) and 100 * c >= share * a and any(x[i:i + len(w)] == w for i in range(len(x))) for x, c in good.items()):
                continue
            score, _, left, right = min((10**6 * a * a // (f[w[:k]] * f[w[k:]]), k, f[w[:k]], f[w[k:]]) for k in range(1, len(w)))
            found.append((-score, -a, " ".join(w).encode(), left, right))
        for rank, (s, a, w, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, w.decode(), -a, left, right, n, -s))
    return sorted(out)


def run(spark, rows, **kw):
    frame = docs_frame(spark, [(i, text, lang) for i, (text, lang) in enumerate(rows)], ("phrase", "c", "k"))
    found = ph.phrases(frame, **kw).collect()
    return sorted(tuple(r[x] for x in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in found)


def corpus():
    rng = random.Random(5)
    words = ["The", "of", "New", "york", "a\x00b", "été", " ", "x" * 300, "DE", "日本", "#", "a\\b"]
    rows = []
    for i in range(400):
        text = "".join(rng.choice(words) + rng.choice([" "] * 9 + ["  ", "\t", " \t", ", ", " . ", "\n", "\r\n", " ; "]) for _ in range(rng.randrange(60)))
        rows.append((text, rng.choice(["en", "en", "de", None, "de\n", "", "d"])))
    rows += [(None, "en"), ("", None), (" \t\n,;", "en"), ("!", "xx")]
    rows += [("one two three four " * 20, "en")] * 3 + [("one two " * 9 + "late", "rare")]  # overlapping, repeated and below the least
    return rows


def test_equals_brute_force(spark):
    rows = corpus()
    want = brute(rows)
    assert len(want) > 60 and len({w[0] for w in want}) > 4
    assert run(spark, rows) == want


def test_many_small_blocks_shards_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(ph, "BLOCK_BYTES", 300)
    monkeypatch.setattr(ph, "SHARD_BYTES", 600)
    monkeypatch.setattr(ph, "ROUND_BYTES", 60_000)
    monkeypatch.setattr(ph, "BITS", 8)  # nearly every part looks frequent: more candidates, same result
    rows = corpus()
    assert run(spark, rows, least=4, top=30, longest=4) == brute(rows, least=4, top=30, longest=4)


def test_very_long_text_and_none(spark):
    rows = [("to be or not " * 30_000, "en")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [("one two", "en")]) == [] == run(spark, [])


@pytest.mark.parametrize("seed", range(4))
def test_trie_holds_its_keys_only(seed):
    rng = random.Random(seed)
    letters = [bytes([b]) for b in ([97, 98] if seed % 2 else [b for b in range(256) if b not in (9, 10, 32)])]
    keys = sorted({b"".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(3000)})
    inside, outside = keys[::2], keys[1::2]
    trie = DoubleArray(inside)
    text = np.frombuffer(b"\n".join(keys) + b"\n", dtype=np.uint8)
    starts = np.r_[0, np.flatnonzero(text == 10)[:-1] + 1]
    found = np.bincount(trie.accepted(text, starts, 0), minlength=len(inside))
    assert (found == 1).all() and found.sum() == len(inside) < len(inside) + len(outside)


def test_first_sums_take_several_vectors(spark):
    """32 tasks made 32 first sums of one vector each: a group for every row, and nothing summed."""
    assert [ph.partial_sums(n) for n in (0, 1, 32, 100, 2000)] == [1, 1, 5, 10, 44]
    rows = [("a b c d. " * 12, "en")] * 40
    docs = docs_frame(spark, [(i, *r) for i, r in enumerate(rows)]).repartition(20)
    got = {(r["phrase"], r["a"]) for r in ph.phrases(docs).collect()}
    assert got == {(p, a) for _, _, p, a, *_ in brute(rows)}
