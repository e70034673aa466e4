import re

import numpy as np

from tests.conftest import DATA
from tests.llm.helpers import docs_frame, prose
from tidemark.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = list(zip(words, words[1:], words[2:]))
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


TEXTS = [None, "", " \t\n\x0b\x0c\r", "a b c a b c", "é ü\x85x y\xa0z 日本 😀", "l1\nl1\n\nl2\nl1 \n l1", "#*$%&|<>@ <b>", "x x x x x", prose(1, 300, 8), prose(2, 80)]


def test_base_counts_as_brute_force():
    for text in TEXTS:
        f = qr.features(text)
        assert (f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words) == base(text)


def test_estimated_accuracies_recover_a_planted_model():
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.85
    patterns = {}
    for g in good:
        v = "".join(rng.choice(list("+0-"), p=(0.9, 0.08, 0.02) if g else (0.25, 0.15, 0.6)) for _ in qr.RULES)
        patterns[v] = patterns.get(v, 0) + 1
    prior, table = qr.estimate(patterns)
    assert abs(prior - good.mean()) < 0.01
    assert np.abs(table[0] - [0.9, 0.08, 0.02]).max() < 0.02 and np.abs(table[1] - [0.25, 0.15, 0.6]).max() < 0.04


def test_rows(spark):
    rows = list(enumerate(TEXTS)) + [(9, TEXTS[9]), (None, TEXTS[9])]
    got = qr.judge(docs_frame(spark, rows, ["votes", "kept", "posterior", "n_words"])).collect()
    assert len(got) == len(rows)
    for r in got:
        want = base(TEXTS[r["doc_id"] if r["doc_id"] is not None else 9])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r["base_failed"] and r["kept"])
    assert qr.judge(docs_frame(spark, [])).collect() == []


def test_keeps_good_and_rejects_bad_documents(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    seen = {(r["quality"], r["kept"]): r["count"] for r in qr.judge(docs).where("not base_failed").join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert seen[1, True] >= 0.97 * (seen[1, True] + seen.get((1, False), 0))
    assert seen.get((0, False), 0) >= 0.9 * (seen.get((0, False), 0) + seen.get((0, True), 0))
