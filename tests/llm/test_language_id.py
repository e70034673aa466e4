import math
import unicodedata

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tests.llm.helpers import docs_frame
from tidemark.llm import language_id as li
from tidemark.llm.common import fold


def model(words, grams=()):
    return li.Model(["aa", "bb"], words, list(grams))


def test_known_words_first_then_shorter_windows():
    m = model([("aa", "cat", 8, 10), ("aa", "dog", 2, 10), ("bb", "cat", 1, 10), ("bb", "chat", 9, 10)],
              [("aa", 3, "ogs", 1, 4), ("bb", 3, "hat", 2, 4), ("aa", 1, "d", 1, 2), ("bb", 1, "h", 1, 2)])
    s = li.Scorer(m)
    assert s.predict("Cat, cat!") == ("aa", pytest.approx(1 / (1 + math.exp(2 * (math.log(0.1) - math.log(0.8))))))
    assert s.predict("dogs")[0] == "aa" and s.predict("hats")[0] == "bb"  # by the windows of three
    assert s.backed_off("h")[1] == li.STEP * 5 + math.log(1 / 2)  # by single characters, five steps down
    assert s.predict("zzz") == ("aa", 0.5)  # nothing known: a tie, the first by name


def test_rows_of_unknown_words_are_reused_without_mixing(monkeypatch):
    monkeypatch.setattr(li, "REMEMBERED", 3)
    words, grams = [("aa", "cat", 8, 10), ("bb", "chat", 9, 10)], [(x, 1, c, n, 9) for c in "dogshatbird" for x, n in (("aa", ord(c) % 5 + 1), ("bb", 3))]
    small = li.Scorer(model(words, grams))
    texts = ["dog hat bird cat dogs hats birds", "bird", "hat cat", "dog dog bird hat dogs", "chat"]
    monkeypatch.setattr(li, "REMEMBERED", 100)
    large = li.Scorer(model(words, grams))
    for text in texts:
        want = large.predict(text)
        monkeypatch.setattr(li, "REMEMBERED", 3)
        assert small.predict(text) == (want[0], pytest.approx(want[1]))
        monkeypatch.setattr(li, "REMEMBERED", 100)


def test_undetermined():
    s = li.Scorer(model([("aa", "cat", 1, 1)]))
    assert [s.predict(t) for t in (None, "", "123 !? ²")] == [("und", 0.0)] * 3
    assert li.Scorer(li.Model([], [], [])).predict("cat") == ("und", 0.0)


def test_counts_cover_the_whole_training_part(spark):
    rows = [(i, "ab ab cd", "x") for i in range(5)] + [(9, "ef", "y"), (10, None, "y"), (11, "gh", None)]
    m = li.train(docs_frame(spark, rows, ["word", "n", "gram"]))
    assert m.languages == ["x", "y"] and set(m.words.index) == {"ab", "cd", "ef"}
    assert m.words.get("ab").tolist() == [math.log(10 / 15), math.log(0.5)]
    assert m.grams[2].get("ab")[0] == math.log(10 / 45)  # three windows of two characters a word


def test_rows_without_data(spark):
    empty = docs_frame(spark, [])
    m = li.train(empty)
    assert li.identify(empty, m).collect() == []
    got = li.identify(docs_frame(spark, [(1, "cat"), (1, "cat"), (None, None)], ["score", "lang_pred"]), m).collect()
    assert sorted((r["doc_id"] or 0, r["lang_pred"], r["score"]) for r in got) == [(0, "und", 0.0), (1, "und", 0.0), (1, "und", 0.0)]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = li.train_and_identify(docs, fold("doc_id", 3) != 1).join(docs.select("doc_id", "lang"), "doc_id").where(fold("doc_id", 3) == 1)
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 30 and right >= 0.97


def test_marks_are_part_of_words():
    assert li._words("हिन्दी भाषा") == ["हिन्दी", "भाषा"]
    assert li._words("ภาษาที่ดี, நல்ல தமிழ்") == ["ภาษาที่ดี", "நல்ல", "தமிழ்"]
    assert li._words(unicodedata.normalize("NFD", "Été à Malmö")) == [unicodedata.normalize("NFD", w) for w in ("été", "à", "malmö")]
    assert li._words("́ 12") == []
    s = li.Scorer(li.Model(["hi", "mr"], [("hi", "है", 5, 10), ("mr", "हा", 5, 10)], []))
    assert s.predict("है")[0] == "hi" and s.predict("हा")[0] == "mr"
