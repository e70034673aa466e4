import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tests.conftest import DATA
from tests.llm.helpers import docs_frame, prose
from tidemark.llm.common import components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order():
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mixing", "bpe"]


def test_each_stage_returns_documents_and_takes_effect(spark):
    clean = [(i, "\n".join(prose(1000 + 9 * i + j, 60, 5000) for j in range(3)), "en", "ab"[i % 2]) for i in range(40)]
    junk = [(100 + i, " ".join(w + "###" for w in prose(i, 80).split()), "en", "a") for i in range(8)]
    copies = [(200 + i, clean[0][1].replace("\n", " ") + f" tail{i}", "en", "a") for i in range(5)]
    rows = [*clean, *junk, *copies, (300, None, "en", "a"), (None, prose(5, 80, 5000), None, None)]
    docs = docs_frame(spark, rows)
    judged = cp.quality_rules(spark, docs, "")
    ids = {r["doc_id"] for r in judged.collect()}
    assert ids >= {i for i, *_ in clean} and not ids & {100 + i for i in range(8)} and 300 not in ids
    lined = cp.line_dedup(spark, judged, "")
    assert {r["doc_id"] for r in lined.collect()} == ids and lined.columns == COLUMNS
    apart = cp.near_dedup(spark, judged, "")
    assert {r["doc_id"] for r in apart.collect()} == ids - {200, 201, 202, 203, 204}
    assert apart.columns == judged.columns == COLUMNS
    mixed = cp.mixing(spark, apart, "")
    times = {}
    for r in mixed.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert mixed.columns == COLUMNS and max(times.values()) <= 2 and times[None] == 1
    coded = {r["doc_id"]: list(r["ids"]) for r in cp.bpe(spark, mixed, "").collect()}
    library, texts = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert coded == {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}


def test_empty_table(spark):
    docs = docs_frame(spark, [])
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, "")
        assert docs.collect() == []


def test_run(spark):
    found = cp.run(spark, DATA)
    assert found.columns == ["doc_id", "n_tokens", "ids", "decoded"] and found.count() > 50


def test_components_of_paths_stars_and_text_ids(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(100, 100 + i) for i in range(1, 300)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(path + star + [(500, 500)], "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(300)}}
