import random

from pyspark.sql import functions as F

from tests.llm.helpers import classes, docs_frame, edited, prose
from tidemark.llm.line_dedup import line_classes, without_repeats

ENDS = "".join(map(chr, range(33)))


def expected(rows):
    lines = {}
    for i, text in rows:
        for j, raw in enumerate((text or "").split("\n") if text is not None and i is not None else []):
            line = raw.strip(ENDS)
            if line:
                lines.setdefault(line, []).append((i, j))
    sets = {x: {x[a:a + 8] for a in range(max(1, len(x) - 7))} for x in lines}
    first = {min(at): x for x, at in lines.items()}
    found = classes(list(first), lambda a, b: 5 * len(sets[first[a]] & sets[first[b]]) >= 4 * len(sets[first[a]] | sets[first[b]]))
    return {o: found[min(at)] for at in lines.values() for o in at}


def test_same_classes_as_brute_force(spark):
    base = prose(4, 40)
    rows = [(i, "\n".join([prose(50 + i, 20), edited(base, i, (i % 5) / 100), "All rights reserved.", prose(i % 4, 12)])) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "\n\n \n"), (103, "short"), (104, "SHORT \nshor"), (105, "Ünïcödé täxt in einer Zeile, länger als acht"),
             (106, "ünïcödé täxt in einer zeile, länger als acht!"), (107, prose(9, 20_000)), (108, prose(9, 20_000) + " x"),
             (109, "日本語の文章がここにあります。とても長いです"), (110, "日本語の文章がここにあります。とても長いですよ")]
    want = expected(rows)
    got = line_classes(docs_frame(spark, rows, ["version", "line_no", "k1", "id", "kept"])).collect()
    assert {(r["doc_id"], r["line_no"]): (r["class_doc_id"], r["class_line_no"]) for r in got} == want
    assert all(r["kept"] == ((r["doc_id"], r["line_no"]) == want[r["doc_id"], r["line_no"]]) for r in got)


def test_texts_without_repeated_lines(spark):
    rows = [(1, "a first line here\n\nshared heading of all\nlast of one"), (2, "shared heading of all\nonly in two, which stays"),
            (3, "shared heading of all"), (4, None), (5, ""), (None, "shared heading of all")]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in without_repeats(docs_frame(spark, rows, ["line_no", "class", "head"])).collect()}
    assert got == {1: (rows[0][1], len(rows[0][1])), 2: ("only in two, which stays", 24), 3: ("", 0), 4: (None, None), 5: ("", 0),
                   None: ("shared heading of all", 21)}


def test_repeated_rows_and_texts_of_one_id(spark):
    rows = [(1, "the same line twice"), (1, "the same line twice"), (2, "another of its lines\nthe same line twice"), (2, "something else")]
    got = sorted((r["doc_id"], r["text"]) for r in without_repeats(docs_frame(spark, rows)).collect())
    assert got == [(1, "the same line twice"), (1, "the same line twice"), (2, "another of its lines"), (2, "something else")]


def test_empty_table(spark):
    assert line_classes(docs_frame(spark, [])).collect() == []
    assert without_repeats(docs_frame(spark, [])).collect() == []


def test_every_pair_of_a_band_is_compared(spark, monkeypatch):
    """Rare near-copies behind many frequent lines of the same band, none of them similar to each other."""
    from tidemark.llm import line_dedup as ld
    signed = ld.signatures
    monkeypatch.setattr(ld, "signatures", lambda *a, **k: signed(*a, **k).withColumns({f"b{i}": F.lit(i).cast("long") for i in range(ld.BANDS)}))
    monkeypatch.setattr(ld, "BLOCK_LINES", 4, raising=False)
    lines = [prose(700 + i, 20) for i in range(12)]
    rows = [(100 * i + j, x) for i, x in enumerate(lines) for j in range(12 - i)]
    rows += [(5000 + i, prose(900 + i, 20)) for i in range(6)] + [(6000 + i, prose(900 + i, 20) + " x") for i in range(6)]
    got = {r["doc_id"]: r["class_doc_id"] for r in line_classes(docs_frame(spark, rows)).collect()}
    assert {i: o for (i, _), (o, _) in expected(rows).items()} == got
    assert all(got[6000 + i] == 5000 + i for i in range(6))


def test_recall_of_short_lines(spark):
    """Pairs of 12 and 11 characters share four of five windows: about 3 of 1000 miss every band."""
    from tidemark.llm import line_dedup as ld
    rng = random.Random(11)
    long = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(12)) for _ in range(3000)]
    cells = spark.createDataFrame([(i, 2 * i + j, x[:12 - j]) for i, x in enumerate(long) for j in (0, 1)], "k1 long, k2 long, line string")
    signed = ld.signatures(cells)
    one, two = signed.where("k2 % 2 = 0").alias("x"), signed.where("k2 % 2 = 1").alias("y")
    shared = F.greatest(*[F.col(f"x.b{b}") == F.col(f"y.b{b}") for b in range(ld.BANDS)])
    assert one.join(two, F.col("x.k1") == F.col("y.k1")).where(~shared).count() < 0.01 * len(long)


def test_query_and_pipeline_ignore_case(spark, tmp_path):
    import corpus_pipeline
    from tidemark.llm.queries import QUERIES
    docs = docs_frame(spark, [(1, "All rights reserved."), (2, "ALL RIGHTS RESERVED."), (3, "Größe und Länge in Zentimetern"), (4, "GRÖßE UND LÄNGE IN ZENTIMETERN")])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["class_doc_id"] for r in QUERIES["op3_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3}
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert left == {1: "All rights reserved.", 2: "", 3: "Größe und Länge in Zentimetern", 4: ""}


def test_sketches_never_rule_out_a_similar_pair(spark):
    """On pairs of every similarity: those of 0.8 or more pass, and most unlike ones don't."""
    from tidemark.llm import line_dedup as ld
    base = [prose(40 + i, 3 + i % 40, 60) for i in range(400)]
    rows = [(i, x, edited(x, i, (i % 10) / 20)) for i, x in enumerate(base)] + [(400 + i, x, base[i - 1]) for i, x in enumerate(base)]
    cells = spark.createDataFrame(rows, "i long, x string, y string").select("i", ld.shingle_set(F.col("x")).alias("u"), ld.shingle_set(F.col("y")).alias("v"))
    alike = F.size(F.array_intersect("u", "v")) / F.size(F.array_union("u", "v"))
    passed = ld.may_share(F.size("u"), F.size("v"), ld.sketch(F.col("u")), ld.sketch(F.col("v")), 0.8)
    got = cells.select(alike.alias("alike"), passed.alias("passed")).collect()
    assert sum(r["alike"] >= 0.8 for r in got) > 50 and all(r["passed"] for r in got if r["alike"] >= 0.8)
    unlike = [r["passed"] for r in got if r["alike"] < 0.4]
    assert len(unlike) > 200 and sum(unlike) < 0.1 * len(unlike)


def test_sketches_tell_long_lines_apart(spark):
    """Lines of 900 to 1100 windows filled the 256 bits there once were, so that unlike ones were compared in full."""
    from tidemark.llm import line_dedup as ld
    base = [prose(300 + i, 200) for i in range(12)]
    rows = [(3 * i + j, x) for i, b in enumerate(base) for j, x in enumerate((b, b + " x", edited(b, i, 0.5)))]
    lines = spark.createDataFrame(rows, "id long, line string").withColumn("set", ld.shingle_set(F.col("line")))
    marks = ld.sketches(lines).cache()
    wanted = {r["id"]: r for r in lines.select("id", *ld.sketch(F.col("set"))).collect()}
    assert {r["id"]: r for r in marks.collect()} == wanted  # window by window as from the sets
    sized = marks.join(lines.select("id", "set"), "id").alias("u")
    pairs = sized.join(sized.alias("v"), F.col("u.id") < F.col("v.id"))
    words = [[F.col(f"{t}.s{q}") for q in range(ld.SKETCH)] for t in "uv"]
    passed = ld.may_share(F.size("u.set"), F.size("v.set"), *words, 0.8)
    alike = F.size(F.array_intersect("u.set", "v.set")) / F.size(F.array_union("u.set", "v.set"))
    got = pairs.select(alike.alias("alike"), passed.alias("passed")).collect()
    assert sum(r["alike"] >= 0.8 for r in got) >= 12 and all(r["passed"] for r in got if r["alike"] >= 0.8)
    unlike = [r["passed"] for r in got if r["alike"] < 0.5]
    assert len(unlike) > 500 and sum(unlike) < 0.1 * len(unlike)
