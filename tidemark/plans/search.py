"""Search over a text corpus: chunks, inverted index, fusion, judged evaluation."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.functions import text as tx
from tidemark.functions.numeric import exact_round
from tidemark.operators.nearest import nearest
from tidemark.operators.ordering import first_per, top_n
from tidemark.operators.scalars import attach
from tidemark.session import cut, stored

# Chunk size and step, smallest text kept, candidates per arm, fusion constant, scoring constants.
CHUNK, OVERLAP, MIN_CHARS, ARM, RRF_K, K1, B = 800, 100, 20, 40, 60, 1.2, 0.75
FEW_TERMS = 200_000  # distinct query terms up to which they are broadcast, a few megabytes
FEW_PAIRS = 500_000  # (query, term) pairs, likewise
SLAB = 4_000_000  # scores that a task holds at a time
FIXED = 1e12  # scores are summed in units of 1e-12
LENGTH_EDGES = [0, 100, 400, 800, 1600, 3200, 6400, 12800, 25600]


def corpus(documents: DataFrame) -> DataFrame:
    """Texts worth indexing: at least twenty characters that are not white space."""
    return documents.where(F.length(F.regexp_replace("text", r"[ \t\n\r]", "")) >= MIN_CHARS)


def chunks(documents: DataFrame) -> DataFrame:
    """Sliding windows over whole texts; the last one reaches the end. Ids depend on the text's id only."""
    step = CHUNK - OVERLAP
    last = F.when(F.length("text") <= CHUNK, F.lit(0)).otherwise(F.ceil((F.length("text") - CHUNK) / step).cast("int"))
    rows = documents.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last)))
    return rows.select(F.concat_ws("#", F.col("doc_id").cast("string"), F.col("chunk_no").cast("string")).alias("chunk_id"), "doc_id",
                       "chunk_no", F.substring("text", F.col("chunk_no") * step + 1, F.lit(CHUNK)).alias("content"))


def postings(units: DataFrame, ident: str, text: str) -> DataFrame:
    """(unit, term, tf, length) with terms counted in the map task before anything is shuffled."""
    return _counted(_words(units, ident, text))


def _words(units: DataFrame, ident: str, text: str) -> DataFrame:
    rows = units.select(F.col(ident).alias("unit"), tx.tokens(F.col(text)).alias("_w"))
    # outer: else the filter that drops empty texts would split every text a second time
    return rows.select("unit", F.size("_w").alias("unit_len"), F.explode_outer("_w").alias("term"))


def _counted(words: DataFrame) -> DataFrame:
    return words.where("term is not null").groupBy("unit", "unit_len", "term").agg(F.count(F.lit(1)).alias("tf"))


def lexical(units: DataFrame, queries: DataFrame, ident: str = "chunk_id", text: str = "content",
            top: int | None = ARM, documents: int | None = None) -> DataFrame:
    """BM25 of every query against the inverted index: (query_id, unit, score, rank).

    Only terms of the queries leave the index. While they are few enough to be broadcast, a unit is one row of
    (term, count) pairs and is scored where it is read; beyond that the counted index is joined. Without ``top``,
    ``documents`` leaves out units that cannot be the best of one of a query's first so many documents.
    """
    asked = queries.select("query_id", F.explode(F.array_distinct(tx.tokens(F.col("query")))).alias("term"))
    asked = cut(asked)
    wanted = cut(asked.select("term").distinct())
    if wanted.count() <= FEW_TERMS and asked.count() <= FEW_PAIRS:
        scored = _scored_in_place(units, asked, wanted, ident, text, top, None if top else documents)
    else:
        scored = _scored_by_joins(units, asked, wanted, ident, text)
    scored = scored.select("query_id", "unit", exact_round(F.col("_s") / F.lit(FIXED), 6).alias("score"))
    order = [F.col("score").desc(), F.col("unit").asc()]
    return top_n(scored, ["query_id"], order, top) if top else scored


def _idf() -> Column:
    return F.log(1 + (F.col("_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))


def _scored_by_joins(units: DataFrame, asked: DataFrame, wanted: DataFrame, ident: str, text: str) -> DataFrame:
    stats = units.select(F.size(tx.tokens(F.col(text))).alias("n")).agg(
        F.count(F.lit(1)).cast("double").alias("_docs"), F.avg("n").alias("_avg"))
    kept = cut(_counted(_words(units, ident, text)).join(wanted, "term", "left_semi"))
    df = kept.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    norm = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("unit_len") / F.col("_avg")))
    weights = asked.join(df, "term").transform(attach, stats).select("query_id", "term", _idf().alias("idf"), "_avg")
    return kept.join(weights, "term").groupBy("query_id", "unit").agg(
        F.sum(F.round(F.col("idf") * norm * FIXED).cast("long")).alias("_s"))  # whole numbers: any order of rows gives one sum


def _document(unit: str = "unit") -> Column:
    return F.substring_index(unit, "#", 1).cast("long")


def _scored_in_place(units: DataFrame, asked: DataFrame, wanted: DataFrame, ident: str, text: str,
                     top: int | None, documents: int | None) -> DataFrame:
    """(query_id, unit, _s) without a row per (unit, term) or per (query, unit) in any shuffle.

    Each task leaves out, batch by batch, what the batch's own best rule out of the first ``top`` units or
    ``documents`` documents.
    """
    spark = units.sparkSession
    terms = spark.sparkContext.broadcast(sorted(r["term"] for r in wanted.collect()))
    kind = units.schema[ident].dataType.simpleString()

    def count(batches):
        known = {}
        for batch in batches:
            words = batch.column("_w")
            flat, lens = words.flatten(), pc.list_value_length(words)
            if flat.type not in known:
                known[flat.type] = pa.array(terms.value, type=flat.type)
            at = pc.index_in(flat, value_set=known[flat.type])
            row = np.repeat(np.arange(len(batch)), pc.fill_null(lens, 0).to_numpy(zero_copy_only=False))
            hit = pc.is_valid(at).to_numpy(zero_copy_only=False)
            key, tf = np.unique(row[hit] * max(1, len(terms.value)) + pc.fill_null(at, 0).to_numpy(zero_copy_only=False)[hit], return_counts=True)
            row, term = np.divmod(key, max(1, len(terms.value)))
            offsets = pa.array(np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32))
            listed = lambda v: pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("unit"), lens.cast(pa.int32()), listed(term), listed(tf)], ["unit", "unit_len", "terms", "tfs"])

    rows = units.select(F.col(ident).alias("unit"), tx.tokens(F.col(text)).alias("_w"))
    index = stored(rows.mapInArrow(count, f"unit {kind}, unit_len int, terms array<int>, tfs array<int>"), "terms")
    stats = index.agg(F.count(F.lit(1)).cast("double").alias("_docs"), F.avg("unit_len").alias("_avg"))
    if index.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        index = index.select("unit", "terms", "tfs", F.array_repeat("unit_len", F.size("terms")).alias("lens"))
    else:  # rows that repeat a unit are one unit
        pairs = index.select("unit", "unit_len", F.explode(F.arrays_zip("terms", "tfs")).alias("p"))
        pairs = pairs.groupBy("unit", "unit_len", F.col("p.terms").alias("term")).agg(F.sum("p.tfs").cast("int").alias("tf"))
        index = pairs.groupBy("unit").agg(F.collect_list(F.struct("term", "tf", "unit_len")).alias("p"))
        index = stored(index.select("unit", F.col("p.term").alias("terms"), F.col("p.tf").alias("tfs"), F.col("p.unit_len").alias("lens")), "terms")
    df = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = df.transform(attach, stats).select("term", _idf().alias("idf"), "_avg").collect()

    ids = sorted({r["query_id"] for r in asked.select("query_id").distinct().collect()})
    number, place = {q: i for i, q in enumerate(ids)}, {t: i for i, t in enumerate(terms.value)}
    links = np.array([(place[r["term"]], number[r["query_id"]]) for r in asked.collect()], dtype=np.int64).reshape(-1, 2)
    links = links[np.argsort(links[:, 0], kind="stable")]
    idf = np.zeros(len(place))
    idf[[r["term"] for r in weights]] = [r["idf"] for r in weights]
    shared = spark.sparkContext.broadcast({
        "ids": ids, "idf": idf, "avg": weights[0]["_avg"] if weights else 1.0, "first": np.searchsorted(links[:, 0], np.arange(len(place) + 1)),
        "asking": links[:, 1], "longest": int(np.bincount(links[:, 1]).max()) if len(links) else 0})
    limit = top or documents

    def score(batches):
        known = shared.value
        least = np.ones(len(known["ids"]), dtype=np.int64)  # of a query, what it takes to be among its first
        names = pa.array(known["ids"], type=query_type)
        slab = max(1, SLAB // max(1, len(known["ids"])))
        for whole in batches:
            for at in range(0, len(whole), slab):
                batch = whole.slice(at, slab)
                sums = _sums(batch, known)
                if limit:
                    row, query = _first_documents(sums, batch.column("doc").to_numpy(zero_copy_only=False), limit, least)
                else:
                    row, query = np.nonzero(sums)
                yield pa.RecordBatch.from_arrays([names.take(pa.array(query)), batch.column("unit").take(pa.array(row)), pa.array(sums[row, query])],
                                                 ["query_id", "unit", "_s"])

    asked_kind = asked.schema["query_id"].dataType
    query_type = to_arrow_type(asked_kind)
    read = index.select("unit", "terms", "tfs", "lens", (_document() if documents else F.col("unit")).alias("doc"))
    return read.mapInArrow(score, f"query_id {asked_kind.simpleString()}, unit {kind}, _s long")


def _sums(batch: pa.RecordBatch, known: dict) -> np.ndarray:
    """(units, queries): scores in units of 1 / FIXED, whole numbers."""
    lists = batch.column("terms")
    flat = lambda name: batch.column(name).flatten().to_numpy(zero_copy_only=False)
    term, tf, length = flat("terms"), flat("tfs").astype(np.float64), flat("lens").astype(np.float64)
    row = np.repeat(np.arange(len(batch)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    norm = tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / known["avg"]))
    exact = known["idf"][term] * norm * FIXED
    whole = np.floor(exact)
    whole += exact - whole >= 0.5
    queries, many = len(known["ids"]), known["first"][term + 1] - known["first"][term]
    out = np.zeros(len(batch) * queries, dtype=np.int64)
    ends = np.cumsum(many)
    cuts = np.searchsorted(ends, np.arange(SLAB, ends[-1] + SLAB, SLAB)) + 1 if len(ends) else []
    for low, high in zip([0, *cuts], cuts):
        n = many[low:high]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        target = np.repeat(row[low:high], n) * queries + known["asking"][np.repeat(known["first"][term[low:high]], n) + within]
        value = np.repeat(whole[low:high], n)
        if known["longest"] * whole.max() < 2 ** 52:  # sums of doubles are exact
            out += np.bincount(target, value, len(out)).astype(np.int64)
        else:
            np.add.at(out, target, value.astype(np.int64))
    return out.reshape(len(batch), queries)


def _first_documents(sums: np.ndarray, docs: np.ndarray, limit: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, query) of the best units of each query's first ``limit`` documents of a batch, by falling rounded score and
    rising document. ``least`` grows to what ``limit`` documents of one batch have reached."""
    rounded = np.where(sums > 0, (sums + 500_000) // 1_000_000 + 1, 0)
    _, code = np.unique(docs, return_inverse=True)
    order = np.argsort(code, kind="stable")
    best = np.maximum.reduceat(rounded[order], np.flatnonzero(np.diff(code[order], prepend=-1)), axis=0)
    held = best >= least
    for query in np.flatnonzero(held.sum(axis=0) > limit):
        score = best[:, query]
        some = np.flatnonzero(held[:, query])
        edge = np.partition(score[some], len(some) - limit)[len(some) - limit]
        tied = some[score[some] == edge]
        held[:, query] = score > edge
        held[tied[:limit - int(held[:, query].sum())], query] = True
        least[query] = max(least[query], edge)
    return np.nonzero(held[code] & (rounded == best[code]))


def best_chunk(hits: DataFrame, top: int = ARM) -> DataFrame:
    """One row per (query, document), its best chunk, ranked again as documents."""
    best = first_per(hits.withColumn("doc_id", _document()), ["query_id", "doc_id"], [F.col("score").desc(), F.col("unit").asc()])
    return top_n(best.select("query_id", "doc_id", F.col("unit").alias("chunk_id"), "score"), ["query_id"],
                 [F.col("score").desc(), F.col("doc_id").asc()], top)


def vector_arm(vectors: DataFrame, query_vectors: DataFrame, top: int = ARM) -> DataFrame:
    found = nearest(vectors.select(F.col("doc_id").alias("id"), "vector"), top,
                    query_vectors.select(F.col("query_id").alias("id"), "vector"))
    return found.select("query_id", F.col("item_id").alias("doc_id"), "score", "rank")


def hybrid(lex: DataFrame, vec: DataFrame, top: int = ARM, k: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion of two arms, keeping each arm's rank."""
    both = lex.select("query_id", "doc_id", F.col("rank").alias("lex_rank")).join(
        vec.select("query_id", "doc_id", F.col("rank").alias("vec_rank")), ["query_id", "doc_id"], "full_outer")
    part = lambda r: F.coalesce((F.lit(1.0) / (k + F.col(r))).cast("decimal(20,16)"), F.lit(0).cast("decimal(20,16)"))
    fused = both.withColumn("rrf", part("lex_rank") + part("vec_rank"))
    return top_n(fused, ["query_id"], [F.col("rrf").desc(), F.col("doc_id").asc()], top)


def pooled(arms: dict[str, DataFrame], depth: int = 20) -> DataFrame:
    parts = [df.where(F.col("rank") <= depth).select("query_id", "doc_id") for df in arms.values()]
    return reduce(DataFrame.unionByName, parts).distinct()


def judge(pool: DataFrame, documents: DataFrame, queries: DataFrame) -> DataFrame:
    """Grades for pooled pairs only: 3 holds the passage, 2 most of its words, 1 some, 0 few."""
    pool = cut(pool)
    if pool.count() <= FEW_PAIRS:
        pool = F.broadcast(pool)  # so that no text is shuffled
    rows = pool.join(documents.select("doc_id", "text"), "doc_id").join(queries.select("query_id", "query"), "query_id")
    q = F.array_distinct(tx.tokens(F.col("query")))
    share = F.size(F.array_intersect(q, tx.tokens(F.col("text")))) / F.size(q)
    grade = F.when(F.contains("text", "query"), 3).when(share >= 0.8, 2).when(share >= 0.5, 1).otherwise(0)
    return rows.select("query_id", "doc_id", grade.alias("grade"))


def sanity(metrics: DataFrame, slack: float = 0.02) -> DataFrame:
    """The fused arm may not clearly lose to either of its parts."""
    of = lambda name: F.max(F.when((F.col("variant") == name) & (F.col("metric") == "ndcg"), F.col("value")).cast("double"))
    row = metrics.agg(of("lexical").alias("lexical"), of("vector").alias("vector"), of("hybrid").alias("hybrid"))
    return row.withColumn("fusion_holds", F.col("hybrid") >= F.greatest("lexical", "vector") - slack)


def corpus_stats(documents: DataFrame) -> DataFrame:
    """Length histogram, documents per source, chunks per document, and what was filtered out."""
    kept = corpus(documents).withColumn("_len", F.length("text"))
    step = CHUNK - OVERLAP
    n = F.when(F.col("_len") <= CHUNK, 1).otherwise(F.ceil((F.col("_len") - CHUNK) / step) + 1)
    edge = F.lit(LENGTH_EDGES[0])
    for e in LENGTH_EDGES[1:]:
        edge = F.when(F.col("_len") >= e, e).otherwise(edge)
    row = lambda df, kind: df.select(F.lit(kind).alias("kind"), F.col("name").cast("string").alias("name"), F.col("amount").cast("long").alias("amount"))
    by_len = kept.groupBy(edge.alias("name")).agg(F.count(F.lit(1)).alias("amount"))
    by_source = kept.groupBy(F.col("source").alias("name")).agg(F.count(F.lit(1)).alias("amount"))
    totals = kept.agg(F.count(F.lit(1)).alias("documents"), F.sum(n).cast("long").alias("chunks")).transform(attach, documents.agg(F.count(F.lit(1)).alias("given")))
    totals = totals.select(F.expr("stack(3, 'documents', documents, 'chunks', chunks, 'filtered_out', given - documents) AS (name, amount)"))
    return row(by_len, "length_from").unionByName(row(by_source, "source")).unionByName(row(totals, "total"))


def not_indexed(documents: DataFrame, index: DataFrame, key: str = "doc_id") -> DataFrame:
    """What still has to be indexed: rows whose key the index lacks."""
    return documents.join(index.select(key).distinct(), key, "left_anti")


def screen(texts: DataFrame, text: str = "text") -> DataFrame:
    """Injection patterns and personal data over whole texts: which patterns, how many, and the masked text."""
    plain = F.regexp_replace(F.col(text), tx.INVISIBLE, "")
    hits = [F.when(plain.rlike(f"(?i){p}"), F.lit(i + 1)) for i, p in enumerate(tx.INJECTION)]
    out = texts.withColumn("injection_patterns", F.concat_ws(",", *[h.cast("string") for h in hits]))
    found: Column = F.lit(0)
    masked = F.col(text)
    for pattern in tx.PERSONAL.values():
        found = found + F.regexp_count(masked, F.lit(pattern))
        masked = F.regexp_replace(masked, pattern, "***")
    return out.withColumns({"hidden_characters": F.length(text) - F.length(plain), "personal_count": found, "masked": masked})


# --- number verification ----------------------------------------------------------------

NUMBER = r"[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?%?"


def unverified_numbers(answers: DataFrame, facts: DataFrame, keys: list[str], text: str = "answer", value: str = "fact") -> DataFrame:
    """Numbers in an answer that match no fact of the same key.

    A fact also matches rounded, as a percentage and as a share; small ordinals and years are
    exempt. Facts are few per key, so the tolerance join stays inside one key.
    """
    token = F.explode(F.regexp_extract_all(F.col(text), F.lit(f"({NUMBER})"), 1))
    found = answers.select(*keys, token.alias("token")).distinct()
    plain = F.regexp_replace(F.regexp_replace("token", ",", ""), "%", "").cast("double")
    found = found.withColumn("number", plain)
    exempt = (~F.col("token").contains("%") & ~F.col("token").contains(".") & ((plain <= 10) | plain.between(2000, 2100)))
    checked = found.where(~exempt)
    v = F.col(value).cast("double")
    forms = F.array(v, F.round(v, 0), F.round(v, 1), F.round(v, 2), v * 100, v / 100)
    known = facts.select(*keys, F.explode(F.array_distinct(forms)).alias("form"))
    near = checked.join(known, keys).where(F.abs(F.col("number") - F.col("form")) <= F.greatest(F.lit(0.005), 0.005 * F.abs("form")))
    return checked.join(near.select(*keys, "token").distinct(), [*keys, "token"], "left_anti").select(*keys, "token", "number")
