"""Near-duplicate lines across documents, in DataFrame functions alone.

A line's set is its distinct windows of eight characters (code points), without the spaces at its ends. Exact copies
are one class from the start, counted before anything is shuffled. Signature: the smallest shingle hash under
24 independent hash functions (disjoint parts of eight hashes), all taken in one pass over the exploded shingles, eight of them a row.
Banding: eight bands of three minima, which lines of similarity 0.8 miss with probability 0.003, of 0.9 with 0.00003.

A band never emits its pairs. Its most frequent line is compared with the others; where some of them end up in
another component, the most frequent of those is compared with all that differ from it, and so on for ``rounds``
rounds, each with a line that hasn't been compared yet. What then still lies in several components is compared in
blocks of bounded size, each pair of a band's blocks once. So every two lines that share a
band are linked or ruled out. Every comparison is an exact Jaccard similarity of the full sets, made unless
sizes or sketches (1024 bits set by the shingles: one that only the first line sets is a shingle the other lacks) prove
that too few shingles are shared. Components are found
by distributed union-find, and each keeps its first line by document and position.

Before texts or bands are shuffled again, rows that can't take part are dropped by a bitmap of fixed size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import components, only, released, written

SHINGLE = 8
BAND, BANDS = 3, 8
ROUNDS = 3
WINDOWS = 8  # of a row while signatures are taken
BLOCK_LINES = 256  # of a block, about
SKETCH = 16  # words of 64 bits of a line's sketch
WORD_BITS = 19  # the bitmap has 2^19 words of 64 bits
ENDS = "".join(map(chr, range(33)))
# Fixed values, spread by multiples of the golden ratio: each is mixed into a window's hash, which is then hashed again
MASKS = [((i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) - (1 << 63) for i in range(BANDS)]
PART = 64 // BAND  # bits of such a hash by which one minimum is taken: disjoint parts of a hash are independent


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold_case: bool = False) -> DataFrame:
    """(doc_id, version, line_no, line, k1, k2): every line with a character other than spaces, and its key."""
    rows = only(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("version"), F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    # spaces and control characters at the ends don't distinguish lines
    plain = F.btrim("raw", F.lit(ENDS))
    rows = rows.select("doc_id", "version", "line_no", (F.lower(plain) if fold_case else plain).alias("line")).where(F.col("line") != "")
    return rows.withColumns({"k1": F.xxhash64("line"), "k2": F.xxhash64(F.lit(1), F.col("line"))})


def _count(data: Column) -> Column:
    """How many windows an array of UTF-32 has: one at least."""
    return F.greatest((F.octet_length(data) / 4).cast("int") - (SHINGLE - 1), F.lit(1))


def _window(data: Column, i: Column) -> Column:
    return F.xxhash64(F.substring(data, (i * 4 - 3).cast("int"), F.lit(4 * SHINGLE)))


def shingle_set(line: Column) -> Column:
    """The distinct hashes of a line's windows, in one pass: the encoded line is bound once."""
    encoded = F.array(F.encode(line, "UTF-32"))
    return F.array_distinct(F.transform(encoded, lambda b: F.transform(F.sequence(F.lit(1), _count(b)), lambda i: _window(b, i)))[0])


def _bit(h: Column, q: int) -> Column:
    """The bit that a shingle's hash sets in word ``q`` of a sketch: none in all words but one."""
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 8).bitwiseAND(F.lit(63)).cast("int"))
    return F.when(h.bitwiseAND(F.lit(SKETCH - 1)) == q, mask).otherwise(F.lit(0).cast("long"))


def sketch(shingles: Column) -> list[Column]:
    """Words of 64 bits in which every shingle of an array sets one bit, by its own hash."""
    def word(q: int) -> Column:
        return F.aggregate(shingles, F.lit(0).cast("long"), lambda bits, h: bits.bitwiseOR(_bit(h, q)))

    return [word(q).alias(f"s{q}") for q in range(SKETCH)]


def may_share(n: Column, m: Column, one: list[Column], two: list[Column], least: float) -> Column:
    """Whether sets of n and m shingles with these sketches can have a Jaccard similarity of at least ``least``.

    A bit that only one sketch has stands for a shingle, at least, that the other set lacks. Never false for a similar pair.
    """
    def lacking(u: list[Column], v: list[Column]) -> Column:
        return sum((F.bit_count(a.bitwiseAND(F.bitwise_not(b))) for a, b in zip(u, v)), F.lit(0))

    shared = F.least(n - lacking(one, two), m - lacking(two, one))
    return (F.least(n, m) >= least * F.greatest(n, m)) & (shared * (1 + least) >= least * (n + m) - 1e-6)


def windows(cells: DataFrame, *keys: str) -> DataFrame:
    """(keys, i, h0, h1, ...) of (keys, line): the hashes of the windows of every line, some of them a row.

    In a line's last row the last window fills the rest, which neither minima nor sets notice.
    """
    cells = cells.select(*keys, F.encode("line", "UTF-32").alias("data")).withColumn("last", _count(F.col("data")))
    cells = cells.select("*", F.explode(F.sequence(F.lit(1), F.col("last"), F.lit(WINDOWS))).alias("i"))
    return cells.select(*keys, "i", *[_window(F.col("data"), F.least(F.col("i") + w, F.col("last"))).alias(f"h{w}") for w in range(WINDOWS)])


def sketches(texts: DataFrame) -> DataFrame:
    """(id, s0, s1, ...) of (id, line): ``sketch`` of every line's set, taken from the windows in one pass."""
    cells = windows(texts, "id")
    words = [F.bit_or(reduce(Column.bitwiseOR, [_bit(F.col(f"h{w}"), q) for w in range(WINDOWS)])).alias(f"s{q}") for q in range(SKETCH)]
    return cells.groupBy("id").agg(*words)


def signatures(found: DataFrame) -> DataFrame:
    """(k1, k2, n, b0, b1, ...) of distinct lines: number of occurrences, and the band keys.

    Rows hold numbers of 64 bits only, for aggregation without sorting. A band's hash of a window gives its three
    minima, each by other bits: shifted, these decide which is smallest.
    """
    cells = windows(found, "k1", "k2")

    def smallest(b: int, j: int) -> Column:
        return F.min(F.least(*[F.shiftleft(F.xxhash64(F.col(f"h{w}").bitwiseXOR(F.lit(MASKS[b]))), PART * j) for w in range(WINDOWS)])).alias(f"m{BAND * b + j}")

    least = [smallest(b, j) for b in range(BANDS) for j in range(BAND)]
    grouped = cells.groupBy("k1", "k2").agg(F.sum((F.col("i") == 1).cast("long")).alias("n"), *least)
    bands = [F.xxhash64(F.lit(b), *[F.col(f"m{BAND * b + j}") for j in range(BAND)]).alias(f"b{b}") for b in range(BANDS)]
    return grouped.select("k1", "k2", "n", *bands)


def possible(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose hash ``key`` may be among the hashes ``wanted`` (one column of that name): a bitmap test.

    The bitmap has at most 2^19 rows however many hashes there are, so it is broadcast. It lets others pass
    too, more of them the fuller it is; a join with ``wanted`` has to follow.
    """
    word, bit = F.shiftrightunsigned(F.col(key), 64 - WORD_BITS), F.shiftrightunsigned(F.col(key), 58 - WORD_BITS).bitwiseAND(F.lit(63))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int"))
    words = wanted.groupBy(word.alias("_word")).agg(F.bit_or(mask).alias("_bits"))
    kept = rows.join(F.broadcast(words), word == F.col("_word")).where(F.col("_bits").bitwiseAND(mask) != 0)
    return kept.drop("_word", "_bits")


def _similar(pairs: DataFrame, texts: DataFrame, marks: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose full sets have a Jaccard similarity of at least ``least``.

    Sets whose sizes or sketches differ too much can't be that similar: their lines aren't moved.
    """
    words = range(SKETCH)
    one = marks.select(F.col("id").alias("a"), F.col("size").alias("n"), *[F.col(f"s{q}").alias(f"u{q}") for q in words])
    two = marks.select(F.col("id").alias("b"), F.col("size").alias("m"), *[F.col(f"s{q}").alias(f"v{q}") for q in words])
    likely = may_share(F.col("n"), F.col("m"), [F.col(f"u{q}") for q in words], [F.col(f"v{q}") for q in words], least)
    return _confirmed(pairs.join(one, "a").join(two, (pairs["b"] == two["b"]) & likely).select("a", pairs["b"], "n", "m"), texts, least)


def _confirmed(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of (a, b, n, m), n and m being the sizes of their sets, that are as similar as that."""
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("line").alias("x")), "a").join(texts.select(F.col("id").alias("b"), F.col("line").alias("y")), "b")
    common = F.size(F.array_intersect(shingle_set(F.col("x")), shingle_set(F.col("y"))))
    sized = both.select("a", "b", "n", "m", common.alias("k"))
    return sized.where(F.col("k") >= least * (F.col("n") + F.col("m") - F.col("k"))).select("a", "b")


def _block_links(members: DataFrame, texts: DataFrame, marks: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between the classes of each band of ``members`` (band, id, class), all its pairs compared.

    A band is dealt to blocks by its number of lines, which meet two at a time. Sketches are compared within the
    join: a pair of lines that they rule out is never a row, and only the lines of the others are moved.
    """
    facts = members.groupBy("band").agg(F.greatest(F.ceil(F.count("*") / BLOCK_LINES), F.lit(1)).cast("int").alias("blocks"),
                                        F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("band", "blocks")
    dealt = members.select("band", "id", "class").join(facts, "band").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = written(dealt.join(marks, "id"), "blocks")
    words = range(SKETCH)
    one = dealt.select("band", F.col("block").alias("i"), F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("j"), F.col("id").alias("a"),
                       F.col("class").alias("of_a"), F.col("size").alias("n"), *[F.col(f"s{q}").alias(f"u{q}") for q in words])
    two = dealt.select(F.col("band").alias("_band"), F.explode(F.sequence(F.lit(0), F.col("block"))).alias("_i"), F.col("block").alias("_j"), F.col("id").alias("b"),
                       F.col("class").alias("of_b"), F.col("size").alias("m"), *[F.col(f"s{q}").alias(f"v{q}") for q in words])
    met = (F.col("band") == F.col("_band")) & (F.col("i") == F.col("_i")) & (F.col("j") == F.col("_j")) & (F.col("of_a") != F.col("of_b"))
    # within a block each pair once
    met &= (F.col("i") != F.col("j")) | (F.col("a") < F.col("b"))
    met &= may_share(F.col("n"), F.col("m"), [F.col(f"u{q}") for q in words], [F.col(f"v{q}") for q in words], least)
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), F.col("n")).otherwise(F.col("m")).alias("n"),
            F.when(F.col("a") < F.col("b"), F.col("m")).otherwise(F.col("n")).alias("m")]
    return _confirmed(one.join(two, met).select(*ends).distinct(), texts, least)


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, class) after classes that ``links`` (a, b) connect have become one: union-find over classes only."""
    ends = links.join(classes.select(F.col("id").alias("a"), F.col("class").alias("x")), "a")
    ends = ends.join(classes.select(F.col("id").alias("b"), F.col("class").alias("y")), "b")
    roots = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b"))).withColumnRenamed("id", "class")
    return written(classes.join(roots, "class", "left").select("id", F.coalesce("component", "class").alias("class")), "classes")


def line_classes(docs: DataFrame, similar: float = 0.8, rounds: int = ROUNDS, id_col: str = "doc_id",
                 text_col: str = "text", fold_case: bool = False) -> DataFrame:
    """(doc_id, version, line_no, class_doc_id, class_line_no, kept) per line with more than spaces in it.

    The class is named by its first line, by document and position; that one is kept. Lines of fewer than
    eight characters are equal or different. Null and empty texts have no lines; rows without id take no
    part. Rows that repeat an id and a text are one document, and keep the same lines; ``version`` is the
    hash of the text, which tells texts of one id apart. With ``fold_case`` lines are compared in lower case.
    """
    with released(docs.sparkSession):
        return _line_classes(docs, similar, rounds, id_col, text_col, fold_case)


def _line_classes(docs: DataFrame, similar: float, rounds: int, id_col: str, text_col: str, fold_case: bool) -> DataFrame:
    found = lines(docs.where(F.col(id_col).isNotNull()), id_col, text_col, fold_case)
    ids = signatures(found).withColumn("id", F.monotonically_increasing_id())
    reps = written(ids, "lines")  # the ids are fixed once the table is written

    weight = (F.least(F.col("n"), F.lit((1 << 30) - 1)) * F.lit(1 << 32) + F.col("k1").bitwiseAND(F.lit((1 << 32) - 1))).alias("weight")
    bands = reps.select("id", weight, F.explode(F.array(*[f"b{b}" for b in range(BANDS)])).alias("band"))
    heads = bands.groupBy("band").agg(F.max_by("id", "weight").alias("head"), F.min("id").alias("lo"), F.max("id").alias("hi"))
    heads = written(heads.where("lo <> hi").select("band", "head"), "heads")
    live = written(possible(bands, "band", heads.select("band")).join(heads, "band"), "bands")

    wanted = reps.join(live.select("id").distinct(), "id", "left_semi").select("id", "k1", "k2")
    # copies collapse in the map tasks, before the texts of distinct lines are shuffled
    texts = possible(found, "k1", wanted.select("k1")).groupBy("k1", "k2").agg(F.min("line").alias("line"))
    texts = written(texts.join(wanted, ["k1", "k2"]).select("id", "line", F.size(shingle_set(F.col("line"))).alias("size")), "texts")
    marks = written(texts.select("id", "size").join(sketches(texts), "id"), "sketches")

    links = _similar(live.where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct(), texts, marks, similar)
    classes = _merged(wanted.select("id", F.col("id").alias("class")), links)
    for _ in range(rounds - 1):
        placed = live.join(classes, "id").select("band", "id", "weight", "class", (F.col("id") == F.col("head")).alias("is_head"))
        main = placed.where("is_head").select("band", F.col("class").alias("main"))
        # a line that was head has met all others: it takes no further part
        placed = placed.where("not is_head")
        rest = placed.join(main, "band").where("class <> main")
        new = rest.groupBy("band").agg(F.max_by("id", "weight").alias("head"), F.max_by("class", "weight").alias("of"))
        new = written(new, "next-heads")
        if not new.limit(1).count():
            live = None
            break
        pairs = placed.join(new, "band").where("class <> of").select(F.least("head", "id").alias("a"), F.greatest("head", "id").alias("b"))
        live = written(placed.drop("class", "is_head").join(new.select("band", "head"), "band"), "bands")
        classes = _merged(classes, _similar(pairs.distinct(), texts, marks, similar))
    if live is not None:
        links = written(_block_links(live.where("id <> head").join(classes, "id"), texts, marks, similar), "block-links")
        if links.limit(1).count():
            classes = _merged(classes, links)

    named = reps.join(classes, "id", "left").select("k1", "k2", F.coalesce("class", "id").alias("class"))
    rows = found.select("doc_id", "version", F.col("line_no").cast("long").alias("line_no"), "k1", "k2")
    rows = written(rows.join(named, ["k1", "k2"]).select("doc_id", "version", "line_no", "class"), "line-classes")
    first = rows.groupBy("class").agg(F.min(F.struct("doc_id", "line_no")).alias("at"))
    rows = rows.join(first, "class").select("doc_id", "version", "line_no", F.col("at.doc_id").alias("class_doc_id"),
                                            F.col("at.line_no").alias("class_line_no"))
    return rows.withColumn("kept", (F.col("doc_id") == F.col("class_doc_id")) & (F.col("line_no") == F.col("class_line_no")))


def without_repeats(docs: DataFrame, similar: float = 0.8, rounds: int = ROUNDS, fold_case: bool = False) -> DataFrame:
    """``docs`` (doc_id, text, n_chars, ...) with the lines of ``line_classes`` that aren't kept taken out.

    Blank lines stay. A document that loses all its lines stays, with what is left of its text; null texts
    stay null. ``n_chars`` follows the text. No row is dropped.
    """
    gone = line_classes(docs, similar, rounds, fold_case=fold_case).where("not kept").groupBy("doc_id", "version").agg(F.collect_set("line_no").alias("_gone"))
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), "_gone")
    rows = docs.join(gone, (docs["doc_id"] == F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_version")), "left")
    # the lines are bound once; the numbers that stay are taken in order
    left = F.transform(F.array(F.split(docs["text"], "\n")), lambda all_: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0).cast("long"), (F.size(all_) - 1).cast("long")), F.col("_gone")),
        lambda i: F.get(all_, i.cast("int"))), "\n"))[0]
    text = F.when(F.col("_gone").isNull(), docs["text"]).otherwise(left)
    out = rows.withColumn("_text", text)
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("_text").alias("text"))
        elif c == "n_chars":
            columns.append(F.when(F.col("_gone").isNull(), docs["n_chars"]).otherwise(F.length("_text")).cast(docs.schema["n_chars"].dataType).alias("n_chars"))
        else:
            columns.append(docs[c])
    return out.select(*columns)
