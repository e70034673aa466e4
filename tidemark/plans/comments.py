"""Comments and forum articles: selection, cleaning, healing, merging, daily marts."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import text as tx
from tidemark.functions.numeric import exact_round, ratio
from tidemark.operators.ordering import first_per, ordered_prefix, top_n
from tidemark.operators.scalars import attach
from tidemark.session import cut
from tidemark.plans.marts import latest_per_day
from tidemark.sources.store import upsert

# Videos per region, article size for "hot", longest text kept, share of failures that fails a run.
TOP_VIDEOS, HOT_COMMENTS, MAX_TEXT, MAX_FAILED_SHARE = 25, 50, 5000, 0.10
COMMENT_COLUMNS = ["comment_id", "video_id", "text", "like_count", "total_reply_count", "published_at", "updated_at",
                   "author_hash", "is_reply", "lang_bucket", "ingest_date", "ingested_at", "ingestion_id"]


def pick_videos(stg: DataFrame, day: Column, top: int = TOP_VIDEOS) -> DataFrame:
    """The most-commented videos of each region on a day, each video once."""
    latest = latest_per_day(stg.where(F.col("trending_date") == day))
    best = top_n(latest, ["region"], [F.col("comment_count").desc(), F.col("video_id").asc()], top)
    return best.groupBy("video_id").agg(F.max("comment_count").alias("comment_count"), F.count(F.lit(1)).alias("regions"))


def to_comments(threads: DataFrame, salt: str) -> DataFrame:
    """Thread documents to the thirteen columns; authors are masked before anything is stored."""
    top = F.col("item.snippet.topLevelComment")
    author = tx.author_hash(salt, top["snippet"]["authorChannelId"]["value"], top["snippet"]["authorDisplayName"])
    rows = threads.select("ingest_date", "ingested_at", F.explode("items").alias("item")).select(
        top["id"].alias("comment_id"), F.col("item.snippet.videoId").alias("video_id"),
        tx.clean_text(top["snippet"]["textDisplay"]).alias("text"),
        F.coalesce(top["snippet"]["likeCount"], F.lit(0)).alias("like_count"),
        F.coalesce(F.col("item.snippet.totalReplyCount"), F.lit(0)).alias("total_reply_count"),
        F.to_timestamp(top["snippet"]["publishedAt"]).alias("published_at"),
        F.to_timestamp(top["snippet"]["updatedAt"]).alias("updated_at"),
        author.alias("author_hash"), F.lit(False).alias("is_reply"), "ingest_date", "ingested_at")
    return rows.withColumns({
        "lang_bucket": tx.lang_bucket(F.col("text")),
        "ingestion_id": F.concat_ws("_", "video_id", F.date_format("ingest_date", "yyyyMMdd"))}).select(*COMMENT_COLUMNS)


def merge_comments(base: DataFrame, batch: DataFrame) -> DataFrame:
    """One row per comment: the batch's newest copy replaces what is stored."""
    newest = first_per(batch, ["comment_id"], [F.col("published_at").desc(), F.col("ingested_at").desc(), F.col("text").desc()])
    return upsert(base, newest, ["comment_id"], check_keys=False)


def progress(selected: DataFrame, yesterday: DataFrame) -> DataFrame:
    """Today's work list: unfinished videos of yesterday first, then today's selection by comments."""
    open_ = F.col("old_status").isin("budget_stopped", "pending", "in_progress")
    rows = selected.join(yesterday.select("video_id", F.col("status").alias("old_status"), "watermark_published_at"), "video_id", "full_outer")
    rows = rows.where(F.col("comment_count").isNotNull() | open_).select(
        "video_id", "comment_count", "watermark_published_at", F.coalesce(open_, F.lit(False)).alias("carried_over"),
        F.when(open_, F.col("old_status")).when(F.col("old_status").isin("comments_disabled", "not_found"), F.col("old_status"))
        .otherwise("pending").alias("status"))
    return ordered_prefix(rows, [F.col("carried_over").desc(), F.col("comment_count").desc_nulls_last(), F.col("video_id").asc()],
                          row_number="priority")


def newer_than_seen(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Only comments published after the newest one stored for their video."""
    marks = stored.groupBy("video_id").agg(F.max("published_at").alias("_mark"))
    return batch.join(marks, "video_id", "left").where(F.col("_mark").isNull() | (F.col("published_at") > F.col("_mark"))).drop("_mark")


def heal(rows: DataFrame, text: str = "text", kind: str = "json_type") -> DataFrame:
    """Five repairs in order; what cannot be repaired is quarantined, never filled in.

    ``kind`` is the JSON type the text arrived as.
    """
    raw, arrived = F.col(text), F.col(kind)
    stripped = F.regexp_replace(F.regexp_replace(raw, tx.CONTROL, ""), tx.INVISIBLE, "")
    blank = F.regexp_replace(raw, r"[ \t\n\r]", "") == ""
    no_words = tx.count_of(stripped, r"[\p{L}\p{N}]") == 0
    empty_after = F.regexp_replace(stripped, r"[ \t\n\r]", "") == ""
    error = (F.when(raw.isNull() | ~arrived.isin("string", "number"), "missing_text")
             .when(arrived == "number", "wrong_type").when(blank, "empty_text")
             .when(no_words, "special_characters_only").when(F.length(raw) > MAX_TEXT, "too_long"))
    out = rows.withColumn("error_type", error)
    e = F.col("error_type")
    action = (F.when(e.isin("missing_text", "empty_text"), "quarantined").when(e == "wrong_type", "type_conversion")
              .when(e == "special_characters_only", F.when(empty_after, "quarantined").otherwise("stripped_control_chars"))
              .when(e == "too_long", "truncated"))
    healed = (F.when(F.col("heal_action") == "truncated", F.concat(F.substring(raw, 1, MAX_TEXT), F.lit("…")))
              .when(F.col("heal_action") == "stripped_control_chars", stripped)
              .when(F.col("heal_action") == "quarantined", F.lit(None).cast("string")).otherwise(raw))
    out = out.withColumn("heal_action", action)
    return out.withColumn("healed_text", healed).withColumn(
        "was_healed", F.coalesce(F.col("heal_action") != "quarantined", F.lit(False)))


def health_log(healed: DataFrame, run: list[str]) -> DataFrame:
    """One log row per run with its level, worst level first."""
    counts = healed.groupBy(*run).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if("was_healed").alias("healed_rows"),
        F.count_if(F.coalesce(F.col("heal_action") == "quarantined", F.lit(False))).alias("quarantined_rows"))
    bad, fixed = F.col("quarantined_rows") / F.col("total_rows"), F.col("healed_rows") / F.col("total_rows")
    return counts.withColumn("health_status", F.when(bad > 0.10, "CRITICAL").when(bad > 0, "DEGRADED")
                             .when(fixed > 0.10, "WARNING").otherwise("HEALTHY"))


def health_latest(log: DataFrame, pipeline: str, executed_at: str) -> DataFrame:
    level = (F.when(F.col("health_status") == "HEALTHY", 0).when(F.col("health_status") == "WARNING", 1)
             .when(F.col("health_status") == "DEGRADED", 2).otherwise(3))
    newest = first_per(log, [pipeline], [F.col(executed_at).desc(), F.col("health_status").asc()])
    return newest.select(F.col(pipeline).alias("pipeline"), executed_at, level.alias("status"))


# --- forum ------------------------------------------------------------------------------

class _Article(HTMLParser):
    """Collects a page's title, its meta values, its body text and its comment marks."""

    SKIP = {"script", "style", "nav", "head"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title, self.meta, self.body, self.marks = "", [], [], []
        self.open: list[tuple[str, str]] = []

    def handle_starttag(self, tag, attrs):
        if tag not in ("br", "meta", "link", "img", "input", "hr"):
            self.open.append((tag, dict(attrs).get("class") or ""))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        classes = " ".join(c for _, c in self.open)
        if self.open and self.open[-1][0] == "title":
            self.title += data
        elif "article-meta-value" in classes:
            self.meta.append(data.strip())
        elif "push-tag" in classes:
            self.marks.append(data.strip())
        elif "push" not in classes and "article-meta" not in classes and not any(t in self.SKIP for t, _ in self.open):
            self.body.append(data)


PARSED = ("page_id long, title string, body string, author string, posted string, marks array<string>, error string")


def _parse_batches(batches):
    import pandas as pd

    for pdf in batches:
        rows = []
        for page_id, html in zip(pdf["page_id"], pdf["html"]):
            page = _Article()
            try:
                page.feed(html)
                page.close()
                meta = (page.meta + [None] * 4)[:4]
                title = page.title.strip() or (meta[2] or "")
                if not title:
                    raise ValueError("no title")
                rows.append((page_id, title, " ".join("".join(page.body).split()), meta[0], meta[3], page.marks, None))
            except Exception as exc:  # a bad page is a row, not a failed job
                rows.append((page_id, None, None, None, None, [], f"{type(exc).__name__}: {exc}"))
        yield pd.DataFrame(rows, columns=["page_id", "title", "body", "author", "posted", "marks", "error"])


def parse_pages(pages: DataFrame, fallback_date: Column) -> DataFrame:
    """Article pages to columns: category from the title, author split, counts of marks, typed time."""
    raw = pages.select("page_id", "html").mapInPandas(_parse_batches, schema=PARSED)
    mark = lambda m: F.size(F.filter("marks", lambda x: x == m))
    posted = F.try_to_timestamp(F.regexp_replace(F.regexp_replace("posted", r"^[A-Za-z]{3} +", ""), " +", " "),
                                F.lit("MMM d HH:mm:ss yyyy"))
    out = raw.select(
        "page_id", "title", F.nullif(F.regexp_extract("title", r"\[([^\]]+)\]", 1), F.lit("")).alias("category"),
        F.nullif(F.trim(F.regexp_replace("author", r"\(.*$", "")), F.lit("")).alias("author_id"),
        F.nullif(F.regexp_extract("author", r"\((.*)\)", 1), F.lit("")).alias("author_nick"),
        F.coalesce(posted, fallback_date).alias("post_ts"), posted.isNull().alias("post_ts_fallback"),
        F.col("body").alias("content"), F.size("marks").alias("comments_total"), mark("推").alias("comments_push"),
        mark("噓").alias("comments_boo"), mark("→").alias("comments_neutral"), "error")
    return out.withColumn("comments_score", F.col("comments_push") - F.col("comments_boo"))


class TooManyFailures(RuntimeError):
    pass


def require_parsed(parsed: DataFrame, limit: float = MAX_FAILED_SHARE) -> DataFrame:
    """The parsed rows; a share of failures above the limit fails the run."""
    parsed = cut(parsed)  # every page is parsed once
    row = parsed.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("error").isNotNull()).alias("bad")).first()
    if row["n"] and row["bad"] / row["n"] > limit:
        raise TooManyFailures(f"{row['bad']} of {row['n']} pages failed")
    return parsed.where("error is null").drop("error")


def infer_year(listing: DataFrame, board: str, position: str, month_day: str, first_year: Column) -> DataFrame:
    """Full dates for MM/DD lists read newest to oldest: a month going up means the year before.

    The row before is found by its position, and the jumps are a running sum, so a board may
    be of any length.
    """
    rows = listing.withColumn("_m", F.substring(month_day, 1, 2).cast("int"))
    above = rows.select(F.col(board), (F.col(position) + 1).alias(position), F.col("_m").alias("_above"))
    rows = rows.join(above, [board, position], "left").withColumn(
        "_jump", F.when(F.col("_m") > F.col("_above"), 1).otherwise(0))
    rows = ordered_prefix(rows, [F.col(position).asc()], [board], {"_jumps": "_jump"})
    year = first_year - F.col("_jumps")
    return rows.withColumn("post_date", F.to_date(F.concat_ws("/", year.cast("string"), F.col(month_day)), "yyyy/MM/dd")).drop(
        "_m", "_above", "_jump", "_jumps", "row_number")


def board_daily(articles: DataFrame) -> DataFrame:
    """Nine measures per board and day. The top category breaks ties by name."""
    keys = ["board", "post_date"]
    counted = articles.groupBy(*keys, "category").agg(F.count(F.lit(1)).alias("_n"))
    top = first_per(counted.where("category is not null"), keys, [F.col("_n").desc(), F.col("category").asc()])
    out = articles.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("articles_count"), F.countDistinct("author_id").alias("distinct_authors"),
        F.sum("comments_total").alias("comments_total"), F.sum("comments_push").alias("push_total"),
        F.sum("comments_boo").alias("boo_total"),
        F.count_if(F.col("comments_total") >= HOT_COMMENTS).alias("hot_articles_count"),
        F.sum("comments_score").alias("_score"))
    return (out.join(top.select(*keys, F.col("category").alias("top_category")), keys, "left")
            .withColumn("avg_comments_per_article", ratio(F.col("comments_total"), F.col("articles_count"), 1))
            .withColumn("avg_comment_score", ratio(F.col("_score"), F.col("articles_count"), 2)).drop("_score"))


def text_invariants(comments: DataFrame, boards: DataFrame) -> DataFrame:
    per_comment = comments.agg(
        F.count_if(~F.col("author_hash").rlike("^[0-9a-f]{16}$")).alias("plain_author"),
        F.count_if((F.col("like_count") < 0) | (F.col("total_reply_count") < 0)).alias("negative_counts"),
        F.count_if("is_reply").alias("replies"))
    per_board = boards.agg(F.count_if(F.col("push_total") + F.col("boo_total") > F.col("comments_total")).alias("push_boo_bounded"))
    return per_comment.transform(attach, per_board).select(F.expr("""stack(4, 'plain_author', plain_author,
        'negative_counts', negative_counts, 'replies', replies, 'push_boo_bounded', push_boo_bounded)
        AS (check_name, offending_rows)"""))


def route_failures(work: DataFrame, max_attempts: int = 3) -> DataFrame:
    """Done, to be tried again, or dead; the error stays with the message."""
    failed = F.col("error").isNotNull()
    return work.withColumn("route", F.when(~failed, "done").when(F.col("attempts") >= max_attempts, "dead_letter").otherwise("retry"))


def replay_dead(routed: DataFrame, limit: int | None = None, oldest: str = "event_id") -> DataFrame:
    """Dead letters as fresh work: the error field removed, attempts started over. A limit takes the oldest first."""
    out = routed.where("route = 'dead_letter'").withColumns({"error": F.lit(None).cast("string"), "attempts": F.lit(0).cast("long")}).drop("route")
    return out.orderBy(oldest).limit(limit) if limit else out


def video_sentiment(scored: DataFrame) -> DataFrame:
    """Label shares per video and the most-liked negative comment."""
    of = lambda label: F.count_if(F.col("label") == label)
    liked = F.max(F.when(F.col("label") == "negative", F.struct("like_count", "comment_id")))["comment_id"]
    n = F.count(F.lit(1))
    return scored.groupBy("video_id").agg(
        n.alias("scored_comments"), ratio(of("positive"), n, 4).alias("pos_ratio"), ratio(of("neutral"), n, 4).alias("neu_ratio"),
        ratio(of("negative"), n, 4).alias("neg_ratio"), ratio(of("positive") - of("negative"), n, 4).alias("sentiment_score"),
        liked.alias("top_liked_negative_comment_id"))


def stratified_sample(df: DataFrame, strata: list[str], key: str, per_stratum: int, seed: int) -> DataFrame:
    """The same rows on every run: the first of each stratum by a seeded digest of the key."""
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return top_n(df.withColumn("_d", digest), strata, [F.col("_d").asc(), F.col(key).asc()], per_stratum, "sample_no").drop("_d")


def cohen_kappa(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Agreement of two raters from their contingency counts."""
    cells = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    left = cells.groupBy("a").agg(F.sum("n").alias("na"))
    right = cells.groupBy("b").agg(F.sum("n").alias("nb"))
    both = left.join(right, F.col("a") == F.col("b")).agg(F.sum(F.col("na").cast("double") * F.col("nb")).alias("e"))
    seen = cells.agg(F.sum("n").cast("double").alias("t"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).cast("double").alias("o"))
    po, pe = F.col("o") / F.col("t"), F.col("e") / (F.col("t") * F.col("t"))
    return seen.transform(attach, both).select(F.col("t").cast("long").alias("items"), exact_round(po, 6).alias("observed"),
                                       exact_round(pe, 6).alias("expected"), exact_round((po - pe) / F.nullif(1 - pe, F.lit(0.0)), 6).alias("kappa"))
