"""Queries: recommendation tables and their evaluation. Item vectors are the given embeddings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog.commerce import ga
from tidemark.operators.nearest import nearest
from tidemark.operators.scalars import attach
from tidemark.plans import commerce, growth, ranking, reco
from tidemark.registry import query, view
from tidemark.session import cut, stored
from tidemark.sources.tables import Tables

TRAIN_END, LABEL_START = "2024-01-20", "2024-01-21"
FIT_END, FIT_LABEL_START = "2024-01-10", "2024-01-11"  # of the window a ranker is fitted on; its labels end with TRAIN_END
FEATURE_NAMES = ["recency_days", "orders_count", "sessions_count", "active_days", "log1p_monetary", "distinct_items_viewed",
                 "log1p_users_viewed", "log1p_users_purchased", "view_to_cart_user_rate", "view_to_purchase_user_rate",
                 "log1p_price_latest", "days_since_first_seen", "days_since_last_seen", "i2v_cos_user_item",
                 "weighted_hist_interaction", "seed_same_category", "recall_src", "rt_views_1h", "rt_carts_1h",
                 "rt_events_30m", "rt_item_matches_top_cat", "has_rt"]

_W = "(CASE event_name WHEN 'view_item' THEN 1 WHEN 'add_to_cart' THEN 3 WHEN 'begin_checkout' THEN 4 ELSE 5 END)"
_G = "(CASE event_name WHEN 'view_item' THEN 1 WHEN 'add_to_cart' THEN 2 WHEN 'begin_checkout' THEN 3 ELSE 4 END)"

view("rc_train", f"SELECT * FROM ga WHERE event_date <= date '{TRAIN_END}'")
view("rc_label", f"SELECT * FROM ga WHERE event_date >= date '{LABEL_START}'")
view("rc_seq", """
  SELECT *, row_number() OVER s AS pos, count(*) OVER (PARTITION BY user_pseudo_id, session_key) AS n
  FROM (SELECT *, lag(item_id) OVER (PARTITION BY user_pseudo_id, session_key ORDER BY event_ts_micros, event_name, item_id) AS prev
        FROM (SELECT *, coalesce(ga_session_id::varchar, event_date::varchar) AS session_key FROM ga))
  WHERE prev IS NULL OR prev <> item_id
  WINDOW s AS (PARTITION BY user_pseudo_id, session_key ORDER BY event_ts_micros, event_name, item_id)""")


def _popular(source: str) -> str:
    return f"""SELECT scope, item_id, score, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY scope ORDER BY score DESC, item_id) AS rank
      FROM (SELECT unnest(['global', 'category:' || c.item_category]) AS scope, item_id, score
            FROM (SELECT item_id, sum({_W})::bigint AS score FROM {source} GROUP BY 1) LEFT JOIN ga_catalog c USING (item_id))
      WHERE scope IS NOT NULL) WHERE rank <= 100"""


view("rc_popular", _popular("ga"))
view("rc_knn", """
  SELECT query_id, item_id, score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank
    FROM (SELECT a.vec_id AS query_id, b.vec_id AS item_id,
                 round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 9) AS score
          FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)) WHERE rank <= 50""")


def _interest(source: str) -> str:
    return f"""SELECT user_pseudo_id, item_id, sum(({_W} * exp(-((SELECT max(event_date) FROM {source}) - event_date) / 14.0::double))::decimal(20,12)) AS w
      FROM {source} GROUP BY 1, 2"""


def _fused(source: str, pop: str) -> str:
    """Fusion of neighbour lists of ten seeds with the popular list, as nested SQL."""
    return f"""WITH i AS ({_interest(source)}),
      seeds AS (SELECT user_pseudo_id, item_id AS seed FROM (SELECT *, row_number() OVER (PARTITION BY user_pseudo_id ORDER BY w DESC, item_id) AS rn FROM i) WHERE rn <= 10),
      lists AS (SELECT s.user_pseudo_id, 'item_' || k.item_id AS item_id, k.rank, 0 AS src FROM seeds s JOIN rc_knn k ON s.seed = 'item_' || k.query_id
                UNION ALL SELECT u.user_pseudo_id, p.item_id, p.rank, 2 FROM (SELECT DISTINCT user_pseudo_id FROM seeds) u CROSS JOIN ({pop}) p WHERE p.scope = 'global'),
      f AS (SELECT user_pseudo_id, item_id, sum((1.0::double / (60 + rank))::decimal(20,16)) AS rrf, min(src) AS src FROM lists GROUP BY 1, 2)
      SELECT user_pseudo_id, item_id, rrf, src, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY user_pseudo_id ORDER BY rrf DESC, item_id) AS rank FROM f
        WHERE (user_pseudo_id, item_id) NOT IN (SELECT user_pseudo_id, item_id FROM {source} WHERE event_name = 'purchase')) WHERE rank <= 200"""


view("rc_pool", _fused("ga", "SELECT * FROM rc_popular"))
view("rc_train_popular", _popular("rc_train"))
view("rc_train_pool", _fused("rc_train", "SELECT * FROM rc_train_popular"))


def vectors(t: Tables) -> DataFrame:
    return t.embeddings.select(F.concat(F.lit("item_"), F.col("vec_id").cast("string")).alias("item_id"), F.col("embedding").alias("vector"))


def neighbours(t: Tables) -> DataFrame:
    found = nearest(t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")), reco.NEIGHBOURS)
    name = lambda c: F.concat(F.lit("item_"), F.col(c).cast("string"))
    return stored(found.select(name("query_id").alias("query_id"), name("item_id").alias("item_id"), "rank"), "neighbours")


def kept_events(t: Tables, *more: str) -> DataFrame:
    """The columns that the catalogue and lists of candidates need, and ``more``, stored once: other attributes aren't shuffled."""
    return stored(ga(t).select("event_date", "event_ts_micros", "event_name", "user_pseudo_id", "item_id", "item_name", "item_category",
                                 "price", "quantity", "item_revenue", *more), "events")


def pool(events: DataFrame, near: DataFrame, catalog: DataFrame):
    interest = stored(reco.decayed(events, commerce.anchor(events)), "interest")
    lists = reco.candidate_lists(reco.seeds(interest), near, reco.popularity(events, catalog))
    return reco.fuse(lists, reco.bought_items(events)), interest, lists


def train(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_date") <= F.lit(TRAIN_END).cast("date"))


def label(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_date") >= F.lit(LABEL_START).cast("date"))


@query("session_sequences", "SELECT user_pseudo_id, session_key, item_id, event_ts_micros, pos, n FROM rc_seq WHERE n >= 2")
def session_sequences(t: Tables):
    return reco.session_sequences(ga(t)).select("user_pseudo_id", "session_key", "item_id",
                                                F.unix_micros("event_ts").alias("event_ts_micros"), "pos", "n")


@query("popularity", "SELECT scope, item_id, score, rank FROM rc_popular")
def popularity(t: Tables):
    events = ga(t)
    return reco.popularity(events, commerce.item_catalog(events))


@query("item2vec")
def item2vec(t: Tables):
    found = reco.item_vectors(reco.session_sequences(ga(t)))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    return found.select("item_id", F.size("vector").alias("dims"), norm.alias("norm"))


@query("knn_items", "SELECT * FROM rc_knn")
def knn_items(t: Tables):
    return nearest(t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")), reco.NEIGHBOURS)


view("rc_uservec", f"""
  SELECT user_pseudo_id, dim, x / nullif(sqrt(sum(x * x) OVER (PARTITION BY user_pseudo_id)), 0) AS value
  FROM (SELECT user_pseudo_id, dim, sum((w::double * x)::decimal(28,16))::double AS x
        FROM (SELECT i.user_pseudo_id, i.w, unnest(e.embedding)::double AS x, unnest(generate_series(0, len(e.embedding) - 1)) AS dim
              FROM ({_interest('ga')}) i JOIN embeddings e ON i.item_id = 'item_' || e.vec_id) GROUP BY 1, 2)""")


@query("user_vectors", "SELECT user_pseudo_id, dim, round(value::decimal(38,12), 6)::double AS value FROM rc_uservec")
def user_vectors(t: Tables):
    events = ga(t)
    return reco.user_vectors(reco.decayed(events, commerce.anchor(events)), vectors(t))


@query("rrf_candidates", "SELECT user_pseudo_id, item_id, round(rrf::decimal(38,12), 9)::double AS rrf, rank FROM rc_pool")
def rrf_candidates(t: Tables):
    events = kept_events(t)
    found = pool(events, neighbours(t), commerce.item_catalog(events))[0]
    return found.withColumn("rrf", F.round(F.col("rrf").cast("decimal(38,12)"), 9))


view("rc_pit", """
  SELECT user_pseudo_id || '|' || event_ts_micros || '|' || event_name || '|' || item_id AS event_key, user_pseudo_id, event_ts_micros, event_name, item_id,
         count(*) FILTER (event_name = 'view_item') OVER h AS views_1h, count(*) FILTER (event_name = 'add_to_cart') OVER h AS carts_1h,
         count(*) OVER (PARTITION BY user_pseudo_id ORDER BY event_ts_micros RANGE BETWEEN 1799999999 PRECEDING AND CURRENT ROW) AS events_30m
  FROM ga WINDOW h AS (PARTITION BY user_pseudo_id ORDER BY event_ts_micros RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW)""")


@query("pit_features", "SELECT event_key, user_pseudo_id, views_1h, carts_1h, events_30m FROM rc_pit")
def pit_features(t: Tables):
    return reco.point_in_time(ga(t))


_L = lambda e: f"round(ln(1 + {e})::decimal(38,12), 6)::double"


@query("rank_features", f"""
  WITH newest AS (SELECT user_pseudo_id, max(event_ts) AS t_end, arg_max(event_key, (p.event_ts_micros, p.event_name, p.item_id)) AS event_key
                  FROM rc_pit p JOIN ga g USING (user_pseudo_id, event_ts_micros, event_name, item_id) GROUP BY 1),
  rtc AS (SELECT user_pseudo_id, item_category AS rt_cat FROM (
      SELECT g.user_pseudo_id, g.item_category, row_number() OVER (PARTITION BY g.user_pseudo_id ORDER BY count(*) DESC, g.item_category) AS rn
      FROM ga g JOIN newest n USING (user_pseudo_id) WHERE g.event_name = 'view_item' AND g.item_category IS NOT NULL
        AND g.event_ts > n.t_end - INTERVAL 1 HOUR GROUP BY 1, 2) WHERE rn = 1),
  fav AS (SELECT user_pseudo_id, item_category AS cat FROM (
      SELECT i.user_pseudo_id, c.item_category, row_number() OVER (PARTITION BY i.user_pseudo_id ORDER BY sum(i.w) DESC, c.item_category) AS rn
      FROM ({_interest('ga')}) i JOIN ga_catalog c USING (item_id) WHERE c.item_category IS NOT NULL GROUP BY 1, 2) WHERE rn = 1),
  hist AS (SELECT user_pseudo_id, item_id, sum({_W})::bigint AS weighted_hist_interaction FROM ga GROUP BY 1, 2),
  uv AS (SELECT user_pseudo_id, list(round(value::decimal(38,12), 6)::double ORDER BY dim) AS u FROM rc_uservec GROUP BY 1)
  SELECT p.user_pseudo_id, p.item_id, coalesce(r.recency_days, 30)::bigint AS recency_days, coalesce(r.orders_count, 0) AS orders_count,
         coalesce(r.sessions_count, 0) AS sessions_count, coalesce(r.active_days, 0) AS active_days,
         coalesce({_L('r.monetary_total')}, 0) AS log1p_monetary, coalesce(r.distinct_items_viewed, 0) AS distinct_items_viewed,
         coalesce({_L('c.users_viewed')}, 0) AS log1p_users_viewed,
         coalesce({_L('c.users_purchased')}, 0) AS log1p_users_purchased,
         coalesce(round((c.users_carted / nullif(c.users_viewed, 0)::double)::decimal(38,12), 4)::double, 0) AS view_to_cart_user_rate,
         coalesce(round((c.users_purchased / nullif(c.users_viewed, 0)::double)::decimal(38,12), 4)::double, 0) AS view_to_purchase_user_rate,
         coalesce({_L('c.price_latest')}, 0) AS log1p_price_latest, coalesce((r.data_anchor_date - c.first_seen_date)::bigint, 0) AS days_since_first_seen,
         coalesce((r.data_anchor_date - c.last_seen_date)::bigint, 0) AS days_since_last_seen,
         coalesce(round((list_dot_product(uv.u, e.embedding::double[]) / nullif(sqrt(list_dot_product(e.embedding::double[], e.embedding::double[])), 0))::decimal(38,12), 5)::double, 0) AS i2v_cos_user_item,
         coalesce(h.weighted_hist_interaction, 0) AS weighted_hist_interaction,
         coalesce((c.item_category = fav.cat)::bigint, 0) AS seed_same_category, p.src::bigint AS recall_src,
         coalesce(pt.views_1h, 0) AS rt_views_1h, coalesce(pt.carts_1h, 0) AS rt_carts_1h, coalesce(pt.events_30m, 0) AS rt_events_30m,
         coalesce((c.item_category = rtc.rt_cat)::bigint, 0) AS rt_item_matches_top_cat,
         CASE WHEN pt.events_30m IS NOT NULL THEN 1 ELSE 0 END::bigint AS has_rt
  FROM rc_pool p LEFT JOIN ga_rfm r ON r.user_pseudo_id = p.user_pseudo_id LEFT JOIN ga_catalog c ON c.item_id = p.item_id
  LEFT JOIN hist h ON h.user_pseudo_id = p.user_pseudo_id AND h.item_id = p.item_id
  LEFT JOIN fav ON fav.user_pseudo_id = p.user_pseudo_id LEFT JOIN rtc ON rtc.user_pseudo_id = p.user_pseudo_id
  LEFT JOIN newest n ON n.user_pseudo_id = p.user_pseudo_id LEFT JOIN rc_pit pt ON pt.event_key = n.event_key
  LEFT JOIN uv ON uv.user_pseudo_id = p.user_pseudo_id LEFT JOIN embeddings e ON p.item_id = 'item_' || e.vec_id""")
def rank_features(t: Tables):
    return features(t)[0].select("user_pseudo_id", "item_id", *FEATURE_NAMES)


def features(t: Tables, window=None, near: DataFrame | None = None):
    """Ranking features of all candidates, from the events of ``window`` alone (a filter of events)."""
    events = stored(window(ga(t)) if window else ga(t), "events")
    catalog = cut(commerce.item_catalog(events))
    found, interest, lists = pool(events, neighbours(t) if near is None else near, catalog)
    found = stored(found, "candidates")
    cosines = reco.user_item_cosine(found, reco.user_vectors(interest, vectors(t)), vectors(t))
    return reco.rank_features(found, events, commerce.user_rfm(events), catalog, interest, cosines, lists, 30), events


view("rc_grades", f"SELECT user_pseudo_id, item_id, max({_G}) AS grade FROM rc_label GROUP BY 1, 2")


@query("ltr_dataset", """
  WITH r AS (SELECT p.user_pseudo_id, p.item_id, p.rank, coalesce(g.grade, 0)::bigint AS grade FROM rc_train_pool p LEFT JOIN rc_grades g USING (user_pseudo_id, item_id))
  SELECT * FROM r WHERE user_pseudo_id IN (SELECT user_pseudo_id FROM r WHERE grade > 0)""")
def ltr_dataset(t: Tables):
    events = kept_events(t)
    found = pool(train(events), neighbours(t), commerce.item_catalog(events))[0]
    return reco.ltr_dataset(found, label(events)).select("user_pseudo_id", "item_id", "rank", "grade")


def variants(t: Tables, events: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """Two ranked lists per user of the training window: popular and fused."""
    catalog = commerce.item_catalog(events)
    past = train(events)
    fused = pool(past, neighbours(t) if near is None else near, catalog)[0].select("user_pseudo_id", "item_id", "rank", F.lit("rrf").alias("variant"))
    users = past.select("user_pseudo_id").distinct()
    short = reco.popularity(past, catalog).where("scope = 'global'").agg(F.collect_list(F.struct("item_id", "rank")).alias("l"))
    pop = users.transform(attach, short).select("user_pseudo_id", F.explode("l").alias("p")).select(
        "user_pseudo_id", "p.item_id", "p.rank", F.lit("pop").alias("variant"))
    return fused.unionByName(pop)


def _metric_sql(ranked: str, judged: str, keys: str, k: int = 10) -> str:
    return f"""
      WITH rk AS ({ranked}), jd AS ({judged}),
      ideal AS (SELECT {keys}, count(*) AS relevant, sum(CASE WHEN i <= {k} THEN (pow(2.0, grade) - 1) / log2(i + 1) END) AS idcg
                FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY grade DESC, item_id) AS i FROM jd) GROUP BY {keys}),
      got AS (SELECT variant, {keys}, count(*) AS hits, sum((pow(2.0, grade) - 1) / log2(rank + 1)) AS dcg, sum(seen / rank::double) AS precisions, min(rank) AS first
              FROM (SELECT *, row_number() OVER (PARTITION BY variant, {keys} ORDER BY rank) AS seen FROM rk JOIN jd USING ({keys}, item_id) WHERE rank <= {k})
              GROUP BY variant, {keys}),
      q AS (SELECT v.variant, i.*, coalesce(hits, 0) AS hits, coalesce(dcg, 0) AS dcg, coalesce(precisions, 0) AS precisions, coalesce(first, 0) AS first
            FROM ideal i CROSS JOIN (SELECT DISTINCT variant FROM rk) v LEFT JOIN got g USING (variant, {keys}))
      SELECT variant, count(*) AS queries, unnest(['hit', 'recall', 'ndcg', 'map', 'mrr']) AS metric,
             unnest([round(avg((hits > 0)::int)::decimal(38,12), 6)::double, round(avg(hits / relevant::double)::decimal(38,12), 6)::double,
                     round(avg(dcg / idcg)::decimal(38,12), 6)::double, round(avg(precisions / least(relevant, {k}))::decimal(38,12), 6)::double,
                     round(avg(CASE WHEN first > 0 THEN 1.0::double / first ELSE 0 END)::decimal(38,12), 6)::double]) AS value, {k}::bigint AS k
      FROM q GROUP BY variant"""


_RANKED = """SELECT 'rrf' AS variant, user_pseudo_id, item_id, rank FROM rc_train_pool
    UNION ALL SELECT 'pop', u.user_pseudo_id, p.item_id, p.rank FROM (SELECT DISTINCT user_pseudo_id FROM rc_train) u
    CROSS JOIN rc_train_popular p WHERE p.scope = 'global'"""
view("rc_metrics", _metric_sql(_RANKED, "SELECT * FROM rc_grades", "user_pseudo_id").strip())


@query("rank_metrics", "SELECT * FROM rc_metrics")
def rank_metrics(t: Tables):
    events = kept_events(t)
    return ranking.rank_metrics(stored(variants(t, events), "lists"), reco.graded(label(events)), ["user_pseudo_id"])


@query("promotion_gate", """
  SELECT *, passes_floor AND beats_baseline AND holds_production AS promoted FROM (
    SELECT c AS candidate, b AS baseline, p AS production, c >= 0.15 AS passes_floor, c > b AS beats_baseline, p IS NULL OR c >= p - 0.02 AS holds_production
    FROM (SELECT max(value) FILTER (variant = 'rrf') AS c, max(value) FILTER (variant = 'pop') AS b, max(value) FILTER (variant = 'pop') AS p
          FROM rc_metrics WHERE metric = 'ndcg'))""")
def promotion_gate(t: Tables):
    return ranking.promotion_gate(rank_metrics(t), "rrf", "pop", "pop")


@query("ltr_groups", """
  SELECT count(*) AS users, count(*) FILTER (hits = 0) AS dropped, round((count(*) FILTER (hits = 0) / count(*)::double)::decimal(38,12), 6)::double AS dropped_rate
  FROM (SELECT p.user_pseudo_id, count(g.grade) AS hits FROM rc_train_pool p LEFT JOIN rc_grades g USING (user_pseudo_id, item_id) GROUP BY 1)""")
def ltr_groups(t: Tables):
    events = kept_events(t)
    return reco.dropped_groups(pool(train(events), neighbours(t), commerce.item_catalog(events))[0], label(events))


def fitting(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_date") <= F.lit(FIT_END).cast("date"))


def fitting_label(events: DataFrame) -> DataFrame:
    return train(events).where(F.col("event_date") >= F.lit(FIT_LABEL_START).cast("date"))


def ranked_by_model(t: Tables, near: DataFrame | None = None) -> DataFrame:
    """Ranks for the label window from a model that has seen neither that window nor its features."""
    near = neighbours(t) if near is None else near
    past, now = features(t, fitting, near)[0], features(t, train, near)[0]
    return reco.pointwise_ranker(stored(past, "features"), reco.graded(fitting_label(ga(t))), stored(now, "features"), FEATURE_NAMES)


@query("ranker")
def ranker(t: Tables):
    return ranked_by_model(t)


@query("ranker_gate")
def ranker_gate(t: Tables):
    """The fitted ranker against the popular list, with the fused list in production."""
    events = kept_events(t)
    near = neighbours(t)
    lists = variants(t, events, near).unionByName(ranked_by_model(t, near).select("user_pseudo_id", "item_id", "rank", F.lit("ranker").alias("variant")))
    found = ranking.rank_metrics(stored(lists, "lists"), reco.graded(label(events)), ["user_pseudo_id"])
    return ranking.promotion_gate(found, "ranker", "pop", "rrf")


view("ab_crc", """
  WITH tbl AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::bigint, generate_series(1, 8)),
      lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(generate_series(0, 255)) AS i)))
  SELECT user_pseudo_id, xor(list_reduce(list_prepend(4294967295::bigint, [unicode(ch)::bigint FOR ch IN string_split(user_pseudo_id, '')]),
      lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::int])), 4294967295) AS crc
  FROM (SELECT DISTINCT user_pseudo_id FROM ga), tbl""")
view("ab_judged", """
  WITH s AS (SELECT *, row_number() OVER (PARTITION BY user_pseudo_id, ga_session_id ORDER BY event_ts_micros, event_name, item_id) AS pos
             FROM rc_label WHERE ga_session_id IS NOT NULL),
  j AS (SELECT s.*, CASE WHEN c.crc % 100 < 50 THEN 'A' ELSE 'B' END AS arm,
               CASE WHEN c.crc % 100 < 50 THEN (s.user_pseudo_id, s.item_id) IN (SELECT user_pseudo_id, item_id FROM rc_train_pool WHERE rank <= 10)
                    ELSE s.item_id IN (SELECT item_id FROM rc_train_popular WHERE scope = 'global' AND rank <= 10) END AS hit
        FROM s JOIN ab_crc c USING (user_pseudo_id))
  SELECT user_pseudo_id, ga_session_id, arm, coalesce(bool_or(hit) FILTER (pos > 1), false) AS hit_any,
         coalesce(bool_or(hit AND event_name = 'purchase') FILTER (pos > 1), false) AS hit_purchase
  FROM j GROUP BY ALL""")


def replayed(t: Tables) -> DataFrame:
    events = kept_events(t, "ga_session_id", "event_ts")
    past, catalog = train(events), commerce.item_catalog(events)
    return reco.ab_replay(label(events), pool(past, neighbours(t), catalog)[0], reco.popularity(past, catalog))


@query("ab_replay", """
  SELECT arm, 'labeled_event_replay' AS traffic_type, count(*) AS sessions, count(*) FILTER (hit_any) AS hits, count(*) FILTER (hit_purchase) AS purchase_hits,
         round((count(*) FILTER (hit_any) / count(*)::double)::decimal(38,12), 6)::double AS hit_rate,
         round((count(*) FILTER (hit_purchase) / count(*)::double)::decimal(38,12), 6)::double AS purchase_hit_rate
  FROM ab_judged GROUP BY arm""")
def ab_replay(t: Tables):
    return reco.ab_summary(replayed(t))


_TAIL = """(exp(-x * x / 2) * 0.3989422804014327::double * k * (0.319381530::double + k * (-0.356563782::double + k * (1.781477937::double
    + k * (-1.821255978::double + k * 1.330274429::double)))))"""
_R = lambda e, n: f"round(({e})::decimal(38,12), 6)::double AS {n}"


@query("ab_ztest", f"""
  WITH a AS (SELECT (count(*) FILTER (arm = 'A'))::double AS na, (count(*) FILTER (arm = 'B'))::double AS nb,
                    (count(*) FILTER (arm = 'A' AND hit_any))::double AS ha, (count(*) FILTER (arm = 'B' AND hit_any))::double AS hb FROM ab_judged),
  b AS (SELECT *, ha / na AS pa, hb / nb AS pb, (ha + hb) / (na + nb) AS p FROM a),
  c AS (SELECT *, pa - pb AS d, sqrt(p * (1 - p) * (1 / na + 1 / nb)) AS se, sqrt(pa * (1 - pa) / na + pb * (1 - pb) / nb) AS sd FROM b),
  z AS (SELECT *, d / nullif(se, 0) AS z, abs(d / nullif(se, 0)) AS x, 1.0::double / (1.0::double + 0.2316419::double * abs(d / nullif(se, 0))) AS k FROM c)
  SELECT {_R('pa', 'rate_a')}, {_R('pb', 'rate_b')}, {_R('z', 'z')}, {_R('2 * ' + _TAIL, 'p_value')},
         {_R('d - 1.959964::double * sd', 'ci_low')}, {_R('d + 1.959964::double * sd', 'ci_high')} FROM z""")
def ab_ztest(t: Tables):
    return ranking.two_proportions(reco.ab_summary(replayed(t)), "arm", "sessions", "hits")


@query("reco_segments", """
  SELECT user_pseudo_id, CASE WHEN orders_count >= 2 THEN 'buyer_repeat' WHEN orders_count = 1 THEN 'buyer_once'
         WHEN active_days >= 3 THEN 'browser_active' ELSE 'cold' END AS segment FROM ga_rfm""")
def reco_segments(t: Tables):
    return reco.display_segments(commerce.user_rfm(ga(t)))


view("loo", f"""
  WITH l AS (SELECT user_pseudo_id, session_key, list(item_id ORDER BY pos) AS items, max(event_date) AS last_date
             FROM rc_seq WHERE n >= 2 AND pos > n - 21 GROUP BY 1, 2)
  SELECT user_pseudo_id, session_key, array_to_string(items[:-2], ' ') AS history, items[-2] AS last_item, items[-1] AS target, last_date,
         CASE WHEN last_date <= date '{TRAIN_END}' THEN 'eval' WHEN last_date >= date '2024-01-25' THEN 'test' ELSE 'label' END AS split FROM l""")


@query("loo_samples", "SELECT * REPLACE (last_date::varchar AS last_date) FROM loo")
def loo_samples(t: Tables):
    return reco.leave_one_out(reco.session_sequences(ga(t)), TRAIN_END, "2024-01-25").drop("validation")


_NEXT = """SELECT 'lastitem' AS variant, l.user_pseudo_id, l.session_key, 'item_' || k.item_id AS item_id, k.rank FROM loo l
      JOIN rc_knn k ON l.last_item = 'item_' || k.query_id WHERE l.split = 'test' AND k.rank <= 10
    UNION ALL SELECT 'pop', l.user_pseudo_id, l.session_key, p.item_id, p.rank FROM loo l CROSS JOIN rc_train_popular p
      WHERE l.split = 'test' AND p.scope = 'global' AND p.rank <= 10"""


@query("next_item_eval", _metric_sql(_NEXT, "SELECT user_pseudo_id, session_key, target AS item_id, 1 AS grade FROM loo WHERE split = 'test'", "user_pseudo_id, session_key"))
def next_item_eval(t: Tables):
    """Full ranking of the held-out next item; a target never seen in training stays in as a miss."""
    events = kept_events(t, "ga_session_id", "event_ts")
    samples = cut(reco.leave_one_out(reco.session_sequences(events), TRAIN_END, "2024-01-25").where("split = 'test'"))
    key = ["user_pseudo_id", "session_key"]
    near = neighbours(t).where("rank <= 10")
    last = samples.select(*key, F.col("last_item").alias("query_id")).join(near, "query_id").select(
        F.lit("lastitem").alias("variant"), *key, "item_id", "rank")
    short = reco.popularity(train(events), commerce.item_catalog(events)).where("scope = 'global' and rank <= 10").agg(
        F.collect_list(F.struct("item_id", "rank")).alias("l"))  # ten items
    pop = samples.select(*key).transform(attach, short).select(*key, F.explode("l").alias("p")).select(
        F.lit("pop").alias("variant"), *key, "p.item_id", "p.rank")
    judged = samples.select(*key, F.col("target").alias("item_id"), F.lit(1).alias("grade"))
    return ranking.rank_metrics(last.unionByName(pop), judged, key)


@query("recall_ablation")
def recall_ablation(t: Tables):
    """The same evaluation over four sets of recall paths."""
    events = kept_events(t, "transaction_id")
    past, catalog, near = train(events), commerce.item_catalog(events), neighbours(t)
    chosen = stored(reco.seeds(reco.decayed(past, commerce.anchor(past))), "seeds")
    popular = cut(reco.popularity(past, catalog))
    baskets = past.where("event_name = 'purchase' and transaction_id is not null").select(
        F.col("transaction_id").alias("basket"), F.col("item_id").alias("item"))
    found = growth.bought_together(baskets, min_cooccur=1, min_confidence=0.0)
    rules = cut(found.select(F.col("antecedent").alias("seed_item"), F.col("consequent").alias("item_id"), F.col("rule_rank").alias("rank")))
    bought = cut(reco.bought_items(past))
    sets = {"i2v": (None, None), "i2v_pop": (popular, None), "i2v_fbt": (None, rules), "all": (popular, rules)}
    lists = [reco.fuse(reco.candidate_lists(chosen, near, p, r), bought).withColumn("variant", F.lit(name))
             .select("variant", "user_pseudo_id", "item_id", "rank") for name, (p, r) in sets.items()]
    return ranking.rank_metrics(stored(reduce(DataFrame.unionByName, lists), "lists"), reco.graded(label(events)), ["user_pseudo_id"], 50)
