"""Main texts of pages by the templates that their hosts share.

Tokens are tags and texts, told apart by the path of elements they stand on. For every host and token, the vector
of its occurrences over the host's pages is reduced to sums of hashes of (page, count). Tokens with equal vectors
form an equivalence class. Classes that are frequent and large enough are candidates; one is valid if its
tokens come in one order on every page, once or repeatedly, and if it nests: seen from any other kept class, it
always lies in the same gap. Valid classes are the host's template, and what lies between template tokens are
slots. Hosts with too few pages are taken together.

A page's main text are the slots within its article (else its main element, else all slots that aren't mostly
links). What an element's name, class or role marks as menu, header, footer, sidebar, notice, advert, form or
comments is no slot of it, and outside articles neither is a block all of whose texts belong to the template.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import only, written
from tidemark.llm.html_tokens import ARTICLE, INLINE, MAIN, OFF, TEXT, Token, blocks, tokens

MIN_PAGES = 4  # of a host that has a template of its own
FREQUENT = 0.5  # share of a host's pages that a template token is on
LARGE = 2  # tokens of a class
BROADCAST_BYTES = 32 << 20  # measured size of all templates up to which they are broadcast

STREAM = "host string, page long, roles array<long>, seen array<struct<role: long, c: int>>"
RELATION = "grp string, outer long, inner long, low long, high long"
MIXED = -2  # not one gap
OUTSIDE = -1
LOW32 = (1 << 32) - 1


def _signed(roles: list[int]) -> np.ndarray:
    return np.array(roles, dtype=np.uint64).view(np.int64)


def _stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for at in range(0, len(frame), 500):
            part, roles, seen = frame.iloc[at:at + 500], [], []
            for page in part["html"]:
                mine = _signed([t.role for t in tokens(page)])
                name, count = np.unique(mine, return_counts=True)
                roles.append(mine)
                seen.append([{"role": r, "c": c} for r, c in zip(name.tolist(), count.tolist())])
            yield pd.DataFrame({"host": part["host"], "page": part["page"], "roles": roles, "seen": seen})


def relations(roles: list[int], known: dict[int, int], sizes: dict[int, int]) -> dict[tuple[int, int], int]:
    """Of one page: (class, class) -> hash of its tokens' order, (outer, inner) -> gap of the outer's period.

    ``known`` maps roles to classes. Gap i follows the outer's i-th token; before its first and after its last
    one is outside. What isn't one order or one gap is ``MIXED``.
    """
    position = {}
    for role in roles:
        mine = known.get(role)
        if mine is not None and role not in position.setdefault(mine, {}):
            position[mine][role] = len(position[mine])
    out, now = {}, {}
    for mine, order in position.items():
        out[mine, mine] = xxhash.xxh3_64_intdigest(np.array(list(order), dtype=np.int64).tobytes()) >> 1 if len(order) == sizes[mine] else MIXED
    for role in roles:
        mine = known.get(role)
        if mine is None:
            continue
        step = position[mine][role]
        if step != now.get(mine, OUTSIDE) + 1:  # each token once a period, in the order of the first one
            out[mine, mine] = MIXED
        for other in position:
            if other != mine:
                gap = now.get(other, OUTSIDE)
                if out.setdefault((other, mine), gap) != gap:
                    out[other, mine] = MIXED
        now[mine] = OUTSIDE if step == sizes[mine] - 1 else step
    return out


def valid(sizes: dict[int, tuple[int, int]], gaps: dict[tuple[int, int], int]) -> set[int]:
    """Classes in one order that nest with all others kept; the most frequent, then the largest come first.

    ``sizes``: class -> (pages, tokens); ``gaps``: relations that are the same on all pages, else ``MIXED``. Two
    classes nest if one always lies in one gap of the other, or outside it. Those that never meet nest.
    """
    kept = []
    for c in sorted(sizes, key=lambda c: (-sizes[c][0], -sizes[c][1], c)):
        if gaps.get((c, c), MIXED) == MIXED:
            continue
        if all((k, c) not in gaps or MIXED not in (gaps[k, c], gaps[c, k]) or gaps[k, c] >= 0 or gaps[c, k] >= 0 for k in kept):
            kept.append(c)
    return set(kept)


def _bounded_join(rows: DataFrame, small: DataFrame, key: str, size: int) -> DataFrame:
    """``rows`` with their template: broadcast if all templates are measured small, else joined by key."""
    return rows.join(F.broadcast(small) if size <= BROADCAST_BYTES else small, key, "left")


def _related(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    found = {}
    for frame in frames:
        for grp, roles, names, classes in zip(frame["grp"], frame["roles"], frame["names"], frame["classes"]):
            if names is None or roles is None:
                continue
            known = dict(zip(names.tolist(), classes.tolist()))
            sizes = dict(zip(*(x.tolist() for x in np.unique(classes, return_counts=True))))
            for (a, b), gap in relations(roles.tolist(), known, sizes).items():
                low, high = found.get((grp, a, b), (gap, gap))
                found[grp, a, b] = min(low, gap), max(high, gap)
        if len(found) > 500_000:
            yield _relation_frame(found)
            found = {}
    yield _relation_frame(found)


def _relation_frame(found: dict) -> pd.DataFrame:
    return pd.DataFrame([(*k, *v) for k, v in found.items()], columns=["grp", "outer", "inner", "low", "high"])


def _template(key, frame: pd.DataFrame) -> pd.DataFrame:
    """One group's rows: relations (with a gap) and classes (with their roles)."""
    own = frame[frame["roles"].notna()]
    sizes = {int(c): (int(p), len(r)) for c, p, r in zip(own["outer"], own["pages"], own["roles"])}
    met = frame[frame["roles"].isna()]
    gaps = {(int(a), int(b)): int(low) if low == high else MIXED for a, b, low, high in zip(met["outer"], met["inner"], met["low"], met["high"])}
    good = valid(sizes, gaps)
    names = [x for c, r in zip(own["outer"], own["roles"]) if int(c) in good for x in r]
    return pd.DataFrame({"grp": [key[0]], "names": [np.array(names, dtype=np.int64)]})


def templates(stream: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(host, grp), (grp, names: roles of all template tokens) and the number of bytes of the latter."""
    hosts = stream.groupBy("host").agg(F.count("*").alias("n"))
    hosts = written(hosts.select("host", F.when((F.col("n") >= MIN_PAGES), F.concat(F.lit("h"), "host")).otherwise("").alias("grp"), "n"), "template-hosts")
    groups = hosts.groupBy("grp").agg(F.sum("n").alias("n"))
    one = stream.select("host", "page", F.explode("seen").alias("s")).select("host", "page", "s.role", "s.c")
    h = F.xxhash64("page", "c")
    vectors = one.groupBy("host", "role").agg(F.count("*").alias("pages"), F.sum("c").alias("total"), F.sum(h.bitwiseAND(LOW32)).alias("x"),
                                              F.sum(F.shiftrightunsigned(h, 32)).alias("y"))
    vectors = vectors.join(hosts.select("host", "grp"), "host").groupBy("grp", "role").agg(*[F.sum(c).alias(c) for c in ("pages", "total", "x", "y")])
    frequent = vectors.join(groups, "grp").where((F.col("pages") >= F.col("n") * FREQUENT) & (F.col("pages") >= 2))
    # a group has at most (tokens of a page) / FREQUENT of these, so its rows can be one array
    classes = frequent.groupBy("grp", "pages", "total", "x", "y").agg(F.sort_array(F.collect_list("role")).alias("roles")).where(F.size("roles") >= LARGE)
    classes = written(classes.select("grp", F.xxhash64("pages", "total", "x", "y").alias("outer"), "pages", "roles"), "template-classes")
    flat = classes.select("grp", "outer", F.explode("roles").alias("role")).groupBy("grp")
    packed = flat.agg(F.collect_list(F.struct("role", "outer")).alias("t")).select("grp", F.col("t.role").alias("names"), F.col("t.outer").alias("classes"))
    size = 16 * (classes.agg(F.sum(F.size("roles"))).first()[0] or 0)
    known = hosts.select("host", "grp").join(packed, "grp")
    met = _bounded_join(stream.select("host", "roles"), known, "host", size + 32 * hosts.count()).select("grp", "roles", "names", "classes")
    met = met.mapInPandas(_related, RELATION).groupBy("grp", "outer", "inner").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    none = F.lit(None)
    both = met.select("grp", "outer", "inner", "low", "high", none.cast("long").alias("pages"), none.cast("array<long>").alias("roles")).unionByName(
        classes.select("grp", "outer", F.col("outer").alias("inner"), none.cast("long").alias("low"), none.cast("long").alias("high"), "pages", "roles"))
    made = written(both.groupBy("grp").applyInPandas(_template, "grp string, names array<long>"), "templates")
    return hosts.select("host", "grp"), made, 8 * (made.agg(F.sum(F.size("names"))).first()[0] or 0) + 32 * hosts.count()


def main_text(page: str, template: set[int]) -> str:
    """The text of the page's main slots."""
    stream = tokens(page)
    texts = [t for t in stream if t.kind == TEXT]
    for region in (ARTICLE, MAIN):
        if any(t.region == region for t in texts):
            return blocks([(t, t.region >= region) for t in stream])
    return blocks(_open_slots(stream, template))


def _open_slots(stream: list[Token], template: set[int]) -> list[tuple[Token, bool]]:
    """Without an article: slots whose text isn't mostly links, less the blocks whose every text is the template's."""
    slot, block, of, size, links, data = 0, 0, [], {}, {}, set()
    for t in stream:
        if t.kind != TEXT:
            slot += t.role in template
            block += t.name not in INLINE
        elif t.region != OFF and t.role not in template:
            data.add(block)
            size[slot] = size.get(slot, 0) + len(t.text)
            links[slot] = links.get(slot, 0) + len(t.text) * t.linked
        of.append((slot, block))
    return [(t, t.region != OFF and b in data and 2 * links.get(s, 0) <= size.get(s, 0)) for t, (s, b) in zip(stream, of)]


def _extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    last, unsigned = None, set()
    for frame in frames:
        for at in range(0, len(frame), 500):
            part, out = frame.iloc[at:at + 500], []
            for grp, page, names in zip(part["grp"], part["html"], part["names"]):
                if grp is None or grp != last:
                    last, unsigned = grp, set() if names is None else set(names.astype(np.int64).view(np.uint64).tolist())
                out.append(main_text(page, unsigned) if page else "")
            yield pd.DataFrame({"page_id": part["page_id"], "url": part["url"], "text": out})


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row: the main text, empty for a null or empty page or one without.

    Rows without a url or host are one group, as are all hosts of fewer than ``MIN_PAGES`` pages. Repeated rows
    are pages like others. Character references are decoded, white space within a block is one space, blocks are
    joined by one.
    """
    host = F.lower(F.regexp_extract(F.col(f"`{url_col}`"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = only(pages, id_col, url_col, html_col).select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"),
        F.coalesce(host, F.lit("")).alias("host"))
    stream = rows.select("host", F.xxhash64("page_id", "url", "html").alias("page"), "html").mapInPandas(_stream, STREAM)
    hosts, made, size = templates(written(stream, "page-tokens"))
    known = hosts.join(made, "grp", "left")
    found = _bounded_join(rows, known, "host", size).select("page_id", "url", "grp", "html", "names")
    found = found.mapInPandas(_extract, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
