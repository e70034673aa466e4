"""Byte-pair encoding of whole texts with the word-end vocabulary of a ``tokenizers`` JSON file, and decoding.

Each piece of a text is an array of part ids beside an array of the ranks of adjacent pairs. The smallest rank
is found by a scan, its boundary deleted and the two neighbouring ranks refreshed, until no pair has a rank.
Scanning is quadratic, so pieces of more than ``SHORT`` parts take the same merges from a heap of ranks instead.
Frequent pieces are remembered, up to a fixed number per task.

Lower-casing, composition and splitting follow this Python's Unicode tables. Text with a character they don't
know yet, or with a combining mark that the ``tokenizers`` library orders otherwise (its tables of letters are newer
than Python's, those of composition older), is normalised and split by the library; merging stays the same. Which
way a text goes is decided by its distinct characters; a mark's order is asked of the library once.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator, Sequence

import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import only, utf8

SHORT = 64  # parts up to which the smallest rank is found by scanning
REMEMBERED = 300_000  # pieces kept per Python worker, twice: the current ones and those before
BATCH_CHARS = 2_000_000
NONE = 1 << 60

# The white space of the vocabulary's patterns, and its pattern of pieces
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + SPACE + r"\p{L}\p{N}]+"
# the same for texts whose letters and digits are all that \w stands for
PLAIN_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w" + SPACE + r"]|_)+"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(spare)) for b in range(256)]


PLAIN, NUMERAL, UNKNOWN = range(3)


@functools.cache
def kind(c: str) -> int:
    """Whether ``c`` is a number other than a digit, or not in this Python's tables; most are neither."""
    category = unicodedata.category(c)
    if category == "Cn":
        return UNKNOWN
    return NUMERAL if c.isalnum() and category[0] != "L" and category != "Nd" else PLAIN


# An old mark of each of the classes 1, 220, 230 and 240, which every table orders alike
OLD_MARKS = "\u0334\u0323\u0301\u0345"


def lowered(part: str) -> str:
    """Composed and lower-cased: each character by itself, also a final sigma."""
    return unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()


class Bpe:
    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.ranks: dict[int, int] = {}  # by both ids as one number
        self.made: list[int] = []  # id by rank
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault(self.ids[a] << 32 | self.ids[b], rank)
            self.made.append(self.ids[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        letters = byte_letters()
        self.inner = [self.ids[c] for c in letters]
        self.last = [self.ids[c + self.end] for c in letters]
        self.pieces, self.plain_pieces = regex.compile(PIECES), re.compile(PLAIN_PIECES)
        self.plain: set[str] = set()  # characters found to be
        self.kinds: dict[str, int] = {}
        self.marks = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        self.known: dict[str, list[int]] = {}
        self.before: dict[str, list[int]] = {}

    def kind(self, c: str) -> int:
        """``kind`` of a character, and ``UNKNOWN`` for a mark that the library doesn't order as Python does."""
        found = self.kinds.get(c)
        if found is None:
            found = kind(c)
            if unicodedata.category(c)[0] == "M" and found != UNKNOWN and not self.ordered_alike(c, self.ordered_marks):
                found = UNKNOWN
            self.kinds[c] = found
        return found

    def ordered_alike(self, c: str, marks: Sequence[str]) -> bool:
        probes = (text for m in marks for text in (f"x{c}{m}", f"x{m}{c}"))
        return all(self.library.normalizer.normalize_str(t) == lowered(t) for t in probes)

    @functools.cached_property
    def ordered_marks(self) -> list[str]:
        """For each canonical combining class the first mark that the library and Python order alike."""
        first: dict[int, str] = {}
        for c in map(chr, range(0x300, 0x1F000)):
            if (ccc := unicodedata.combining(c)) and ccc not in first and self.ordered_alike(c, OLD_MARKS):
                first[ccc] = c
        return list(first.values())

    def merged(self, parts: list[int]) -> list[int]:
        """The rank array: ``ranks[i]`` is that of parts i and i + 1."""
        get, made = self.ranks.get, self.made
        ranks = [get(a << 32 | b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == NONE:
                break
            i = ranks.index(low)
            part = parts[i] = made[low]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(part << 32 | parts[i + 1], NONE)
            if i:
                ranks[i - 1] = get(parts[i - 1] << 32 | part, NONE)
        return parts

    def merged_long(self, parts: list[int]) -> list[int]:
        """The same merges, smallest rank and then leftmost first, from a heap over linked parts."""
        get, n = self.ranks.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def found(i: int, j: int) -> list[tuple[int, int, int, int]]:
            rank = get(parts[i] << 32 | parts[j])
            return [] if rank is None else [(rank, i, parts[i], parts[j])]

        heap = [x for i in range(n - 1) for x in found(i, i + 1)]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue  # one of them has been merged since
            parts[i], parts[j] = self.made[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                for x in found(i, k):
                    heapq.heappush(heap, x)
            if (h := before[i]) >= 0:
                for x in found(h, i):
                    heapq.heappush(heap, x)
        return [p for p in parts if p >= 0]

    def joined(self, parts: list[int]) -> list[int]:
        return self.merged(parts) if len(parts) <= SHORT else self.merged_long(parts)

    def word(self, piece: str) -> list[int]:
        """The ids of a piece that isn't among the known ones; it is from then on."""
        found = self.before.get(piece)
        if found is None:
            data = utf8(piece)
            found = self.joined([self.inner[b] for b in data[:-1]] + [self.last[data[-1]]])
        if len(piece) <= SHORT:
            if len(self.known) >= REMEMBERED:
                self.before, self.known = self.known, {}
            self.known[piece] = found
        return found

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.marks.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                plain = lowered(part)
                kinds = {self.kind(c) for c in set(plain) - self.plain}
                if UNKNOWN in kinds:
                    for letters, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part)):
                        out += self.joined([self.ids[c] for c in letters[:-1]] + [self.ids[letters[-1] + self.end]])
                    continue
                if not kinds - {PLAIN}:
                    self.plain.update(plain)
                for piece in (self.pieces if NUMERAL in kinds else self.plain_pieces).findall(plain):
                    ids = self.known.get(piece)
                    out += self.word(piece) if ids is None else ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder: its tokens, a space between each two."""
        return " ".join([self.tokens[i] for i in ids])


@functools.lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) per row, special tokens only where the text spells them.

    ``path`` must be readable on every executor. A null or empty text has no ids and decodes to "". Rows are
    independent: repeated rows give repeated results, null ids stay null.
    """
    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for frame in frames:
            rows, chars = [], 0
            for doc, text in zip(frame["id"], frame["text"]):
                ids = bpe.encode(text) if isinstance(text, str) else []
                rows.append((doc, ids, bpe.decode(ids)))
                chars += len(text) if isinstance(text, str) else 0
                if chars > BATCH_CHARS:
                    yield pd.DataFrame(rows, columns=["doc_id", "ids", "decoded"])
                    rows, chars = [], 0
            yield pd.DataFrame(rows, columns=["doc_id", "ids", "decoded"])

    source = only(docs, id_col, text_col).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    out = source.mapInPandas(each, "doc_id string, ids array<int>, decoded string")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
