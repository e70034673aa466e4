import random
import unicodedata

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import docs_frame, prose
from tidemark.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
CASES = ["", "Hello World's it'll 123 ABC", "ΣΑΣ Σ İstanbul ß ﬁ", "á é x y\x1cz\x85w v", "x" * 500, "thonthere" * 200,
         "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "日本語テキスト 한국어 ȩ́", "!!!###  $$$ 'S 'T 're", "😀👍🏽 ÄÖÜ", "Ǆ ǅ ŉ ΐ",
         "\x00\x01\x7f​‍﻿", "Ᲊa Ꟛb", "'sometimes 'tis", prose(1, 20_000)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_and_text_as_the_library(library):
    own = bpe.load(PATH)
    rng = random.Random(2)
    mixed = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x600), rng.randrange(0x1E00, 0x2100), rng.randrange(0x3040, 0x30FF)]))
                     for _ in range(60)) for _ in range(300)]
    for text in CASES + mixed:
        want = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == want
        assert own.decode(want) == library.decode(want, skip_special_tokens=False)


def test_all_marks_in_pairs(library):
    """Every combining mark before and after every other one, also those the library's tables don't order."""
    own = bpe.load(PATH)
    marks = [chr(c) for c in range(0x300, 0x1F000) if unicodedata.combining(chr(c))]
    odd = [m for m in marks if own.kind(m) == bpe.UNKNOWN]
    sure = [m for m in marks if own.kind(m) != bpe.UNKNOWN]
    assert len(odd) > 50 and len(sure) > 700
    assert own.encode("a\u0898\u0323") == library.encode("a\u0898\u0323", add_special_tokens=False).ids
    for first in marks:
        for others in (sure, odd):  # a text with an odd mark goes through the library as a whole
            text = " ".join("a" + first + m for m in others)
            assert own.encode(text) == library.encode(text, add_special_tokens=False).ids, hex(ord(first))


def test_random_texts(library):
    own, rng = bpe.load(PATH), random.Random(11)
    points = [c for c in range(0x20, 0x1F000) if not 0xD800 <= c < 0xE000]
    marks = [c for c in points if unicodedata.category(chr(c))[0] == "M"]
    pick = lambda: chr(rng.choice(marks) if rng.random() < 0.4 else rng.choice(points) if rng.random() < 0.5 else rng.randrange(0x20, 0x250))
    texts = ["".join(pick() for _ in range(rng.randrange(1, 16))) for _ in range(100_000)]
    for text, want in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False)):
        assert own.encode(text) == want.ids, ascii(text)


def test_scan_and_heap_merge_alike():
    own, rng = bpe.load(PATH), random.Random(3)
    for _ in range(300):
        parts = [own.inner[rng.randrange(97, 105)] for _ in range(rng.randrange(1, 60))]
        assert own.merged(list(parts)) == own.merged_long(list(parts))


def test_rows(spark, library):
    rows = [(i, t) for i, t in enumerate(CASES)] + [(99, None), (None, "null id"), (7, CASES[7])]
    got = bpe.encode_decode(docs_frame(spark, rows, ["ids", "decoded", "id"]), PATH).collect()
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([(r["doc_id"], list(r["ids"]), r["decoded"]) for r in got], key=key) == sorted(want, key=key)
    assert bpe.encode_decode(docs_frame(spark, []), PATH).collect() == []
