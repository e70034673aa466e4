"""Text expressions. Whole texts only; Python runs for NFC alone, which has no built-in."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Prompt-injection patterns, read case-insensitively.
INJECTION = [
    r"ignore\s+(all\s+)?previous\s+instructions?", r"忽略.{0,10}(以上|之前|前面|所有).{0,10}指令", r"forget\s+everything",
    r"你現在是.{0,20}(AI|機器人|助手)", r"act\s+as\s+(if\s+you\s+are|a)", r"system\s*prompt", r"jailbreak", r"DAN\s+mode",
    r"pretend\s+you\s+(are|have\s+no)", r"<\s*(system|assistant|user)\s*>", r"\[INST\]", r"###\s*(System|Instruction)",
    r"<\|im_start\|>|<\|im_end\|>|<\|system\|>", r"developer\s+mode",
    r"(repeat|reveal|print|輸出|重複).{0,20}(system|instructions?|prompt|指令|提示詞)",
]
# Invisible and direction characters that could hide a pattern; removed before matching.
INVISIBLE = r"[\u200b-\u200f\u202a-\u202e\u2066-\u2069]"
# Personal data, masked in this order.
PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\+?[0-9]{0,2} ?\([0-9]{3}\) [0-9]{3}-[0-9]{4}",
    "ip": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "card": r"[0-9]{16}",
    "national_id": r"[A-Z][12][0-9]{8}",
}
CONTROL = r"[\x00-\x08\x0B-\x1F\x7F-\x9F]"
CJK = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]"
EDGES = r"^[ \t\n]+|[ \t\n]+$"


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda s: s if s is None or s.isascii() else unicodedata.normalize("NFC", s))


def clean_text(text: Column) -> Column:
    """Control characters out (line breaks and tabs stay), NFC, trimmed; wording and emoji kept."""
    return F.regexp_replace(nfc(F.regexp_replace(text, CONTROL, "")), EDGES, "")


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def lang_bucket(text: Column) -> Column:
    """A coarse bucket: zh from 30 % CJK letters, en from 70 % Latin letters, else other."""
    letters = F.nullif(count_of(text, r"\p{L}").cast("double"), F.lit(0.0))
    return (F.when(count_of(text, CJK) / letters >= 0.3, "zh")
            .when(count_of(text, r"\p{IsLatin}") / letters >= 0.7, "en").otherwise("other"))


def author_hash(salt: str, channel: Column, name: Column) -> Column:
    """Sixteen hex digits of a salted digest; the display name stands in for a missing id."""
    return F.substring(F.sha2(F.concat(F.lit(salt), F.coalesce(channel, F.concat(F.lit("dn:"), name))), 256), 1, 16)


def duration_seconds(text: Column) -> Column:
    """ISO-8601 duration such as P1DT2H3M4S to seconds; anything else is NULL."""
    part = lambda unit: F.coalesce(F.nullif(F.regexp_extract(text, rf"([0-9]+){unit}", 1), F.lit("")).cast("long"), F.lit(0))
    minutes = F.coalesce(F.nullif(F.regexp_extract(text, r"T.*?([0-9]+)M", 1), F.lit("")).cast("long"), F.lit(0))
    total = part("D") * 86400 + part("H") * 3600 + minutes * 60 + part("S")
    return F.when(text.rlike(r"^P([0-9]+D)?(T([0-9]+H)?([0-9]+M)?([0-9]+S)?)?$"), total)


def tokens(text: Column) -> Column:
    """Lower-cased words; runs of Han characters become overlapping pairs, the same for texts and queries."""
    low = F.lower(text)
    plain = F.regexp_extract_all(low, F.lit(r"([\p{L}\p{N}]+)"), 1)
    mixed = F.regexp_extract_all(low, F.lit(r"([\p{IsHan}]+|[\p{L}\p{N}&&[^\p{IsHan}]]+)"), 1)
    pairs = lambda w: F.when(
        w.rlike(r"^\p{IsHan}") & (F.length(w) > 2),
        F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.substring(w, i, F.lit(2)))).otherwise(F.array(w))
    return F.when(text.rlike(r"\p{IsHan}"), F.flatten(F.transform(mixed, pairs))).otherwise(plain)


def mask_personal(text: Column) -> Column:
    for pattern in PERSONAL.values():
        text = F.regexp_replace(text, pattern, "***")
    return text


def log_pattern(line: Column) -> Column:
    """A log line without its changing parts: uuids, hex numbers, numbers."""
    for pattern in (r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", r"0x[0-9a-f]+", r"[0-9a-f]{16,}", r"[0-9]+(\.[0-9]+)?"):
        line = F.regexp_replace(line, pattern, "#")
    return line
