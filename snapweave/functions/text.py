"""Text normalisation and comparison.

What Java's regular expressions can say is a column expression; only NFKC, HTML unescaping, case folding,
charset fallback and the block-matching ratio are Arrow UDFs. Apply them to distinct dimension values.
"""

from __future__ import annotations

import difflib
import html
import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Characters and words that the identity keys leave out or unify.
MIDDLE_DOTS = "・･·"
DASHES = "‐‑‒–—―−ーｰ-"
PUNCTUATION = "，,．。・:：;；/／\\"
BRACKETS = "()（）[]【】"
QUOTES = "「」『』"
PREFECTURE = "熊本県"
ADDRESS_WORDS = ("大字", "字", "番地", "番", "号")
MUNICIPAL_ADDRESS_WORDS = ("大字", "字", "丁目", "番地", "番", "号")
MUNICIPAL_SYNONYMS = {"コミュニティーセンター": "コミュニティセンター", "コミュニティーセンタ-": "コミュニティセンター", "武道場": "武道館", "2f": "2階", "二階": "2階"}
MUNICIPAL_CITIES = ("八代市", "宇城市")
VARIANT_SUFFIXES = ("体育館", "武道館", "交流スペース")
VARIANT_INFIXES = ("総合体育文化センター", "総合体育館")


def one_of(characters: str) -> str:
    """A character class of Java and Python alike."""
    return "[" + "".join("\\" + c if c in "\\[]^-()&/" else c for c in characters) + "]"


def squeeze(c: Column) -> Column:
    """Runs of Unicode white space become one space; ends are trimmed; null is the empty text."""
    return F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?U)\s+", " "))


def trimmed(c: Column) -> Column:
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


@F.pandas_udf(StringType())
def nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


@F.pandas_udf(StringType())
def unescape_nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda x: unicodedata.normalize("NFKC", html.unescape(x)), na_action="ignore")


@F.pandas_udf(StringType())
def casefold(values: pd.Series) -> pd.Series:
    return values.map(str.casefold, na_action="ignore")


@F.pandas_udf(StringType())
def decode_bytes(values: pd.Series) -> pd.Series:
    """Text of bytes in the first encoding that fits; the last resort replaces what doesn't."""

    def decode(raw: bytes) -> str:
        for encoding in ("utf-8-sig", "utf-8", "cp932", "shift_jis"):
            try:
                return bytes(raw).decode(encoding)
            except UnicodeDecodeError:
                pass
        return bytes(raw).decode("utf-8", "replace")

    return values.map(decode, na_action="ignore")


def normalize_text(c: Column) -> Column:
    """HTML unescaped, NFKC, white space squeezed."""
    return squeeze(unescape_nfkc(F.coalesce(c.cast("string"), F.lit(""))))


def normalize_list(c: Column) -> Column:
    """`normalize_text` of each element of an array; all pass through Python as one text."""
    whole = F.array_join(F.transform(c, lambda v: F.coalesce(v, F.lit(""))), "\x1f")
    return F.when(F.size(c) > 0, F.transform(F.split(unescape_nfkc(whole), "\x1f"), squeeze)).otherwise(F.array().cast("array<string>"))


def clean_text(c: Column) -> Column:
    """NFKC, white space squeezed."""
    return squeeze(nfkc(F.coalesce(c.cast("string"), F.lit(""))))


def _without(c: Column, *classes: str) -> Column:
    for characters in classes:
        c = F.regexp_replace(c, one_of(characters), "")
    return c


def _no_space(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", "")


def _without_words(c: Column, words: tuple[str, ...]) -> Column:
    for w in words:
        c = F.replace(c, F.lit(w), F.lit(""))
    return c


def name_key_reference(c: Column) -> Column:
    """Key of a name in the reference master: brackets stay."""
    return _without(_no_space(casefold(clean_text(c))), MIDDLE_DOTS, DASHES, PUNCTUATION)


def name_key_capacity(c: Column) -> Column:
    """Key of a name in the capacity and coordinate masters: brackets go, middle dots outside the first class stay."""
    return _without(_no_space(casefold(clean_text(c))), MIDDLE_DOTS, DASHES, PUNCTUATION.replace("・", "") + BRACKETS)


def name_key_municipal(c: Column) -> Column:
    """Key of a name in municipal reports: synonyms unified, city prefix dropped, brackets and quotes go."""
    out = casefold(normalize_text(c))
    for old, new in MUNICIPAL_SYNONYMS.items():
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.regexp_replace(out, f"^(?:{PREFECTURE})?(?:{'|'.join(MUNICIPAL_CITIES)})(?:立)?", "")
    out = _no_space(out)
    return _without(out, MIDDLE_DOTS + PUNCTUATION + "." + BRACKETS + QUOTES, DASHES)


def name_variants(key: Column) -> Column:
    """The key, and what is left without each known suffix or infix; blanks and repeats dropped, sorted."""
    options = [key, *(F.when(F.endswith(key, F.lit(s)), F.substring(key, F.lit(1), F.length(key) - len(s))) for s in VARIANT_SUFFIXES), *(F.replace(key, F.lit(s), F.lit("")) for s in VARIANT_INFIXES)]
    return F.array_sort(F.array_distinct(F.filter(F.array(*options), lambda v: v.isNotNull() & (v != ""))))


def address_key(c: Column) -> Column:
    """Key of an address: prefecture and counters dropped, dashes unified."""
    out = _no_space(F.replace(casefold(clean_text(c)), F.lit(PREFECTURE), F.lit("")))
    out = F.regexp_replace(_without_words(out, ADDRESS_WORDS), one_of(DASHES), "-")
    return _without(out, PUNCTUATION)


def address_key_municipal(c: Column) -> Column:
    """Key of an address in municipal reports: city prefix, counters, dashes and all but plain characters dropped."""
    out = F.replace(casefold(normalize_text(c)), F.lit(PREFECTURE), F.lit(""))
    out = F.regexp_replace(out, f"^(?:{'|'.join(MUNICIPAL_CITIES)})", "")
    out = _without(_without_words(out, MUNICIPAL_ADDRESS_WORDS), DASHES)
    return F.regexp_replace(out, "[^0-9a-zぁ-んァ-ヶ一-龠]", "")


def municipality_key(c: Column) -> Column:
    return _no_space(F.replace(casefold(clean_text(c)), F.lit(PREFECTURE), F.lit("")))


def token_key(c: Column) -> Column:
    """Lower case without spaces, dots and dashes, for loose containment."""
    return _without(_no_space(casefold(clean_text(c))), MIDDLE_DOTS, DASHES + "_")


def contains_either(a: Column, b: Column) -> Column:
    """Whether one of two non-empty keys contains the other."""
    return (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))


def infer_municipality(c: Column, suffixes: str = "市|町|村", prefix: str = PREFECTURE) -> Column:
    """The shortest beginning that ends with a municipality's suffix, after the first prefix is dropped."""
    at = F.instr(c, prefix)
    rest = F.when(at > 0, F.concat(F.substring(c, F.lit(1), at - 1), F.substring(c, at + len(prefix), F.length(c)))).otherwise(c)
    return F.regexp_extract(rest, f"^(.+?(?:{suffixes}))", 1)


def ratio(a: str, b: str) -> float:
    """Block-matching similarity 2 M / T; the order of the arguments matters."""
    return difflib.SequenceMatcher(None, a, b).ratio()


@lru_cache(maxsize=1024)
def _against(b: str) -> difflib.SequenceMatcher:
    """A matcher that has read b, the costly half of a comparison."""
    return difflib.SequenceMatcher(None, "", b)


@lru_cache(maxsize=1 << 18)
def _known_ratio(a: str, b: str) -> float:
    """`ratio`; a worker process remembers what its batches compared."""
    if a == b:
        return 1.0
    matcher = _against(b)
    matcher.set_seq1(a)
    return matcher.ratio()


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """`ratio` of two columns; null if either is. Equal pairs in a process are compared once, as long as it remembers them."""
    return pd.Series([None if x is None or y is None else _known_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def best_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Largest ratio between two arrays of variants; 0 if either is empty."""
    return pd.Series([max((_known_ratio(x, y) for x in xs for y in ys), default=0.0) if xs is not None and ys is not None else 0.0 for xs, ys in zip(a, b, strict=True)], dtype="float64")


def unique_join(values: Column, separator: str = " | ") -> Column:
    """Distinct non-blank values of an array in order of first appearance."""
    return F.array_join(F.array_distinct(F.filter(F.transform(values, squeeze), lambda v: v != "")), separator)


def split_list(c: Column, separator: str = ";") -> Column:
    """Parts of a delimited cell, without blanks, sorted."""
    return F.array_sort(F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), re.escape(separator)), lambda v: F.trim(v)), lambda v: v != ""))


def keyword_count(text: Column, keyword: str) -> Column:
    return F.regexp_count(text, F.lit(re.escape(keyword)))


def keyword_contexts(text: Column, keyword: str, before: int = 180, after: int = 240, first: int = 3) -> Column:
    """Text around the first hits of a keyword: `before` characters, the keyword, up to `after` characters from its start."""
    pieces = F.split(text, re.escape(keyword), first + 1)
    hits = F.least(F.size(pieces) - 1, F.lit(first))
    lengths = F.transform(pieces, lambda p: F.length(p) + len(keyword))
    starts = F.transform(F.when(hits > 0, F.sequence(F.lit(1), hits)).otherwise(F.array().cast("array<int>")), lambda n: F.aggregate(F.slice(lengths, 1, n), F.lit(0), lambda acc, x: acc + x) - len(keyword))
    low = lambda s: F.greatest(s - before, F.lit(0))
    return F.transform(starts, lambda s: F.substring(text, low(s) + 1, s + after - low(s)))
