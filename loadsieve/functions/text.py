"""Text cleaning and header keys as native column expressions."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Null tokens of the two generations of the loader (case-sensitive, after trimming).
NULL_TOKENS = ("", "-", "--", "—", "–", "nan", "None", "N/A", "n/a")
NULL_TOKENS_V1 = ("", "nan", "None")

# A header without a name, as spreadsheet readers label it.
UNNAMED_PATTERN = r"^unnamed[:\s_0-9-]*$"


@lru_cache(maxsize=1)
def whitespace() -> str:
    """Every character str.strip() removes; Spark's plain trim only knows U+0020."""
    return "".join(chr(cp) for cp in range(0x3001) if chr(cp).isspace())


def _begins_visibly(c: Column) -> Column:
    """Whether a text begins with a visible ASCII character, none of which is white space. A comparison of bytes."""
    return (c >= "!") & (c < "\x7f")


def strip(c: Column) -> Column:
    # measured: trimming by a list of characters costs several times as much as looks at both ends
    trimmed = _begins_visibly(c) & _begins_visibly(F.right(c, F.lit(1)))
    return F.when(trimmed, c).otherwise(F.btrim(c, F.lit(whitespace())))


def clean_text(c: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Trimmed text, or null when the text is one of the null tokens."""
    t = strip(c)
    # a text longer than every token needs no look at the tokens
    longest = max(len(token.encode()) for token in tokens)
    return F.when(F.octet_length(t) > longest, t).when(~t.isin(*tokens), t)


def safe_text(c: Column) -> Column:
    """Trimmed text with null shown as the empty string."""
    return F.coalesce(strip(c), F.lit(""))


def text_array(values: Sequence[str]) -> Column:
    """Constant array from one literal; Catalyst folds the split."""
    return F.split(F.lit("\x1f".join(values)), "\x1f")


def is_unnamed(c: Column) -> Column:
    return F.lower(strip(c)).rlike(UNNAMED_PATTERN)


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Accent folding derived from the Unicode database.

    Compatibility decomposition without combining marks turns a character into one key
    character (translated), several (expanded) or none (deleted). Characters that contribute
    no key character need no entry: the callers replace them anyway.
    """
    keep = set("abcdefghijklmnopqrstuvwxyz0123456789")
    one_from, one_to, marks, many = [], [], [], {}
    for cp in range(0x80, min(0x20000, sys.maxunicode)):
        ch = chr(cp)
        if unicodedata.combining(ch):
            marks.append(ch)
            continue
        full = unicodedata.normalize("NFKD", ch)
        if full == ch:
            continue
        base = "".join(x for x in full if not unicodedata.combining(x))
        if len(base) == 1 and base in keep:
            one_from.append(ch)
            one_to.append(base)
        elif len(base) > 1 and keep & set(base):
            many[ch] = base
    # translate() deletes the characters that have no partner, so the marks go last
    return "".join(one_from + marks), "".join(one_to), many


def fold_accents(c: Column) -> Column:
    src, dst, many = _fold_tables()
    plain = F.translate(c, src, dst)
    # one literal that Catalyst folds into a constant map, instead of hundreds of literals
    pairs = F.lit("\x1e".join(f"{ch}\x1f{base}" for ch, base in many.items()))
    table = F.str_to_map(pairs, F.lit("\x1e"), F.lit("\x1f"))
    spelled = F.array_join(
        F.transform(F.split(c, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), ""
    )
    # translate() looks characters up in a table, which a pattern with hundreds of them does not
    has_many = F.translate(c, "".join(many), "") != c
    folded = F.when(has_many, F.translate(spelled, src, dst)).otherwise(plain)
    return F.when(c.rlike(r"[^\x00-\x7F]"), folded).otherwise(c)


def _key_base(c: Column, drop_parentheses: bool) -> Column:
    t = F.lower(strip(c))
    if drop_parentheses:
        t = F.regexp_replace(t, r"[(][^)]*[)]", " ")
    return fold_accents(t)


def canonical_key(c: Column, drop_parentheses: bool = True) -> Column:
    """Header key: lower case, no accents, only letters and digits."""
    return F.regexp_replace(_key_base(c, drop_parentheses), "[^a-z0-9]+", "")


def canonical_key_v1(c: Column) -> Column:
    """Header key of the fixed-schema loader: text in parentheses counts."""
    return canonical_key(c, drop_parentheses=False)


def snake_name(c: Column) -> Column:
    return F.btrim(F.regexp_replace(_key_base(c, True), "[^a-z0-9]+", "_"), F.lit("_"))


def canonical_key_py(text: str) -> str:
    """The same key for the few names the driver holds (target columns of one spec)."""
    t = unicodedata.normalize("NFKD", re.sub(r"[(][^)]*[)]", " ", text.strip().lower()))
    return re.sub("[^a-z0-9]", "", t)
