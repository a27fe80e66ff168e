"""Column functions for text: normalisation, extraction, taxonomies.

Built-in expressions do the work; the one Python piece is Unicode NFKD
folding (no JVM built-in), run as an Arrow-batched pandas UDF.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def nfkd_ascii(s: pd.Series) -> pd.Series:
    """NFKD decomposition, then drop every non-ASCII code point."""
    return s.map(lambda t: None if t is None else
                 unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode("ascii"))


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: leading/trailing whitespace of any kind."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def normalize_text(c: Column) -> Column:
    """Fold accents to ASCII, strip, lower-case, turn newlines and slashes into
    spaces and drop punctuation (spaces are not squeezed)."""
    folded = F.lower(strip_ws(nfkd_ascii(c)))
    return F.regexp_replace(F.regexp_replace(folded, r"[\n/]", " "), r"[^\w\s]", "")


def first_word(c: Column) -> Column:
    return F.split_part(F.trim(c), F.lit(" "), F.lit(1))


def digits_to_int(c: Column) -> Column:
    """First digit run after removing thousand dots; no digits -> null."""
    return F.regexp_extract(F.replace(c, F.lit("."), F.lit("")), r"\d+", 0).try_cast("bigint")


def remove_words(c: Column, words: Iterable[str]) -> Column:
    """Remove whole words (case-insensitive) from multi-word values, then strip
    and squeeze spaces; single-word values are kept as they are."""
    alternation = "|".join(sorted({w for w in words if w}))
    pattern = r"(?i)\b(" + alternation + r")\b"
    cleaned = F.regexp_replace(strip_ws(F.regexp_replace(c, pattern, "")), r"\s+", " ")
    return F.when(F.size(F.split(strip_ws(c), r"\s+")) > 1, cleaned).otherwise(c)


# Size-title classes, tested in this order.
SIZE_CLASSES = [
    ("none", r"^no_size$"),
    ("kids", r"(?i)\d+\s*(anos|meses|years|months)"),
    ("jeans", r"^W\d{2}"),
    ("weight", r"(?i)\d+\s*(-\s*\d+\s*)?kgs?\b"),
    ("volume", r"(?i)\d+\s*x\s*\d+\s*cm"),
    ("jewellery", r"(?i)(\bmm\b|diameter)"),
    ("cup", r"^\d{2,3}[A-H]{1,2}$"),
    ("footwear", r"^\d{1,2}([.,]5)?$"),
    ("clothing", r"(?i)^(X{0,4}S|M|X{0,4}L|\d?XL|\d?XS|XXS|XXL|XXXL|one size|tamanho único)$"),
]


def size_class(c: Column) -> Column:
    expr = None
    for name, pat in SIZE_CLASSES:
        expr = F.when(c.rlike(pat), name) if expr is None else expr.when(c.rlike(pat), name)
    return expr.otherwise("other")


def size_class_sql(col: str) -> str:
    """The same taxonomy as a DuckDB CASE expression (oracle side)."""
    arms = " ".join(
        f"WHEN regexp_matches({col}, '{pat.replace('(?i)', '')}'{', ' + repr('i') if '(?i)' in pat else ''}) "
        f"THEN '{name}'" for name, pat in SIZE_CLASSES)
    return f"CASE {arms} ELSE 'other' END"


# Street keywords for the title gazetteer.
STREET_KEYWORDS = ["rua", "avenida", "beco", "praça", "travessa", "estrada", "alameda", "largo", "caminho"]


def street_name(title: Column, fallback: Column | None = None) -> Column:
    """Street phrase starting at a keyword (accent-folded match) up to the next
    comma or end; falls back to ``fallback`` (e.g. the neighbourhood)."""
    folded = sorted({unicodedata.normalize("NFKD", k).encode("ascii", "ignore").decode() for k in STREET_KEYWORDS})
    pat = r"(?i)\b((?:" + "|".join(folded) + r")\b[^,;]*)"
    hit = F.nullif(F.trim(F.regexp_extract(nfkd_ascii(title), pat, 1)), F.lit(""))
    return F.coalesce(hit, fallback) if fallback is not None else hit


# Item condition, lowest to highest.
CONDITION_ORDER = ["Satisfatório", "Bom", "Muito bom", "Novo sem etiquetas", "Novo com etiquetas"]
# Order priority, lowest to highest.
PRIORITY_ORDER = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]


def ordinal(c: Column, order: list[str]) -> Column:
    """Rank of the value in ``order`` (0-based); unknown values -> null."""
    m = F.create_map(*[x for i, v in enumerate(order) for x in (F.lit(v), F.lit(i))])
    return F.try_element_at(m, c)


def word_count(c: Column) -> Column:
    return F.size(F.split(F.trim(c), r"\s+"))
