"""Quality rules by distribution divergence (DataFrame functions only).

Each document gets two histograms: character classes, and the common words of each language of
``LANGUAGES`` (one bin per word, one for all other words).  Its language is the one with most common
words.  The corpus gives each language its reference in two rounds over the saved counts: the summed
histograms of all documents with enough words, then those of the documents whose distances to that
first reference are within the bounds, so that junk does not shape the reference it is judged by.  A
document is kept if it passes the base rules and the Jensen-Shannon distances (root of the divergence,
base 2, 0 to 1) to its language's reference stay below a bound for both histograms.  Bounds widen with
1/sqrt(n_words), as short documents scatter more; below ``min_words`` the base rules reject before any
distance is asked for.

Defined cases: a null or empty text has all counts 0, fails the base rules and is rejected; equal rows
get equal verdicts and all rows stay; a language without reference documents has distance 0; an empty
table gives an empty result.  Only the named columns are read, so further columns, whatever their
names, change nothing (internal columns start with ``_q_``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import WORD, saved, settled

#: Common function words of each reference language (a parameter; lower case).
LANGUAGES = {
    "en": "the of and to in a is that it was for on are with as be".split(),
    "fr": "le la les de des du et un une est que qui dans en pour sur".split(),
    "de": "der die das und ist von den dem ein eine zu mit auf für im nicht".split(),
    "es": "el los las de del y que en un una es por con para no su".split(),
}

#: Character classes: name and the pattern of everything outside the class.
CLASSES = {
    "upper": r"[^\p{Lu}]+",
    "symbol": r"[^#*$%&|<>]+",
    "stop": r"[^.,;:!?'\"()\[\]-]+",
}


@dataclass(frozen=True)
class Bounds:
    """Limits of the rules: words a document needs, the share (%) of words in repeated 3-word windows,
    and for both histograms the largest distance ``base + slack / sqrt(n_words)``."""

    min_words: int = 50
    max_repeat_pct: int = 50
    char: float = 0.10
    char_slack: float = 0.8
    word: float = 0.15
    word_slack: float = 3.5


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def vocabulary(languages: dict[str, list[str]]) -> list[str]:
    return sorted({w for words in languages.values() for w in words})


def _sum(a: Column, zero) -> Column:
    return F.aggregate(a, F.lit(zero), lambda s, x: s + x)


def with_counts(docs: DataFrame, text: str, languages: dict[str, list[str]]) -> DataFrame:
    """``docs`` with ``_q_counts``: the base counts, ``classes`` (upper-case letters, symbols, stops,
    other word characters) and ``common`` (occurrences of each word of ``vocabulary``).

    Written as a chain of columns, so that each is computed once, in generated code where Spark has it."""
    words = vocabulary(languages)
    t = docs.withColumn("_q_t", F.coalesce(F.col(text), F.lit("")))
    t = t.withColumn("_q_w", F.filter(F.split("_q_t", r"[\x20\x09-\x0D]+", -1), lambda x: x != ""))
    t = t.withColumn("_q_lines", F.filter(F.split("_q_t", "\n", -1), lambda x: x.rlike(WORD)))
    t = t.withColumn("_q_h", F.when(F.size("_q_w") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("_q_w") - 3),
        lambda i: F.xxhash64(F.get("_q_w", i), F.get("_q_w", i + 1), F.get("_q_w", i + 2)))))
    # sorting is only worth it where some window occurs twice
    t = t.withColumn("_q_s", F.when(F.size(F.array_distinct("_q_h")) < F.size("_q_h"), F.sort_array(
        F.transform("_q_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    t = t.withColumn("_q_p", F.sort_array(F.transform(F.filter(
        F.col("_q_s"), lambda x, j: F.coalesce(x["h"] == F.get("_q_s", j - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get("_q_s", j + 1)["h"], F.lit(False))), lambda x: x["i"])))
    t = t.withColumn("_q_r", F.coalesce(F.aggregate("_q_p", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
                                  lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"),
                                                        x.alias("last")))["n"], F.lit(0).cast("long")))
    t = t.withColumn("_q_common", F.concat(F.lit(" "), F.array_join(F.filter(
        F.split(F.lower("_q_t"), r"[\x20\x09-\x0D.,;:!?]+", -1), lambda w: w.isin(words)), "  "), F.lit(" ")))
    size = F.length(F.regexp_replace("_q_t", r"[\x20\x09-\x0D]+", "")).cast("long")
    t = t.withColumn("_q_n", size).withColumn(
        "_q_cls", F.array(*[F.length(F.regexp_replace("_q_t", p, "")).cast("long") for p in CLASSES.values()]))
    return t.withColumn("_q_counts", F.struct(
        F.size("_q_w").cast("long").alias("n_words"), F.col("_q_n").alias("word_chars"),
        F.col("_q_cls")[list(CLASSES).index("symbol")].alias("n_symbols"),
        (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_q_r").alias("n_repeat_words"),
        F.concat(F.col("_q_cls"), F.array(F.greatest(
            F.col("_q_n") - sum((F.col("_q_cls")[i] for i in range(len(CLASSES))), F.lit(0)), F.lit(0).cast("long")))
                 ).alias("classes"),
        F.array(*[((F.length("_q_common") - F.length(F.replace(F.col("_q_common"), F.lit(f" {w} "), F.lit(""))))
                   / F.lit(len(w) + 2)).cast("long") for w in words]).alias("common"),
    )).drop("_q_t", "_q_w", "_q_lines", "_q_h", "_q_s", "_q_p", "_q_r", "_q_common", "_q_n", "_q_cls")


def with_language(df: DataFrame, languages: dict[str, list[str]], bounds: Bounds) -> DataFrame:
    """Adds ``_q_base`` (base_failed, lang, and the word histogram of that language)."""
    words = vocabulary(languages)
    bins = {n: [F.col("_q_counts.common")[words.index(w)] for w in ws] for n, ws in languages.items()}
    hits = {n: sum(b, F.lit(0).cast("long")) for n, b in bins.items()}
    top = F.greatest(*hits.values()) if len(hits) > 1 else next(iter(hits.values()))
    lang, hist = None, None
    for n in languages:
        h = F.array(*bins[n], F.greatest(F.col("_q_counts.n_words") - hits[n], F.lit(0).cast("long")))
        lang = F.when(hits[n] == top, n) if lang is None else lang.when(hits[n] == top, n)
        hist = F.when(hits[n] == top, h) if hist is None else hist.when(hits[n] == top, h)
    c = F.col("_q_counts")
    failed = (c["n_words"] < bounds.min_words) | (
        100 * c["n_repeat_words"] > bounds.max_repeat_pct * c["n_words"])
    return df.withColumn("_q_base", F.struct(failed.alias("base_failed"), lang.alias("lang"), hist.alias("words")))


def js_distance(p: Column, q: Column) -> Column:
    """Root of the base-2 Jensen-Shannon divergence of two share arrays of equal length."""
    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    return F.round(F.sqrt(F.greatest(_sum(terms, 0.0) / 2, F.lit(0.0))), 9)


def _shares(a: Column, total: Column) -> Column:
    return F.transform(a, lambda x: x / total)


References = dict[str, tuple[list[int], list[int]]]


def with_distances(df: DataFrame, refs: References | None, bounds: Bounds) -> DataFrame:
    """Adds ``_q_d``: char_distance, word_distance (0 where text or reference is empty) and near (within the bounds)."""
    n = F.col("_q_counts.n_words")

    def distance(counts: str, total: Column, side: int) -> Column:
        ref = None
        for name, r in refs.items():
            whole = sum(r[side])
            a = F.array(*[F.lit(x / whole) for x in r[side]]) if whole else F.lit(None).cast("array<double>")
            ref = F.when(F.col("_q_base.lang") == name, a) if ref is None else ref.when(F.col("_q_base.lang") == name, a)
        return F.when(total > 0, F.coalesce(js_distance(_shares(F.col(counts), total), ref), F.lit(0.0))).otherwise(0.0)

    df = df.withColumn("_q_d", F.struct(
        distance("_q_counts.classes", F.col("_q_counts.word_chars"), 0).alias("c"),
        distance("_q_base.words", n, 1).alias("w")))
    root = F.sqrt(F.greatest(n, F.lit(1)).cast("double"))
    near = ((F.col("_q_d.c") <= bounds.char + bounds.char_slack / root)
            & (F.col("_q_d.w") <= bounds.word + bounds.word_slack / root))
    return df.withColumn("_q_d", F.struct("_q_d.c", "_q_d.w", near.alias("near")))


def references(counted: DataFrame, languages: dict[str, list[str]]) -> References:
    """Summed class and word histograms by language; one row per language of the parameter reaches the driver."""
    n_classes, n_words = len(CLASSES) + 1, {k: len(v) + 1 for k, v in languages.items()}
    got = {r["lang"]: r for r in counted.groupBy(F.col("_q_base.lang").alias("lang")).agg(
        *[F.sum(F.get("_q_counts.classes", F.lit(i))).alias(f"c{i}") for i in range(n_classes)],
        *[F.sum(F.get("_q_base.words", F.lit(i))).alias(f"w{i}") for i in range(max(n_words.values()))]).collect()}
    return {k: ([got[k][f"c{i}"] for i in range(n_classes)] if k in got else [0] * n_classes,
                [got[k][f"w{i}"] for i in range(n_words[k])] if k in got else [0] * n_words[k]) for k in languages}


def learn(counted: DataFrame, languages: dict[str, list[str]], bounds: Bounds) -> References:
    """The two rounds of references over a saved table of counts and languages."""
    enough = counted.filter(F.col("_q_counts.n_words") >= bounds.min_words)
    first = references(enough, languages)
    return references(with_distances(enough, first, bounds).filter("_q_d.near"), languages)


def _verdicts(df: DataFrame, refs: References, bounds: Bounds) -> DataFrame:
    return with_distances(df, refs, bounds).withColumn("_quality", F.struct(
        *[F.col(f"_q_counts.{c}") for c in COUNTS], "_q_base.base_failed",
        (~F.col("_q_base.base_failed") & F.col("_q_d.near")).alias("kept"), "_q_base.lang",
        F.col("_q_d.c").alias("char_distance"), F.col("_q_d.w").alias("word_distance"))
    ).drop("_q_counts", "_q_base", "_q_d")


def _counted(docs: DataFrame, text: str, languages: dict[str, list[str]], bounds: Bounds) -> DataFrame:
    return with_language(with_counts(docs, text, languages), languages, bounds)


def verdicts(docs: DataFrame, key: str = "doc_id", text: str = "text",
             languages: dict[str, list[str]] | None = None, bounds: Bounds = Bounds()) -> DataFrame:
    """One row per document: ``key`` and the struct ``_quality`` (n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, lang, char_distance, word_distance).  Texts are read once; only
    their counts are saved and read again."""
    languages = languages or LANGUAGES
    counted = saved(_counted(docs.select(key, text), text, languages, bounds).drop(text), "quality-counts")
    return _verdicts(counted, learn(counted, languages, bounds), bounds)


def keep_good(docs: DataFrame, text: str = "text", languages: dict[str, list[str]] | None = None,
              bounds: Bounds = Bounds()) -> DataFrame:
    """The rows of ``docs`` (its columns unchanged) whose text is kept.  The counts are saved without the
    texts for the references; the final pass counts each row again, so no text is shuffled or stored."""
    languages = languages or LANGUAGES
    counted = saved(_counted(docs.select(text), text, languages, bounds).drop(text), "quality-counts")
    refs = learn(counted, languages, bounds)
    judged = settled(_verdicts(_counted(docs, text, languages, bounds), refs, bounds), "_q_s")
    return judged.filter("_q_s >= 0 and _quality.kept").drop("_quality", "_q_s")


def oracle(languages: dict[str, list[str]] | None = None, bounds: Bounds = Bounds(), key: str = "doc_id") -> str:
    """DuckDB SQL over ``documents`` for ``key``, the counts, base_failed, kept and lang, written from
    the definitions (strings for windows, rows for histogram bins)."""
    languages = languages or LANGUAGES
    quoted = {n: "[" + ", ".join(f"'{w}'" for w in ws) + "]" for n, ws in languages.items()}
    outside = list(CLASSES.values())
    cls = ", ".join("length(regexp_replace(t, '" + p.replace("'", "''") + "', '', 'g'))" for p in outside)
    lists = " UNION ALL ".join(f"SELECT {i} AS rank, '{n}' AS lang, unnest({quoted[n]}) AS w, "
                               f"generate_subscripts({quoted[n]}, 1) AS bin" for i, n in enumerate(languages))
    n_cls = len(outside) + 1

    def distance(ref: str) -> str:
        return f"""(
  SELECT x.rid, x.side, round(sqrt(greatest(sum(
      CASE WHEN x.p > 0 THEN x.p * log2(2 * x.p / (x.p + r.q)) ELSE 0 END
    + CASE WHEN r.q > 0 THEN r.q * log2(2 * r.q / (x.p + r.q)) ELSE 0 END) / 2, 0)), 9) AS d
  FROM (SELECT rid, lang, side, bin, cnt / total AS p FROM hist WHERE total > 0) x
  JOIN (SELECT lang, side, bin, cnt / sum(cnt) OVER (PARTITION BY lang, side) AS q FROM {ref}) r
    USING (lang, side, bin) GROUP BY x.rid, x.side)"""

    def near(ref: str) -> str:
        return f"""(SELECT f.rid,
      coalesce(c.d, 0) <= {bounds.char} + {bounds.char_slack} / sqrt(greatest(n_words, 1))
  AND coalesce(v.d, 0) <= {bounds.word} + {bounds.word_slack} / sqrt(greatest(n_words, 1)) AS near
  FROM f LEFT JOIN {distance(ref)} c ON c.rid = f.rid AND c.side = 0
         LEFT JOIN {distance(ref)} v ON v.rid = f.rid AND v.side = 1)"""

    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, {key}, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
  regexp_split_to_array(lower(t), '[\x20\x09-\x0D.,;:!?]+') AS lw,
  length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars, [{cls}] AS cls FROM d),
g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM w, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i)),
r AS (SELECT rid, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM g)
            WHERE n >= 2) GROUP BY rid),
vocab AS ({lists}),
hit AS (SELECT rid, rank, lang, bin, count(*) AS cnt FROM (SELECT rid, unnest(lw) AS w FROM w) JOIN vocab USING (w)
        GROUP BY ALL),
tot AS (SELECT rid, rank, lang, sum(cnt) AS cnt FROM hit GROUP BY ALL),
best AS (SELECT rid, arg_min(lang, (-cnt, rank)) AS lang FROM tot GROUP BY rid),
f AS MATERIALIZED (SELECT w.rid, w.{key}, len(w) AS n_words, word_chars, cls[{list(CLASSES).index("symbol") + 1}] AS n_symbols,
  len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n_repeat_words, 0) AS n_repeat_words,
  coalesce(b.lang, '{next(iter(languages))}') AS lang, cls FROM w LEFT JOIN r USING (rid) LEFT JOIN best b USING (rid)),
base AS (SELECT rid, n_words < {bounds.min_words} OR 100 * n_repeat_words > {bounds.max_repeat_pct} * n_words AS base_failed FROM f),
hist AS MATERIALIZED (
  SELECT rid, lang, 0 AS side, unnest(range(1, {n_cls + 1})) AS bin,
         unnest(list_append(cls, greatest(word_chars - list_sum(cls), 0)::BIGINT)) AS cnt, word_chars AS total FROM f
  UNION ALL
  SELECT f.rid, f.lang, 1, v.bin, coalesce(h.cnt, 0), n_words FROM f JOIN vocab v ON v.lang = f.lang
    LEFT JOIN hit h ON h.rid = f.rid AND h.lang = f.lang AND h.bin = v.bin
  UNION ALL
  SELECT f.rid, f.lang, 1, 0, greatest(n_words - coalesce(t.cnt, 0), 0), n_words FROM f
    LEFT JOIN tot t ON t.rid = f.rid AND t.lang = f.lang),
enough AS (SELECT rid FROM f WHERE n_words >= {bounds.min_words}),
ref1 AS MATERIALIZED (SELECT lang, side, bin, sum(cnt) AS cnt FROM hist JOIN enough USING (rid) GROUP BY ALL),
near1 AS MATERIALIZED (SELECT rid FROM {near("ref1")} JOIN enough USING (rid) WHERE near),
ref2 AS MATERIALIZED (SELECT lang, side, bin, sum(cnt) AS cnt FROM hist JOIN near1 USING (rid) GROUP BY ALL)
SELECT f.{key}, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND near AS kept, lang
FROM f JOIN base USING (rid) JOIN {near("ref2")} n USING (rid)"""
