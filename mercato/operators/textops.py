"""Text operators over document tables (dedup, sentences, n-grams, spans)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.operators.relational import spread


def squeeze_lower(c: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def exact_dedup(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per distinct normalised text: the smallest key and the copy count.
    An aggregate on the hash, so a text with many copies is combined map-side."""
    h = F.sha2(squeeze_lower(F.col(text)), 256)
    return df.groupBy(h.alias("text_hash")).agg(F.min(key).alias(key), F.count(F.lit(1)).alias("n_copies"))


SENTENCE_END = r"[.!?][ \t\n\r]+"


def sentences_with_context(df: DataFrame, key: str, text: str) -> DataFrame:
    """Sentence rows with the previous and next sentence: the row's array of sentences is zipped with itself shifted by
    one each way, so no row leaves its task."""
    x = df.select(key, F.split(F.col(text), SENTENCE_END).alias("_s"))
    none = F.array(F.lit(None).cast("string"))
    zipped = F.arrays_zip(F.col("_s").alias("s"), F.concat(none, "_s").alias("p"), F.concat(F.slice("_s", 2, F.size("_s")), none).alias("n"))
    z = x.select(key, F.posexplode(F.slice(zipped, 1, F.size("_s"))).alias("pos", "z"))
    return z.select(key, "pos", F.col("z.s").alias("sentence"), F.col("z.p").alias("prev_sentence"), F.col("z.n").alias("next_sentence"))


def words(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != "")


def ngrams(df: DataFrame, key: str, text: str, n: int, short: bool = False) -> DataFrame:
    """(key, pos, gram) for every n-word window of the whole text; with ``short``, a text of fewer words gives its
    whole word sequence as one.

    Built from ``n`` shifted slices zipped together: linear in the text length
    (a per-position lambda over the word array would re-split the text for
    every position, quadratic for long documents)."""
    x = df.select(key, words(F.col(text)).alias("_w"))
    size = F.size("_w")
    zipped = F.arrays_zip(*[F.slice("_w", k + 1, F.greatest(size - k, F.lit(1))).alias(f"w{k}")
                            for k in range(n)])
    g = x.select(key, F.posexplode(F.when(size >= n, F.slice(zipped, 1, F.greatest(size - n + 1, F.lit(1)))))
                 .alias("pos", "z"))
    g = g.select(key, "pos", F.concat_ws(" ", *[F.col(f"z.w{k}") for k in range(n)]).alias("gram"))
    if not short:
        return g
    few = x.filter((F.size("_w") > 0) & (F.size("_w") < n))
    return g.unionByName(few.select(key, F.lit(0).alias("pos"), F.array_join("_w", " ").alias("gram")))


def phrase_hits(docs: DataFrame, doc_key: str, text: str, entries: DataFrame, key: str, phrase: str) -> DataFrame:
    """(doc_key, pos, label): every place where all words of a gazetteer entry stand in a row.

    Places where an entry's first words (up to three) stand are found by an equi-join on word n-grams; there
    the whole entry is compared with the document's words."""
    e = entries.select(F.col(key).alias("label"), words(F.col(phrase)).alias("_e")).filter(F.size("_e") > 0)
    e = e.withColumn("_s", F.least(F.size("_e"), F.lit(3)))
    docs = spread(docs.select(doc_key, text))
    found = None
    for r in e.select("_s").distinct().orderBy("_s").collect():  # at most 1, 2 and 3
        n = r["_s"]
        starts = e.filter(F.col("_s") == n).withColumn("gram", F.array_join(F.slice("_e", 1, n), " "))
        hits = ngrams(docs, doc_key, text, n).join(starts, "gram").select(doc_key, "pos", "label", "_e")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return docs.select(doc_key, F.lit(0).alias("pos"), F.lit(None).alias("label")).filter("false")
    # entries of no more words than were looked up are found already; the rest are compared with their text, which
    # joins all of its places once
    longer = found.filter(F.size("_e") > 3)
    places = longer.groupBy(F.col(doc_key).alias("_k")).agg(F.collect_list(F.struct("pos", "label", "_e")).alias("_p"))
    whole = docs.join(places, F.col(doc_key) == F.col("_k")).select(doc_key, F.explode(F.get(F.transform(
        F.array(words(F.col(text))), lambda w: F.filter("_p", lambda p: F.slice(w, p["pos"] + 1, F.size(p["_e"])) == p["_e"])), F.lit(0))).alias("h"))
    return found.filter(F.size("_e") <= 3).select(doc_key, "pos", "label").unionByName(whole.select(doc_key, "h.pos", "h.label"))


def context_windows(df: DataFrame, key: str, text: str, phrase: str, width: int = 65) -> DataFrame:
    """``width`` words centred on every occurrence of ``phrase`` (one word).

    Each row cuts the windows from its own array of words (bound once per row): work and output are linear in the
    text's length plus hits x width, and no row leaves its task."""
    half = width // 2
    cut = F.get(F.transform(F.array(F.split(F.col(text), r"\s+")), lambda w: F.transform(
        F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.lower(F.get(w, i)) == phrase.lower()),
        lambda i: F.struct(i.alias("pos"), F.array_join(F.slice(
            w, F.greatest(i - half, F.lit(0)) + 1, F.least(i, F.lit(half)) + half + 1), " ").alias("context")))), F.lit(0))
    return df.filter(F.col(text).isNotNull()).select(key, F.inline(cut))


# Inline annotation markup ``[entity text](Label)``, optional space before "(".
MARKUP = r"\[([^\]]+)\]\s?\(([^)]+)\)"


def annotate_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """Strip ``[text](Label)`` markup and emit half-open code-point spans into
    the cleaned text, plus a validity flag (every span slices back to its text).
    All array work is per row; nothing is paired across rows."""
    pieces = F.split(F.col(text), MARKUP)
    ents = F.regexp_extract_all(F.col(text), F.lit(MARKUP), 1)
    labels = F.regexp_extract_all(F.col(text), F.lit(MARKUP), 2)
    k = F.size(ents)
    idx = F.when(k > 0, F.sequence(F.lit(0), k - 1)).otherwise(F.array().cast("array<int>"))
    clean = F.aggregate(idx, F.get(pieces, 0), lambda acc, i: F.concat(acc, F.get(ents, i), F.get(pieces, i + 1)))

    def start(i):
        before_p = F.aggregate(F.slice(pieces, 1, i + 1), F.lit(0), lambda a, p: a + F.length(p))
        before_e = F.aggregate(F.slice(ents, 1, i), F.lit(0), lambda a, e: a + F.length(e))
        return before_p + before_e

    spans = F.transform(idx, lambda i: F.struct(start(i).alias("start"),
                                                (start(i) + F.length(F.get(ents, i))).alias("end"),
                                                F.get(labels, i).alias("label"), F.get(ents, i).alias("text")))
    out = df.withColumn("clean_text", clean).withColumn("spans", spans)
    valid = F.forall("spans", lambda s: F.substring(F.col("clean_text"), s["start"] + 1, s["end"] - s["start"])
                     == s["text"])
    return out.withColumn("spans_valid", valid)


def bio_tags(df: DataFrame, key: str, text: str = "clean_text", spans: str = "spans") -> DataFrame:
    """Whitespace tokens with offsets and B-/I-/O tags from the spans.  Offsets
    come from a running sum over the document's tokens; each token looks up its
    span in the document's (small) span array."""
    from pyspark.sql import Window
    t = df.select(key, spans, F.posexplode(F.split(F.col(text), " ")).alias("pos", "token"))
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("offset", F.coalesce(F.sum(F.length("token") + 1).over(w), F.lit(0)))
    hit = F.get(F.filter(spans, lambda s: (s["start"] <= F.col("offset")) & (F.col("offset") < s["end"])), 0)
    lab = F.regexp_replace(hit["label"], " ", "_")
    tag = (F.when(hit.isNull() | (F.col("token") == ""), F.lit("O"))
           .when(hit["start"] == F.col("offset"), F.concat(F.lit("B-"), lab))
           .otherwise(F.concat(F.lit("I-"), lab)))
    return t.select(key, "pos", "token", "offset", tag.alias("tag"))
