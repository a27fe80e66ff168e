"""Text plans over whole documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.functions.text import (
    PRIORITY_ORDER, digits_to_int, first_word, normalize_text, ordinal, remove_words, size_class,
    size_class_sql, word_count,
)
from mercato.operators import textops as X
from mercato.plans.aggregation import CATALOG_VALUES
from mercato.operators.ranges import join_groups, quantile_scalars
from mercato.plans.registry import register
from mercato.sources.tables import Tables, tracking

_NORM_SQL = (r"regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(strip_accents(text), "
             r"'[^\x01-\x7F]', '', 'g'), '^\s+|\s+$', '', 'g')), '[\n/]', ' ', 'g'), '[^\w\s]', '', 'g')")


@register("normalized_documents", "H1", sql=f"""
SELECT doc_id, sha256({_NORM_SQL}) AS norm_hash, length({_NORM_SQL}) AS norm_len FROM documents""")
def normalized_documents(spark, sf):
    from mercato.operators.relational import spread
    d = spread(Tables(spark, sf).documents.select("doc_id", "text"))
    n = d.select("doc_id", normalize_text(F.col("text")).alias("norm"))
    return n.select("doc_id", F.sha2("norm", 256).alias("norm_hash"), F.length("norm").alias("norm_len"))


@register("title_first_word", "H2", sql="""
SELECT p_partkey, split_part(trim(p_name), ' ', 1) AS home_type FROM part""")
def title_first_word(spark, sf):
    p = Tables(spark, sf).part
    return p.select("p_partkey", first_word(F.col("p_name")).alias("home_type"))


@register("digits_extract", "H3", sql=r"""
SELECT doc_id, TRY_CAST(NULLIF(regexp_extract(replace(text, '.', ''), '\d+', 0), '') AS BIGINT) AS price
FROM documents""")
def digits_extract(spark, sf):
    d = Tables(spark, sf).documents
    return d.select("doc_id", digits_to_int(F.col("text")).alias("price"))


@register("safe_ratio", "H5", sql="""
SELECT product_id, order_id, package_size_id,
       CASE WHEN discount = 0 THEN NULL ELSE round(price_numeric / discount, 4) END AS price_per_discount
FROM tracking""")
def safe_ratio(spark, sf):
    tr = tracking(Tables(spark, sf))
    return tr.select("product_id", "order_id", "package_size_id",
                     F.round(F.try_divide("price_numeric", "discount"), 4).alias("price_per_discount"))


_WORDS_RE = "|".join(sorted(CATALOG_VALUES))


@register("remove_word_set", "H6", sql=rf"""
SELECT p_partkey,
  CASE WHEN len(string_split_regex(regexp_replace(p_name, '^\s+|\s+$', '', 'g'), '\s+')) > 1
       THEN regexp_replace(regexp_replace(regexp_replace(p_name, '\b({_WORDS_RE})\b', '', 'gi'),
                           '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')
       ELSE p_name END AS name_clean
FROM part""")
def remove_word_set(spark, sf):
    p = Tables(spark, sf).part
    return p.select("p_partkey", remove_words(F.col("p_name"), CATALOG_VALUES).alias("name_clean"))


@register("size_taxonomy", "H7", sql=f"""
SELECT size_title, {size_class_sql('size_title')} AS size_class, COUNT(*) AS n FROM tracking GROUP BY size_title""")
def size_taxonomy(spark, sf):
    tr = tracking(Tables(spark, sf))
    return (tr.groupBy("size_title").agg(F.count(F.lit(1)).alias("n"))
            .select("size_title", size_class(F.col("size_title")).alias("size_class"), "n"))


@register("size_taxonomy_all", "H7", sql="""
SELECT p_partkey, CASE p_partkey % 11 WHEN 0 THEN 'footwear' WHEN 1 THEN 'clothing' WHEN 2 THEN 'kids' WHEN 3 THEN 'jeans' WHEN 4 THEN 'weight'
  WHEN 5 THEN 'volume' WHEN 6 THEN 'jewellery' WHEN 7 THEN 'cup' WHEN 8 THEN 'none' WHEN 9 THEN 'clothing' ELSE 'other' END AS size_class FROM part""")
def size_taxonomy_all(spark, sf):
    """Sizes of every class, made from the products' sizes; the statement states the class that each form has."""
    n, size = F.col("p_partkey") % 11, F.col("p_size").cast("string")
    forms = [size, F.lit("M"), F.concat(size, F.lit(" anos")), F.concat(F.lit("W"), (F.col("p_size") % 40 + 20).cast("string")), F.concat(size, F.lit(" kg")),
             F.concat(size, F.lit(" x 20 cm")), F.concat(size, F.lit(" mm")), F.concat((F.col("p_size") % 30 + 70).cast("string"), F.lit("D")),
             F.lit("no_size"), F.lit("One Size"), F.lit("unknown thing")]
    title = F.get(F.array(*forms), n.cast("int"))
    return Tables(spark, sf).part.select("p_partkey", title.alias("t")).select("p_partkey", size_class(F.col("t")).alias("size_class"))


@register("date_format_parse", "H13", sql="""
SELECT strftime(ts, '%Y-%m-%d') AS day_label,
       CAST(date_trunc('month', CAST(strptime(strftime(ts, '%Y-%m-%d'), '%Y-%m-%d') AS DATE)) AS DATE) AS month,
       COUNT(*) AS n
FROM events GROUP BY 1, 2""")
def date_format_parse(spark, sf):
    e = Tables(spark, sf).events
    label = F.date_format("ts", "yyyy-MM-dd")
    return (e.groupBy(label.alias("day_label"), F.trunc(F.to_date(label, "yyyy-MM-dd"), "MM").alias("month"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("epoch_millis_month", "H15", sql="""
SELECT CAST(date_trunc('month', epoch_ms(epoch_us(ts) // 1000)) AS DATE) AS month, event_type, COUNT(*) AS n,
       MAX(epoch_us(ts) // 1000) AS max_ms
FROM events GROUP BY 1, 2""")
def epoch_millis_month(spark, sf):
    e = Tables(spark, sf).events.withColumn("ms", F.unix_millis("ts"))
    return (e.groupBy(F.trunc(F.to_date(F.timestamp_millis("ms")), "MM").alias("month"), "event_type")
            .agg(F.count(F.lit(1)).alias("n"), F.max("ms").alias("max_ms")))


@register("math_functions", "H16", sql="""
SELECT catalog_id, round(SUM(ln(price_numeric)), 4) AS sum_ln_price, round(SUM(ln(1 + discount)), 6) AS sum_log1p,
       round(SUM(abs(price_numeric - 50000)), 2) AS sum_abs_dev, round(SUM(sqrt(view_count)), 4) AS sum_sqrt_views,
       round(SUM(power(discount, 2)), 6) AS sum_sq_discount,
       round(SUM(greatest(0, price_numeric - 50000)), 2) AS sum_relu
FROM tracking GROUP BY catalog_id""")
def math_functions(spark, sf):
    tr = tracking(Tables(spark, sf))
    return tr.groupBy("catalog_id").agg(
        F.round(F.sum(F.ln("price_numeric")), 4).alias("sum_ln_price"),
        F.round(F.sum(F.log1p("discount")), 6).alias("sum_log1p"),
        F.round(F.sum(F.abs(F.col("price_numeric") - 50000)), 2).alias("sum_abs_dev"),
        F.round(F.sum(F.sqrt("view_count")), 4).alias("sum_sqrt_views"),
        F.round(F.sum(F.pow("discount", 2)), 6).alias("sum_sq_discount"),
        F.round(F.sum(F.greatest(F.lit(0.0), F.col("price_numeric") - 50000)), 2).alias("sum_relu"))


@register("ordinal_priority", "H18", sql="""
SELECT o_orderpriority, CASE o_orderpriority """ + " ".join(
    f"WHEN '{v}' THEN {i}" for i, v in enumerate(PRIORITY_ORDER)) + """ END AS priority_rank, COUNT(*) AS n
FROM orders GROUP BY o_orderpriority""")
def ordinal_priority(spark, sf):
    o = Tables(spark, sf).orders
    return (o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
            .select("o_orderpriority", ordinal(F.col("o_orderpriority"), PRIORITY_ORDER).alias("priority_rank"),
                    "n"))


@register("premium_target", "H20", sql="""
WITH q AS (SELECT quantile_cont(price_numeric, 0.8) AS q80 FROM tracking)
SELECT catalog_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE price_numeric > q.q80) AS n_premium
FROM tracking, q GROUP BY catalog_id""")
def premium_target(spark, sf):
    tr = tracking(Tables(spark, sf))
    q80 = quantile_scalars(tr, "price_numeric", [0.8])[0]  # computed once, not per row
    return tr.groupBy("catalog_id").agg(F.count(F.lit(1)).alias("n"),
                                        F.count_if(F.col("price_numeric") > q80).alias("n_premium"))


_SENT = r"[.!?][ \t\n\r]+"


@register("sentence_context", "H23", sql=rf"""
WITH l AS (SELECT doc_id, string_split_regex(text, '{_SENT}') AS l FROM documents),
s AS (SELECT doc_id, unnest(l) AS sentence, CAST(unnest(range(len(l))) AS INTEGER) AS pos FROM l)
SELECT doc_id, pos, sentence, lag(sentence) OVER w AS prev_sentence, lead(sentence) OVER w AS next_sentence
FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY pos)""")
def sentence_context(spark, sf):
    return X.sentences_with_context(Tables(spark, sf).documents, "doc_id", "text")


@register("context_window_65", "H24", sql=r"""
WITH w AS (SELECT doc_id, string_split_regex(text, '\s+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(w) AS word, CAST(unnest(range(len(w))) AS INTEGER) AS pos FROM w)
SELECT doc_id, pos, array_to_string(w[greatest(pos - 32, 0) + 1 : pos + 33], ' ') AS context
FROM p WHERE lower(word) = 'that'""")
def context_window_65(spark, sf):
    return X.context_windows(Tables(spark, sf).documents, "doc_id", "text", "that", 65)


_WORDS_SQL = r"list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '')"


@register("gazetteer_tagging", "H25", sql=f"""
WITH w AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(w) AS word, unnest(range(len(w))) AS i FROM w),
b AS (SELECT item_id, {_WORDS_SQL} AS e FROM benchmark)
SELECT b.item_id AS label, COUNT(*) AS n_hits, COUNT(DISTINCT p.doc_id) AS n_docs
FROM p JOIN b ON p.word = b.e[1] AND p.w[i + 1 : i + len(b.e)] = b.e GROUP BY b.item_id""")
def gazetteer_tagging(spark, sf):
    t = Tables(spark, sf)
    hits = X.phrase_hits(t.documents.select("doc_id", "text"), "doc_id", "text", t.benchmark, "item_id", "text")
    return hits.groupBy("label").agg(F.count(F.lit(1)).alias("n_hits"), F.countDistinct("doc_id").alias("n_docs"))


@register("corpus_length_stats", "H26", sql=r"""
SELECT lang, COUNT(*) AS n_docs, CAST(SUM(len(string_split_regex(trim(text), '\s+'))) AS BIGINT) AS total_words,
       round(AVG(len(string_split_regex(trim(text), '\s+'))), 4) AS mean_words,
       round(AVG(length(text)), 4) AS mean_chars
FROM documents GROUP BY lang""")
def corpus_length_stats(spark, sf):
    d = Tables(spark, sf).documents.withColumn("nw", word_count(F.col("text")))
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("nw").cast("bigint").alias("total_words"),
                                 F.round(F.avg("nw"), 4).alias("mean_words"),
                                 F.round(F.avg(F.length("text")), 4).alias("mean_chars"))


@register("token_corpus_stats", "E32", sql=f"""
WITH t AS (SELECT lang, unnest({_WORDS_SQL}) AS tok FROM documents),
c AS (SELECT lang, tok, COUNT(*) AS n FROM t GROUP BY lang, tok)
SELECT lang, CAST(SUM(n) AS BIGINT) AS n_tokens, COUNT(*) AS n_unique,
       round(SUM(n * length(tok)) / SUM(n), 4) AS mean_token_len,
       first(tok ORDER BY n DESC, tok) AS top_token, MAX(n) AS top_freq
FROM c GROUP BY lang""")
def token_corpus_stats(spark, sf):
    d = Tables(spark, sf).documents
    t = d.select("lang", F.explode(X.words(F.col("text"))).alias("tok"))
    c = t.groupBy("lang", "tok").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy("lang").agg(
        F.sum("n").cast("bigint").alias("n_tokens"), F.count(F.lit(1)).alias("n_unique"),
        F.round(F.sum(F.col("n") * F.length("tok")) / F.sum("n"), 4).alias("mean_token_len"),
        F.min_by("tok", F.struct(-F.col("n"), F.col("tok"))).alias("top_token"), F.max("n").alias("top_freq"))


@register("token_top20", "E32", sql=f"""
WITH t AS (SELECT lang, unnest({_WORDS_SQL}) AS tok FROM documents),
c AS (SELECT lang, tok, COUNT(*) AS n FROM t GROUP BY lang, tok),
r AS (SELECT *, SUM(n) OVER (PARTITION BY lang) AS total, COUNT(*) OVER (PARTITION BY lang) AS n_unique,
             row_number() OVER (PARTITION BY lang ORDER BY n DESC, tok) AS place FROM c)
SELECT lang, CAST(place AS INTEGER) AS place, tok AS token, n, round(100.0 * n / total, 4) AS share_pct, n_unique FROM r WHERE place <= 20""")
def token_top20(spark, sf):
    """The 20 most frequent tokens of each language with their share.  Each of several hash parts of a language keeps its
    own 20 first, so that no task ranks a whole vocabulary."""
    d = Tables(spark, sf).documents
    c = d.select("lang", F.explode(X.words(F.col("text"))).alias("tok")).groupBy("lang", "tok").agg(F.count(F.lit(1)).alias("n"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = [F.desc("n"), "tok"]
    part = c.withColumn("_p", F.pmod(F.xxhash64("tok"), F.lit(parts)))
    few = part.withColumn("_i", F.row_number().over(Window.partitionBy("lang", "_p").orderBy(*first))).filter("_i <= 20")
    top = few.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(*first))).filter("place <= 20")
    total = c.groupBy("lang").agg(F.sum("n").alias("_total"), F.count(F.lit(1)).alias("n_unique"))
    return join_groups(top.select("lang", "place", F.col("tok").alias("token"), "n"), total, ["lang"]).select(
        "lang", "place", "token", "n", F.round(100.0 * F.col("n") / F.col("_total"), 4).alias("share_pct"), "n_unique")


@register("near_duplicate_documents", "G9")
def near_duplicate_documents(spark, sf):
    from mercato.operators.neardup import near_duplicates
    return near_duplicates(Tables(spark, sf).documents, "doc_id", "text", shingle=5, bands=16, rows=4,
                           threshold=0.7)


@register("conversation_dedup", "G8", sql="""
SELECT conv_id, turn, role, text FROM (
  SELECT *, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations)
WHERE prev IS NULL OR prev <> text""")
def conversation_dedup(spark, sf):
    """Ordered conversations: drop turns repeating the previous turn's text."""
    c = Tables(spark, sf).conversations
    prev = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    return c.withColumn("prev", prev).filter(F.col("prev").isNull() | (F.col("prev") != F.col("text"))).drop("prev")


@register("exact_jaccard_blocks", "G9", sql=r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, array_to_string(w[i + 1 : i + 5], ' ') AS gram
      FROM w, LATERAL (SELECT unnest(range(0, greatest(len(w) - 4, 1))) AS i) WHERE len(w) > 0),
sh AS (SELECT DISTINCT doc_id, gram FROM g),
n AS (SELECT doc_id, COUNT(*) AS n, md5(string_agg(gram, chr(10) ORDER BY gram)) AS digest FROM sh GROUP BY doc_id),
c AS (SELECT doc_id, MIN(doc_id) OVER (PARTITION BY n, digest) AS class_id, n FROM n),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS common FROM sh a JOIN sh b USING (gram) GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
          WHERE 100 * common >= 70 * (nx.n + ny.n - common)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, COALESCE(c.class_id, d.doc_id) AS class_id, COALESCE(m.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN (SELECT x AS doc_id, MIN(y) AS component_id FROM reach GROUP BY x) m USING (doc_id)""")
def exact_jaccard_blocks(spark, sf):
    """Every document's class (smallest id with the same 5-word shingles) and component (smallest id reachable over links of
    exact Jaccard similarity of at least 0.7, all pairs considered)."""
    from mercato.operators.similarity import similar_groups
    return similar_groups(Tables(spark, sf).documents, "doc_id", "text", 5, 70)
