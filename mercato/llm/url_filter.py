"""URL filter: listed rules first, then a path-template tree per host (DataFrame functions only).

The path's segments become tokens: a segment that varies by its look (a digit in it, or longer than ``LONG`` code points)
becomes the wildcard ``*`` with its file ending, others stay.  Segments beyond the ``DEPTH``-th become one wildcard
``**``.  A host and its tokens are a template, whose prefixes are the nodes of the host's tree.  Each node counts the
urls below it by label (bad, good, none) and by what follows (nothing, a wildcard, a name).  Siblings whose majority of
labels agrees are compared: a node whose counts differ from those of the others by no more than chance (chi-square at most
df + 3 sqrt(2 df)) merges with them, others stay as they are; so a branch of its own kind, like one bad directory of a good
host, is neither watered down nor spoils the rest, and names without end become one branch.  A merged template is
rejected if its smoothed share of bad labels, (bad + weight * prior) / (labelled + weight), exceeds ``LIMIT``.

Labels are a column of 1 (bad), 0 (good) or null.  ``weak_labels`` makes them from the rules and from words of the url.

Plan: urls are counted by template before any shuffle, so a host with a third of all urls costs no more than others; the
tables of nodes and branches join by keys that are distinct on one side, and Spark's skew join splits the other.

Defined cases: a null url and one without ``://`` have an empty host and path, which is a template like any other; empty
segments are skipped; repeated and null ids are judged row by row; an empty table gives no rows.  Only the
named columns are read; internal columns start with ``_u_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import saved

#: Verdict, host, beginning of the path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Words that mark an unwanted url.
WORDS = ("adult", "bet", "casino", "escort", "gambling", "pills", "poker", "porn", "sex", "torrent", "viagra", "warez", "xxx")

DEPTH = 8
LONG = 24
PRIOR = 0.25
WEIGHT = 1.0
LIMIT = 0.5

LABELS = ("bad", "good", "none")
SHAPES = ("end", "wild", "name")
CELLS = tuple(f"_u_{a}_{b}" for a in LABELS for b in SHAPES)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty without ``://``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), upper, upper.lower()), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, nulls if none; of equal length the one with the longer host."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(
        F.lit(len(h) + len(p)).alias("size"), F.lit(len(h)).alias("host_size"), F.lit(h + p).alias("rule"),
        F.lit(verdict).alias("verdict"))) for verdict, h, p in rules]
    if not fits:
        return F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    best = F.array_max(F.array(*fits))
    return F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict"))


def tokens(path: Column, depth: int = DEPTH) -> Column:
    """The path's tokens, at most ``depth`` and one for the rest."""
    named = F.filter(F.split(path, "/"), lambda s: s != "")
    varies = lambda s: F.rlike(s, F.lit("[0-9]")) | (F.char_length(s) > LONG)
    general = F.transform(F.slice(named, 1, depth), lambda s: F.when(
        varies(s), F.concat(F.lit("*"), F.regexp_extract(s, r"\.[A-Za-z]{2,5}\z", 0))).otherwise(s))
    return F.when(F.size(named) > depth, F.concat(general, F.array(F.lit("**")))).otherwise(general)


def weak_labels(host: Column, path: Column, verdict: Column) -> Column:
    """1 or 0: the rule's verdict, else whether a word of ``WORDS`` stands in host or path."""
    word = F.rlike(F.lower(F.concat(host, path)), F.lit(f"(^|[^a-z0-9])({'|'.join(WORDS)})([^a-z0-9]|$)"))
    return F.when(verdict.isNotNull(), verdict == "block").otherwise(word).cast("int")


def parsed(pages: DataFrame, key: str, url: str, rules, label, depth: int) -> DataFrame:
    """One row per page: key, host, path, rule, ``_u_rule`` (its verdict), ``_u_template``, ``_u_tokens``, ``_u_label``."""
    host, path = split_url(F.col("_u_url"))
    rows = pages.select(F.col(key), F.col(url).alias("_u_url"), *([F.col(label).cast("int").alias("_u_label")] if isinstance(label, str) else []))
    rows = rows.withColumn("_u_host", host).withColumn("_u_path", path).withColumn(
        "_u_found", rule_of(F.col("_u_host"), F.col("_u_path"), rules)).withColumn("_u_tokens", tokens(F.col("_u_path"), depth))
    if not isinstance(label, str):
        rows = rows.withColumn("_u_label", label(F.col("_u_host"), F.col("_u_path"), F.col("_u_found.verdict")))
    return rows.select(key, "_u_host", "_u_path", F.col("_u_found.rule").alias("_u_name"), F.col("_u_found.verdict").alias("_u_rule"),
                       "_u_tokens", F.concat_ws("/", F.array(F.col("_u_host")), "_u_tokens").alias("_u_template"), "_u_label")


def templates(rows: DataFrame) -> DataFrame:
    """Counts of labels by template, and the merged template each belongs to (``_u_merged``)."""
    n = {a: F.sum(F.when(c, 1).otherwise(0)).cast("long").alias(f"_u_{a}") for a, c in (
        ("bad", F.col("_u_label") == 1), ("good", F.col("_u_label") == 0), ("none", F.col("_u_label").isNull()))}
    counted = saved(rows.groupBy("_u_template", "_u_host", "_u_tokens").agg(*n.values()), "url-templates")

    # node k of a template: its id, its parent's and what follows it
    size = F.size("_u_tokens")
    at = F.transform(F.sequence(F.lit(1), size), lambda k: F.struct(
        k.alias("k"),
        F.concat_ws("/", F.array(F.col("_u_host")), F.slice("_u_tokens", 1, k)).alias("node"),
        F.concat_ws("/", F.array(F.col("_u_host")), F.slice("_u_tokens", 1, k - 1)).alias("parent"),
        F.when(k == size, "end").when(F.get("_u_tokens", k).startswith("*"), "wild").otherwise("name").alias("shape")))
    nodes = counted.withColumn("_u_at", F.explode(F.when(size > 0, at))).select(
        "_u_template", *[f"_u_{a}" for a in LABELS], "_u_at.*")
    cells = [F.sum(F.when(F.col("shape") == b, F.col(f"_u_{a}")).otherwise(0)).cast("long").alias(f"_u_{a}_{b}")
             for a in LABELS for b in SHAPES]
    tree = nodes.groupBy("node", "parent").agg(*cells)

    def total(names, of=F.col):
        out = of(names[0])
        for x in names[1:]:
            out = out + of(x)
        return out

    bad, good = total(CELLS[0:3]), total(CELLS[3:6])
    kinds = tree.withColumn("_u_kind", F.when(bad > good, "bad").otherwise("good"))
    pool = kinds.groupBy(F.col("parent").alias("_u_parent"), F.col("_u_kind").alias("_u_pooled")).agg(
        *[F.sum(c).alias(f"{c}_all") for c in CELLS])
    both = kinds.join(pool, (F.col("parent") == F.col("_u_parent")) & (F.col("_u_kind") == F.col("_u_pooled")))
    mine, all_ = total(CELLS).cast("double"), total([f"{c}_all" for c in CELLS]).cast("double")
    share = F.col("_u_n") / F.col("_u_of")
    spread = total(CELLS, lambda c: F.when(F.col(f"{c}_all") > 0, F.pow(F.col(c) - F.col(f"{c}_all") * share, F.lit(2.0)) / (
        F.col(f"{c}_all") * share)).otherwise(0.0))
    df = total(CELLS, lambda c: F.when(F.col(f"{c}_all") > 0, 1.0).otherwise(0.0)) - 1.0
    alike = F.when(F.col("_u_n") == F.col("_u_of"), True).otherwise(
        spread / (1.0 - share) <= df + 3.0 * F.sqrt(2.0 * df))
    branch = both.withColumn("_u_n", mine).withColumn("_u_of", all_).select(
        F.col("node").alias("_u_node"), F.when(alike, F.concat(F.lit("#"), "_u_kind")).alias("_u_branch"))
    merged = nodes.select("_u_template", "k", "node").join(branch, F.col("node") == F.col("_u_node")).groupBy("_u_template").agg(
        F.sort_array(F.collect_list(F.struct("k", F.coalesce("_u_branch", F.substring_index("node", "/", -1)).alias("t")))).alias("_u_path"))
    return counted.join(merged, "_u_template", "left").withColumn(
        "_u_merged", F.concat_ws("/", F.array(F.col("_u_host")), F.col("_u_path.t"))).drop("_u_path")


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules=RULES, label=weak_labels, depth: int = DEPTH,
          prior: float = PRIOR, weight: float = WEIGHT, limit: float = LIMIT) -> DataFrame:
    """Every page's key, host, path, rule, verdict, and the merged template and its purity that the method goes by.

    ``label`` names a column of ``pages`` (1 bad, 0 good, null unknown) or makes one from host, path and the rule's verdict."""
    rows = parsed(pages, key, url, rules, label, depth)
    found = saved(templates(rows).select("_u_template", "_u_merged", "_u_bad", "_u_good"), "url-branches")
    purity = found.groupBy("_u_merged").agg(
        ((F.sum("_u_bad") + weight * prior) / (F.sum("_u_bad") + F.sum("_u_good") + weight)).alias("_u_purity"))
    verdicts = found.join(purity, "_u_merged").select(F.col("_u_template").alias("_u_key"), "_u_merged", "_u_purity")
    return rows.join(verdicts, F.col("_u_template") == F.col("_u_key")).select(
        key, F.col("_u_host").alias("host"), F.col("_u_path").alias("path"), F.col("_u_name").alias("rule"),
        F.coalesce("_u_rule", F.when(F.col("_u_purity") > limit, "block").otherwise("allow")).alias("verdict"),
        F.col("_u_merged").alias("template"), F.col("_u_purity").alias("purity"))


def oracle(rules=RULES, depth: int = DEPTH, prior: float = PRIOR, weight: float = WEIGHT, limit: float = LIMIT) -> str:
    """DuckDB SQL over ``pages`` for page_id, host, path, rule, verdict, template, purity (weak labels)."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    fits = [(v, h + p, f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))") for v, h, p in ranked]

    def case(i):
        return "CASE " + " ".join(f"WHEN {f[2]} THEN '{f[i]}'" for f in fits) + " END"

    cells = {f"{a}_{b}": f"sum(CASE WHEN shape = '{b}' THEN n_{a} ELSE 0 END)" for a in ("bad", "good", "none") for b in SHAPES}
    spread = " + ".join(f"(CASE WHEN p.{c} > 0 THEN pow(t.{c} - p.{c} * (t.n / p.n), 2) / (p.{c} * (t.n / p.n)) ELSE 0 END)" for c in cells)
    df = "(" + " + ".join(f"(CASE WHEN p.{c} > 0 THEN 1.0::DOUBLE ELSE 0 END)" for c in cells) + " - 1)"
    return f"""
WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)\\A.*?://([^/?#]*)', 1), ''), '{upper}', '{upper.lower()}') AS host,
    coalesce(regexp_extract(url, '(?s)\\A.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT *, {case(1)} AS rule, {case(0)} AS said,
    list_filter(string_split(path, '/'), lambda s: s <> '') AS named FROM u),
g AS (SELECT *, CASE WHEN said IS NOT NULL THEN (said = 'block')::INT
      ELSE regexp_matches(lower(host || path), '(^|[^a-z0-9])({'|'.join(WORDS)})([^a-z0-9]|$)')::INT END AS label,
    list_transform(named[1:{depth}], lambda s: CASE WHEN regexp_matches(s, '[0-9]') OR length(s) > {LONG}
      THEN '*' || regexp_extract(s, '\\.[A-Za-z]{{2,5}}\\z') ELSE s END)
      || CASE WHEN len(named) > {depth} THEN ['**'] ELSE [] END AS toks FROM r),
m AS MATERIALIZED (SELECT *, array_to_string([host] || toks, '/') AS template FROM g),
c AS MATERIALIZED (SELECT template, host, toks, sum((label = 1)::INT) AS n_bad, sum((label = 0)::INT) AS n_good,
    sum((label IS NULL)::INT) AS n_none FROM m GROUP BY ALL),
nodes AS (SELECT *, array_to_string([host] || toks[1:k], '/') AS node, array_to_string([host] || toks[1:k - 1], '/') AS parent,
    CASE WHEN k = len(toks) THEN 'end' WHEN starts_with(toks[k + 1], '*') THEN 'wild' ELSE 'name' END AS shape
  FROM (SELECT *, unnest(range(1, len(toks) + 1)) AS k FROM c)),
t0 AS (SELECT node, parent, {", ".join(f"{v} AS {k}" for k, v in cells.items())} FROM nodes GROUP BY node, parent),
t AS (SELECT *, ({" + ".join(cells)})::DOUBLE AS n,
    CASE WHEN bad_end + bad_wild + bad_name > good_end + good_wild + good_name THEN 'bad' ELSE 'good' END AS kind FROM t0),
p AS (SELECT parent, kind, sum(n) AS n, {", ".join(f"sum({k}) AS {k}" for k in cells)} FROM t GROUP BY parent, kind),
b AS (SELECT t.node, CASE WHEN t.n = p.n OR ({spread}) / (1 - t.n / p.n) <= {df} + 3 * sqrt(2 * {df}) THEN '#' || t.kind END AS branch
  FROM t JOIN p ON t.parent = p.parent AND t.kind = p.kind),
j AS (SELECT template, list(coalesce(branch, toks[k]) ORDER BY k) AS steps FROM nodes JOIN b USING (node) GROUP BY template),
f AS (SELECT c.template, n_bad, n_good, array_to_string([host] || coalesce(steps, []), '/') AS merged FROM c LEFT JOIN j USING (template)),
q AS (SELECT merged, (sum(n_bad) + {weight * prior}) / (sum(n_bad) + sum(n_good) + {weight}) AS purity FROM f GROUP BY merged)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN purity > {limit} THEN 'block' ELSE 'allow' END) AS verdict,
  merged AS template, purity::DOUBLE AS purity
FROM m JOIN f USING (template) JOIN q USING (merged)"""
