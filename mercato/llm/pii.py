"""Personal data by weak supervision (DataFrame functions only).

Base kinds (email, ip, card, phone) are found by pattern and validity rule and always stay.  The method
adds spans: candidates of further kinds (``secret``: long mixed tokens; ``number``: identity and phone
numbers in national formats) are voted on by labelers that may abstain:

* regex: the candidate has the form of a known key, digest or number format;
* gazetteer: it begins with a known prefix, or words of a known list stand before it (for or against);
* context: words around it name what it is (password, token, phone, ...), or name something else
  (version, isbn, figure, ...);
* shape: share of digits and mixed case.

The votes of all candidates of the corpus are counted by pattern (a bounded table), and expectation-
maximisation on these counts estimates each labeler's reliability and each pattern's probability of being
personal data, without labels.  These probabilities, as soft labels, train the final classifier, a logistic
regression over votes and features of the span, on the counts.  Its coefficients become a column
expression that judges every candidate where it stands; no span is shuffled.

Offsets are code points, ends exclusive.  Defined cases: null or empty texts have no spans; equal texts have
equal spans; overlapping candidates of the base kinds are not added again; a corpus without candidates trains
nothing and adds nothing; empty tables give no rows.  Internal columns start with ``_p_``.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "number")

#: Patterns (fixed values, by the contract); possessive, and started only where a run of their first class
#: begins or the last match ended, which finds the same matches in time linear in the text.
_START = r"(?:\G|(?<![%s]))"
PATTERNS = {
    "email": _START % "A-Za-z0-9._%+-" + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _START % "0-9" + r"[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])(?=[0-9_+/-]*+[A-Za-z])[A-Za-z0-9_+/-]{12,}+",
    "number": r"(?<![0-9A-Za-z+-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4})(?![0-9A-Za-z-])",
}
#: A text without a match of this cannot match the pattern (card: not with the 16 digits it needs); cheaper to look for.
HINTS = {
    "email": r"@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]",
    "secret": r"[A-Za-z][_+/-]*+[0-9]|[0-9][_+/-]*+[A-Za-z]", "number": r"[0-9]{3}\)?[\x20.-][0-9]{2}",
}

# Forms, prefixes and words the labelers know.
FORMS = r"^(?:AKIA[0-9A-Z]{16}|[0-9a-f]{16,}|[0-9A-F]{32,}|gh[pousr]_[0-9A-Za-z]{20,}|sk_(?:live|test)_[0-9A-Za-z]{10,}|" \
        r"AIza[0-9A-Za-z_-]{30,}|eyJ[0-9A-Za-z_-]{10,}|[A-Z]{2}[0-9]{2}[0-9A-Z]{11,30}|[0-9]{3}-[0-9]{2}-[0-9]{4})$"
PREFIXES = r"^(?:AKIA|ASIA|gh[pousr]_|sk_|pk_|AIza|eyJ|xox[abp]-)"
FOR_WORDS = r"(?i)(?:password|passwd|pwd|secret|token|api[ _-]?key|access[ _-]?key|key|auth|bearer|credential|ssn|" \
            r"social security|passport|iban|account|phone|tel|mobile|fax|call|contact|kennwort|passwort|mot de passe|" \
            r"contraseña|clave)[\"']?\s*(?:is|ist|est|es)?\s*[:=]?\s*[\"']?$"
AGAINST_WORDS = r"(?i)(?:version|isbn|issn|doi|figure|page|chapter|section|commit|revision|sha|build|model|part)" \
                r"\s*(?:no\.?|number|#)?\s*[:=]?\s*[\"']?$"
URL_BEFORE = r"(?:https?://|www\.|/)\S*$"

LABELERS = ("regex", "gazetteer", "context", "shape")
CONTEXT = 40


def spans(text: Column, kind: str) -> Column:
    """Array of (s, e, m): the leftmost non-overlapping matches of the kind's pattern.

    Starts follow from the lengths of the pieces between matches and of the matches before."""
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    pieces = F.split(text, pattern, -1)

    def place(pair: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,m:string>>").alias("out"))
        return F.aggregate(
            F.arrays_zip(pair["p"], pair["f"]), zero,
            lambda a, x: F.struct(
                (a["at"] + F.length(x["p"]) + F.coalesce(F.length(x["f"]), F.lit(0))).alias("at"),
                F.when(x["f"].isNull(), a["out"]).otherwise(F.concat(a["out"], F.array(F.struct(
                    (a["at"] + F.length(x["p"])).alias("s"), (a["at"] + F.length(x["p"]) + F.length(x["f"])).alias("e"),
                    x["f"].alias("m"))))).alias("out")), lambda a: a["out"])

    both = F.transform(F.array(F.struct(pieces.alias("p"), found.alias("f"))), place)[0]
    return F.when(text.rlike(HINTS[kind]) & text.rlike(pattern), both).otherwise(
        F.array().cast("array<struct<s:int,e:int,m:string>>"))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """Whether the digits of ``m`` pass the Luhn check."""
    ds = F.transform(F.reverse(F.split(_digits(m), "")), lambda c, i: F.when(
        i % 2 == 1, F.when(c.cast("int") >= 5, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.aggregate(ds, F.lit(0), lambda a, x: a + x) % 10 == 0


VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, r"\."), lambda p: p.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$")),
    "card": lambda m: F.when(F.length(_digits(m)).between(16, 19), luhn(m)).otherwise(F.lit(False)),
    "phone": lambda m: F.length(_digits(m)).between(8, 15),
}


def _valid(kind: str):
    return lambda x: VALID[kind](x["m"])


def _named(kind: str):
    return lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"))


def with_base(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``_p_t`` (the text, null as empty) and ``_p_base``: valid base spans (kind, s, e) by kind, then start."""
    df = docs.withColumn("_p_t", F.coalesce(F.col(text), F.lit("")))
    for kind in BASE:
        df = df.withColumn(f"_p_{kind}", F.filter(spans(F.col("_p_t"), kind), _valid(kind)))
    df = df.withColumn("_p_base", F.concat(*[F.transform(f"_p_{kind}", _named(kind)) for kind in BASE]))
    return df.drop(*[f"_p_{k}" for k in BASE])


def _sign(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _features(text: Column, kind: str, x: Column) -> Column:
    """Votes (1 for, -1 against, 0 abstains) and features of one candidate."""
    before = F.substring(text, F.greatest(x["s"] - CONTEXT, F.lit(0)) + 1, F.least(x["s"], F.lit(CONTEXT)))
    m, n = x["m"], F.length(x["m"])
    digits = F.length(_digits(m))
    letters = F.length(F.regexp_replace(m, "[^A-Za-z]", ""))
    if kind == "secret":
        shape = _sign((digits >= 3) & (letters >= 3) & (digits * 8 >= n), (digits <= 1) | (letters == 0))
    else:
        shape = _sign(digits.between(9, 10), digits < 9)
    return F.struct(
        F.lit(kind).alias("kind"),
        F.when(m.rlike(FORMS), 1).otherwise(0).alias("regex"),
        _sign(m.rlike(PREFIXES), m.rlike(r"^[A-Za-z]+[_/-][A-Za-z_/-]+[0-9]{0,4}$")).alias("gazetteer"),
        _sign(before.rlike(FOR_WORDS), before.rlike(AGAINST_WORDS) | before.rlike(URL_BEFORE)).alias("context"),
        shape.alias("shape"),
        F.least(F.floor(n / 8), F.lit(5)).cast("int").alias("length"),
        F.floor(digits * 4 / n).cast("int").alias("digits"))


def _described(kind: str):
    return lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), _features(F.col("_p_t"), kind, x).alias("f"))


def with_candidates(df: DataFrame) -> DataFrame:
    """Adds ``_p_cand``: candidates (s, e, f) that no base span overlaps, f being votes and features."""
    for kind in ADDED:
        free = F.filter(spans(F.col("_p_t"), kind), lambda x: ~F.exists(
            "_p_base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
        df = df.withColumn(f"_p_{kind}", F.transform(free, _described(kind)))
    return df.withColumn("_p_cand", F.concat(*[F.col(f"_p_{k}") for k in ADDED])).drop(*[f"_p_{k}" for k in ADDED])


#: What a labeler is expected to vote (-1, 0, 1) on a candidate that is not, and that is, personal data.
#: Without it, a corpus whose candidates are nearly all of one class would split that class in two.
PRIOR = {name: ({-1: 0.4, 0: 0.55, 1: 0.05}, {-1: 0.1, 0: 0.4, 1: 0.5}) for name in LABELERS}
PRIOR["shape"] = ({-1: 0.2, 0: 0.35, 1: 0.45}, {-1: 0.1, 0: 0.3, 1: 0.6})


def expectation_maximisation(patterns: dict[tuple[int, ...], int], rounds: int = 200) -> tuple[dict, dict]:
    """Reliability of each labeler and probability of each vote pattern, from the patterns' counts.

    Two classes; a labeler votes -1, 0 or 1 with class-dependent probabilities, independently given the
    class.  ``PRIOR`` counts as much as the candidates do."""
    total = sum(patterns.values())
    rate = {(j, c): dict(PRIOR[name][c]) for j, name in enumerate(LABELERS) for c in (0, 1)}
    share, p = 0.5, {}
    for _ in range(rounds):
        new = {}
        for v in patterns:
            odds = math.log(share / (1 - share)) + sum(math.log(rate[j, 1][x] / rate[j, 0][x]) for j, x in enumerate(v))
            new[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        moved = max((abs(new[v] - p.get(v, -1)) for v in new), default=0)
        p = new
        if moved < 1e-9:
            break
        share = (sum(p[v] * n for v, n in patterns.items()) + total / 2) / (2 * total)
        for j, name in enumerate(LABELERS):
            for c in (0, 1):
                weight = {x: total * q for x, q in PRIOR[name][c].items()}
                for v, n in patterns.items():
                    weight[v[j]] += n * (p[v] if c else 1 - p[v])
                rate[j, c] = {x: w / sum(weight.values()) for x, w in weight.items()}
    return rate, p


FEATURES = ("regex", "gazetteer", "context", "shape", "length", "digits")


def _vector(kind: str, f: dict) -> list[float]:
    """Features of the classifier: votes for and against each labeler, kind, length and digit classes."""
    votes = [float(f[name] == side) for name in LABELERS for side in (1, -1)]
    return votes + [float(kind == k) for k in ADDED] + [f["length"] / 5, f["digits"] / 4]


def learn(candidates: DataFrame, spark) -> tuple[list[float], float] | None:
    """Coefficients and intercept of the span classifier.  What reaches the driver is one row per distinct
    combination of votes and classes, at most 2 * 3**4 * 6 * 5."""
    # outer: else Spark would test the array's size below the columns that compute it
    each = candidates.select(F.explode_outer("_p_cand").alias("x")).filter("x is not null").select("x.f.*")
    counts = each.groupBy("kind", *FEATURES).agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return None
    prob: dict = {}
    for kind in ADDED:
        patterns: dict = {}
        for r in counts:
            if r["kind"] == kind:
                v = tuple(r[name] for name in LABELERS)
                patterns[v] = patterns.get(v, 0) + r["n"]
        if patterns:
            prob[kind] = expectation_maximisation(patterns)[1]
    rows = []
    for r in sorted(counts, key=lambda r: tuple(str(r[c]) for c in ("kind", *FEATURES))):
        p = prob[r["kind"]][tuple(r[name] for name in LABELERS)]
        x = Vectors.dense(_vector(r["kind"], r.asDict()))
        rows += [(x, 1.0, r["n"] * p), (x, 0.0, r["n"] * (1 - p))]
    train = spark.createDataFrame(rows, ["features", "label", "weight"])
    model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=100, standardization=False).fit(train.coalesce(1))
    return [float(c) for c in model.coefficients], float(model.intercept)


def _score(f: Column, model: tuple[list[float], float]) -> Column:
    terms = [(f[name] == side).cast("double") for name in LABELERS for side in (1, -1)]
    terms += [(f["kind"] == k).cast("double") for k in ADDED] + [f["length"] / 5, f["digits"] / 4]
    return sum((t * F.lit(c) for t, c in zip(terms, model[0])), F.lit(model[1]))


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_pii``: base (kind, s, e) and spans (base ones, then added ones, by kind and start).

    Two passes over the texts, the first counts votes; neither shuffles nor stores them."""
    model = learn(with_candidates(with_base(docs.select(text), text)), docs.sparkSession)
    df = with_base(docs, text)
    if model is None:
        added = F.col("_p_base")
    else:
        df = with_candidates(df)
        chosen = F.filter("_p_cand", lambda x: _score(x["f"], model) > 0)
        added = F.concat("_p_base", F.transform(chosen, lambda x: F.struct(
            x["f"]["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"))))
    df = df.withColumn("_pii", F.struct(F.col("_p_base").alias("base"), added.alias("spans")))
    return df.drop("_p_t", "_p_base", "_p_cand")


def written(a: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the base kinds, digest of the base spans, and all spans as a string."""
    df = with_spans(docs.select(key, text), text)
    count = lambda k: F.size(F.filter("_pii.base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return df.select(key, *[count(k) for k in BASE], F.sha2(written(F.col("_pii.base")), 256).alias("base_sha256"),
                     written(F.col("_pii.spans")).alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` (its columns unchanged otherwise) with every span of the text replaced by its kind in brackets.
    Of overlapping spans the one that starts first (the longer of two) is replaced."""
    df = with_spans(docs, text)
    order = F.array_sort(F.transform("_pii.spans", lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("o"), x["kind"].alias("kind"))))
    body = F.coalesce(F.col(text), F.lit(""))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, x: Column) -> Column:
        return F.when(x["s"] < a["at"], a).otherwise(F.struct(
            (-x["o"]).alias("at"), F.concat(a["out"], F.substring(body, a["at"] + 1, x["s"] - a["at"]), F.lit("["),
                                            F.upper(x["kind"]), F.lit("]")).alias("out")))

    new = F.aggregate(order, zero, step, lambda a: F.concat(a["out"], F.substring(body, a["at"] + 1, F.length(body))))
    return df.withColumn(text, F.when(F.size("_pii.spans") > 0, new).otherwise(F.col(text))).drop("_pii")
