"""Links behind documents that are not alike: no earlier copy is lost."""

from pyspark.sql import functions as F

from mercato.operators import neardup


def _docs(spark):
    word = lambda a, b: " ".join(f"w{i}" for i in range(a, b))
    rows = [(1, word(0, 200)), (2, word(0, 100)), (3, word(0, 100)), (4, word(0, 85) + " x y z"), (5, word(300, 400)),
            (6, word(300, 350) + " " + word(0, 50)), (7, word(300, 350) + " " + word(0, 50)), (8, "a b"), (9, "a b")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def _pairs(rows):
    out, sets = set(), {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))}
    for i in sets:
        for j in sets:
            if j < i and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.7:
                out.add((i, j))
    return out


def test_every_document_with_an_earlier_copy_is_linked(spark):
    rows, df = _docs(spark)
    want = _pairs(rows)
    for got in (neardup.exact_links(neardup.shingle_sets(df, "doc_id", "text", 5), "doc_id", 70),
                neardup.near_duplicates(df, "doc_id", "text")):
        pairs = {(r["doc_id"], r["rep"]) for r in got.collect()}
        assert pairs <= want and {i for i, _ in pairs} == {i for i, _ in want} >= {3, 4, 7, 9}


def _components(rows, sets, percent):
    up = {i: i for i, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sets:
        for j in sets:
            if j < i and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in rows}


def test_exact_groups_match_all_pairs(spark):
    import random

    from mercato.operators.similarity import similar_groups
    r = random.Random(8)
    rows = list(_docs(spark)[0]) + [(10, None), (11, ""), (12, " \n"), (13, "b a")]
    base = [[f"v{r.randint(0, 400)}" for _ in range(r.randint(20, 90))] for _ in range(12)]
    common = [f"c{i}" for i in range(30)]  # a passage that many unlike documents share
    for i in range(100, 260):
        w = list(r.choice(base))
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = f"x{r.randint(0, 50)}"
        if r.random() < 0.5:
            w = w[: r.randint(5, len(w))] + common
        rows.append((i, " ".join(w)))
    sets = {}
    for i, t in rows:
        w = (t or "").split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for percent in (50, 70, 90):
        want = _components(rows, sets, percent)
        got = {x["doc_id"]: x for x in similar_groups(df, "doc_id", "text", 5, percent).collect()}
        assert {i: x["component_id"] for i, x in got.items()} == want
        assert all(x["class_id"] == min(j for j in sets if sets[j] == sets[i]) if sets[i] else x["class_id"] == i for i, x in got.items())
    assert similar_groups(df.filter("false"), "doc_id", "text").count() == 0


def test_sets_in_rows_match_and_copies_move_once(spark, monkeypatch):
    rows, df = _docs(spark)
    df = df.unionByName(spark.createDataFrame([(2, "p q r s t u"), (None, "a b c"), (10, None), (11, " ")], "doc_id long, text string"))
    want = {(r["doc_id"], r["gram"]) for r in neardup.shingle_sets(df, "doc_id", "text", 5).collect() if r["doc_id"] is not None}
    got = [(r["doc_id"], g) for r in neardup.shingle_rows(df, "doc_id", "text", 5).collect() for g in r["sh"]]
    assert len(got) == len(want) and set(got) == want
    kept, whole = {}, neardup.saved
    monkeypatch.setattr(neardup, "saved", lambda d, name: kept.setdefault(name, whole(d, name)))
    many = spark.createDataFrame([(100 * i + j, rows[j][1]) for i in range(30) for j in (1, 3)], "doc_id long, text string")
    links = {(r["doc_id"], r["rep"]) for r in neardup.near_duplicates(many, "doc_id", "text").collect()}
    assert {i for i, _ in links} == {100 * i + j for i in range(30) for j in (1, 3)} - {1} and {r for _, r in links} == {1, 3}
    assert kept["pairs"].count() == 1 and kept["sets"].count() == 2


def test_groups_read_the_texts_once(spark, monkeypatch):
    from mercato.operators import similarity
    calls, whole = [], similarity.shingle_arrays
    monkeypatch.setattr(similarity, "shingle_arrays", lambda *a: calls.append(1) or whole(*a))
    assert similarity.similar_groups(_docs(spark)[1], "doc_id", "text").count() == 9 and len(calls) == 1


def test_shingles_move_once_in_slices(spark):
    """Shingles are shuffled once for their counts and for what is kept of them; the files go when a slice is written."""
    import glob
    import os

    from mercato.operators import similarity
    rows, df = _docs(spark)
    sets = similarity.shingle_arrays(df.withColumnRenamed("doc_id", "id"), "id", "text", 5).withColumn("n", F.size("sh"))
    rep = sets.filter("n > 0").groupBy("id").agg(F.min(F.struct("n")).alias("_set"))
    want = {(g, r["id"]) for r in similarity._class_sets(sets, rep, ["n"]).collect() for g in r["sh"]}
    many = {g for g, _ in want if len([1 for h, _ in want if h == g]) > 1}
    got = []
    plan = similarity._shared_grams(sets, rep, ["n"], 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(gram") == 1
    for i in range(similarity.SLICES):
        part = similarity._shared_grams(sets, rep, ["n"], i)
        got += [(r["gram"], r["id"]) for r in part.collect()]
    assert len(got) == len(set(got)) and set(got) == {(g, i) for g, i in want if g in many}
    local = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()[0]
    before = len(glob.glob(os.path.join(local, "*", "shuffle_*.data")))
    similarity.saved(df.repartition(7, "doc_id"), "rows")
    assert len(glob.glob(os.path.join(local, "*", "shuffle_*.data"))) <= before
