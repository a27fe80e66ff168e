"""The pipeline's stages on the smallest table, each held against plain Python on its own input."""

import collections
import re

import corpus_pipeline
from mercato.llm import packing, quality
from mercato.llm.common import shared_folder, table
from mercato.llm.tokens import Encoder, default_path
from test_operators import base_spans, brute_groups

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    names, at = docs.columns, [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        source = spark.createDataFrame(at[-1], docs.schema)
        at.append(stage(spark, source, SF).collect())
    start, good, unique, clean, mixed, packed = at
    kept = {r["doc_id"] for r in quality.verdicts(docs).filter("_quality.kept").collect()}
    assert {r["doc_id"] for r in good} == kept and 0 < len(good) < len(start)
    groups = brute_groups([(r["doc_id"], r["text"], r["source"]) for r in good], 5, 80)
    assert sorted(r["doc_id"] for r in unique) == sorted(i for i, c in groups.items() if i == c)
    before = {r["doc_id"]: r["text"] for r in unique}
    for r in clean:
        assert not base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if not re.search(r"\[(EMAIL|IP|CARD|PHONE|SECRET|NUMBER)\]", r["text"]):
            assert r["text"] == before[r["doc_id"]]
    copies = collections.Counter(r["doc_id"] for r in mixed)
    assert max(copies.values()) <= 3 and set(copies) <= set(before)
    assert all(list(r.asDict()) == names for rows in (good, unique, clean, mixed) for r in rows)
    encode = Encoder(default_path())
    want = sum(len(b) // 4 + 1 for b in encode.batch(r["text"] for r in mixed))
    assert sum(r["length"] for r in packed) == want
    fills = collections.Counter()
    for r in packed:
        fills[r["sequence_id"]] += r["length"]
    assert max(fills.values()) <= packing.CAPACITY


def test_odd_rows_pass_through_every_stage(spark, make, prose):
    """Null ids and texts, ids that repeat with other texts and repeated rows: no text is lost but to a rule or a copy."""
    texts = [prose(i, 120) for i in range(8)]
    rows = [(i, t, f"s{i % 2}") for i, t in enumerate(texts)]
    rows += [(3, texts[0], "s0"), (3, texts[5], "s1"), (9, texts[1], None), (None, texts[2], "s0"), (None, None, None), (10, "", "s1"), (4, texts[4], "s0")]
    docs, seen = make(rows, extra=False), None
    for name, stage in corpus_pipeline.STAGES:
        path = shared_folder(spark, f"test-{name}")
        out = stage(spark, docs, "")
        out.write.parquet(path)
        before, docs = docs, spark.read.schema(out.schema).parquet(path)
        if name != "packing":
            assert docs.columns == before.columns
        if name == "quality":
            seen = {r["text"] for r in docs.collect()}
            assert set(texts) <= seen
        if name == "near_duplicates":
            kept = [(r["doc_id"], r["text"]) for r in docs.collect()]
            assert {t for _, t in kept} == seen
            assert sorted(i for i, t in kept if t in texts and i is not None and (i, t) != (4, texts[4])) == [0, 1, 2, 3, 3, 6, 7]
    assert docs.filter("length <= 0 or length > 2048").count() == 0
