"""File sources, HTML parsing and sinks on small fixtures (FIXTURES.md 3.1, 3.5)."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from mercato.operators.html import extract_articles, listing_features, parse_listings
from mercato.operators.relational import frequent_combinations, keep_frequent
from mercato.sinks.writers import date_dimension, merge_latest, upsert_partitions
from mercato.sources.files import (
    LOCATION_SCHEMA, flatten_location_tree, flatten_struct, read_csv, read_html_dir, read_paged_json,
    split_items_users,
)
from mercato.streaming import jobs

SF = "/root/testdata/sf0.001"

LISTING_HTML = """<html><body><article class="item"><a class="item-link" title="Apartamento T2 na Rua Nova" href="/i/1"></a>
<span class="item-price">1.250.000€</span><span class="item-parking"></span>
<span class="item-detail">T2</span><span class="item-detail">85 m² área bruta</span>
<span class="item-detail">3º andar com elevador</span>
<div class="item-description description"> Texto </div></article>
<article class="item"><a class="item-link" title="Moradia T3" href="/i/2"></a>
<span class="item-detail">T3</span><span class="item-detail">120 m²</span>
<div class="item-description description">Casa</div></article></body></html>"""


def test_listing_html(spark):
    pages = spark.createDataFrame([(1, LISTING_HTML), (2, "<html><p>no listings</p></html>")],
                                  "page_id long, html string")
    rows = listing_features(parse_listings(pages)).orderBy("article_idx").collect()
    assert len(rows) == 2
    a, b = rows
    assert (a.home_type, a.link, a.price, a.garage, a.home_size, a.home_area, a.floor, a.elevator) == (
        "Apartamento", "https://www.idealista.pt/i/1", 1250000, "Yes", "T2", 85, 3, True)
    assert round(a.price_per_sqr_meter, 2) == 14705.88 and a.description == "Texto"
    assert (b.price, b.floor, b.elevator, b.price_per_sqr_meter, b.garage) == (None, 0, False, None, "No")


def test_extract_articles_generic():
    items = extract_articles("<article><h1>Title</h1><p>one</p><p>two</article>", classes=None)
    assert items[0]["title"] == "Title" and items[0]["description"] == "one two"


def test_location_tree_golden(spark):
    tree = {"locationTree": [{"id": "aveiro/agueda", "name": "Águeda", "detailedLevel": "council", "parentIds": [],
                              "sublocations": [
                                  {"id": "aveiro/agueda/aguada-de-cima", "name": "Aguada de Cima",
                                   "detailedLevel": "parish", "parentIds": []},
                                  {"id": "aveiro/agueda/fermentelos", "name": "Fermentelos",
                                   "detailedLevel": "parish", "parentIds": []}]}]}
    d = tempfile.mkdtemp(prefix="loc-")
    with open(os.path.join(d, "tree.json"), "w") as f:
        json.dump(tree, f)
    df = spark.read.schema(LOCATION_SCHEMA).option("multiLine", True).json(d)
    rows = flatten_location_tree(df).orderBy("id").collect()
    assert [(r.district, r.municipality, r.id, r.name, r.detailedLevel) for r in rows] == [
        ("aveiro", "agueda", "aveiro/agueda", "Águeda", "council"),
        ("aveiro", "agueda", "aveiro/agueda/aguada-de-cima", "Aguada de Cima", "parish"),
        ("aveiro", "agueda", "aveiro/agueda/fermentelos", "Fermentelos", "parish")]
    parish = flatten_location_tree(df).filter(F.col("detailedLevel") == "parish")
    assert parish.count() == 2


def test_paged_json_and_users(spark):
    d = tempfile.mkdtemp(prefix="pages-")
    pages = [{"items": [{"id": 1, "title": "a", "price": "5.0", "user": {"id": 10, "login": "u"}},
                        {"id": 2, "title": "b", "price": "7.0", "user": {"id": 10, "login": "u"}}],
              "pagination": {"total_entries": 3, "current_page": 1}},
             {"items": [], "pagination": {"total_entries": 3, "current_page": 2}},
             {"items": [{"id": 3, "title": "c", "price": "9.0", "user": {"id": 11, "login": "v"}}],
              "pagination": {"total_entries": 3, "current_page": 3}}]
    for i, p in enumerate(pages):
        with open(os.path.join(d, f"p{i}.json"), "w") as f:
            json.dump(p, f)
    items = read_paged_json(spark, d)
    assert items.count() == 3  # the empty page does not lose the others
    it, users = split_items_users(items)
    assert users.count() == 2 and "user_id" in it.columns


def test_users_are_described_by_their_latest_item(spark):
    rows = [(1, (10, "old", "fr")), (3, (10, "new", "pt")), (2, (11, "v", None)), (2, (11, "v", None)), (4, None)]
    items = spark.createDataFrame(rows, "id long, user struct<id: long, login: string, country_code: string>")
    it, users = split_items_users(items.repartition(4))
    assert sorted(tuple(r) for r in users.filter("id is not null").collect()) == [(10, "new", "pt"), (11, "v", None)]
    assert it.count() == 5


def test_html_reader_leaves_the_session_alone(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    d = tempfile.mkdtemp(prefix="html-")
    for i in range(3):
        with open(os.path.join(d, f"p{i}.html"), "w") as f:
            f.write(f"<p>{i}</p>")
    assert read_html_dir(spark, d).count() == 3
    assert before == {k: spark.conf.get(k) for k in before}


def test_stream_reads_a_folder_of_files(spark):
    """A table of several files streams like one of a single file."""
    base = tempfile.mkdtemp(prefix="events-")
    events = jobs.events_batch(spark, SF)
    events.repartitionByRange(4, "event_id").write.parquet(os.path.join(base, "events.parquet"))
    want = {r["table"]: r["n"] for r in jobs.fan_out(jobs.events_stream(spark, SF), "one").collect()}
    got = {r["table"]: r["n"] for r in jobs.fan_out(jobs.events_stream(spark, base), "four").collect()}
    assert got == want and got["items"] == events.count() > 0


def test_frequent_combinations_agree_with_row_filters(spark):
    rows = [(i % 3, i % 7, i % 2) for i in range(100)] + [(None, 1, 1)] * 40 + [(0, None, 0)] * 40
    df = spark.createDataFrame(rows, "a int, b int, c int")
    cols = ["a", "b", "c"]
    want = keep_frequent(df, cols, 14).groupBy(*cols).count().collect()
    got = frequent_combinations(df, cols, 14).collect()
    assert sorted(map(tuple, got)) == sorted((r["a"], r["b"], r["c"], r["count"]) for r in want) and got


def test_csv_and_flatten(spark):
    d = tempfile.mkdtemp(prefix="csv-")
    with open(os.path.join(d, "prices.csv"), "w") as f:
        f.write("category_id,price_double\n1,10.5\n2,3\n")
    df = read_csv(spark, d, "category_id double, price_double double")
    assert df.count() == 2
    nested = spark.createDataFrame([((1, (2, "x")),)], "a struct<b:int, c:struct<d:int, e:string>>")
    assert flatten_struct(nested).columns == ["a_b", "a_c_d", "a_c_e"]


def test_html_dir_source(spark):
    d = tempfile.mkdtemp(prefix="html-")
    for i in range(3):
        with open(os.path.join(d, f"f{i}.html"), "w") as f:
            f.write(LISTING_HTML)
    with open(os.path.join(d, "skip.txt"), "w") as f:
        f.write("x")
    df = read_html_dir(spark, d)
    assert df.count() == 3


def test_upsert_idempotent(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="upsert-"), "t")
    a = spark.createDataFrame([(1, "2024-01-01", 1, 10.0), (2, "2024-01-01", 1, 20.0)],
                              "product_id int, day string, v int, price double")
    b = spark.createDataFrame([(1, "2024-01-01", 2, 11.0), (3, "2024-01-02", 1, 30.0)],
                              "product_id int, day string, v int, price double")
    upsert_partitions(a, d, ["product_id", "day"], ["v"], "day")
    upsert_partitions(b, d, ["product_id", "day"], ["v"], "day")
    def read():
        t = spark.read.parquet(d).select("product_id", F.col("day").cast("string"), "v", "price")
        return sorted(tuple(r) for r in t.collect())
    first = read()
    upsert_partitions(b, d, ["product_id", "day"], ["v"], "day")
    again = read()
    assert first == again == [(1, "2024-01-01", 2, 11.0), (2, "2024-01-01", 1, 20.0), (3, "2024-01-02", 1, 30.0)]
    m = merge_latest(a, b, ["product_id", "day"], ["v"])
    assert m.count() == 3


def test_upsert_keeps_table_on_error_and_moves_keys(spark):
    import pytest
    d = os.path.join(tempfile.mkdtemp(prefix="upsert-"), "t")
    old = spark.createDataFrame([(1, "d1", 1, 10.0), (2, "d1", 1, 20.0), (3, "d3", 1, 30.0)],
                                "id int, day string, v int, price double")
    upsert_partitions(old, d, ["id"], ["v"], "day")

    def read():
        t = spark.read.parquet(d).select("id", F.col("day").cast("string"), "v", "price")
        return sorted(tuple(r) for r in t.collect())
    before = read()
    clash = spark.createDataFrame([(1, "d1", 2, "eleven")], "id int, day string, v int, price string")
    with pytest.raises(ValueError):
        upsert_partitions(clash, d, ["id"], ["v"], "day")
    assert read() == before
    moved = spark.createDataFrame([(1, "d2", 2, 11.0), (3, "d2", 2, 31.0)], "id int, day string, v int, price double")
    for _ in range(2):  # a replay changes nothing
        upsert_partitions(moved, d, ["id"], ["v"], "day")
        assert read() == [(1, "d2", 2, 11.0), (2, "d1", 1, 20.0), (3, "d2", 2, 31.0)]


def test_phrases_are_matched_whole(spark):
    from mercato.operators.textops import phrase_hits
    docs = spark.createDataFrame([(1, "a b c d e a b c x"), (2, "b"), (3, None), (4, "a b")], "doc_id long, text string")
    entries = spark.createDataFrame([(10, "A b c d"), (11, "a b"), (12, "b"), (13, "")], "item long, phrase string")
    got = sorted(tuple(r) for r in phrase_hits(docs, "doc_id", "text", entries, "item", "phrase").collect())
    assert got == [(1, 0, 10), (1, 0, 11), (1, 1, 12), (1, 5, 11), (1, 6, 12), (2, 0, 12), (4, 0, 11), (4, 1, 12)]


def test_date_dimension(spark):
    df = spark.createDataFrame([("2024-01-30",), ("2024-02-02",)], "d string").select(F.to_date("d").alias("date"))
    rows = date_dimension(df).orderBy("full_date").collect()
    assert len(rows) == 4 and rows[0].date_id == 20240130 and rows[0].day_of_week == 1  # Tuesday, Monday=0


def test_grouped_json_and_parquet_sinks(spark):
    from mercato.sinks.writers import replace_table, write_grouped_json, write_partitioned
    base = tempfile.mkdtemp(prefix="sinks-")
    df = spark.createDataFrame([("aveiro", "a/1", "x"), ("aveiro", "a/1", "y"), ("porto", "p/1", "z")],
                               "district string, id string, item string")
    write_grouped_json(df, os.path.join(base, "json"), "district", "id", ["item"])
    back = spark.read.json(os.path.join(base, "json"))
    assert sorted(r.district for r in back.collect()) == ["aveiro", "porto"]
    replace_table(df, os.path.join(base, "t"))
    replace_table(df, os.path.join(base, "t"))
    assert spark.read.parquet(os.path.join(base, "t")).count() == 3
    write_partitioned(df, os.path.join(base, "p"), ["district"])
    assert os.path.isdir(os.path.join(base, "p", "district=porto"))


def test_images_labels_and_catalog(spark):
    from mercato.sources.files import catalog_columns, join_images_labels, read_images
    d = tempfile.mkdtemp(prefix="img-")
    for pid in (101, 102):
        with open(os.path.join(d, f"{pid}_0.jpg"), "wb") as f:
            f.write(b"\xff\xd8\xff" + bytes([pid % 256]))
    images = read_images(spark, d)
    labels = spark.createDataFrame([(101, "dress"), (102, "shoe"), (103, "bag")], "product_id long, label string")
    matched, missing = join_images_labels(images, labels)
    assert matched.count() == 2 and [r.product_id for r in missing.collect()] == [103]
    labels.createOrReplaceTempView("labels_fixture")
    cols = catalog_columns(spark).filter("table_name = 'labels_fixture'").collect()
    assert [(c.column_name, c.ordinal_position) for c in cols] == [("product_id", 1), ("label", 2)]


def test_model_save_load(spark):
    from pyspark.ml import PipelineModel
    from mercato.operators.ml import onehot_pipeline
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "c string, x double")
    m = onehot_pipeline(["c"], ["x"]).fit(df)
    path = os.path.join(tempfile.mkdtemp(prefix="model-"), "m")
    m.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = [r.features for r in m.transform(df).collect()]
    b = [r.features for r in again.transform(df).collect()]
    assert a == b
