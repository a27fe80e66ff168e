"""Golden and hand-made cases from FIXTURES.md for text, URL and span functions."""

from pyspark.sql import functions as F

from mercato.functions.text import normalize_text, remove_words, size_class, street_name
from mercato.functions.urls import encode_params, search_api_params
from mercato.operators.textops import annotate_spans, bio_tags

ORIGINAL = ("- A beleza do apartamento é que depois de um dia maravilhoso na vibrante e movimentada "
            "[Amsterdã](Location Features), você volta para casa depois de uma curta caminhada ou uma "
            "[viagem de ônibus/bonde](Location Features) neste adorável apartamento tranquilo. Assista a um filme "
            "na [Netflix] (Appliances), beba um vinho na [varanda] (Facility) ou vá direto para a [cama] "
            "(Hospitality) em um de nossos dois [aconchegantes quartos] (Facility).")
GOLDEN_SPANS = [(87, 95, "Location Features", "Amsterdã"),
                (155, 177, "Location Features", "viagem de ônibus/bonde"),
                (238, 245, "Appliances", "Netflix"), (264, 271, "Facility", "varanda"),
                (292, 296, "Hospitality", "cama"), (318, 339, "Facility", "aconchegantes quartos")]


def test_spans_golden(spark):
    df = spark.createDataFrame([(1, ORIGINAL)], "doc_id long, text string")
    r = annotate_spans(df).first()
    assert r.clean_text.startswith("- A beleza")
    assert [(s.start, s.end, s.label, s.text) for s in r.spans] == GOLDEN_SPANS
    assert r.spans_valid


def test_bio_tags(spark):
    df = annotate_spans(spark.createDataFrame([(1, ORIGINAL)], "doc_id long, text string"))
    tags = {(t.token, t.tag) for t in bio_tags(df, "doc_id").collect()}
    assert ("movimentada", "O") in tags
    assert ("Amsterdã,", "B-Location_Features") in tags
    assert ("viagem", "B-Location_Features") in tags
    assert ("de", "I-Location_Features") in tags
    assert ("ônibus/bonde", "I-Location_Features") in tags


def test_text_normalise(spark):
    df = spark.createDataFrame([("  Praça do Comércio/Lisboa,\nPT!",), ("a / b",)], "t string")
    out = [r[0] for r in df.select(normalize_text(F.col("t"))).collect()]
    assert out == ["praca do comercio lisboa pt", "a   b"]


def test_size_taxonomy(spark):
    cases = {"M": "clothing", "no_size": "none", "41": "footwear", "8 anos": "kids", "95D": "cup",
             "30 mm diameter": "jewellery", "40 x 45 cm": "volume", "9-18kgs": "weight", "W33": "jeans"}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = dict(df.select("s", size_class(F.col("s")).alias("c")).collect())
    assert got == cases


def test_remove_words_only_multiword(spark):
    df = spark.createDataFrame([("Apartamento T2 Lumiar",), ("Moradia",), ("T1  Campo de Ourique",)], "n string")
    out = [r[0] for r in df.select(remove_words(F.col("n"), ["apartamento", "t2", "t1", "moradia"])).collect()]
    assert out == ["Lumiar", "Moradia", "Campo de Ourique"]


def test_street_gazetteer(spark):
    df = spark.createDataFrame([("Apartamento T2 na Rua Nova, Lisboa", "Alvalade"), ("Moradia T3", "Belém"),
                                ("T1 na Praça da Alegria", "Centro")], "t string, n string")
    out = [r[0] for r in df.select(street_name(F.col("t"), F.col("n"))).collect()]
    assert out == ["Rua Nova", "Belém", "Praca da Alegria"]


def test_search_url_params(spark):
    url = ("https://x/catalog?catalog_ids[]=5&catalog_ids[]=7&order=newest_first"
           "&search_text=red&search_text=shoe&brand_ids[]=")
    df = spark.createDataFrame([(1, url)], "page_id long, url string")
    got = {r.param: r.value for r in search_api_params(df, "page_id", "url").collect()}
    assert got == {"catalog_ids": "5,7", "order": "newest_first", "search_text": "red+shoe", "page": "1",
                   "per_page": "20"}


def test_url_encode(spark):
    df = spark.createDataFrame([({"search_text": "red shoe", "order": "new&old"},)], "m map<string,string>")
    assert df.select(encode_params(F.col("m"))).first()[0] == "order=new%26old&search_text=red+shoe"
