import datetime

import pytest
from pyspark.sql import functions as F

from folioforge.operators import segment, temporal

BODY = "> Título I · Capítulo II · Sección TERCERA\n\n# Artículo 5\n\nTexto:\n\nI. Uno;\n\nII.- Dos; y\n\n1. Tres\n\na) Cuatro\n\nArtículo adicionado DOF 03-12-1993. Derogado DOF 15-12-1995, 220-12-1991\n\nCapítulo III"


def test_blocks(spark):
    df = spark.createDataFrame([(1, BODY), (2, None), (3, "")], "id long, t string")
    rows = segment.blocks_of(df, "id", "t").orderBy("pos").collect()
    assert [r.kind for r in rows] == ["breadcrumb", "heading", "paragraph", "fraccion", "fraccion", "numeral", "inciso", "annotation", "structure"]
    assert [r.marker for r in rows][3:7] == ["I", "II", "1", "a"]


def test_breadcrumb_keeps_the_deepest_two(spark):
    row = spark.createDataFrame([(BODY,), ("# x",)], "t string").select(segment.breadcrumb(F.col("t")).alias("b")).collect()
    assert [(p.level, p.label) for p in row[0].b] == [("Capítulo", "II"), ("Sección", "TERCERA")]
    assert row[1].b == []


def test_context_is_reset_by_higher_levels(spark):
    lines = ["Título I", "Capítulo A", "x", "Título II", "y", "Capítulo B", "z"]
    df = spark.createDataFrame([(1, i + 1, x) for i, x in enumerate(lines)], "d long, line_no int, line string")
    rows = segment.carried_context(df, "d").orderBy("line_no").collect()
    assert [(r["Título"], r["Capítulo"]) for r in rows] == [("I", None), ("I", "A"), ("I", "A"), ("II", None), ("II", None), ("II", "B"), ("II", "B")]


def test_reflow_and_marks(spark):
    df = spark.createDataFrame([("técnico-\r\nadministrativas y\nmás\n\nOtro", "(19)(20) texto")], "a string, b string")
    r = df.select(segment.reflow(F.col("a")), segment.amendment_marks(F.col("b")), segment.split_run_on(F.lit("I. a; y II. b; c"))).first()
    assert r[0] == "técnico- administrativas y más\n\nOtro" and r[1] == [19, 20] and r[2] == ["I. a;", "II. b; c"]


def test_events(spark):
    df = spark.createDataFrame([(1, BODY), (2, "x (sic DOF 05-02-1917)"), (3, None)], "id long, t string")
    got = [(r.scope, r.verb, r.raw_date, r.event_date) for r in temporal.events_of(df, "id", "t").orderBy("seq").collect()]
    assert got == [("Artículo", "adicionado", "03-12-1993", datetime.date(1993, 12, 3)), ("Artículo", "derogado", "15-12-1995", datetime.date(1995, 12, 15)), ("Artículo", "derogado", "220-12-1991", None)]


@pytest.mark.parametrize("body,parity,corrected", [
    ("(Se deroga).", "repealed", "repealed"),
    ("Derogación tácita de preceptos", "unknown", "unknown"),
    ("Se derogan todas aquellas disposiciones", "repealed", "unknown"),
    ("(Se deroga el primer párrafo). Lo demás", "repealed", "partial"),
    ("Texto vigente", "unknown", "unknown"),
    (None, "unknown", "unknown"),
])
def test_status(spark, body, parity, corrected):
    df = spark.createDataFrame([(None if body is None else f"> Título I\n\n# Artículo 1\n\n{body}",)], "t string")
    assert tuple(df.select(temporal.status_of(F.col("t")), temporal.corrected_status(F.col("t"))).first()) == (parity, corrected)


def test_relocation(spark):
    df = spark.createDataFrame([(1, "Artículo reformado y recorrido (antes Artículo 118 Bis 1) DOF 11-12-2025")], "id long, t string")
    assert tuple(temporal.relocations_of(df, "id", "t").first()) == (1, "118 Bis 1", "11-12-2025")


def test_split_into_provisions(spark):
    raw = "Ley X\r\nArtículo 1o.- Uno.\r\nel artículo 9 sigue\nArtículo 2 Bis.- Dos.\nArtículo 353-Ñ\nTres\nTRANSITORIOS\nPrimero.- Vigor.\nVigésima Quinta. Otra\nPrimero que nada\nÚNICO\nFin"
    df = spark.createDataFrame([(1, raw), (2, None), (3, "sin artículos"), (4, "")], "id long, t string")
    got = [(r.id, r.pos, r.provision_type, r.number, r.body) for r in segment.split_provisions(df, "id", "t").orderBy("pos").collect()]
    assert got == [
        (1, 1, "article", "1o.", "Uno.\nel artículo 9 sigue"), (1, 2, "article", "2 Bis", "Dos."), (1, 3, "article", "353-Ñ", "Tres"),
        (1, 4, "transitory", "Primero", "Vigor."), (1, 5, "transitory", "Vigésima Quinta", "Otra\nPrimero que nada"), (1, 6, "transitory", "ÚNICO", "Fin")]


def test_furniture(spark):
    text = "Uno\n12 de 40\nCÁMARA DE DIPUTADOS del Congreso\nDos 3 de 4\n  - 7 -\nÚltima Reforma DOF 1-1-2000\n== Fin de página 9 ==\nTres"
    assert spark.createDataFrame([(text,)], "t string").select(segment.strip_furniture(F.col("t"))).first()[0] == "Uno\nDos 3 de 4\nTres"


def test_inline_annotations_and_narrated_reforms(spark):
    text = "# Artículo 3\n\nDe Zubel, S.A. de C.V. Fracción reformada, Fracción reformado DOF 02-08-1944, 24-02-1946. Reubicado DOF 1-3-1950\n\nPublicada en el DOF 3-4-1999 la ley\n\nReforma DOF 24-12-1996: Derogó del artículo el entonces párrafo"
    df = spark.createDataFrame([(1, text)], "id long, t string")
    got = [(r.pos, r.inline, r.scope, r.verb, r.raw_date) for r in temporal.events_of(df, "id", "t").orderBy("seq").collect()]
    assert got == [(3, True, "Fracción", "reformado", "02-08-1944"), (3, True, "Fracción", "reformado", "24-02-1946"), (3, True, "Fracción", "reubicado", "1-3-1950")]
    assert [(r.raw_date, r.event_date, r.verb, r.told) for r in temporal.narrative_reforms(df, "id", "t").collect()] == [("24-12-1996", datetime.date(1996, 12, 24), "derog", "Derogó del artículo el entonces párrafo")]


def test_long_labels_stay_whole(spark):
    label = "X" * 3000
    df = spark.createDataFrame([(f"> Título {label} · Capítulo I",)], "t string")
    assert df.select(segment.breadcrumb(F.col("t"))[0]["label"]).first()[0] == label
