import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from folioforge.operators import refs, relational, render
from folioforge.operators.components import connected_components
from folioforge.plans import catalogue
from folioforge.plans.relational import global_rank, percent_rank
from folioforge.runtime import bounded_broadcast
from folioforge.sources import files


@pytest.mark.parametrize("text,keys", [
    ("conforme al artículo 973 del código", ["973"]),
    ("los artículos 1923, 1924 y 1925", ["1923", "1924", "1925"]),
    ("artículos 1512 al 1519", ["1512", "1519"]),
    ("artículo 1,018", ["1018"]),
    ("artículo 8o. de esta ley", ["8"]),
    ("artículo 118 Bis 1", ["118-bis-1"]),
    ("los dos artículos anteriores", []),
])
def test_prose_references(spark, text, keys):
    df = spark.createDataFrame([(1, text), (2, None)], "id long, t string")
    assert [r.key for r in refs.prose_references(df, "id", "t").orderBy("pos").collect()] == keys


def test_a_reference_right_behind_another(spark):
    df = spark.createDataFrame([(1, "artículo 160 y II del artículo 161 de la Ley General")], "id long, t string")
    assert [(r.key, r.external) for r in refs.prose_references(df, "id", "t").orderBy("pos").collect()] == [("160", False), ("161", True)]


def test_other_norms_are_external(spark):
    df = spark.createDataFrame([(1, "artículo 177 de la Ley General de Sociedades"), (2, "artículo 177 del presente")], "id long, t string")
    assert {r.id: r.external for r in refs.prose_references(df, "id", "t").collect()} == {1: True, 2: False}


def test_headings_and_the_own_number_are_no_references(spark):
    text = "> Título I\n\n# Artículo 5\n\nEl artículo 5 y el [artículo 7](articulo-7.md) del mismo.\n\nartículo 5 de la Ley General"
    df = spark.createDataFrame([(1, text, "5"), (2, text, None)], "id long, t string, own string")
    got = [(r.id, r.key, r.external) for r in refs.prose_references(df, "id", "t", "own").orderBy("id", "pos").collect()]
    assert got == [(1, "7", False), (1, "5", True), (2, "5", False), (2, "7", False), (2, "5", True)]


def test_ranges(spark):
    df = spark.createDataFrame([(1, "artículos 3 al 5, 9 y 11 a 200; artículos 8 a 2; artículos 1 al 3 de la Ley General")], "id long, t string")
    found = refs.prose_references(df, "id", "t")
    assert [(r.key, r.range_end) for r in found.orderBy("pos").collect()] == [("3", False), ("5", True), ("9", False), ("11", False), ("200", True), ("8", False), ("2", True), ("1", False), ("3", True)]
    spans = refs.reference_ranges(found, "id")
    assert {(r.low, r.high) for r in spans.collect()} == {(3, 5), (11, 200)}
    articles = spark.createDataFrame([("i", n, f"a{n}") for n in (2, 3, 5, 6, 12, 63, 64, 128, 200, 201)] + [("j", 4, "b4"), ("i", None, "x")], "g string, n int, a string")
    got = {r.a for r in refs.expand_ranges(spans.withColumn("g", F.lit("i")), articles, ["g"]).collect()}
    assert got == {"a3", "a5", "a12", "a63", "a64", "a128", "a200"}
    wide = spark.createDataFrame([("i", 3, 999_999_999), ("k", 1, 5)], "g string, low int, high int")
    assert refs.expand_ranges(wide, articles, ["g"]).count() == 9


def test_relative_references_and_missed_tails(spark):
    text = "# Artículo anterior\n\nEl artículo anterior y el ARTÍCULO SIGUIENTE; los artículos anteriores, el artículo precedente y el 87- I, no el 87-I."
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id long, t string")
    assert [(r.id, r.pos, r.label) for r in refs.relative_references(df, "id", "t").orderBy("pos").collect()] == [(1, 1, "anterior"), (1, 2, "siguiente")]
    assert [(r.id, r.number) for r in refs.missed_tails(df, "id", "t").collect()] == [(1, "87- I")]


def test_neighbours_across_ranges(spark):
    rng = __import__("random").Random(9)
    rows = [("a" if rng.random() < 0.7 else rng.choice("bc"), rng.randrange(40), i) for i in range(300)] + [("d", 1, 999)]
    df = spark.createDataFrame(rows, "g string, o int, id long")
    got = {r.id: (r.previous_id, r.next_id) for r in refs.neighbours(df.repartition(5), ["g"], "o", "id").collect()}
    want = {}
    for g in "abcd":
        ids = [i for _, _, i in sorted((x for x in rows if x[0] == g), key=lambda x: x[1:])]
        want |= {i: (ids[k - 1] if k else None, ids[k + 1] if k + 1 < len(ids) else None) for k, i in enumerate(ids)}
    assert got == want


def test_cross_references_by_name_alias_and_term(spark):
    texts = ["artículo 8 de la Ley de Aguas y Bosques, y artículo 9 de la LAB.", "artículo 7 de la Ley de Aguas", "artículo 3 de la Ley.", "artículo 4 de la Ley Minera; artículo 2 del presente"]
    df = spark.createDataFrame([(i, "x" if i < 3 else "y", t) for i, t in enumerate(texts)], "id long, instrument_id string, t string")
    names = spark.createDataFrame([("Ley de Aguas", "agua", None), ("Ley de Aguas y Bosques", "bosque", None), ("lab", "bosque", None), ("Ley", "minas", "x"), (None, "nada", None)], "name string, target string, owner string")
    found = refs.prose_references(df.withColumn("k", F.struct("id", "instrument_id")), "k", "t").select("k.id", "k.instrument_id", "pos", "key", "external", "tail")
    got = {(r.id, r.key): r.target_instrument for r in refs.cross_references(found, names).collect()}
    assert got == {(0, "8"): "bosque", (1, "7"): "agua", (2, "3"): "minas", (3, "4"): None}


def test_defined_terms_and_variants(spark):
    text = "# Artículo 2\n\nPara esta Ley se entenderá por:\n\nI. Ley: la Ley de Aguas;\n\nII.- Tribunal Agrario: el [tribunal](x.md) que resuelve, y\n\na) Voz: otra"
    df = spark.createDataFrame([(1, text), (2, "I. Ley: no define"), (3, None)], "id long, t string")
    assert [(r.id, r.term, r.definition) for r in refs.defined_terms(df, "id", "t").collect()] == [(1, "Ley", "la Ley de Aguas;"), (1, "Tribunal Agrario", "el tribunal que resuelve, y"), (1, "Voz", "otra")]
    words = ["Tribunal", "Tribunales", "Institución de Crédito", "Voz", "Leyes", "Unidad", "Bienes"]
    got = spark.createDataFrame([(w,) for w in words], "t string").select(refs.number_variants(F.col("t")).alias("v")).collect()
    assert [r.v[1:] for r in got] == [["Tribunales"], ["Tribunal"], ["Instituciones de Crédito"], ["Voces"], ["Leye"], ["Unidades"], ["Bien"]]


def test_terms_inside_proper_names(spark):
    texts = spark.createDataFrame([(1, "La Ley Federal de Aguas manda. El Código de la Ley Federal de Aguas y la Ley."), (2, "Ley Federal de Aguas")], "id long, t string")
    terms, names = spark.createDataFrame([("Ley",), ("Aguas",)], "term string"), spark.createDataFrame([("Ley Federal de Aguas",), (None,)], "term string")
    assert {(r.id, r.term, r.start_pos) for r in refs.term_matches(texts, "id", "t", terms, later=True, masks=names).collect()} == {(1, "Ley", 73)}


def test_chains_of_any_length(spark):
    edges = [(i, i + 1) for i in range(37)] + [(100, 101), (101, 102), (102, 100), (103, 100), (5, 90), (None, 1), (7, None)]
    got = {r.root: (r.last, r.steps) for r in relational.follow_chains(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: (37, 37 - i) for i in range(37)} | {i: (None, None) for i in (100, 101, 102, 103)}
    assert relational.follow_chains(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_command_line(spark, tmp_path, capsys):
    from folioforge.__main__ import main

    assert main([]) == 0 and "provision_status" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["no_such_query", "--data", "x"])


def test_terms_first_and_longest(spark):
    texts = spark.createDataFrame([(1, "La Ley Marco rige. La Ley y la Ley Marco."), (2, None), (3, "leyes")], "id long, t string")
    terms = spark.createDataFrame([("Ley",), ("Ley Marco",), ("Ley",)], "term string")
    assert {(r.id, r.term, r.start_pos) for r in refs.term_matches(texts, "id", "t", terms).collect()} == {(1, "Ley Marco", 3)}


def test_terms_of_any_length_at_their_own_places(spark):
    texts = spark.createDataFrame([(1, "Leyes: el Manual de Uniformes y Equipo, la Ley Marco y la Ley."), (2, "Ley Marco"), (3, "")], "id long, t string")
    terms = spark.createDataFrame([("Ley",), ("Ley Marco",), ("Manual de Uniformes y Equipo",), (None,)], "term string")
    want = {(1, "Manual de Uniformes y Equipo", 10), (1, "Ley Marco", 43), (1, "Ley", 58), (2, "Ley Marco", 0)}
    assert {(r.id, r.term, r.start_pos) for r in refs.term_matches(texts, "id", "t", terms, later=True).collect()} == want


def test_rewrite_spans(spark):
    df = spark.createDataFrame([("véase 12 y 13.", [(11, 13, "b.md"), (6, 8, "a.md")])], "t string, s array<struct<start int, end int, target string>>")
    assert df.select(refs.rewrite_spans(F.col("t"), F.col("s"))).first()[0] == "véase [12](a.md) y [13](b.md)."


def test_record_round_trip(spark, tmp_path):
    row = ("urn:a", "urn", "A", "Ley de X", "article", "9o", ["A — Artículo 9o"], True, "unknown", "not_analyzed", None, "https://h/x.pdf", "ab", "# Artículo 9o\n\nTexto.")
    df = spark.createDataFrame([row], "id string, instrument_id string, instrument string, name string, provision_type string, number string, aliases array<string>, generated boolean, temporal_status string, review_status string, amendment_marks array<int>, source_url string, source_sha256 string, body string")
    out = df.select("instrument", render.record(F.col("body")).alias("record"))
    text = out.first()["record"]
    assert text.startswith('---\nid: urn:a\n') and "amendment_marks" not in text and text.endswith("Texto.\n")
    m = out.select(render.parse_frontmatter(F.col("record"))).first()[0]
    assert m["number"] == "9o" and m["name"] == "Ley de X" and len(m) == 12
    render.write_records(out, f"file://{tmp_path}/r")
    assert render.read_records(spark, f"file://{tmp_path}/r").first()["record"] == text


def test_a_file_for_each_record(spark, tmp_path):
    rows = [("a", "articulo-1", "uno\r\n"), ("a", "articulo-2", "dos"), ("b", "articulo-1", ""), ("b", None, "x"), ("b", "y", None)]
    df = spark.createDataFrame(rows, "instrument string, file_name string, record string")
    assert render.write_record_files(df, f"file://{tmp_path}/out") == 3 == render.write_record_files(df, f"file://{tmp_path}/out")
    assert sorted(str(p.relative_to(tmp_path / "out")) for p in (tmp_path / "out").rglob("*") if p.is_file()) == ["a/markdown/articulo-1.md", "a/markdown/articulo-2.md", "b/markdown/articulo-1.md"]
    assert (tmp_path / "out/a/markdown/articulo-1.md").read_bytes() == b"uno\r\n"
    with pytest.raises(ValueError):
        render.write_record_files(df, "s3://x/y")


def test_percent_rank(spark):
    rows = [(i, "ab"[i % 2] if i else None, (i * 7) % 5) for i in range(41)] + [(99, "z", 1)]
    df = spark.createDataFrame(rows, "k long, g string, v int")
    w = Window.partitionBy("g").orderBy("v")
    want = {r.k: r.s for r in df.select("k", F.round(F.percent_rank().over(w), 9).alias("s")).collect()}
    assert {r.k: r.share for r in percent_rank(df, "g", "v", "k").collect()} == want


def test_broadcast_is_bounded_by_bytes_too(spark):
    df = spark.createDataFrame([("x" * 1000, 1)] * 20, "a string, b int")
    hinted = lambda x: "broadcast" in x._jdf.queryExecution().logical().toString().lower()
    assert hinted(bounded_broadcast(df)) and not hinted(bounded_broadcast(df, octets=10_000)) and not hinted(bounded_broadcast(df, limit=19))
    assert hinted(bounded_broadcast(df.where("b > 1")))


def test_formats_and_quarantine(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x long, y string")
    for kind in ("parquet", "orc", "json", "csv"):
        files.save(df, f"file://{tmp_path}/{kind}", kind)
        assert files.load(spark, f"file://{tmp_path}/{kind}", kind, "x long, y string").count() == 2
    good, bad = files.quarantine(df, {"y": F.col("y") == "a"})
    assert [r.x for r in good.collect()] == [1] and [(r.x, r.errors) for r in bad.collect()] == [(2, ["y"])]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.md").write_text("uno\ndos")
    assert files.walk(spark, f"file://{tmp_path}/w/*.md").first()["text"] == "uno\ndos"


def test_asof_ties_and_strictness(spark):
    a = spark.createDataFrame([(1, 10), (2, 5)], "k int, t int").select(F.lit("u").alias("u"), "t", F.col("k").alias("id"))
    b = spark.createDataFrame([("u", 5, 1.0), ("u", 10, 2.0)], "u string, t int, v double")
    get = lambda s: {r.id: r.asof_value for r in relational.asof_join(a, b, ["u"], "t", "v", s).collect()}
    assert get(True) == {1: 1.0, 2: None} and get(False) == {1: 2.0, 2: 1.0}


def test_interval_join(spark):
    p = spark.range(0, 50).withColumnRenamed("id", "x")
    i = spark.createDataFrame([("a", 3, 17), ("b", 16, 18), ("c", 5, 5)], "n string, lo long, hi long")
    got = {(r.x, r.n) for r in relational.interval_join(p, i, "x", "lo", "hi", 7).collect()}
    assert got == {(x, "a") for x in range(3, 17)} | {(16, "b"), (17, "b")}


def test_components(spark):
    import random

    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_global_rank(spark):
    df = spark.createDataFrame([((i * 37) % 101, i) for i in range(101)], "a int, b int")
    assert [r.position for r in global_rank(df, ["a", "b"]).orderBy("a", "b").collect()] == list(range(101))


def test_every_query_has_sql_or_a_reason():
    without = {"lineage_origins", "cross_references_by_term", "term_links"}
    assert set(catalogue.QUERIES) - set(catalogue.ORACLES) == without
