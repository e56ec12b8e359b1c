import random

import pytest
from pyspark.sql import functions as F

from folioforge.llm import pii
from folioforge.llm.chunks import split_oversized
from folioforge.llm.sentences import sentence_units, sentences

CASES = [
    ("El art. 5 rige. La Junta, S.A. de C.V. El perito vino.", ["El art. 5 rige.", "La Junta, S.A. de C.V.", "El perito vino."]),
    ("> Título I\n\n# Artículo 1o.\n\nTexto.", ["> Título I", "# Artículo 1o.", "Texto."]),
    ("I.- Uno; y II. Dos. Tres", ["I.- Uno; y II. Dos.", "Tres"]),
    ("Dirá: «Uno. Dos.» y se agregará. Fin", ["Dirá: «Uno. Dos.» y se agregará.", "Fin"]),
    ("Dijo: “Me obligo.” El perito vino.", ["Dijo: “Me obligo.”", "El perito vino."]),
    ("(Uno no obstan.) Dos", ["(Uno no obstan.)", "Dos"]),
    ("¿Procede? La Junta, etc. 5 días bastan", ["¿Procede?", "La Junta, etc.", "5 días bastan"]),
    ("Vale 3.5 o 08.12.2014 según el D.O.F. del lunes… y más.", ["Vale 3.5 o 08.12.2014 según el D.O.F. del lunes… y más."]),
    ("Cada mes.Cuando llueva. Ver [5](articulo-5.md). Fin", ["Cada mes.", "Cuando llueva.", "Ver [5](articulo-5.md).", "Fin"]),
    ("并声明：「甲。乙。」后存入。每季度审查！", ["并声明：「甲。乙。」后存入。", "每季度审查！"]),
    ("करेगा। रु. 3.6 की दर पर करेगा?", ["करेगा।", "रु. 3.6 की दर पर करेगा?"]),
    ("ผู้เช่าต้อง ผู้ตรวจ 5 วัน", ["ผู้เช่าต้อง", "ผู้ตรวจ 5 วัน"]),
    ("El Lic. B. Arconemira y el C. Tarrugo firman. Fin", ["El Lic. B. Arconemira y el C. Tarrugo firman.", "Fin"]),
    ("", []), (" \n\t", []), (None, []), ("“sin cierre. Otra", ["“sin cierre.", "Otra"]), ("\r\nUno\rDos Tres", ["Uno", "Dos", "Tres"]),
]


@pytest.mark.parametrize("text,want", CASES)
def test_units(text, want):
    assert [text[a:b] for a, b in sentence_units(text)] == want


@pytest.mark.parametrize("text,lang,n", [
    ("Dijo que no. Luego salió de la sala.", None, 2), ("Dijo que no. Luego salió de la sala.", "es-MX", 2), ("I said no. Then he left.", " EN", 2), ("This is art. Then we left.", "en", 2),
    ("Véase el art. 5 y el No. XX del anexo.", "es", 1), ("See no. 7 and art. V here.", "en", 1),
    ("Cruzó el mar. Después volvió.", "es", 2), ("On Mar. 5 he left.", "en", 1), ("Er kam bzw. Sie ging.", "de", 1), ("Er kam bzw. Sie ging.", "es", 2), ("Er kam bzw. Sie ging.", "xx", 1),
    ("ខ្ញុំទៅផ្ទះ។ នាងមក។", None, 2), ("မြန်မာ။ စာ။", None, 2), ("ᬅᬓ᭞ ᬅᬓ᭟ ᬅ", None, 3), ("今日は。明日は！", "ja", 2),
])
def test_units_by_language_and_script(text, lang, n):
    assert len(sentence_units(text, lang)) == n


def test_every_terminator_of_the_property_ends_a_unit():
    import regex

    found = [c for c in map(chr, range(0x80, 0x20000)) if regex.fullmatch(r"\p{Sentence_Break=STerm}", c)]
    assert len(found) > 150 and all(len(sentence_units(f"ཀཁག{c} ཀཁག")) == 2 for c in found)


def test_a_very_long_text_is_cut_in_linear_time(spark):
    text = ("Una frase corta. " * 9 + "\n") * 40_000
    df = spark.createDataFrame([(1, text)], "id long, t string")
    got = split_oversized(df, "id", "t").collect()
    assert max(r.end_pos for r in got) == len(text) and [(r.start_pos, r.end_pos) for r in sorted(got, key=lambda r: r.piece_no)[:15]] == pieces(text[:30_000], 1500, 200)[:15]


def test_units_cover_all_but_white_space():
    rng = random.Random(1)
    for _ in range(300):
        t = "".join(rng.choice(["a", "B", ". ", "?", "\n", "«", "»", '"', " ", "1", "。", ")", "(", "etc. ", "S.A. ", "\xa0"]) for _ in range(60))
        at = 0
        for a, b in sentence_units(t):
            assert at <= a < b and not t[at:a].strip() and t[a:b] == t[a:b].strip()
            at = b
        assert not t[at:].strip()


def test_sentences_of_a_table(spark):
    df = spark.createDataFrame([(1, "Uno. Dos.", "x"), (1, "Uno. Dos.", "x"), (2, None, "x"), (3, "", "x")], "id long, t string, row_id string")
    assert sorted(tuple(r) for r in sentences(df, "id", "t").collect()) == [(1, 0, 4), (1, 0, 4), (1, 5, 9), (1, 5, 9)]


def pieces(t, limit, overlap):
    ws, ends, out, s = set(" \t\n\r\xa0"), [b for _, b in sentence_units(t)], [], 0
    while len(t) - s > limit:
        spots = range(s + limit, s + limit // 2, -1)
        e = next((x for x in spots if x < len(t) and t[x] == "\n" and t[x - 1] != "\n"), None)
        e = e or next((x for x in spots if x in ends), None)
        e = e or next((x for x in spots if x < len(t) and t[x] in ws and t[x - 1] not in ws), None) or s + limit
        out.append((s, e))
        s = next((q for q in range(e - overlap, e) if t[q] not in ws and t[q - 1] in ws), e - overlap)
    return [*out, (s, len(t))]


@pytest.mark.parametrize("limit,overlap", [(100, 20), (1500, 200)])
def test_pieces(spark, limit, overlap):
    rng = random.Random(limit)
    words = ["palabra", "de", "😀", "la", "etc.", "S.A. de C.V.", "Fin. ", "\n", "\n\n", "\xa0x", "漢字" * 9, "y" * 40]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 900))), "c") for i in range(25)]
    rows += [(90, "z" * (3 * limit + 7), "c"), (91, " " * (2 * limit), "c"), (92, None, "c"), (93, "", "c"), (94, "a" * limit, "c"), (95, "a b " * 30_000, "c")]
    got = {}
    for r in split_oversized(spark.createDataFrame(rows, "id long, t string, row_id string"), "id", "t", limit, overlap).collect():
        got.setdefault(r.row_id, {})[r.piece_no] = (r.start_pos, r.end_pos)
    want = {i: dict(enumerate(pieces(t, limit, overlap))) for i, t, _ in rows if t and len(t) > limit}
    assert got == want


def test_pieces_of_nothing(spark):
    assert split_oversized(spark.createDataFrame([], "id long, t string"), "id", "t").count() == 0
    with pytest.raises(ValueError):
        split_oversized(spark.createDataFrame([], "id long, t string"), "id", "t", 100, 50)


MENTIONS = [
    ("Dudas: diego_temanera19 (arroba) brivas (punto) example (punto) org / tel. 55.11.06.7687 ext. 617", [("email", "diego_temanera19 (arroba) brivas (punto) example (punto) org"), ("phone", "55.11.06.7687")]),
    ("Compareció la Ing. Fulvino Osvino Valdemira Tarroquio, con domicilio en Cerrada Falpalcor Lembricru, núm. 1711, teléfono 00528113867562.", [("name", "Fulvino Osvino Valdemira Tarroquio"), ("address", "Cerrada Falpalcor Lembricru, núm. 1711"), ("phone", "00528113867562")]),
    ("Declara Arconilcoz Brenirón, Ilduara que es titular de la cuenta vinculada a su NSS 01-98-50-5754-1.", [("name", "Arconilcoz Brenirón, Ilduara"), ("id_number", "01-98-50-5754-1")]),
    ("Testigos: Inés Calbrás Orteemira, Julia Valdbrás de Rebolilcoz y Pedro Orteostra Temiron.", [("name", "Inés Calbrás Orteemira"), ("name", "Julia Valdbrás de Rebolilcoz"), ("name", "Pedro Orteostra Temiron")]),
    ("Filed by Farrin G. Rebolanera, residing at 1430 Dolnavbra Street, who", [("name", "Farrin G. Rebolanera"), ("address", "1430 Dolnavbra Street")]),
    ("demeurant 741 bis rue de Orovelide, tél. 753 084 1274.", [("address", "741 bis rue de Orovelide"), ("phone", "753 084 1274")]),
    ("联系方式：saul_brenariz [at] vasbri.test，33.14.66.6128。", [("email", "saul_brenariz [at] vasbri.test"), ("phone", "33.14.66.6128")]),
    ("La sociedad Monmislun Belpalsut, S.A. de C.V., clave fiscal BBE048349A1, queda inscrita.", []),
    ("Expediente 7172-4299/2018, folio 0038678833. Importe: $46,087,418.00 (clave presupuestal 79-118-3197-5).", []),
    ("Menciónese @lunbriver en el foro; versión 10.9.1.18. La calle de Tarmisros cambia de nombre a partir del 01-02-1964.", []),
    ("CURP: LCBV-761004-HXXPBL-81; domicilio: C. de los Estibadores, No. 133-B; pasaporte G90743826", [("id_number", "LCBV-761004-HXXPBL-81"), ("address", "C. de los Estibadores, No. 133-B"), ("id_number", "G90743826")]),
    (None, []), ("", []), ("   ", []),
]


@pytest.mark.parametrize("text,want", MENTIONS)
def test_mentions(text, want):
    assert [(k, text[a:b]) for a, b, k in pii.find_mentions(text)] == want


@pytest.mark.parametrize("text,want", [
    ("Ayer llegó María García al juzgado.", ["María García"]),
    ("Then John Smith left.", ["John Smith"]),
    ("Declara García, Juan que es titular.", ["García, Juan"]),
    ("Declara García López, Juan que es titular.", ["García López, Juan"]),
    ("Declara Juan García, Director General.", ["Juan García"]),
    ("La Ley Federal del Trabajo rige en San José.", []),
])
def test_names_whose_surnames_are_in_no_list(text, want):
    assert [text[a:b] for a, b, k in pii.find_mentions(text) if k == "name"] == want


@pytest.mark.parametrize("text,want", [
    ("firma don Zoilo Tarro, Notario 5", ["Zoilo Tarro"]), ("Declara Zoilo Tarro, Eulalio Calbo y Cástulo Sol.", ["Zoilo Tarro"]), ("Declara Zoilo Tarro, Inés Calbo y Ana Sol.", ["Zoilo Tarro", "Inés Calbo", "Ana Sol"]),
    ("Declara Wojtyla Kowalska, Zofia que es titular", ["Wojtyla Kowalska, Zofia"]), ("Nombre: Ferreiro Quintas, Uxía; RFC", ["Ferreiro Quintas, Uxía"]),
    ("Atentamente\nFerreiro Quintas, Uxía Noa\nTel: 5", ["Ferreiro Quintas, Uxía Noa"]), ("firma el suscrito Ferreiro Quintas, Uxía, CURP ZSBO440205MXXSVI99.", ["Ferreiro Quintas, Uxía"]),
])
def test_inverted_names_with_any_surnames(text, want):
    assert [text[a:b] for a, b, k in pii.find_mentions(text) if k == "name"] == want


def test_dates_and_check_signs():
    assert pii.find_mentions("ABCD900230HDFRRN04 x") == [] and pii.find_mentions("ABCD000229HDFRRN04 x") != []
    right = [p + pii.check_sign(p + "0") for p in ("GODE561231HDFRRN0", "ABCD000229AB", "9291908431")]
    wrong = [v[:-1] + str((int(v[-1]) + 1) % 10) if v[-1].isdigit() else v[:-1] + "0" for v in right]
    assert all(map(pii.is_checked, right)) and not any(map(pii.is_checked, wrong)) and pii.is_checked("x1") is None
    assert pii.check_sign("92919084311") == "6" and pii.is_checked("9291-90-8431-6")  # digit by the doubling rule
    for v in [*right, *wrong, "ABCD991399HDFRRN04", "ABCD561231HDFRRNA4", "ABCD561231AAA"]:
        for key in (b"k", b"other"):
            p = pii.pseudonym(v, key)
            assert pii.is_checked(p) == pii.is_checked(v) and pii.pseudonym(p, key, back=True) == v


def test_pseudonyms_link_documents(spark):
    docs = [(i, f"Tel: 55 1517 77{i % 3}4; NSS 01-98-50-5754-{i % 2}", "c") for i in range(12)]
    rows = pii.personal_mentions(spark.createDataFrame(docs, "doc_id long, text string, value string"), b"k").collect()
    by = {(r.kind, r.value): {x.placeholder for x in rows if (x.kind, x.value) == (r.kind, r.value)} for r in rows}
    assert len(by) == 5 and all(len(v) == 1 for v in by.values()) and len(set.union(*by.values())) == 5


def test_many_mentions_in_one_text():
    text = "\n".join(f"Tel: 55 1517 {i:04}, correo a{i}@b.example" for i in range(5000))
    assert len(pii.find_mentions(text)) == 10_000


@pytest.mark.parametrize("value", ["ISVG661027AA2", "LCBV-761004-HXXPBL-81", "+52 81 0012 2313", "02-54-59-4748-5", "K57737537", "x", ""])
def test_pseudonyms(value):
    key = b"k" * 16
    p = pii.pseudonym(value, key)
    shape = lambda s: "".join("9" if c.isdigit() else "A" if c.isupper() else c for c in s)
    assert shape(p) == shape(value) and pii.pseudonym(p, key, back=True) == value
    assert len(value) < 4 or pii.pseudonym(value, b"z" * 16) != p


def test_feistel_is_a_permutation():
    net = pii.Feistel(b"k", 97)
    assert sorted(net.permute(i) for i in range(97)) == list(range(97))


def test_redaction(spark):
    text = "Tel: 55 1517 7744\nTel: 55 1517 7744\nFin 🙂"
    df = spark.createDataFrame([(1, text, "c"), (2, None, "c"), (3, "", "c")], "doc_id long, text string, kind string")
    got = {r.doc_id: r.text for r in pii.redacted_texts(df, b"k").collect()}
    token = pii.placeholder("55 1517 7744", "phone", b"k")
    assert got == {1: f"Tel: {token}\nTel: {token}\nFin 🙂", 2: None, 3: ""} and token.startswith("[PHONE:")
    assert [(r.kind, r.value) for r in pii.personal_mentions(df, b"k").select("kind", "value").distinct().collect()] == [("phone", "55 1517 7744")]
    assert pii.personal_mentions(df.where("doc_id > 5"), b"k").count() == 0
