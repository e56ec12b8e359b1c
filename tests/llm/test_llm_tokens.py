import os

import pytest

from folioforge.llm import bpe
from folioforge.llm.encode import decode_column, encode_column
from folioforge.llm.token_budget import count_tokens, one_language, one_spelling, token_budget
from pyspark.sql import functions as F

pytestmark = pytest.mark.skipif(not os.path.isdir(bpe.DEFAULT_DIR), reason="no vocabulary files")

TEXTS = ["", None, "Hola mundo", "it's  don't\n\n x ", "<|endoftext|>", "漢字かな", "ผู้เช่า", "करेगा।", "🙂👍🏽", "a" * 5000, " \t\n", "\x00\x01", "é é", "1234 ½ ²", "_¿¡"]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{bpe.DEFAULT_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids if x else []


@pytest.mark.parametrize("name", ["byte_bpe_50k", "byte_bpe_50k.json"])
def test_encoder_equals_the_public_one(reference, name):
    e = bpe.Encoder(bpe.vocabulary_path(name))
    assert e.encode_batch(TEXTS) == [reference(t) for t in TEXTS]
    assert [e.decode(i) for i in e.encode_batch(TEXTS)] == [t or "" for t in TEXTS]


def test_columns(spark, reference):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)] + [(2, "Hola mundo", "c")], "doc_id long, text string, ids string")
    ids = encode_column(df, "doc_id", "text")
    rows = ids.collect()
    assert len(rows) == len(TEXTS) + 1 and all(list(r.ids) == reference(TEXTS[r.doc_id]) for r in rows)
    assert {r.doc_id: r.text for r in decode_column(ids, "doc_id", "ids").collect()} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert encode_column(df.where("doc_id > 99"), "doc_id", "text").count() == 0


def test_memory_may_overflow(monkeypatch, reference):
    monkeypatch.setattr(bpe, "MEMORY", 3)
    e = bpe.Encoder(bpe.vocabulary_path("byte_bpe_50k"))
    for _ in range(3):
        assert e.encode_batch(TEXTS) == [reference(t) for t in TEXTS]


def test_symbol_counts(reference):
    ranks = bpe.read_ranks(bpe.vocabulary_path("byte_bpe_50k"))
    for t in TEXTS:
        assert sum(bpe.count_symbols(p.encode(), ranks) for p in bpe.pre_token_pattern().findall(t or "")) == len(reference(t))


def test_budget(spark, reference):
    rows = [(1, "Hola mundo", "ES ", "a_b", None), (2, "Adiós", "es-MX", "A-B", "d"), (3, None, None, None, "d"), (4, "", "fr", "a b", None)]
    df = spark.createDataFrame(rows, "row_id long, markdown string, lang string, provider string, domain string")
    df = df.withColumn("lang", one_language(F.col("lang"))).withColumn("provider", one_spelling(F.col("provider")))
    got = {(r["slice"], r.provider, r.lang, r.domain): (r.n_rows, r.n_tokens) for r in token_budget(df, "markdown", ["provider", "lang", "domain"]).collect()}
    n = {r[0]: len(reference(r[1])) for r in rows}
    assert got[("all", None, None, None)] == (4, sum(n.values()))
    assert got[("lang", None, "es", None)] == (2, n[1] + n[2]) and got[("lang", None, None, None)] == (1, 0)
    assert got[("provider", "a_b", None, None)] == (3, n[1] + n[2]) and got[("provider", None, None, None)] == (1, 0)
    assert got[("provider+lang+domain", "a_b", "es", None)] == (1, n[1]) and len(got) == 4 + 2 + 3 + 2 + 1
    assert {r.row_id: r.n_tokens for r in count_tokens(df, "markdown", ["row_id"]).collect()} == n
    assert token_budget(df.where("row_id > 9"), "markdown", ["lang"]).where("slice <> 'all'").count() == 0
