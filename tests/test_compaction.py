import os

import pytest

from folioforge.operators import compaction as C

A = "---\nid: urn:a\nname: \"Á\"\n---\n\n# Artículo 1\n\nTexto.\n"
SAME = ["﻿" + A, A.replace("\n", "\r\n"), A.replace("Á", "Á"), A.replace("Texto.", "Texto.  "), A + "\n\n", "---\nname: \"Á\"\nid: urn:a\n---\n\n# Artículo 1\n\nTexto.\n"]
SCHEMA = "file_id long, path string, file_name string, markdown string, size_bytes long, whole string"


def rows(texts, start=1):
    return [(i, f"p{i}", "f", t, None, "clash") for i, t in enumerate(texts, start)]


@pytest.mark.parametrize("text", SAME)
def test_same_record(text):
    assert C.canonical_record(text) == C.canonical_record(A)


@pytest.mark.parametrize("text", [A.replace("Texto", "texto"), A.replace("urn:a", "urn:b"), A.replace("\n\n#", "\n\n\n#"), "Texto"])
def test_other_record(text):
    assert C.canonical_record(text) != C.canonical_record(A)


def test_compaction(spark, tmp_path):
    long = "---\nid: urn:long\n---\n" + "x" * 300_000
    data = rows([A, *SAME, long, "", "", "cuerpo"]) + [(50, "p", "f", "roto", 100, "c"), (51, "p", "f", None, None, "c"), (52, "p", "f", "justo", 5, "c")]
    out = f"file://{tmp_path}/out"
    report = C.compact_files(spark.createDataFrame(data, SCHEMA), out, 100_000)
    kept = spark.read.parquet(out)
    assert {r.file_id for r in kept.collect()} == {1, 8, 9, 11, 52} and kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert (report["files_in"], report["broken"], report["repeated"], report["kept"]) == (14, 2, 7, 5)
    again = C.compact_files(spark.createDataFrame(rows(["otro"]), SCHEMA), out, 100_000)  # swapped, not added
    assert again["kept"] == 1 and [r.markdown for r in spark.read.parquet(out).collect()] == ["otro"]


def test_files_are_sorted_and_sized(spark, tmp_path):
    texts = [f"---\nid: urn:{i % 7}\n---\n{i} " + "y" * 1000 for i in range(400)]  # a hot key is cut at file ids
    out = f"{tmp_path}/out"
    report = C.compact_files(spark.createDataFrame(rows(texts), SCHEMA), f"file://{out}", 50_000)
    assert report["kept"] == 400 and 6 <= report["files_out"] <= 10
    parts = [p for p in os.listdir(out) if p.endswith(".parquet")]
    assert len(parts) == report["files_out"]
    sizes = [spark.read.parquet(f"file://{out}/{p}").count() for p in parts]
    assert sum(sizes) == 400 and max(sizes) < 2.5 * 400 / len(parts)


def test_empty_table(spark, tmp_path):
    report = C.compact_files(spark.createDataFrame([], SCHEMA), f"file://{tmp_path}/out", 1000)
    assert report["kept"] == 0 and spark.read.schema(SCHEMA).parquet(f"file://{tmp_path}/out").count() == 0


def test_mismatch_leaves_the_old_folder(spark, tmp_path, monkeypatch):
    out = f"file://{tmp_path}/out"
    C.compact_files(spark.createDataFrame(rows(["uno"]), SCHEMA), out, 1000)
    monkeypatch.setattr(C, "range_boundaries", lambda kept, target: ([], (5, 5, 5)))
    with pytest.raises(RuntimeError):
        C.compact_files(spark.createDataFrame(rows(["dos"]), SCHEMA), out, 1000)
    assert spark.read.parquet(out).first()["markdown"] == "uno"


def test_swapped_texts_are_noticed(spark, tmp_path, monkeypatch):
    """Equal counts and bytes, but two texts under each other's id."""
    out = f"file://{tmp_path}/out"
    C.compact_files(spark.createDataFrame(rows(["uno", "dos"]), SCHEMA), out, 1000)
    write = C._written
    other = C.F.when(C.F.col("markdown") == "tres", "seis").when(C.F.col("markdown") == "seis", "tres").otherwise(C.F.col("markdown"))
    monkeypatch.setattr(C, "_written", lambda df, path: write(df.withColumn("markdown", other), path))
    with pytest.raises(RuntimeError):
        C.compact_files(spark.createDataFrame(rows(["tres", "seis"], 2), SCHEMA), out, 1000)
    assert {r.markdown for r in spark.read.parquet(out).collect()} == {"uno", "dos"}


def test_null_and_repeated_ids(spark, tmp_path):
    row = lambda i, t, p="p": (i, p, "f", t, None, "c")
    data = [row(None, "sin id"), row(None, "otro sin id"), row(None, "con id"), row(4, "con id"), row(5, "uno"), row(5, "dos"), row(6, "igual"), row(6, "igual"), row(6, "igual", "q")]
    report = C.compact_files(spark.createDataFrame(data, SCHEMA), f"file://{tmp_path}/out", 1000)
    got = sorted((r.file_id or 0, r.markdown) for r in spark.read.parquet(f"file://{tmp_path}/out").collect())
    assert got == [(0, "otro sin id"), (0, "sin id"), (4, "con id"), (5, "dos"), (5, "uno"), (6, "igual")]
    assert (report["files_in"], report["kept"], report["repeated"]) == (9, 6, 3)


def test_ranges_beyond_the_bound_are_cut_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "MOST_RANGES", 3)
    texts = [f"---\nid: urn:{i % 5}\n---\n{i} " + "y" * 1000 for i in range(300)]
    out = f"{tmp_path}/out"
    report = C.compact_files(spark.createDataFrame(rows(texts), SCHEMA), f"file://{out}", 25_000)
    parts = [p for p in os.listdir(out) if p.endswith(".parquet")]
    sizes = [spark.read.parquet(f"file://{out}/{p}").count() for p in parts]
    assert report["kept"] == sum(sizes) == 300 and 9 <= len(parts) == report["files_out"] <= 15 and max(sizes) < 45


def test_pointer(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    for text in ("uno", "dos"):
        C.compact_files(spark.createDataFrame(rows([text]), SCHEMA), out, 1000, pointer=True)
        assert [r.markdown for r in C.read_compacted(spark, out).collect()] == [text]
