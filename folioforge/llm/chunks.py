"""Cutting long texts into overlapping pieces at natural boundaries.

A text becomes a row of marks, one letter a character: `L` a line feed behind another character, `U` an end of a sentence
unit, `S` white space behind another character, `W` a character behind white space, `.` any other. On the JVM, one
bounded-quantifier pattern with its alternatives in the order of strength consumes marks up to the limit, `.{n}` last, and
a lookback pattern finds the first `W` of the overlap. The pieces are an array that `aggregate` builds, in blocks of about
the square root of their number; marks are kept in cells of the limit's size, so that a step costs no more in a long text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.sentences import language, sentence_units

SPACE = np.array([0x20, 0x09, 0x0A, 0x0D, 0xA0], np.uint32)


def boundary_marks(text: str, lang: str | None) -> str:
    """The marks of a text, the strongest where several hold."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = np.isin(points, SPACE)
    marks = np.full(len(points), ord("."), np.uint8)
    marks[1:][space[:-1] & ~space[1:]] = ord("W")
    marks[1:][~space[:-1] & space[1:]] = ord("S")
    ends = np.array([b for _, b in sentence_units(text, lang)], np.int64)
    marks[ends[ends < len(points)]] = ord("U")
    marks[1:][(points[:-1] != 0x0A) & (points[1:] == 0x0A)] = ord("L")
    return marks.tobytes().decode()


def _marked(batches):
    for batch in batches:
        marks = [boundary_marks(*row) for row in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.large_string()).cast(pa.string())], ["row_id", "marks"])


def split_oversized(df: DataFrame, id_col: str, text_col: str, limit: int = 1500, overlap: int = 200, lang_col: str | None = None) -> DataFrame:
    """(row_id, piece_no, start_pos, end_pos) of every text of more than `limit` characters; positions in code points.

    A piece ends at a position e with start + limit/2 < e <= start + limit: at the last line feed that follows another
    character than a line feed, else at the last end of a sentence unit, else at the last white space behind another
    character, else at start + limit. The next piece starts at the first non-space behind white space in
    [e - overlap, e), else at e - overlap. The last piece ends with the text. Null, empty and shorter texts give no row;
    rows with the same id each give their own pieces; other columns are ignored. `overlap` must be below limit/2.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("overlap must be below half the limit")
    half, cell = limit // 2, limit + 1
    rows = df.select(F.col(id_col).cast("long").alias("row_id"), F.col(text_col).cast("string").alias("text"), language(lang_col))
    rows = rows.where(F.length("text") > limit).mapInArrow(_marked, "row_id long, marks string")
    rows = rows.select("row_id", F.length("marks").alias("len"), F.regexp_extract_all("marks", F.lit(f".{{1,{cell}}}"), F.lit(0)).alias("cells"))
    rows = rows.withColumn("block", F.ceil(F.sqrt(F.col("len") / (half - overlap) + 2)).cast("int"))

    def window(at: str, size: int) -> str:
        """`size` marks, at most a cell, from the position `at`."""
        no = f"cast(({at}) div {cell} as int)"
        return f"substring(concat(element_at(cells, {no} + 1), coalesce(try_element_at(cells, {no} + 2), '')), ({at}) % {cell} + 1, {size})"

    ways = "|".join(f".{{{half + 1},{limit}}}(?={c})" for c in "LUS")
    end = f"s.start + length(regexp_extract({window('s.start', limit + 1)}, '^(?:{ways}|.{{{limit}}})', 0))"
    back = f"length(regexp_extract({window(f'e - {overlap}', overlap)}, '^([^W]*)W', 0))"
    piece = "array<struct<start_pos: int, end_pos: int>>"
    step = f"""
      case when s.start is null then s
           when len - s.start <= {limit} then
             named_struct('start', cast(null as int), 'pieces', concat(s.pieces, array(named_struct('start_pos', s.start, 'end_pos', len))))
           else element_at(transform(array({end}), e -> named_struct(
             'start', cast(e - {overlap} + greatest({back} - 1, 0) as int),
             'pieces', concat(s.pieces, array(named_struct('start_pos', s.start, 'end_pos', cast(e as int)))))), 1) end"""
    inner = f"""aggregate(sequence(1, block), named_struct('start', o.start, 'pieces', cast(array() as {piece})), (s, i) -> {step})"""
    pieces = f"""
      flatten(aggregate(sequence(1, block), named_struct('start', 0, 'blocks', cast(array() as array<{piece}>)),
        (o, j) -> case when o.start is null then o else element_at(transform(array({inner}), r -> named_struct('start', r.start, 'blocks', concat(o.blocks, array(r.pieces)))), 1) end,
        o -> o.blocks))"""
    out = rows.select("row_id", F.posexplode(F.expr(pieces)).alias("piece_no", "piece"))
    return out.select("row_id", "piece_no", "piece.start_pos", "piece.end_pos")
