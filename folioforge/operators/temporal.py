"""Gazette annotations of bodies, their events, and the status that follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What an annotation speaks of, and what happened to it. Fixed values.
SCOPES = ("Artículo", "Párrafo", "Fracción", "Inciso", "Numeral", "Apartado", "Capítulo", "Sección", "Epígrafe", "Denominación")
VERBS = ("parcialmente derogado", "reformado", "adicionado", "derogado", "recorrido", "reubicado", "original", "fe de erratas", "actualizada", "compilada")

#: An annotation that takes a line, and one that ends a line of text: the scope's name, capitalised, and dates in one sentence.
_STANDALONE = rf"(?i)^((?:{'|'.join(SCOPES)}).*)$"
_INLINE = rf"(?:^|[^\p{{L}}])((?:{'|'.join(SCOPES)}) [^.]*DOF [0-9].*)$"
_VERB = rf"({'|'.join(VERBS)})"
_SCOPE_NAME = rf"^({'|'.join(SCOPES)})"
_DATE = r"[0-9]+-[0-9]+-[0-9]+"
_NARRATIVE = r"^Reforma DOF ([0-9]+-[0-9]+-[0-9]+): ((Reform|Adicion|Derog|Recorri|Reubic)[^ ]*.*)$"


def gazette_date(raw: Column) -> Column:
    """The date of `d-m-yyyy`; null if it is no date, such as `220-12-1991`."""
    ok = F.when(raw.rlike("^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"), raw)
    return F.try_to_timestamp(ok, F.lit("d-M-yyyy")).cast("date")


def events_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, seq, inline, scope, verb, raw_date, event_date): one row for each date of each annotation, in order.

    An annotation takes a line or, `inline`, stands behind the text of one. Its later sentences inherit the scope of the
    first. `(sic DOF ...)` marks of a transcription are no events, and narrated reforms (`narrative_reforms`) neither.
    """
    clean = F.regexp_replace(text_col, r"\(sic DOF [^)]*\)", "")
    rows = df.where(F.col(text_col).isNotNull()).select(id_col, F.posexplode(F.split(clean, "\n")).alias("p", "line")).where("line like '%DOF %'")
    alone = F.nullif(F.regexp_extract("line", "(?u)" + _STANDALONE, 1), F.lit(""))
    note = F.coalesce(alone, F.nullif(F.regexp_extract("line", _INLINE, 1), F.lit("")))
    rows = rows.select(id_col, (F.col("p") + 1).alias("pos"), alone.isNull().alias("inline"), note.alias("note")).where("note is not null")
    rows = rows.select(id_col, "pos", "inline", F.regexp_extract("note", "(?iu)" + _SCOPE_NAME, 1).alias("scope"), F.posexplode(F.split("note", r"\. ")).alias("s", "part"))
    rows = rows.select(id_col, "pos", "inline", "scope", "s", F.lower(F.regexp_extract("part", "(?iu)" + _VERB, 1)).alias("verb"), F.posexplode(F.regexp_extract_all("part", F.lit(_DATE), F.lit(0))).alias("d", "raw_date"))
    seq = (F.col("s") * 1000 + F.col("d") + 1).alias("seq")
    return rows.select(id_col, "pos", seq, "inline", "scope", F.nullif("verb", F.lit("")).alias("verb"), "raw_date", gazette_date(F.col("raw_date")).alias("event_date"))


def sql_events_of(key: str, text: str, table: str) -> str:
    return rf"""(with l as (select {key}, unnest(k) as line, generate_subscripts(k, 1) as pos from (select {key}, string_split(regexp_replace({text}, '\(sic DOF [^)]*\)', '', 'g'), chr(10)) as k from {table} where {text} is not null)),
      n as (select {key}, pos, nullif(regexp_extract(line, '{_STANDALONE}', 1), '') as alone, nullif(regexp_extract(line, '{_INLINE}', 1), '') as inl from l where line like '%DOF %'),
      s as (select {key}, pos, alone is null as inline, regexp_extract(coalesce(alone, inl), '(?i){_SCOPE_NAME}', 1) as scope, string_split(coalesce(alone, inl), '. ') as k from n where coalesce(alone, inl) is not null),
      p as (select {key}, pos, inline, scope, unnest(k) as part, generate_subscripts(k, 1) - 1 as s from s),
      d as (select {key}, pos, inline, scope, s, nullif(lower(regexp_extract(part, '(?i){_VERB}', 1)), '') as verb, regexp_extract_all(part, '{_DATE}') as k from p),
      e as (select {key}, pos, inline, scope, s, verb, unnest(k) as raw_date, generate_subscripts(k, 1) as d from d)
      select {key}, pos, s * 1000 + d as seq, inline, scope, verb, raw_date, case when regexp_matches(raw_date, '^[0-9]{{1,2}}-[0-9]{{1,2}}-[0-9]{{4}}$') then try_strptime(raw_date, '%d-%m-%Y')::date end as event_date from e)"""


def narrative_reforms(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, raw_date, event_date, verb, told) of lines `Reforma DOF d: Derogó …`; the verb is its stem in lower case."""
    rows = df.where(F.col(text_col).isNotNull()).select(id_col, F.posexplode(F.split(text_col, "\n")).alias("p", "line")).where(F.col("line").rlike(_NARRATIVE))
    raw = F.regexp_extract("line", _NARRATIVE, 1)
    return rows.select(id_col, (F.col("p") + 1).alias("pos"), raw.alias("raw_date"), gazette_date(raw).alias("event_date"), F.lower(F.regexp_extract("line", _NARRATIVE, 3)).alias("verb"), F.regexp_extract("line", _NARRATIVE, 2).alias("told"))


def body_of(text: Column) -> Column:
    """A body without breadcrumb and heading lines."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"(?m)^[>#] .*$", ""), r"^\s+", ""))


def status_of(text: Column) -> Column:
    """`repealed` if the body begins, marks apart, with a form of (se) derog- other than derogaci-; else `unknown`.

    Null texts are `unknown`. Kept as published: bodies that repeal other norms, or a part of their own, count as well.
    """
    return F.when(F.coalesce(body_of(text).rlike(r"(?iu)^\W*(se )?derog(?!aci)"), F.lit(False)), "repealed").otherwise("unknown")


def corrected_status(text: Column) -> Column:
    """As `status_of`, but `partial` for a part of the provision and `unknown` for the repeal of other norms."""
    body = body_of(text)
    part = body.rlike(r"(?iu)^\W*(se )?derogan? (el|la|los|las) [^.]{0,40}(párrafo|fracción|inciso|numeral|apartado)")
    others = body.rlike(r"(?iu)^\W*se derogan? (todas?|todos?|las|los|la|el|cualquier|aquellas?)\b")
    return F.when(part, "partial").when(others, "unknown").otherwise(status_of(text))


def relocations_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, old_number, raw_date) of notes `recorrido (antes Artículo X) DOF d`."""
    found = F.regexp_extract_all(text_col, F.lit(r"antes Artículo ([^)]+)\) DOF ([0-9-]+)"), F.lit(0))
    rows = df.where(F.col(text_col).isNotNull()).select(id_col, F.explode(found).alias("x"))
    return rows.select(id_col, F.regexp_extract("x", r"antes Artículo ([^)]+)\)", 1).alias("old_number"), F.regexp_extract("x", r"DOF ([0-9-]+)", 1).alias("raw_date"))
