"""Queries of the record operators: identity, segmentation, gazette events, references, rendering, governance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.functions import text as T
from folioforge.operators import refs as R
from folioforge.operators import render, segment, temporal
from folioforge.operators.relational import follow_chains
from folioforge.plans.registry import query
from folioforge.runtime import bounded_broadcast, table
from folioforge.sources.files import quarantine, reader_of, url_parts

LATEST = "(select * from provisions qualify row_number() over (partition by id order by exported_at desc, row_id desc) = 1)"


def latest(df: DataFrame, key: str = "id") -> DataFrame:
    """The last version of each key; a maximum with map-side combine, not a sort of each key's rows."""
    return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), F.struct("exported_at", "row_id")).alias("x")).select("x.*")


# ---- sources ----
@query("content_hash", "select row_id, sha256(markdown) as sha from provisions")
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "provisions").select("row_id", F.sha2("markdown", 256).alias("sha"))


@query("exact_duplicates", "select sha256(text) as sha, min(doc_id) as first_id, count(*) as n from documents where text is not null group by 1 having count(*) > 1")
def exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where("text is not null").groupBy(F.sha2("text", 256).alias("sha"))
    return rows.agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")


@query("url_parts", "select instrument_id, regexp_extract(source_url, '^https?://([^/]+)', 1) as host, lower(regexp_extract(source_url, '\\.([A-Za-z0-9]+)$', 1)) as ext, url_decode(source_url) as decoded from instruments")
def q_url_parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "instruments").withColumn("u", url_parts(F.col("source_url"))).select("instrument_id", "u.host", "u.ext", "u.decoded")


@query("url_ext_dispatch", "select case when source_ext = 'pdf' then 'pdf' when source_ext in ('doc','docx') then 'legacy_doc' when source_ext in ('html','htm') then 'html' else 'other' end as reader, count(*) as n from provisions p join instruments using (instrument_id) group by 1")
def url_ext_dispatch(spark: SparkSession, d: str) -> DataFrame:
    dim = bounded_broadcast(table(spark, d, "instruments").select("instrument_id", reader_of(F.col("source_ext")).alias("reader")))
    return table(spark, d, "provisions").select("instrument_id").join(dim, "instrument_id").groupBy("reader").agg(F.count("*").alias("n"))


@query("provider_of_host", "select source_host, min(provider) as provider, count(*) as n from instruments group by 1")
def provider_of_host(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "instruments").groupBy("source_host").agg(F.min("provider").alias("provider"), F.count("*").alias("n"))


@query("source_registry", "select i.instrument_id, i.source_url, count(p.row_id) as n from instruments i left join provisions p on p.instrument_id = i.instrument_id and p.source_url = i.source_url group by 1, 2")
def source_registry(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "provisions").groupBy("instrument_id", "source_url").agg(F.count("*").alias("n"))
    return table(spark, d, "instruments").select("instrument_id", "source_url").join(n, ["instrument_id", "source_url"], "left").select("instrument_id", "source_url", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


_STRIP = r"regexp_replace(regexp_replace(text, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]+>', ' ', 'g')"


@query("html_to_text", f"select doc_id, trim(regexp_replace(replace(replace(replace(replace(replace({_STRIP}, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&'), '[ \\t\\r\\n]+', ' ', 'g')) as plain from documents where text is not null")
def html_to_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null").select("doc_id", segment.strip_markup(F.col("text")).alias("plain"))


@query("frontmatter_scan", r"select file_id, nullif(regexp_extract(markdown, '(?:^|\n)id: ([^\r\n]*?)[ \t]*(?:\r?\n)', 1), '') as id, nullif(regexp_extract(markdown, '(?:^|\n)instrument: ([^\r\n]*?)[ \t]*(?:\r?\n)', 1), '') as instrument from md_files where markdown is not null and regexp_matches(markdown, '(?s)^\x{FEFF}?---\r?\n(.*?)\r?\n---')")
def frontmatter_scan(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "md_files").where(F.col("markdown").rlike(r"(?s)^﻿?---\r?\n(.*?)\r?\n---")).withColumn("m", render.parse_frontmatter(F.col("markdown")))
    return rows.select("file_id", F.try_element_at("m", F.lit("id")).alias("id"), F.try_element_at("m", F.lit("instrument")).alias("instrument"))


# ---- identity ----
@query("slug", f"select instrument_id, {T.sql_slug('name')} as slug from instruments")
def slug(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "instruments").select("instrument_id", T.slug(F.col("name")).alias("slug"))


_KEY = T.sql_number_key("number", "provision_type")


@query("urn_mint", f"select row_id, concat_ws(':', instrument_id, provision_type, {_KEY}) as urn, {_KEY} as number_key from provisions")
def urn_mint(spark: SparkSession, d: str) -> DataFrame:
    n, k = F.col("number"), F.col("provision_type")
    return table(spark, d, "provisions").select("row_id", T.urn(F.col("instrument_id"), k, n).alias("urn"), T.number_key(n, k).alias("number_key"))


@query("urn_mismatch", f"select row_id, id from provisions where id <> concat_ws(':', instrument_id, provision_type, {_KEY})")
def urn_mismatch(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "provisions")
    return rows.where(F.col("id") != T.urn(F.col("instrument_id"), F.col("provision_type"), F.col("number"))).select("row_id", "id")


@query("file_name_mint", f"select row_id, case when provision_type = 'article' then 'articulo-' || regexp_replace(number, ' +', '-', 'g') else 'transitorio-' || {T.sql_slug('number')} end as minted from provisions")
def file_name_mint(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "provisions").select("row_id", T.file_name(F.col("number"), F.col("provision_type")).alias("minted"))


@query("alias_mint", "select row_id, instrument || ' — ' || case when provision_type = 'article' then 'Artículo ' else '' end || number as alias from provisions")
def alias_mint(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "provisions").select("row_id", T.alias(F.col("instrument"), F.col("provision_type"), F.col("number"))[0].alias("alias"))


@query("class_of_urn", "select split_part(instrument_id, ':', 4) as class, count(distinct instrument_id) as instruments, count(*) as n from provisions group by 1")
def class_of_urn(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "provisions").groupBy("instrument_id").agg(F.count("*").alias("n"))
    return rows.groupBy(F.split_part("instrument_id", F.lit(":"), F.lit(4)).alias("class")).agg(F.count("*").alias("instruments"), F.sum("n").alias("n"))


@query("abbreviation_differs", "select slug, abbrev from instruments where lower(abbrev) <> slug")
def abbreviation_differs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "instruments").where(F.lower("abbrev") != F.col("slug")).select("slug", "abbrev")


@query("urn_uniqueness", "select id, count(*) as n, count(distinct sha256(markdown)) as bodies from provisions group by 1 having count(*) > 1")
def urn_uniqueness(spark: SparkSession, d: str) -> DataFrame:
    once = table(spark, d, "provisions").groupBy("id", F.sha2("markdown", 256).alias("sha")).agg(F.count("*").alias("n"))
    return once.groupBy("id").agg(F.sum("n").alias("n"), F.count("sha").alias("bodies")).where("n > 1")


_FOLDED = T.sql_fold("number")


@query("number_grammar", f"select row_id, try_cast(nullif(regexp_extract({_FOLDED}, '^([0-9]+)', 1), '') as int) as base, nullif(regexp_extract({_FOLDED}, '^[0-9]+o?[.]?-([a-z])(?:-|$)', 1), '') as letter, nullif(regexp_extract({_FOLDED}, '(?:^|[^a-z])({'|'.join(T.SUFFIXES)})(?:[^a-z]|$)', 1), '') as suffix, try_cast(nullif(regexp_extract({_FOLDED}, '[a-z][ -]([0-9]+)$', 1), '') as int) as sub from provisions")
def number_grammar(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "provisions").select("row_id", T.article_parts(F.col("number")).alias("p")).select("row_id", "p.*")


_ORD = " ".join(f"when '{k}' then {v}" for k, v in sorted(T._ordinal_table().items()))


@query("ordinal_words", f"select distinct number, coalesce(try_cast(nullif(regexp_extract({T.sql_slug('number')}, '^([0-9]+)[oa]?$', 1), '') as int), case {T.sql_slug('number')} {_ORD} end) as ord from provisions where provision_type = 'transitory'")
def ordinal_words(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "provisions").where("provision_type = 'transitory'").select("number").distinct().select("number", T.ordinal_value(F.col("number")).alias("ord"))


# ---- segmentation ----
@query("segment_lines", "select doc_id, i as line_no, string_split(text, chr(10))[i] as line from (select doc_id, text, unnest(generate_series(1, len(string_split(text, chr(10))))) as i from documents where text is not null)")
def segment_lines(spark: SparkSession, d: str) -> DataFrame:
    return segment.lines_of(table(spark, d, "documents"), "doc_id", "text")


def _sql_kind(x: str) -> str:
    return "case " + " ".join(f"when regexp_matches({x}, '{p}') then '{n}'" for n, p in segment.KINDS) + " else 'paragraph' end"


_BLOCKS = "(select row_id, i as pos, k[i] as t from (select row_id, k, unnest(generate_series(1, len(k))) as i from (select row_id, list_filter(list_transform(string_split(markdown, chr(10)), lambda x: rtrim(x)), lambda x: x <> '') as k from provisions where markdown is not null)))"


@query("blocks", f"select row_id, pos, {_sql_kind('t')} as kind, nullif(regexp_extract(t, '^([IVXLCDM]+|[0-9]+|[a-zA-Z])(?:\\.-|\\.|\\)) ', 1), '') as marker from {_BLOCKS}")
def blocks(spark: SparkSession, d: str) -> DataFrame:
    return segment.blocks_of(table(spark, d, "provisions"), "row_id", "markdown").drop("text")


@query("block_kinds", f"select {_sql_kind('t')} as kind, count(*) as n from {_BLOCKS} group by 1")
def block_kinds(spark: SparkSession, d: str) -> DataFrame:
    return segment.blocks_of(table(spark, d, "provisions"), "row_id", "markdown").groupBy("kind").agg(F.count("*").alias("n"))


@query("heading_leaks", f"with b as (select row_id, pos, {_sql_kind('t')} as kind from {_BLOCKS}) select row_id, pos from b where kind = 'structure'")
def heading_leaks(spark: SparkSession, d: str) -> DataFrame:
    return segment.blocks_of(table(spark, d, "provisions"), "row_id", "markdown").where("kind = 'structure'").select("row_id", "pos")


@query("breadcrumbs", "select row_id, regexp_extract(markdown, '(?:^|\\n)> ([^\\n]*)', 1) as crumb from provisions where regexp_matches(markdown, '(?:^|\\n)> [^\\n]')")
def breadcrumbs(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "provisions").withColumn("b", segment.breadcrumb(F.col("markdown"))).where(F.size("b") > 0)
    return rows.select("row_id", F.array_join(F.transform("b", lambda x: F.concat_ws(" ", x["level"], F.nullif(x["label"], F.lit("")))), " · ").alias("crumb"))


@query("breadcrumb_shapes", "with c as (select list_transform(string_split(regexp_extract(markdown, '(?:^|\\n)> ([^\\n]*)', 1), ' · '), lambda x: split_part(x, ' ', 1)) as k from provisions where regexp_matches(markdown, '(?:^|\\n)> [^\\n]')) select array_to_string(k[-2:], '·') as shape, count(*) as n from c group by 1")
def breadcrumb_shapes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "provisions").withColumn("b", segment.breadcrumb(F.col("markdown"))).where(F.size("b") > 0)
    return rows.groupBy(F.array_join("b.level", "·").alias("shape")).agg(F.count("*").alias("n"))


def _sql_level(line: str) -> str:
    """The label of a structure line, for each level; null for other lines."""
    return ", ".join(f"case when lower(split_part({line}, ' ', 1)) = '{w.lower()}' then substr({line}, {len(w) + 2}) end as l{i}" for i, w in enumerate(segment.LEVELS))


_OVER = "over (partition by row_id order by line_no rows unbounded preceding)"
_HIGHER = ["0", *(f"coalesce(max(case when {' or '.join(f'l{k} is not null' for k in range(i))} then line_no end) {_OVER}, 0)" for i in range(1, 4))]
_FILLED = ", ".join(f"case when max(case when l{i} is not null then line_no end) {_OVER} > {_HIGHER[i]} then last_value(l{i} ignore nulls) {_OVER} end as \"{w}\"" for i, w in enumerate(segment.LEVELS))


@query("context_fill", f"with t as (select row_id, k, generate_subscripts(k, 1) as line_no, unnest(k) as line from (select row_id, string_split(markdown, chr(10)) as k from provisions where markdown is not null)), l as (select row_id, line_no, {_sql_level('line')} from t) select row_id, line_no, {_FILLED} from l")
def context_fill(spark: SparkSession, d: str) -> DataFrame:
    """Every line with the book, title, chapter and section last seen above it, reset by higher ones."""
    return segment.carried_context(segment.lines_of(table(spark, d, "provisions"), "row_id", "markdown"), "row_id").drop("line")


@query("article_split", segment.sql_split_provisions("row_id", "markdown", "provisions"))
def article_split(spark: SparkSession, d: str) -> DataFrame:
    return segment.split_provisions(table(spark, d, "provisions"), "row_id", "markdown")


@query("transitory_split", f"select * from {segment.sql_split_provisions('doc_id', 'text', 'documents')} where provision_type = 'transitory'")
def transitory_split(spark: SparkSession, d: str) -> DataFrame:
    return segment.split_provisions(table(spark, d, "documents"), "doc_id", "text").where("provision_type = 'transitory'")


@query("furniture", f"select doc_id, sha256(regexp_replace(text, '{segment.FURNITURE}', '', 'g')) as sha, length(text) - length(regexp_replace(text, '{segment.FURNITURE}', '', 'g')) as removed from documents where text is not null")
def furniture(spark: SparkSession, d: str) -> DataFrame:
    kept = segment.strip_furniture(F.col("text"))
    rows = table(spark, d, "documents").where("text is not null").select("doc_id", F.length("text").alias("n"), kept.alias("kept"))
    return rows.select("doc_id", F.sha2("kept", 256).alias("sha"), (F.col("n") - F.length("kept")).cast("long").alias("removed"))


@query("repeated_lines", "select line, count(*) as n from (select unnest(string_split(text, chr(10))) as line from documents) where line <> '' group by 1 having count(*) > 2")
def repeated_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = segment.lines_of(table(spark, d, "documents"), "doc_id", "text").where("line <> ''")
    return rows.groupBy("line").agg(F.count("*").alias("n")).where("n > 2")


@query("marks", f"select row_id, pos, list_transform(regexp_extract_all(regexp_extract(t, '^((?:\\([0-9]{{1,3}}\\) ?)+)', 1), '\\(([0-9]{{1,3}})\\)', 1), lambda x: x::int) as marks from {_BLOCKS} where regexp_matches(t, '^\\([0-9]{{1,3}}\\)')")
def marks(spark: SparkSession, d: str) -> DataFrame:
    """Footnote marks that lead a block, as numbers; those of a next heading that stayed behind (`mark` blocks) as well."""
    rows = segment.blocks_of(table(spark, d, "provisions"), "row_id", "markdown")
    return rows.select("row_id", "pos", segment.amendment_marks(F.col("text")).alias("marks")).where("marks is not null")


@query("mark_leaks", f"select row_id, pos from {_BLOCKS} where regexp_matches(t, '^(?:\\([0-9]{{1,3}}\\) ?)+$')")
def mark_leaks(spark: SparkSession, d: str) -> DataFrame:
    return segment.blocks_of(table(spark, d, "provisions"), "row_id", "markdown").where("kind = 'mark'").select("row_id", "pos")


@query("marks_stored", "select row_id, len(amendment_marks) as n, list_sum(amendment_marks)::bigint as total from provisions where amendment_marks is not null")
def marks_stored(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "provisions").where("amendment_marks is not null")
    return rows.select("row_id", F.size("amendment_marks").alias("n"), F.aggregate("amendment_marks", F.lit(0).cast("long"), lambda s, x: s + x).alias("total"))


@query("transcription_marks", "select row_id, len(regexp_extract_all(markdown, '\\(sic DOF [^)]*\\)')) as n from provisions where regexp_matches(markdown, '\\(sic DOF [^)]*\\)')")
def transcription_marks(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "provisions").where(F.col("markdown").rlike(r"\(sic DOF [^)]*\)"))
    return rows.select("row_id", F.size(F.regexp_extract_all("markdown", F.lit(r"\(sic DOF [^)]*\)"), F.lit(0))).alias("n"))


@query("run_on_items", "with r as (select row_id, string_split(regexp_replace(markdown, ';[ \\t\\n\\r]+(?:y )?([IVXLC]+\\. )', ';' || chr(1) || '\\1', 'g'), chr(1)) as k from provisions where markdown is not null) select row_id, generate_subscripts(k, 1) as pos, sha256(unnest(k)) as item from r where len(k) > 1")
def run_on_items(spark: SparkSession, d: str) -> DataFrame:
    """The items of bodies in which several stand in one line, each apart, by their digests."""
    rows = table(spark, d, "provisions").where("markdown is not null").select("row_id", segment.split_run_on(F.col("markdown")).alias("k")).where("size(k) > 1")
    return rows.select("row_id", F.posexplode("k").alias("p", "x")).select("row_id", (F.col("p") + 1).alias("pos"), F.sha2("x", 256).alias("item"))


_JOIN = "'([^\\n])\\n([^ \\t\\n\\r\\f])', '\\1 \\2', 'g')"


@query("reflow", f"select doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), {_JOIN}, {_JOIN}) as sha from documents where text is not null")
def reflow(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.sha2(segment.reflow(F.col("text")), 256).alias("sha"))


# ---- gazette ----
@query("event_dates", "select event_key, case when regexp_matches(raw_date, '^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$') then try_strptime(raw_date, '%d-%m-%Y')::date end as parsed from gazette_events")
def event_dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "gazette_events").select("event_key", temporal.gazette_date(F.col("raw_date")).alias("parsed"))


@query("bad_dates", "select event_key, raw_date from gazette_events where event_date is null")
def bad_dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "gazette_events").where("event_date is null").select("event_key", "raw_date")


@query("events_of_bodies", f"select * from {temporal.sql_events_of('row_id', 'markdown', 'provisions')}")
def events_of_bodies(spark: SparkSession, d: str) -> DataFrame:
    return temporal.events_of(table(spark, d, "provisions"), "row_id", "markdown")


@query("body_vocabulary", f"select scope, coalesce(verb, 'none') as verb, inline, count(*) as n, min(event_date) as first, max(event_date) as last from {temporal.sql_events_of('row_id', 'markdown', 'provisions')} group by 1, 2, 3")
def body_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    """Scopes and verbs of the annotations in bodies."""
    rows = temporal.events_of(table(spark, d, "provisions"), "row_id", "markdown").groupBy("scope", F.coalesce("verb", F.lit("none")).alias("verb"), "inline")
    return rows.agg(F.count("*").alias("n"), F.min("event_date").alias("first"), F.max("event_date").alias("last"))


@query("narrative_reforms", "with l as (select row_id, unnest(k) as line, generate_subscripts(k, 1) as pos from (select row_id, string_split(markdown, chr(10)) as k from provisions where markdown is not null)) select row_id, pos, regexp_extract(line, '^Reforma DOF ([0-9-]+):', 1) as raw_date from l where regexp_matches(line, '^Reforma DOF [0-9]+-[0-9]+-[0-9]+: (Reform|Adicion|Derog|Recorri|Reubic)')")
def narrative_reforms(spark: SparkSession, d: str) -> DataFrame:
    return temporal.narrative_reforms(table(spark, d, "provisions"), "row_id", "markdown").select("row_id", "pos", "raw_date")


_EV = "(select distinct provision_id, seq, scope, lower(verb) as verb, raw_date, event_date from gazette_events)"


def distinct_events(spark: SparkSession, d: str) -> DataFrame:
    """Events without those that were delivered again under a new key."""
    return table(spark, d, "gazette_events").select("provision_id", "seq", "scope", F.lower("verb").alias("verb"), "raw_date", "event_date").distinct()


@query("event_vocabulary", f"select coalesce(scope, 'none') as scope, verb, count(*) as n, min(event_date) as first, max(event_date) as last from {_EV} group by 1, 2")
def event_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    rows = distinct_events(spark, d).groupBy(F.coalesce("scope", F.lit("none")).alias("scope"), "verb")
    return rows.agg(F.count("*").alias("n"), F.min("event_date").alias("first"), F.max("event_date").alias("last"))


@query("last_event", f"select provision_id, arg_max(verb, (event_date, seq, verb)) as verb, max(event_date) as event_date from {_EV} where event_date is not null and scope = 'Artículo' group by 1")
def last_event(spark: SparkSession, d: str) -> DataFrame:
    rows = distinct_events(spark, d).where("event_date is not null and scope = 'Artículo'")
    return rows.groupBy("provision_id").agg(F.max_by("verb", F.struct("event_date", "seq", "verb")).alias("verb"), F.max("event_date").alias("event_date"))


@query("event_daily", "select event_date, count(*) as n, count(distinct provision_id) as provisions from gazette_events where event_date is not null group by 1")
def event_daily(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "gazette_events").where("event_date is not null").groupBy("event_date", "provision_id").agg(F.count("*").alias("n"))
    return rows.groupBy("event_date").agg(F.sum("n").alias("n"), F.count("*").alias("provisions"))


_BODY = r"regexp_replace(regexp_replace(markdown, '(?:^|\n)[>#] [^\n]*', '', 'g'), '^\s+', '')"
_STATUS = rf"case when regexp_matches({_BODY}, '(?i)^[^\p{{L}}\p{{N}}_]*(se )?derog') and not regexp_matches({_BODY}, '(?i)^[^\p{{L}}\p{{N}}_]*(se )?derogaci') then 'repealed' else 'unknown' end"


@query("status_classify", f"select row_id, {_STATUS} as status from provisions")
def status_classify(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "provisions").select("row_id", temporal.status_of(F.col("markdown")).alias("status"))


@query("status_disagreement", f"select temporal_status, {_STATUS} as computed, count(*) as n from provisions group by 1, 2")
def status_disagreement(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "provisions").select("temporal_status", temporal.status_of(F.col("markdown")).alias("computed"))
    return rows.groupBy("temporal_status", "computed").agg(F.count("*").alias("n"))


_PARTIAL = rf"regexp_matches({_BODY}, '(?i)^[^\p{{L}}\p{{N}}_]*(se )?derogan? (el|la|los|las) [^.]{{0,40}}(párrafo|fracción|inciso|numeral|apartado)')"
_OTHERS = rf"regexp_matches({_BODY}, '(?i)^[^\p{{L}}\p{{N}}_]*se derogan? (todas?|todos?|las|los|la|el|cualquier|aquellas?)(?:[^\p{{L}}\p{{N}}_]|$)')"


@query("status_corrected", f"select row_id, case when markdown is null then 'unknown' when {_PARTIAL} then 'partial' when {_OTHERS} then 'unknown' else {_STATUS} end as status from provisions")
def status_corrected(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "provisions").select("row_id", temporal.corrected_status(F.col("markdown")).alias("status"))


@query("lineage_edges", "with r as (select row_id, unnest(regexp_extract_all(markdown, 'antes Artículo [^)]+\\) DOF [0-9-]+')) as x from provisions where markdown is not null) select row_id, regexp_extract(x, 'antes Artículo ([^)]+)\\)', 1) as old_number, regexp_extract(x, 'DOF ([0-9-]+)', 1) as raw_date from r")
def lineage_edges(spark: SparkSession, d: str) -> DataFrame:
    return temporal.relocations_of(table(spark, d, "provisions"), "row_id", "markdown")


@query("lineage_origins")
def lineage_origins(spark: SparkSession, d: str) -> DataFrame:
    """Provisions that were moved, with the number that they first had: relocation notes followed back to their start."""
    p = table(spark, d, "provisions").where("provision_type = 'article'").withColumn("own", T.urn(F.col("instrument_id"), F.col("provision_type"), F.col("number")))
    moved = temporal.relocations_of(p.withColumn("k", F.struct("own", "instrument_id")), "k", "markdown")
    edges = moved.select(F.col("k.own").alias("src"), T.urn(F.col("k.instrument_id"), F.lit("article"), F.col("old_number")).alias("dst"))
    return follow_chains(edges, "src", "dst")


@query("event_asof", "with g as (select distinct provision_id, event_date from gazette_events where event_date is not null), p as (select row_id, id, cast(exported_at as date) as day from provisions) select row_id, (select max(event_date) from g where provision_id = p.id and event_date <= p.day) as last_date from p")
def event_asof(spark: SparkSession, d: str) -> DataFrame:
    """For every export of a provision, its last gazette date up to then: a running maximum over both, in one shuffle."""
    g = table(spark, d, "gazette_events").where("event_date is not null").select(F.col("provision_id").alias("id"), F.col("event_date").alias("day")).distinct()
    both = g.select("id", "day", F.lit(0).alias("side"), F.lit(None).cast("long").alias("row_id")).union(table(spark, d, "provisions").select("id", F.col("exported_at").cast("date").alias("day"), F.lit(1).alias("side"), "row_id"))
    w = Window.partitionBy("id").orderBy("day", "side").rowsBetween(Window.unboundedPreceding, 0)
    return both.select("row_id", "side", F.max(F.when(F.col("side") == 0, F.col("day"))).over(w).alias("last_date")).where("side = 1").drop("side")


# ---- references ----
@query("links", r"with l as (select row_id, unnest(regexp_extract_all(markdown, '\[[^\]\n]+\]\([^)\s]+\)')) as link, generate_subscripts(regexp_extract_all(markdown, '\[[^\]\n]+\]\([^)\s]+\)'), 1) as pos from provisions where markdown is not null) select row_id, pos, regexp_extract(link, '^\[([^\]]+)\]', 1) as label, regexp_extract(link, '\(([^)]+)\)$', 1) as target_path from l")
def links(spark: SparkSession, d: str) -> DataFrame:
    return R.links_of(table(spark, d, "provisions"), "row_id", "markdown")


@query("cross_instrument_links", "select e.edge_id, i.instrument_id, i.instrument_class from ref_edges e join instruments i on i.slug = regexp_extract(e.target_path, '^(?:\\.\\./)+([^/]+)/markdown/', 1)")
def cross_instrument_links(spark: SparkSession, d: str) -> DataFrame:
    dim = bounded_broadcast(table(spark, d, "instruments").select("slug", "instrument_id", "instrument_class"))
    rows = table(spark, d, "ref_edges").select("edge_id", F.regexp_extract("target_path", r"^(?:\.\./)+([^/]+)/markdown/", 1).alias("slug"))
    return rows.join(dim, "slug").select("edge_id", "instrument_id", "instrument_class")


@query("link_kinds", "select case when contains(target_path, '/markdown/') then 'cross_instrument' when lower(label) in ('anterior', 'siguiente') then 'relative' when regexp_matches(label, '^[0-9]') then 'numeric' else 'term' end as computed, kind, count(*) as n from ref_edges group by 1, 2")
def link_kinds(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "ref_edges").select(R.link_kind(F.col("label"), F.col("target_path")).alias("computed"), "kind")
    return rows.groupBy("computed", "kind").agg(F.count("*").alias("n"))


@query("edge_kinds", "select kind, resolved, count(*) as n, count(distinct target_id) as targets from ref_edges group by 1, 2")
def edge_kinds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ref_edges").groupBy("kind", "resolved").agg(F.count("*").alias("n"), F.countDistinct("target_id").alias("targets"))


@query("prose_references", f"with f as {R.sql_prose_references()}, a as (select instrument_id, {_KEY} as key, min(id) as target_id from provisions where provision_type = 'article' group by 1, 2) select f.row_id, f.pos, f.raw, f.external, f.range_end, case when not f.external then a.target_id end as target_id from f left join a using (instrument_id, key)")
def prose_references(spark: SparkSession, d: str) -> DataFrame:
    """References in prose resolved within their instrument; those of other norms stay unresolved."""
    found = _found(spark, d).drop("tail")
    p = table(spark, d, "provisions").where("provision_type = 'article'")
    hit = R.resolve(found, p.select("instrument_id", T.number_key(F.col("number"), F.col("provision_type")).alias("key"), "id"), ["instrument_id", "key"], "id")
    return hit.select("row_id", "pos", "raw", "external", "range_end", F.when(~F.col("external"), F.col("target_id")).alias("target_id"))


def _found(spark: SparkSession, d: str) -> DataFrame:
    """References in the prose of provisions, without those of an article to itself."""
    p = table(spark, d, "provisions")
    own = F.when(F.col("provision_type") == "article", T.number_key(F.col("number"), F.col("provision_type")))
    found = R.prose_references(p.select(F.struct("row_id", "instrument_id").alias("k"), "markdown", own.alias("own_key")), "k", "markdown", "own_key")
    return found.select("k.row_id", "k.instrument_id", *[c for c in found.columns if c != "k"])


_FOLDED_NAME = T.sql_fold("name")
_REST = T.sql_fold(f"regexp_replace(tail, '{R.BEFORE_NAME}', '')")


@query("cross_references", f"with f as {R.sql_prose_references()}, n as (select {_FOLDED_NAME} as named, min(instrument_id) as target from instruments where name is not null group by 1 union select lower(abbrev), instrument_id from instruments where abbrev is not null), h as (select f.row_id, f.pos, arg_max(n.target, (length(n.named), n.target)) as target_instrument from f join n on starts_with({_REST}, n.named) and regexp_matches(substr({_REST}, length(n.named) + 1), '^(?:$|[ .,;:)\\]])') where external and regexp_matches(tail, '{R.BEFORE_NAME}') group by 1, 2) select f.row_id, f.pos, f.raw, h.target_instrument from f left join h using (row_id, pos) where external")
def cross_references(spark: SparkSession, d: str) -> DataFrame:
    """References to provisions of other instruments, by the name or abbreviation that follows."""
    return R.cross_references(_found(spark, d), _names(spark, d)).select("row_id", "pos", "raw", "target_instrument")


def _names(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "instruments")
    full = i.groupBy(T.fold(F.col("name")).alias("name")).agg(F.min("instrument_id").alias("target"))
    return full.union(i.select(F.lower("abbrev"), "instrument_id")).select("name", "target", F.lit(None).cast("string").alias("owner"))


@query("cross_references_by_term")
def cross_references_by_term(spark: SparkSession, d: str) -> DataFrame:
    """As `cross_references`, with the terms that an instrument defines as another norm's name."""
    p = table(spark, d, "provisions")
    terms = R.defined_terms(p.select(F.struct("row_id", "instrument_id").alias("k"), "markdown"), "k", "markdown")
    # a definition that begins with a norm's name binds its term to that norm, in the instrument that defines it
    said = terms.select(F.col("k.instrument_id").alias("instrument_id"), "term", F.concat(F.lit(" de "), F.regexp_replace("definition", r"^(?i:la|el|las|los) ", "")).alias("tail"), F.lit(True).alias("external"))
    bound = R.cross_references(said, _names(spark, d)).where("target_instrument is not null").select(F.col("term").alias("name"), F.col("target_instrument").alias("target"), F.col("instrument_id").alias("owner"))
    return R.cross_references(_found(spark, d), _names(spark, d).union(bound)).select("row_id", "pos", "raw", "target_instrument")


@query("cross_coverage", f"with f as {R.sql_prose_references()}, a as (select instrument_id, count(*) as in_prose from f where external group by 1), b as (select instrument_id, count(*) as linked from ref_edges where kind = 'cross_instrument' group by 1) select instrument_id, coalesce(in_prose, 0) as in_prose, coalesce(linked, 0) as linked, coalesce(linked, 0) < coalesce(in_prose, 0) as uneven from a full join b using (instrument_id)")
def cross_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Of every instrument, references to other norms in prose against those that are links, and whether some are not."""
    a = _found(spark, d).where("external").groupBy("instrument_id").agg(F.count("*").alias("in_prose"))
    b = table(spark, d, "ref_edges").where("kind = 'cross_instrument'").groupBy("instrument_id").agg(F.count("*").alias("linked"))
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return a.join(b, "instrument_id", "full").select("instrument_id", n("in_prose"), n("linked")).withColumn("uneven", F.col("linked") < F.col("in_prose"))


_ORDERED = "(select id, lag(id) over w as previous_id, lead(id) over w as next_id from (select instrument_id, provision_type, id, min(row_id) as ord from provisions group by 1, 2, 3) window w as (partition by instrument_id, provision_type order by ord))"


@query("relative_references", f"with m as (select row_id, id, regexp_extract_all({R.sql_body_text('markdown')}, '(?i){R.RELATIVE}', 1) as k from provisions where markdown is not null), r as (select row_id, id, generate_subscripts(k, 1) as pos, lower(unnest(k)) as label from m) select row_id, pos, label, case when label = 'anterior' then previous_id else next_id end as target_id from r left join {_ORDERED} using (id)")
def relative_references(spark: SparkSession, d: str) -> DataFrame:
    """`artículo anterior` and `artículo siguiente` with the provision before or after in document order."""
    p = table(spark, d, "provisions")
    found = R.relative_references(p.select(F.struct("row_id", "id").alias("k"), "markdown"), "k", "markdown").select("k.row_id", "k.id", "pos", "label")
    order = p.groupBy("instrument_id", "provision_type", "id").agg(F.min("row_id").alias("ord"))
    near = R.neighbours(order, ["instrument_id", "provision_type"], "ord", "id").select("id", "previous_id", "next_id")
    return found.join(near, "id", "left").select("row_id", "pos", "label", F.when(F.col("label") == "anterior", F.col("previous_id")).otherwise(F.col("next_id")).alias("target_id"))


@query("missed_tails", f"select row_id, unnest(regexp_extract_all({R.sql_body_text('markdown')}, '\\b([0-9]+- [A-Z])\\b', 1)) as number from provisions where markdown is not null")
def missed_tails(spark: SparkSession, d: str) -> DataFrame:
    return R.missed_tails(table(spark, d, "provisions"), "row_id", "markdown")


@query("defined_terms", f"with l as (select row_id, unnest(string_split({R.sql_body_text('markdown')}, chr(10))) as line from provisions where regexp_matches(markdown, '{R.DEFINES}')) select row_id, regexp_extract(line, '{R.DEFINED}', 1) as term, regexp_extract(line, '{R.DEFINED}', 2) as definition from l where regexp_matches(line, '{R.DEFINED}')")
def defined_terms(spark: SparkSession, d: str) -> DataFrame:
    return R.defined_terms(table(spark, d, "provisions"), "row_id", "markdown")


@query("dangling_refs", "select edge_id from ref_edges e where not exists (select 1 from provisions p where p.id = e.target_id)")
def dangling_refs(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "provisions").select(F.col("id").alias("target_id")).distinct()
    return table(spark, d, "ref_edges").join(ids, "target_id", "left_anti").select("edge_id")


@query("resolved_refs", "select edge_id from ref_edges e where exists (select 1 from provisions p where p.id = e.target_id)")
def resolved_refs(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "provisions").select(F.col("id").alias("target_id"))
    return table(spark, d, "ref_edges").join(ids, "target_id", "left_semi").select("edge_id")


@query("self_links", "select edge_id from ref_edges where src_id = target_id")
def self_links(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ref_edges").where("src_id = target_id").select("edge_id")


@query("first_term_link", "select edge_id from ref_edges where kind = 'term' qualify row_number() over (partition by src_id, label order by pos, edge_id) = 1")
def first_term_link(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "ref_edges").where("kind = 'term'")
    return rows.groupBy("src_id", "label").agg(F.min(F.struct("pos", "edge_id")).alias("x")).select("x.edge_id")


@query("in_degree", "select target_id, count(*) as n, count(distinct src_id) as sources from ref_edges where target_id is not null group by 1")
def in_degree(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ref_edges").where("target_id is not null").groupBy("target_id").agg(F.count("*").alias("n"), F.countDistinct("src_id").alias("sources"))


@query("neighbours", "with u as (select instrument_id, provision_type, id, min(row_id) as ord from provisions group by 1, 2, 3) select id, ord, lag(id) over w as previous_id, lead(id) over w as next_id from u window w as (partition by instrument_id, provision_type order by ord)")
def neighbours(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "provisions").groupBy("instrument_id", "provision_type", "id").agg(F.min("row_id").alias("ord"))
    return R.neighbours(u, ["instrument_id", "provision_type"], "ord", "id").select("id", "ord", "previous_id", "next_id")


@query("range_refs", f"with f as {R.sql_prose_references()}, a as (select distinct instrument_id, try_cast(nullif(regexp_extract(number, '^([0-9]+)$', 1), '') as int) as n, id from provisions where provision_type = 'article'), w as (select *, try_cast(nullif(regexp_extract(key, '^([0-9]{{1,9}})$', 1), '') as int) as n from f), r as (select y.row_id, y.instrument_id, y.pos, x.n as low, y.n as high from w y join w x on x.row_id = y.row_id and x.pos + 1 = y.pos where y.range_end and not y.external and x.n <= y.n) select r.row_id, r.pos, a.id from r join a on a.instrument_id = r.instrument_id and a.n between r.low and r.high")
def range_refs(spark: SparkSession, d: str) -> DataFrame:
    """The articles inside the ranges `A al B` of prose, ends included."""
    whole = F.nullif(F.regexp_extract("number", "^([0-9]+)$", 1), F.lit("")).cast("int")
    a = table(spark, d, "provisions").where("provision_type = 'article'").select("instrument_id", whole.alias("n"), "id").distinct()
    found = _found(spark, d).withColumn("k", F.struct("row_id", "instrument_id"))
    r = R.reference_ranges(found, "k").select("k.row_id", "k.instrument_id", "pos", "low", "high")
    return R.expand_ranges(r, a, ["instrument_id"]).select("row_id", "pos", "id")


@query("label_ranges", "with a as (select distinct instrument_id, try_cast(nullif(regexp_extract(number, '^([0-9]+)$', 1), '') as int) as n, id from provisions where provision_type = 'article'), r as (select edge_id, instrument_id, try_cast(label as int) as lo from ref_edges where kind = 'numeric' and regexp_matches(label, '^[0-9]{1,9}$')) select r.edge_id, a.id from r join a on a.instrument_id = r.instrument_id and a.n between r.lo and r.lo + 2")
def label_ranges(spark: SparkSession, d: str) -> DataFrame:
    """The articles from a link's label to two beyond, as ranges opened by buckets."""
    whole = F.nullif(F.regexp_extract("number", "^([0-9]+)$", 1), F.lit("")).cast("int")
    a = table(spark, d, "provisions").where("provision_type = 'article'").select("instrument_id", whole.alias("n"), "id").distinct()
    r = table(spark, d, "ref_edges").where("kind = 'numeric'").where(F.col("label").rlike("^[0-9]{1,9}$")).select("edge_id", "instrument_id", F.col("label").cast("int").alias("low"))
    return R.expand_ranges(r.withColumn("high", F.col("low") + 2), a, ["instrument_id"]).select("edge_id", "id")


@query("term_matches", r"with t as (select distinct label as term from ref_edges where kind = 'term' and label is not null), h as (select row_id, term, regexp_extract(markdown, '(?s)^(.*?(?:^|[^\p{L}\p{N}]))' || regexp_escape(term) || '(?:[^\p{L}\p{N}]|$)', 1) as before, regexp_matches(markdown, '(?s)(?:^|[^\p{L}\p{N}])' || regexp_escape(term) || '(?:[^\p{L}\p{N}]|$)') as there from provisions, t where contains(markdown, term)) select row_id, term, length(before)::int as start_pos from h where there")
def term_matches(spark: SparkSession, d: str) -> DataFrame:
    terms = table(spark, d, "ref_edges").where("kind = 'term'").select(F.col("label").alias("term")).distinct()
    return R.term_matches(table(spark, d, "provisions"), "row_id", "markdown", terms, later=True)


@query("term_links")
def term_links(spark: SparkSession, d: str) -> DataFrame:
    """Terms in singular and plural, outside of the proper names of instruments."""
    terms = table(spark, d, "ref_edges").where("kind = 'term'").select(F.explode(R.number_variants(F.col("label"))).alias("term"))
    names = table(spark, d, "instruments").select(F.col("name").alias("term")).distinct()
    return R.term_matches(table(spark, d, "provisions"), "row_id", "markdown", terms, later=True, masks=names)


@query("link_text", r"select row_id, regexp_replace(markdown, '\[([^\]\n]+)\]\([^)\s]+\)', '\1', 'g') as plain from provisions where markdown is not null")
def link_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "provisions").where("markdown is not null").select("row_id", F.regexp_replace("markdown", r"\[([^\]\n]+)\]\([^)\s]+\)", "$1").alias("plain"))


# ---- rendering ----
@query("render_record", "select row_id, sha256(concat('---', chr(10), concat_ws(chr(10), 'id: ' || id, 'instrument_id: ' || instrument_id, 'instrument: ' || instrument, 'name: \"' || name || '\"', 'provision_type: ' || provision_type, 'number: \"' || number || '\"', 'aliases: [\"' || array_to_string(aliases, '\", \"') || '\"]', 'generated: ' || generated::varchar, 'temporal_status: ' || temporal_status, 'review_status: ' || review_status, 'amendment_marks: [' || array_to_string(amendment_marks, ',') || ']', 'source_url: ' || source_url, 'source_sha256: ' || source_sha256), chr(10), '---', chr(10), chr(10), coalesce(markdown, ''), chr(10))) as sha from provisions")
def render_record(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "provisions").select("row_id", F.sha2(render.record(F.coalesce("markdown", F.lit(""))), 256).alias("sha"))


@query("toc_index", f"with p as (select instrument_id, name, provision_type, row_id as ord, '- [' || number || '](' || file_name || '.md)' as l from {LATEST}) select instrument_id, concat_ws(chr(10) || chr(10), '# ' || min(name), string_agg(l, chr(10) order by ord) filter (provision_type = 'article'), string_agg(l, chr(10) order by ord) filter (provision_type = 'transitory')) as page from p group by 1")
def toc_index(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "provisions").select("id", "instrument_id", "name", "provision_type", "number", "file_name", "row_id", "exported_at")
    return render.index_pages(latest(rows).withColumnRenamed("row_id", "ord"))


@query("record_json", "select row_id, cast(to_json({id: id, number: number, marks: amendment_marks}) as varchar) as j from provisions where amendment_marks is not null")
def record_json(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "provisions").where("amendment_marks is not null")
    return rows.select("row_id", F.to_json(F.struct("id", "number", F.col("amendment_marks").alias("marks"))).alias("j"))


# ---- governance ----
@query("provenance_check", "select p.row_id, p.source_sha256 is not distinct from i.source_sha256 as same, coalesce(sha256(p.markdown) = p.source_sha256, false) as body_is_source from provisions p join instruments i using (instrument_id)")
def provenance_check(spark: SparkSession, d: str) -> DataFrame:
    """Stored digests against the registry's, and against the body's recomputed one: a body that was parsed is not its source."""
    dim = bounded_broadcast(table(spark, d, "instruments").select("instrument_id", F.col("source_sha256").alias("stored")))
    recomputed = F.coalesce(F.sha2("markdown", 256) == F.col("source_sha256"), F.lit(False)).alias("body_is_source")
    return table(spark, d, "provisions").join(dim, "instrument_id").select("row_id", F.col("source_sha256").eqNullSafe(F.col("stored")).alias("same"), recomputed)


@query("payload_check", "select file_id, octet_length(encode(markdown)) as octets, octet_length(encode(markdown)) >= size_bytes as complete, sha256(markdown) as sha from md_files where markdown is not null")
def payload_check(spark: SparkSession, d: str) -> DataFrame:
    """Recomputed size and digest of every file against the size that was announced; null where none was."""
    n = F.octet_length("markdown").cast("long")
    return table(spark, d, "md_files").where("markdown is not null").select("file_id", n.alias("octets"), (n >= F.col("size_bytes")).alias("complete"), F.sha2("markdown", 256).alias("sha"))


@query("review_default", "with l as (select id, arg_max(review_status, (loaded_at, row_id)) as label from provisions where review_status is not null group by 1) select p.row_id, coalesce(l.label, 'not_analyzed') as review_status from provisions p left join l using (id)")
def review_default(spark: SparkSession, d: str) -> DataFrame:
    """The last label that was given to any version of a provision, joined to all of them; without one, not analyzed."""
    p = table(spark, d, "provisions").select("row_id", "id", "review_status", "loaded_at")
    labels = p.where("review_status is not null").groupBy("id").agg(F.max_by("review_status", F.struct("loaded_at", "row_id")).alias("label"))
    return p.join(labels, "id", "left").select("row_id", F.coalesce("label", F.lit("not_analyzed")).alias("review_status"))


@query("generated_guard", "select count(*) filter (generated) as guarded, count(*) filter (not coalesce(generated, false)) as open from provisions")
def generated_guard(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "provisions").agg(F.count_if("generated").alias("guarded"), F.count_if(~F.coalesce("generated", F.lit(False))).alias("open"))


@query("quarantine", "select row_id, array_to_string(list_filter([case when markdown is null then 'body' end, case when lang is null then 'lang' end, case when not coalesce(regexp_matches(source_sha256, '^[0-9a-f]{64}$'), false) then 'sha' end], lambda x: x is not null), ',') as errors from provisions where markdown is null or lang is null or not coalesce(regexp_matches(source_sha256, '^[0-9a-f]{64}$'), false)")
def q_quarantine(spark: SparkSession, d: str) -> DataFrame:
    _, bad = quarantine(table(spark, d, "provisions"), {"body": F.col("markdown").isNotNull(), "lang": F.col("lang").isNotNull(), "sha": F.col("source_sha256").rlike("^[0-9a-f]{64}$")})
    return bad.select("row_id", F.array_join("errors", ",").alias("errors"))


@query("late_rows", "select row_id from provisions where loaded_at > exported_at + interval 1 day")
def late_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "provisions").where("loaded_at > exported_at + interval 1 day").select("row_id")


# ---- flagship ----
@query("provision_status", f"with p as {LATEST}, e as (select provision_id as id, arg_max(verb, (event_date, seq, verb)) as last_verb, max(event_date) as last_date, count(*) as n_events from {_EV} where event_date is not null group by 1), r as (select src_id as id, count(*) as n_refs, count(*) filter (resolved) as n_resolved from ref_edges group by 1) select p.id, p.row_id, {_STATUS} as status, e.last_verb, e.last_date, coalesce(e.n_events, 0) as n_events, coalesce(r.n_refs, 0) as n_refs, coalesce(r.n_resolved, 0) as n_resolved from p left join e using (id) left join r using (id)")
def provision_status(spark: SparkSession, d: str) -> DataFrame:
    """The latest version of every provision with its status, last gazette event and references."""
    p = latest(table(spark, d, "provisions").select("id", "row_id", "exported_at", temporal.status_of(F.col("markdown")).alias("status")))
    e = distinct_events(spark, d).where("event_date is not null").groupBy(F.col("provision_id").alias("id"))
    e = e.agg(F.max_by("verb", F.struct("event_date", "seq", "verb")).alias("last_verb"), F.max("event_date").alias("last_date"), F.count("*").alias("n_events"))
    r = table(spark, d, "ref_edges").groupBy(F.col("src_id").alias("id")).agg(F.count("*").alias("n_refs"), F.count_if("resolved").alias("n_resolved"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return p.join(e, "id", "left").join(r, "id", "left").select("id", "row_id", "status", "last_verb", "last_date", zero("n_events"), zero("n_refs"), zero("n_resolved"))
