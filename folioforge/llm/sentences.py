"""Sentence units across languages and scripts.

The standard sentence-break classes decide: terminators of every script (the Unicode property Sentence_Break=STerm), the
ambiguous full stop (ATerm), closing marks (Close), white space (Sp) and paragraph ends (ParaSep). A full stop needs
evidence: what stands before it (abbreviation of the text's language, initial, number, list marker) and what follows (case,
digit, opening mark). Quoted passages are passed over whole, in one step, so nothing inside them divides.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUOTES = {"“": "”", "«": "»", "„": "”“", "‹": "›", "「": "」", "『": "』", "《": "》", '"': '"'}
CLOSE = "])}）］】〕〉》」』”»›’\""
OPEN = "¿¡([{（［【“«「『„‹\"'‘"

#: Abbreviations after which a sentence goes on, by language. Fixed values.
GOES_ON = {
    "es": "no nos art arts fracc núm num párr parr inc lic ing dr dra sr sra srta dir gral edo av avda blvd prol col tel ext p ej pág pag págs cap tít secc exp ing arq mtro mtra prof cía cia sto sta fr ap apdo cfr vid vol",
    "en": "art sec no nos mr mrs ms dr prof st approx jan feb mar apr jun jul aug sep sept oct nov dec e.g i.e eg ie fig vol cf vs gen col capt ref",
    "fr": "art al no nos mme mlle m mm p ex sté ste cf chap fig vol av bd éd",
    "hi": "सं रु डॉ श्री कु",
    "de": "abs nr z b bzw dr prof art str",
}
#: Abbreviations that are also words: a sentence goes on only before a number, a numeral, a single letter or a sign.
BEFORE_NUMBERS = frozenset("no nos art arts al sec fig vol cap".split())
#: Abbreviations that may also end a sentence: they do if a capital, a digit or an opening mark follows.
MAY_END = frozenset("etc hrs inc ltd co corp a.m p.m s.a c.v r.l".split())
#: Of these, the ones that end a sentence where a text is all capitals and case tells nothing.
ENDS_IN_CAPS = frozenset(("etc", "c.v"))
#: Letters that continue a sentence after a closed quotation in scripts without case.
CONTINUES = frozenset("とをはがにのもでへや后後并並的、，,；;：:")

_COUNTED = re.compile(r"\s*(?:[^\w\s]|\d|[IVXLCDM]+\b|[^\W\d_]\b)")
_MARKER = re.compile(r"(?:[IVXLCDM]+|\d{1,3}|[^\W\d_])(?:\.-|\.|\))(?=\s)|\([^\W_]{1,4}\)(?=\s)")
_ROMAN = re.compile(r"[IVXLCDM]+")
_SINGLE = re.compile(r"[^\W\d_](?:\.[^\W\d_])+")
_TOKEN = re.compile(r"[^\s()\[\]{}«»“”\"¿¡,;:/]*$")
_LISTED = re.compile(r"[;:,]\s+(?:(?:y|e|o|u|and|or|et|ou)\s+)?$", re.I)
_NUMBERED = re.compile(r"(?:art|arts|núm|num|no|fracc|inc|sec|al|párr|parr|anexo|título|capítulo|sección|section|annex)\.?\s+$", re.I)
_LINE = re.compile("[^\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]+")
_LOWER = re.compile("[a-zß-öø-ÿ]")
_ORDINAL = re.compile(r"\d+[oa]")
_JOINED = re.compile(r"\s+(?:Y|E|O|U|ET|OU|AND|OR)\b")
_THAI = "[ก-๛]"


@cache
def abbreviations(lang: str | None) -> frozenset:
    """The abbreviations of a language (`es`, `es-MX`, in any case), those of all where it is not known."""
    own = GOES_ON.get(re.split("[-_]", (lang or "").strip().lower())[0])
    return frozenset((own or " ".join(GOES_ON.values())).split())


@cache
def terminators() -> str:
    """The characters of Sentence_Break=STerm in all scripts, and marks that end a sentence as they do."""
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, sys.maxunicode + 1))))
    return "".join(sorted({*regex.findall(r"\p{Sentence_Break=STerm}", every), *"…．｡"}))


_BEYOND = re.compile("[\U00010000-\U0010ffff]")


@cache
def _event(beyond: bool) -> re.Pattern:
    """What may end a unit. Texts with no character beyond the first plane have a pattern without those, which is faster."""
    t = re.escape("".join(c for c in terminators() if beyond or c < "\U00010000"))
    return re.compile(f"[.{t}]+|[{''.join(map(re.escape, QUOTES))}]|(?<={_THAI})[ \xa0]+(?={_THAI})")


@cache
def _kind(ch: str) -> str:
    """U upper or title case, l lower case, d digit, o another letter, '' anything else."""
    c = unicodedata.category(ch)
    return {"Lu": "U", "Lt": "U", "Ll": "l", "Nd": "d", "Nl": "d", "No": "d", "Lo": "o", "Lm": "o", "Mc": "o"}.get(c, "")


def _next_kind(line: str, at: int, end: int) -> str:
    while at < end:
        if k := _kind(line[at]):
            return k
        if line[at] in "-–—•*" or not (line[at].isspace() or line[at] in OPEN):
            return "U" if line[at] in "-–—•*" else ""
        at += 1
    return ""


def _capitals(text: str, start: int, dot: int) -> bool:
    """Whether the words just before are all capitals, so that case tells nothing."""
    return not _LOWER.search(text, max(start, dot - 14), dot)


def _stop_ends(text: str, start: int, dot: int, after: int, end: int, goes_on: frozenset) -> bool:
    """Whether the full stop at `dot` ends the unit that began at `start`; `after` is behind the closing marks."""
    ch = text[after]
    token = _TOKEN.search(text, max(start, dot - 40), dot).group()
    low = token.lower()
    if not ch.isspace():
        k = _kind(ch) or ("U" if ch in OPEN and ch != "[" and _next_kind(text, after, end) in ("U", "o") else "")
        if k not in ("U", "d", "o") or not token:
            return False
        tail = re.split(r"[.\-]", low)[-1]
        if k == "d":
            return tail.isalpha() and len(tail) > 2 and low not in goes_on
        if low in MAY_END:
            return k == "U" and _kind(text[after + 1 : after + 2] or " ") == "l" or low == "etc"
        if _SINGLE.fullmatch(low) or "@" in token or "//" in token:
            return False
        return (len(tail) > 2 or token[-1].isdigit()) and low not in goes_on
    k = _next_kind(text, after, end)
    if not k:
        return True
    if k == "l":
        return False
    if token and not text[start:dot].strip(" \t\xa0").strip(token) and _MARKER.match(token + ". "):
        return False  # the marker that opens the unit
    if low in MAY_END:
        if low == "s.a" and re.match(r"\s*de\b", text[after : after + 12], re.I):
            return False
        return low in ENDS_IN_CAPS or not _capitals(text, start, dot)
    if _SINGLE.fullmatch(low):
        return False
    if low in goes_on:
        return low in BEFORE_NUMBERS and not _COUNTED.match(text, after, end)
    before = text[max(start, dot - len(token) - 14) : dot - len(token)]
    if _ROMAN.fullmatch(token) or token.isdigit() and len(token) < 4 or len(token) == 1 and token.isalpha():
        if _LISTED.search(before) and not token.isdigit():
            return False  # a marker within the line
        if len(token) == 1 and token.isalpha():
            return bool(_ROMAN.fullmatch(token) and _NUMBERED.search(before)) or _kind(token) == "o"
    return not (token[-1:].isupper() and _ORDINAL.fullmatch(low))


def _line_units(text: str, begin: int, end: int, out: list, goes_on: frozenset, event: re.Pattern) -> None:
    while begin < end and text[begin].isspace():
        begin += 1
    while end > begin and text[end - 1].isspace():
        end -= 1
    if begin == end:
        return
    if text[begin] in ">#":
        out.append((begin, end))
        return
    start = begin
    at = m.end() if (m := _MARKER.match(text, begin, end)) else begin
    while at < end and (m := event.search(text, at, end)):
        mark, at = m.group(), m.end()
        quoted = False
        if mark in QUOTES:
            close = next((i for i in range(at, end) if text[i] in QUOTES[mark]), -1) if len(QUOTES[mark]) > 1 else text.find(QUOTES[mark], at, end)
            if close < 0:
                continue
            i = close - 1
            while i > at and (text[i].isspace() or text[i] in CLOSE):
                i -= 1
            at, quoted = close + 1, True
            if not event.match(text[i]) or text[i] in QUOTES:
                continue
            mark = text[i]
            while at < end and text[at] in CLOSE and text[at] != '"':
                at += 1
        elif mark[0] in " \xa0":
            out.append((start, m.start()))
            start = at
            continue
        else:
            while at < end and text[at] in CLOSE and not (text[at] == '"' and text.find('"', start, m.start()) < 0):
                at += 1
        if at >= end:
            break
        last = mark[-1]
        if quoted or last != ".":
            wide = ord(last) > 0x2000 and last not in "…‼⁇⁈⁉"
            k = _kind(text[at]) if not text[at].isspace() else _next_kind(text, at, end)
            if text[at] in CONTINUES or text[at] in ".":
                cut = False
            elif wide:
                cut = not quoted or text[at] not in CONTINUES
            elif text[at].isspace():
                cut = k != "l" and not (quoted and (k == "o" or _JOINED.match(text, at)))
            else:
                cut = k in ("U", "o") and not quoted or k == "U" or (k == "" and text[at] in "¿¡«“「(")
        elif len(mark) > 1:
            cut = text[at].isspace() and _next_kind(text, at, end) not in ("l",)
        else:
            cut = _stop_ends(text, start, m.start(), at, end, goes_on)
        if cut:
            out.append((start, at))
            start = at
            while start < end and text[start].isspace():
                start += 1
            at = start
            if m := _MARKER.match(text, at, end):
                at = m.end()
    if start < end:
        out.append((start, end))


def sentence_units(text: str | None, lang: str | None = None) -> list[tuple[int, int]]:
    """(start, end) of every unit in code points, in order, without surrounding white space. Null, empty and blank give none.

    All text but white space between units lies in exactly one unit. A line end always ends a unit; breadcrumb (`>`) and
    heading (`#`) lines are one unit each; a marker that opens a list item belongs to the item's first unit. Quotation marks
    that are never closed on their line divide nothing and hide nothing. Lone surrogates count as one character. `lang` picks
    the abbreviations; null and unknown languages have those of all.
    """
    out: list[tuple[int, int]] = []
    goes_on, event = abbreviations(lang), _event(bool(text and _BEYOND.search(text)))
    for m in _LINE.finditer(text or ""):
        _line_units(text, m.start(), m.end(), out, goes_on, event)
    return out


def _flat(batches):
    for batch in batches:
        starts, ends, counts = [], [], []
        for text, lang in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            units = sentence_units(text, lang)
            counts.append(len(units))
            starts += [a for a, _ in units]
            ends += [b for _, b in units]
        ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts)))
        yield pa.RecordBatch.from_arrays([ids, pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["row_id", "start_pos", "end_pos"])


def language(lang_col: str | None):
    """The column of languages as text, null without one."""
    return (F.lit(None) if lang_col is None else F.col(lang_col)).cast("string").alias("lang")


def sentences(df: DataFrame, id_col: str, text_col: str, lang_col: str | None = None) -> DataFrame:
    """(row_id, start_pos, end_pos): every sentence unit of every row; a narrow pass, without a shuffle.

    Null, empty and blank texts give no row. Rows with the same id each give their own units. `lang_col` holds languages in
    any spelling; null and unknown ones have the abbreviations of all. Other columns are ignored.
    """
    rows = df.select(F.col(id_col).cast("long").alias("row_id"), F.col(text_col).cast("string").alias("text"), language(lang_col)).where("text is not null")
    return rows.mapInArrow(_flat, "row_id long, start_pos int, end_pos int")
