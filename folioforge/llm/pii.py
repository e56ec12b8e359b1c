"""Personal information in free text: mentions with their kind, typed placeholders, linked pseudonyms.

Each kind has a cheap anchor that most texts lack (an at-sign, a run of digits, a street word, a label before a name);
patterns run only around anchors. Numbers are told from others by form, checks of their parts and labels. The placeholder
of a number keeps its format: digits and letters are permuted by a keyed Feistel network over the number's own alphabet,
so equal values get equal placeholders across documents without a table of them; dates inside stay dates.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import re
import unicodedata
from datetime import date, timedelta
from functools import cache, lru_cache, partial

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "phone", "id_number", "address", "name")

W = r"[ \t\xa0]*(?:\r\n|\r|\n)?[ \t\xa0]*"  # white space with one line end at most
S = r"(?:[ \t\xa0]+(?:\r\n|\r|\n)?[ \t\xa0]*|(?:\r\n|\r|\n)[ \t\xa0]*)"

# ---- e-mail ----
_AT = r"(?:@|＠|\[\s?(?:at|arroba)\s?\]|\(\s?(?:at|arroba)\s?\)|\{\s?at\s?\}|\barroba\b)"
_AT_SIGN = re.compile(_AT, re.I)
_DOT = r"(?:\.|\s?[\[(]\s?(?:dot|punto|point)\s?[\])]\s?|\s(?:punto|dot)\s)"
_LOCAL = re.compile(r"[A-Za-z0-9_%+\-]+(?:\.[A-Za-z0-9_%+\-]+)*(\s?)\Z")
_DOMAIN = re.compile(rf"(\s?)[A-Za-z0-9\-]+(?:{_DOT}[A-Za-z0-9\-]+)*{_DOT}[A-Za-z]{{2,}}(?![A-Za-z0-9])", re.I)

# ---- phone ----
_PHONE = re.compile(
    rf"(?<![\w.+\-/$#])(?:"
    rf"\+\d{{1,3}}(?:[ \t\xa0]?[.\-]?\(\d{{1,4}}\)|)(?:[ .\-][ \t\xa0]*?\d{{1,4}}|[ \t\xa0]\d{{1,4}}){{1,5}}"
    rf"|\+\d{{9,14}}"
    rf"|\(\d{{2,4}}\)[ \t\xa0]*\d{{3,4}}(?:[ .\-][ \t\xa0]*?|[ \t\xa0])\d{{3,4}}(?:[ .\-]\d{{2,4}})?"
    rf"|\d{{2,3}}(?:[ .\-]\d{{2,4}}|[ \t\xa0]\d{{2,4}}){{2,4}}"
    rf"|0052\d{{10}}|00\d{{10,13}}|\d{{10}}"
    r")(?![\w]|[.\-/]\d)"
)
_PHONE_LABEL = re.compile(r"(?:t[eé]l(?:[eé]fonos?|[eé]phone|ephone)?|telefono|celular|cel|m[oó]vil|mobile|phone|call|whats\s?app|fax|dial|ring|reached\s+on|llamar|marcar|marque|appeler|joindre|电话|电話|電話|手机|โทร|หรือ|फ़ोन|मोबाइल)[\s.:\"'）)]*(?:n[uú]m(?:ero)?\.?|no\.?|al|on|at|à|a|au)?[\s.:\"'（]*\Z", re.I)
_AFTER_MAIL = re.compile(r"(?:[\w\])][,，、;/|]|หรือ|\bor(?:\s+call)?|\bo)\s*\Z")
_NOT_PHONE = re.compile(r"(?:folio|expediente|clave(?:\s+presupuestal)?|isbn|issn|huella|oficio|n[uú]m(?:ero)?\.?|no\.|ventanilla|versi[oó]n|importe|cuenta|factura|referencia|contrato|nss|social:?|ticket|p[aá]gina|columna|id|doc|ref)[\s.:#nN°ºo]*\Z", re.I)

# ---- identity numbers ----
_ID = re.compile(
    r"(?<![\w\-/])(?:"
    r"(?P<curp>[A-Z]{4}-?\d{6}-?[HMX][A-Z]{5}-?[A-Z0-9]\d)"
    r"|(?P<voter>[A-Z]{6}\d{8}[HM]\d{3})"
    r"|(?P<rfc>[A-ZÑ&]{4}[- ]?\d{6}[- ]?[A-Z0-9]{2}[A0-9])"
    r"|(?P<nss>\d{2}-\d{2}-\d{2}-\d{4}-\d)"
    r"|(?P<nss11>\d{11})"
    r"|(?P<passport>[A-Z]{1,2}\d{7,8})"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4})"
    r")(?![\w]|-\d)"
)
_ID_LABEL = re.compile(r"(?:nss|seguridad\s+social|social\s+security|s[eé]curit[eé]\s+sociale|imss|pass?port|pasaporte|passeport|elector|curp|r\.?f\.?c\.?|ine|ssn|护照|旅券|パスポート|पासपोर्ट|หนังสือเดินทาง)[\s.:,]*(?:(?:n[uú]m(?:ero)?|no|n[°º]|number|num[eé]ro)[\s.:]*)?(?:de\s+)?[\s:\"|(]*\Z", re.I)

# ---- addresses ----
_STREET = r"(?:C\.|Calle|Av\.|Avda\.|Avenida|Blvd\.|Bulevar|Boulevard|Calz\.|Calzada|Cda\.|Cerrada|Privada|Priv\.|Prol\.|Prolongaci[oó]n|Andador|And\.|Paseo|Circuito|Callej[oó]n|Cjón\.|Carretera|Camino|Retorno|Rinconada|V[ií]a)"
_CAP = r"(?:[A-ZÁÉÍÓÚÑÜ][\w'’]+)"
_MONTH = r"(?:enero|febrero|marzo|abril|mayo|junio|julio|agosto|sep?tiembre|octubre|noviembre|diciembre)"
_ADDRESS = re.compile(
    rf"(?<!\w)(?i:{_STREET}){W}(?:"
    rf"\d{{1,2}}{S}(?i:de){S}(?i:{_MONTH})"
    rf"|(?:(?i:de{S}(?:las?|los|el)|del|de|las?|los){S})?{_CAP}(?:{S}(?:(?i:de(?:l|{S}las?|{S}los)?|y){S})?{_CAP}){{0,4}}"
    rf"),?{W}(?:(?i:n[uú]m(?:ero)?\.?|no\.|n[°º]\.?|#){W})?(?:\d{{1,5}}(?:-?[A-Z](?![a-zá-ú]))?(?!\w)|(?i:s/n)(?!\w))"
)
_STREET_ANCHOR = re.compile(rf"(?<!\w)(?:{_STREET})(?=\W)", re.I)
_EN_STREET = re.compile(rf"(?<![\w\-.,/])\d{{1,5}}(?:-?[A-Z])?{S}{_CAP}(?:{S}{_CAP}){{0,3}}{S}(?i:Street|St\.|Road|Rd\.|Avenue|Ave\.|Lane|Ln\.|Drive|Dr\.|Boulevard|Blvd\.|Court|Ct\.|Way|Place|Pl\.|Terrace|Square|Row|Crescent|Close)(?!\w)")
_FR_STREET = re.compile(rf"(?<![\w\-.,/])\d{{1,5}}(?:{S}?(?i:bis|ter|quater))?,?{S}(?i:rue|avenue|av\.|boulevard|bd|impasse|place|chemin|all[eé]e|quai|route|cours|passage|square)(?:{S}(?i:de{S}la|des|du|de|d['’]|l['’]))?{W}{_CAP}(?:[ \-]{_CAP}){{0,3}}")

# ---- names ----
_UP = "A-ZÁÉÍÓÚÑÜÇÀÂÈÊËÎÏÔÙÛŸŒ"
_NAME_WORD = rf"[{_UP}](?:[\w'’\-]*\w)?"
_B = r"[ \t\xa0]+"
_PART = rf"(?:de(?:{_B}(?:la|los|las))?|del|van|von|di|da|DE|DEL)"
#: Given name(s) and surname(s), with particles and initials, on one line; an inverted form has a comma.
_NAME = rf"{_NAME_WORD}(?:{_B}(?:[{_UP}]\.(?={_B}[{_UP}])|(?:{_PART}{_B})?{_NAME_WORD})){{1,5}}"
_INVERTED = rf"{_NAME_WORD}(?:{_B}(?:{_PART}{_B})?{_NAME_WORD}){{0,3}},{_B}{_NAME_WORD}(?:{_B}{_NAME_WORD})?"
#: Words that a capital makes no name: titles, roles, institutions. Fixed values.
_TITLE = r"(?:(?:Lic|Ing|Dr|Dra|Sr|Sra|Srta|Mtro|Mtra|Arq|Prof|Profa|C|CC|Mr|Mrs|Ms|Miss|Mme|M|Mlle|Me)\.|Mme|Mlle|Maître|don|doña|Don|Doña|el\s+señor|la\s+señora|señor|señora|el\s+suscrito|la\s+suscrita|suscrito|suscrita|ciudadano|ciudadana)"
#: What stands before a name: a literal to look for, and the pattern from there to the name.
_LEADS = [(w, re.compile(rf"{p}(?:{_TITLE}{S})*")) for w, p in (
    *((w, rf"{w}\w*(?:{S}(?:el|la|a|por|de))?{S}") for w in ("Compareci", "Declara", "firma ", "presentad", "pregunte por", "inmueble de", "propiedad de", "escrito de", "turnado a", "signado por", "suscrito por")),
    *((w, w.replace(" ", S) + rf"{W}:?{S}") for w in ("Filed by", "Signed by", "go to", "posé par", "posee par", "émoin", "Atentamente,", "Atentamente", "Signed", "Signé")),
    *((w, rf"{w}\w*{W}:{S}") for w in ("Witness", "Contact", "ombre:"[:-1], "NOMBRE", "Nom", "ame:"[:-1], "irmante", "itular", "romovente", "olicitante", "estigo")),
    *((f'"{w}"', rf'"{w}":{W}"') for w in ("solicitante", "nombre", "name", "promovente", "titular", "nom", "firmante", "testigo", "persona")),
    *((f"{w} ", rf"(?<!\w){re.escape(w)}{S}") for w in "Lic. Ing. Dr. Dra. Sr. Sra. Srta. Mtro. Mtra. Arq. Prof. Profa. C. Mr. Mrs. Ms. Mme. Mlle. Me. Mme Mlle don doña Don Doña señor señora suscrito suscrita ciudadano ciudadana".split()),
    ("|", rf"(?<![^\n\r])\|{W}"),
)]
_LISTED = re.compile(rf"(?:Testigos|Comparecientes|Witnesses|Firmantes|T[eé]moins){W}:{W}", re.I)
_NAME_AT, _INVERTED_AT = re.compile(_NAME), re.compile(_INVERTED)
_NO_NAME = frozenset(
    "junta direccion comision secretaria instituto fideicomiso tribunal registro consejo comite sociedad empresa compania banco oficina office board commission tribunal conseil greffe secretariat registry company inc corp ltd ley codigo reglamento articulo capitulo titulo seccion expediente importe acuerdo villa puerto edo estado municipio ciudad colonia calle avenida blvd calzada cerrada privada andador el la los las un una nombre correo solicitante nss rfc curp pasaporte passport".split()
)
#: Common given names of the languages in the texts, from general knowledge and not from the test data. One opens a name
#: without a label, whatever the surnames, or follows the comma of an inverted one. Fixed values.
_GIVEN = frozenset(
    "jose juan luis carlos jesus francisco pedro miguel antonio manuel alejandro jorge javier fernando ricardo eduardo roberto sergio rafael daniel arturo enrique raul alberto ramon andres pablo diego oscar mario hector victor gerardo guillermo armando gustavo alfredo ernesto felipe ignacio julio rodrigo tomas maria ana guadalupe rosa carmen laura patricia leticia elena gabriela martha silvia lucia alicia claudia veronica adriana monica isabel teresa beatriz josefina sofia andrea julia ines cecilia margarita lourdes norma irma diana susana raquel "
    "john james robert michael william david richard thomas charles christopher matthew anthony mark steven paul andrew joshua kevin brian george edward peter henry mary jennifer linda elizabeth barbara susan jessica sarah karen nancy margaret lisa betty dorothy emily anna alice jane helen "
    "jean pierre michel philippe alain jacques bernard francois nicolas laurent christophe antoine guillaume julien marie nathalie isabelle sylvie catherine francoise monique sophie christine camille claire".split()
)
#: Roles and the like that follow a name and its comma; what stands there is no given name. Fixed values.
_ROLE = frozenset(
    "director directora subdirector subdirectora secretario secretaria presidente presidenta juez jueza magistrado magistrada gerente apoderado apoderada abogado abogada representante titular jefe jefa coordinador coordinadora notario notaria perito perita actuario actuaria general regional delegado delegada oficial asesor asesora contador contadora licenciado ingeniero doctor doctora arquitecto senador senadora diputado diputada gobernador gobernadora rector rectora mayor menor "
    "manager secretary president judge attorney counsel chair chairman officer director head clerk notary esq jr sr "
    "directeur directrice president juge avocat avocate notaire greffier greffiere gerant gerante".split()
)
#: What follows an inverted name: the end of a line, cell or bracket, a mark, or a word in lower case.
_INVERTED_END = re.compile(r"[ \t\xa0]*(?:[\n\r,;.()|\"”»:]|\Z)|[ \t\xa0]+[^\W\d_A-ZÁÉÍÓÚÑÜ]")
_AND_MORE = re.compile(rf"{W}(?:,{W}|{S}(?:y|e|and|et){S})[{_UP}][a-zà-ÿ][\w'’\-]*[ \t\xa0]+[{_UP}][a-zà-ÿ]")
#: Words before a given name that make it a place or an institution. Fixed values.
_PLACE = frozenset("san santa santo hospital escuela universidad plaza parque saint st".split())
_NOT_BEFORE = _NO_NAME | _GIVEN | _PLACE
_CAPITALISED = re.compile(rf"(?<!\w)[{_UP}]\w{{2,}}")
_FREE = re.compile(_NAME + rf"(?:,{_B}{_NAME_WORD}(?:{_B}{_NAME_WORD})?)?")
_BACK = re.compile(rf"(?<![\w.@\-])([{_UP}](?:[\w'’\-]*\w|\.)){_B}(?:{_PART}{_B})?\Z")
_NEXT_LISTED = re.compile(rf"{W}(?:,|\by\b|\band\b|\bet\b|;){W}(?:y{S}|and{S}|et{S})?")
_COMPANY = re.compile(rf"{W},?{W}(?:S\.{W}A\.|S\.{W}de|Inc\.|Ltd|Corp)")


class Spans:
    """Spans without overlaps, in order; whether one is free is a search among the sorted ones."""

    def __init__(self):
        self.sorted: list[tuple[int, int, str]] = []

    def free(self, a: int, b: int) -> bool:
        i = bisect.bisect_left(self.sorted, (b,))  # the first that begins at b or behind it
        return i == 0 or self.sorted[i - 1][1] <= a

    def add(self, spans, kind: str) -> None:
        for a, b in spans:
            if self.free(a, b):
                bisect.insort(self.sorted, (a, b, kind))

    def ends_within(self, kind: str, low: int, high: int) -> bool:
        """Whether a span of this kind ends in [low, high]."""
        i = bisect.bisect_left(self.sorted, (high,))
        return any(k == kind and low <= b <= high for _, b, k in self.sorted[max(0, i - 2) : i])


def _emails(text: str):
    if not ("@" in text or "arroba" in text or "ARROBA" in text or "＠" in text or "at]" in text or "at)" in text or "at}" in text):
        return
    for m in _AT_SIGN.finditer(text):
        left = _LOCAL.search(text, max(0, m.start() - 80), m.start())
        right = _DOMAIN.match(text, m.end())
        if left and right and (m.group() not in "@＠" or bool(left[1]) == bool(right[1])):
            yield left.start(), right.end()


_ID_ANCHOR = re.compile(r"[0-9]{6,}|[0-9][0-9]-[0-9][0-9]-[0-9][0-9]-[0-9]{4}-[0-9]|[0-9]{3}-[0-9][0-9]-[0-9]{4}")
_NUMBER = re.compile(r"[0-9](?:[0-9.\-() \t\xa0]{6,}[0-9])")


@lru_cache(1 << 16)
def _is_date(digits: str) -> bool:
    """Whether two digits each of year, month and day are a date, in either century."""
    for century in (1900, 2000):
        try:
            date(century + int(digits[:2]), int(digits[2:4]), int(digits[4:]))
            return True
        except ValueError:
            continue
    return False


def _ids(text: str):
    done = 0
    for anchor in _ID_ANCHOR.finditer(text):
        m = _ID.search(text, max(done, anchor.start() - 8), anchor.end() + 12)
        if not m:
            continue
        done = m.end()
        before = text[max(0, m.start() - 48) : m.start()]
        kind = m.lastgroup
        if kind in ("curp", "rfc"):
            digits = re.search(r"\d{6}", m.group()).group()
            ok = _is_date(digits) or bool(_ID_LABEL.search(before))
        elif kind in ("voter", "nss"):
            ok = True
        else:
            cell = before.rstrip(" ").endswith("|") and text[m.end() : m.end() + 2].strip(" ")[:1] == "|"
            ok = cell or bool(_ID_LABEL.search(before))
        if ok:
            yield m.start(), m.end()


def _phones(text: str, taken: Spans):
    spans = (x.span() for x in _NUMBER.finditer(text) if x.end() - x.start() > 7)
    for m in (m for a, b in spans for m in _PHONE.finditer(text, max(0, a - 2), b)):
        a, b = m.start(), m.end()
        if a and (text[a - 1].isalnum() or text[a - 1] in "_.+-/$#") or text[b : b + 1].isalnum():
            continue
        if not taken.free(a, b):
            continue
        value, before = m.group(), text[max(0, a - 44) : a]
        digits = sum(c.isdigit() for c in value)
        if not 8 <= digits <= 15 or _ID_LABEL.search(before):
            continue
        labelled = bool(_PHONE_LABEL.search(before))
        mailed = bool(_AFTER_MAIL.search(before)) and taken.ends_within("email", a - 16, a)
        if not labelled and not mailed:
            if _NOT_PHONE.search(before):
                continue
            groups = re.findall(r"\d+", value)
            if value[0] in "+(":
                pass
            elif re.fullmatch(r"(?:01|0\d{1,3})[ .\-]\d{3}[ .\-]\d{3}[ .\-]?\d{4}", value) or value.startswith("0052"):
                pass
            elif len(groups) in (3, 4) and digits == 10 and len(groups[-1]) == 4:
                pass
            else:
                continue
        yield a, b


#: Spellings of the Spanish street words, each looked for as it stands: most texts have none.
_STREET_WORDS = sorted({f(w) for w in "C. |Calle|Av. |Avda.|Avenida|Blvd.|Bulevar|Boulevard|Calz.|Calzada|Cda.|Cerrada|Privada|Priv.|Prol.|Prolongaci|Andador|And. |Paseo|Circuito|Callej|Carretera|Camino|Retorno|Rinconada|Via |Vía |C.\xa0|Av.\xa0|C.\n|Av.\n".split("|") for f in (str, str.upper, lambda w: w[0].lower() + w[1:])})
_LIST_WORDS = ("estigos", "omparecientes", "itnesses", "irmantes", "émoins")
_EN_WORDS, _FR_WORDS = ("Street", " St.", "Road", " Rd", "Avenue", " Ave", "Lane", " Ln", "Drive", " Dr", "Boulevard", "Blvd", "Court", " Ct", " Way", "Place", " Pl", "Terrace", "Square", "Row", "Crescent", "Close"), ("rue ", "Rue ", "venue ", "av. ", "oulevard ", "bd ", "impasse ", "place ", "chemin ", "llée ", "quai ", "route ", "cours ", "passage ", "square ")


@cache
def _anchors() -> ahocorasick.Automaton:
    """All literal words that patterns start from, for one pass over a text: word -> (its length, what it is for)."""
    uses: dict[str, list[tuple[str, int]]] = {}
    for i, (word, _) in enumerate(_LEADS):
        uses.setdefault(word, []).append(("lead", i))
    for kind, words in (("street", _STREET_WORDS), ("en", _EN_WORDS), ("fr", _FR_WORDS), ("list", _LIST_WORDS)):
        for word in words:
            uses.setdefault(word, []).append((kind, 0))
    found = ahocorasick.Automaton()
    for word, tags in uses.items():
        found.add_word(word, (len(word), tags))
    found.make_automaton()
    return found


class Places:
    """Where the anchors of a text stand."""

    def __init__(self, text: str):
        self.leads: dict[int, list[int]] = {}
        self.streets: list[int] = []
        self.kinds: set[str] = set()
        for end, (n, tags) in _anchors().iter(text):
            for kind, i in tags:
                if kind == "lead":
                    self.leads.setdefault(i, []).append(end - n + 1)
                elif kind == "street":
                    self.streets.append(end - n + 1)
                else:
                    self.kinds.add(kind)
        self.streets.sort()


def _addresses(text: str, places: Places):
    for at in places.streets:
        if m := _ADDRESS.match(text, at):
            yield m.span()
    for kind, pattern in (("en", _EN_STREET), ("fr", _FR_STREET)):
        if kind in places.kinds:
            for m in pattern.finditer(text):
                yield m.span()


@lru_cache(1 << 16)
def _plain(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word.lower()) if unicodedata.category(c) != "Mn")


def _words(text: str, a: int, b: int) -> list[str]:
    return [w.strip(",.") for w in text[a:b].split()]


def _is_name(text: str, a: int, b: int) -> bool:
    words = [w for w in _words(text, a, b) if w[:1].isupper() and w.upper() not in ("DE", "DEL", "Y")]
    return len(words) >= 2 and not any(_plain(w) in _NO_NAME for w in words) and not _COMPANY.match(text, b)


def _inverted(text: str, at: int) -> int | None:
    """Where a name `Surname Surname, Given` that begins at `at` ends.

    One word before the comma is no whole name, so the given name follows. Two or more are surnames if none of them is a
    common given name and what follows the comma is one or two words, no role, with nothing else of the name behind them;
    `A B, C D and E F` are whole names.
    """
    if not (m := _INVERTED_AT.match(text, at)):
        return None
    head, tail = text[at : m.end()].split(",", 1)
    surnames = [w for w in head.split() if w.lower() not in ("de", "del", "la", "las", "los")]
    given = tail.split()
    if len(surnames) == 1:
        return m.end()
    if _plain(surnames[0]) in _GIVEN or any(_plain(w) in _ROLE or _plain(w) in _NO_NAME for w in given):
        return None
    if len(given) == 2 and _AND_MORE.match(text, m.end()):
        return None
    return m.end() if _plain(given[0]) in _GIVEN or len(surnames) == 2 and _INVERTED_END.match(text, m.end()) else None


def _name_at(text: str, at: int, inverted: bool = True) -> tuple[int, int] | None:
    """The name that begins at `at`."""
    if inverted and (end := _inverted(text, at)):
        return at, end
    return m.span() if (m := _NAME_AT.match(text, at)) else None


def _names(text: str, places: Places):
    if "list" in places.kinds:
        for m in _LISTED.finditer(text):
            at = m.end()
            while found := _name_at(text, at, inverted=False):
                yield found
                step = _NEXT_LISTED.match(text, found[1])
                if not step:
                    break
                at = step.end()
    for i in sorted(places.leads):
        for at in places.leads[i]:
            if (m := _LEADS[i][1].match(text, at)) and (found := _name_at(text, m.end())):
                yield found
    for m in _CAPITALISED.finditer(text):  # without a label: a common given name opens a name
        if _plain(m.group()) in _GIVEN:
            p = _BACK.search(text, max(0, m.start() - 40), m.start())
            before = _plain(p.group(1)) if p else ""
            if before not in _NOT_BEFORE and (found := _NAME_AT.match(text, m.start())):
                yield found.span()


def find_mentions(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every mention, in order, without overlaps; null and empty texts have none."""
    if not text:
        return []
    taken, places = Spans(), Places(text)
    taken.add(_emails(text), "email")
    if _DIGITS.search(text):
        taken.add(_ids(text), "id_number")
        taken.add(_phones(text, taken), "phone")
    taken.add(_addresses(text, places), "address")
    taken.add((s for s in _names(text, places) if _is_name(text, *s)), "name")
    return taken.sorted


_DIGITS = re.compile(r"\d{2}")


# ---- pseudonyms ----
class Feistel:
    """A keyed permutation of the numbers below `size`: a balanced Feistel network, walked until it stays below."""

    def __init__(self, key: bytes, size: int, tweak: str = ""):
        self.key, self.size, self.tweak = key, size, tweak.encode()
        self.half = max(1, ((size - 1).bit_length() + 1) // 2)

    def _round(self, i: int, x: int) -> int:
        d = hmac.new(self.key, self.tweak + bytes([i]) + x.to_bytes(16, "big"), hashlib.sha256).digest()
        return int.from_bytes(d[:16], "big") & ((1 << self.half) - 1)

    def _once(self, x: int, rounds) -> int:
        left, right = x >> self.half, x & ((1 << self.half) - 1)
        for i in rounds:
            left, right = right, left ^ self._round(i, right)
        return right << self.half | left

    def permute(self, x: int) -> int:
        x = self._once(x, range(8))
        while x >= self.size:
            x = self._once(x, range(8))
        return x

    def restore(self, x: int) -> int:
        x = self._once(x, range(7, -1, -1))
        while x >= self.size:
            x = self._once(x, range(7, -1, -1))
        return x


_FIRST_DAY, _DAYS = date(1920, 1, 1), (date(2020, 1, 1) - date(1920, 1, 1)).days
_DATED = re.compile(r"(?<![A-Z0-9])([A-ZÑ&]{4,6}-?)(\d{6})(?=-?[HMX0-9A-Z])")


@lru_cache(1 << 12)
def _network(key: bytes, size: int, tweak: str) -> Feistel:
    return Feistel(key, size, tweak)


def _day(digits: str) -> int | None:
    """Days since the first day of a two-digit-year date, or None if it is none."""
    try:
        y = int(digits[:2])
        d = date(2000 + y if y < 20 else 1900 + y, int(digits[2:4]), int(digits[4:]))
    except ValueError:
        return None
    return (d - _FIRST_DAY).days


_CURP_SIGNS = "0123456789ABCDEFGHIJKLMNÑOPQRSTUVWXYZ"
_RFC_SIGNS = "0123456789ABCDEFGHIJKLMN&OPQRSTUVWXYZ Ñ"


_CURP = re.compile(r"[A-Z]{4}\d{6}[HMX][A-Z]{5}[A-Z0-9]\d")
_RFC = re.compile(r"[A-ZÑ&]{4}\d{6}[A-Z0-9]{2}[A0-9]")
_NSS = re.compile(r"\d{11}")
_BLANK = re.compile(r"[\s\-]")


def check_sign(plain: str) -> str | None:
    """The check sign that belongs to a CURP (18 signs), an RFC (13) or a social security number (11 digits); None for others.

    The sign that is there doesn't matter, only that it is one such a number may end with.
    """
    if _CURP.fullmatch(plain):
        return str(-sum(_CURP_SIGNS.index(c) * (18 - i) for i, c in enumerate(plain[:17])) % 10)
    if _RFC.fullmatch(plain):
        n = -sum(_RFC_SIGNS.index(c) * (13 - i) for i, c in enumerate(plain[:12])) % 11
        return "A" if n == 10 else str(n)
    if _NSS.fullmatch(plain):
        return str(-sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(plain[:10])) % 10)
    return None


def is_checked(value: str) -> bool | None:
    """Whether the check sign of a number is right; None for a number without one."""
    plain = _BLANK.sub("", value)
    sign = check_sign(plain)
    return None if sign is None else plain[-1] == sign


def _is_dated(value: str) -> bool:
    m = _DATED.match(value)
    return bool(m) and _day(m[2]) is not None


def pseudonym(value: str, key: bytes, back: bool = False) -> str:
    """The value's digits and capitals permuted within their places; marks, spaces and lower case stay.

    A date of birth inside an identity number becomes another valid date; a number with a right check sign becomes one
    with a right check sign, and one with a wrong sign or date stays so. One to one for values of the same format, and
    reversible with the key (`back`).
    """
    right, dated = is_checked(value), _is_dated(value)
    out = value
    while True:  # a permutation of all values of the format, walked on until the value is of the same sort again
        if right:
            body = _permuted(out, key, back, dated, 1)
            out = body[:-1] + check_sign(_BLANK.sub("", body))
        else:
            out = _permuted(out, key, back, dated, 0)
        if is_checked(out) == right and _is_dated(out) == dated:
            return out


def _alphabets(value: str) -> list[str]:
    """The signs that may stand at each place, one where the sign stays."""
    out = [_DIGIT_SIGNS if "0" <= c <= "9" else _CAPITALS if "A" <= c <= "Z" else c for c in value]
    plain = [i for i, c in enumerate(value) if not _BLANK.match(c)]
    bare = "".join(value[i] for i in plain)
    if _CURP.fullmatch(bare):
        out[plain[10]] = "HMX"
    elif _RFC.fullmatch(bare) and bare[-1] == "A":
        out[plain[-1]] = "A"
    return out


_DIGIT_SIGNS, _CAPITALS = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _permuted(value: str, key: bytes, back: bool, dated: bool, kept: int) -> str:
    """One step of the keyed permutation; the last `kept` signs stay, and with `dated` the date goes to another date."""
    out, signs = list(value), _alphabets(value)
    free = [i for i in range(len(value) - kept) if len(signs[i]) > 1]
    if dated:
        m = _DATED.match(value)
        net = _network(key, _DAYS, "date")
        n = _day(m[2])
        d = _FIRST_DAY + timedelta(days=net.restore(n) if back else net.permute(n))
        out[m.start(2) : m.end(2)] = d.strftime("%y%m%d")
        free = [i for i in free if not m.start(2) <= i < m.end(2)]
    size, x = 1, 0
    for i in free:
        size, x = size * len(signs[i]), x * len(signs[i]) + signs[i].index(value[i])
    if size > 1:
        shape = f"{kept}{dated}" + "".join(s if len(s) == 1 else {10: "9", 26: "A"}.get(len(s), "S") for s in signs[: len(value) - kept])
        net = _network(key, size, shape)
        x = net.restore(x) if back else net.permute(x)
        for i in reversed(free):
            x, r = divmod(x, len(signs[i]))
            out[i] = signs[i][r]
    return "".join(out)


def placeholder(value: str, kind: str, key: bytes) -> str:
    """`[KIND:token]`: numbers keep their format, other mentions get a short keyed token; equal values, equal tokens."""
    if kind in ("phone", "id_number"):
        token = pseudonym(value, key)
    else:
        same = " ".join(value.split()).casefold()
        token = hmac.new(key, f"{kind}\x00{same}".encode("utf-8", "surrogatepass"), hashlib.sha256).hexdigest()[:10]
    return f"[{kind.upper()}:{token}]"


def redact(text: str | None, key: bytes) -> str | None:
    """The text with a typed placeholder for each mention and otherwise unchanged; null stays null."""
    if text is None:
        return None
    out, at = [], 0
    for a, b, kind in find_mentions(text):
        out += [text[at:a], placeholder(text[a:b], kind, key)]
        at = b
    return "".join(out) + text[at:]


def _mentions(batches, key: bytes):
    token = lru_cache(1 << 16)(partial(placeholder, key=key))
    for batch in batches:
        rows, kinds, values, starts, tokens = [], [], [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            for a, b, kind in find_mentions(text):
                rows.append(i), kinds.append(kind), values.append(text[a:b]), starts.append(a), tokens.append(token(text[a:b], kind))
        ids = batch.column(0).take(pa.array(rows, pa.int64()))
        cells = [pa.array(kinds, pa.string()), pa.array(values, pa.string()), pa.array(starts, pa.int32()), pa.array(tokens, pa.string())]
        yield pa.RecordBatch.from_arrays([ids, *cells], ["doc_id", "kind", "value", "start_pos", "placeholder"])


def _redacted(batches, key: bytes):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([redact(t, key) for t in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def personal_mentions(df: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, kind, value, start_pos, placeholder) of every mention, with its typed placeholder under `key`; a narrow pass.

    Null, empty and blank texts give no row; repeated rows each give theirs; other columns are ignored; whole texts are
    read, however long.
    """
    return _rows(df, id_col, text_col).where("text is not null").mapInArrow(partial(_mentions, key=key), "doc_id long, kind string, value string, start_pos int, placeholder string")


def redacted_texts(df: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of every row, mentions replaced by typed placeholders under `key`; null texts stay null."""
    return _rows(df, id_col, text_col).mapInArrow(partial(_redacted, key=key), "doc_id long, text string")
