"""PII: keyed surrogates of the same type, format, script and gender, distinct and the same wherever an entity recurs."""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, forget, join_by_key, settle

#: Entities whose surrogate had to be drawn again that may be broadcast; more are joined to the texts that hold them.
MAX_BROADCAST = 100_000
#: Draws of a surrogate in the entity's own format; after as many again it gets a character or syllable more, and so on.
PATIENCE = 4

# Given names by gender and script, and titles that precede a name, by the gender that they tell.
GIVEN = {
    ("latin", "f"): "Anna Maria Laura Julia Emma Clara Sophie Alice Elena Lucia Marta Ines Sarah Mary Linda Susan Karen Emily Helen Grace Carmen Pilar Isabel Camille Chloe Manon Monika Petra Sabine Ursula Jennifer Jessica Elizabeth Patricia Barbara Margaret Lisa Nancy Sandra Ashley Claire Juliette Nathalie Brigitte Martina Heike Katrin Andrea Teresa Lucía".split(),
    ("latin", "m"): "John James Peter Paul David Mark Thomas Daniel Martin Robert Michael William George Henry Louis Pierre Jean Luc Hugo Hans Klaus Stefan Jürgen Karl Carlos Juan José Luis Miguel Pedro Richard Joseph Charles Christopher Matthew Anthony Andrew Steven Kevin Brian François Philippe Antoine Wolfgang Dieter Uwe Javier Antonio Manuel Francisco".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Ирина Наталья Татьяна Светлана Юлия Екатерина".split(),
    ("cyrillic", "m"): "Иван Пётр Алексей Дмитрий Сергей Андрей Николай Михаил Владимир Павел".split(),
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Σοφία Άννα Ιωάννα".split(),
    ("greek", "m"): "Γιώργος Δημήτρης Νίκος Κώστας Γιάννης Παύλος".split(),
}
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Sir": "m", "Madam": "f", "Herr": "m", "Herrn": "m", "Frau": "f", "M": "m", "Monsieur": "m",
    "Mme": "f", "Mlle": "f", "Madame": "f", "Sr": "m", "Sra": "f", "Srta": "f", "Señor": "m", "Señora": "f", "Don": "m", "Doña": "f",
    "г-н": "m", "г-жа": "f", "господин": "m", "госпожа": "f", "κ": "m", "κα": "f", "κύριος": "m", "κυρία": "f",
}
SYLLABLES = {
    "latin": ["bel", "dor", "fan", "gri", "hal", "jor", "kel", "lin", "mar", "nov", "per", "ros", "sel", "tan", "vel", "wen"],
    "cyrillic": ["бел", "дор", "фан", "гри", "хал", "жор", "кел", "лин", "мар", "нов", "пер", "рос", "сел", "тан", "вел", "зим"],
    "greek": ["βελ", "δορ", "φαν", "γρι", "χαλ", "κελ", "λιν", "μαρ", "νοβ", "περ", "ροσ", "σελ", "ταν", "θεμ", "ζαν", "μιλ"],
}
ENDINGS = {("latin", "f"): "a", ("latin", "m"): "o", ("cyrillic", "f"): "а", ("cyrillic", "m"): "", ("greek", "f"): "η", ("greek", "m"): "ος"}
GENDER = {n.casefold(): (s, g) for (s, g), names in GIVEN.items() for n in names}

WORD = r"[^\W\d_]"
NAME = rf"{WORD}[^\W\d_'’]*(?:[-'’]{WORD}+)?"
#: What stands before and after the @ of an address, sought within the lengths that addresses may have.
LOCAL = re.compile(r"(?<![\w.%+\-])[\w.%+\-]{1,64}$")
DOMAIN = re.compile(r"(?:[A-Za-z0-9\-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z])")
#: Digits with no more than GAP characters between them, four at least, may be a number; an entity reaches no further than REACH beyond them.
GAP, REACH = 8, 48
PHONE = re.compile(r"(?<![\w.+])(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .\-]\d{3,4}[ .\-]\d{3,4}(?:[ .\-]\d{2,4})?(?![\w]|\.\d)|(?<![\w+])\+\d{8,14}(?!\w)")
IP = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\w|\.\d)")
CARD = re.compile(r"(?<![\w.])\d(?:[ \-]?\d){12,18}(?!\w|\.\d)")
#: How the numbers of card issuers begin, and their lengths.
ISSUER = re.compile(r"4(?:\d{12}|\d{15}|\d{18})|(?:5[1-5]|2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720))\d*(?<=^.{16})|3[47]\d{13}|3(?:0[0-5]|[68]\d)\d{11}|35(?:2[89]|[3-8]\d)\d{12}|6(?:011|4[4-9]\d|5\d\d|2\d\d)\d{12,15}")
#: No number is given out with an area of 000, 666 or 9xx, a group of 00 or a serial of 0000.
SSN = re.compile(r"(?<![\w\-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w\-])")
IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
SECRET_WORDS = ("token", "secret", "password", "passwd", "api_key", "api-key", "apikey")
SECRET = re.compile(r"(?i)\b(?:token|secret|password|passwd|api[_-]?key)\b\s{0,9}[:=]\s{0,9}[\"']?([A-Za-z0-9_\-]{12,})")
#: Credentials that show by their own form: (what every one of them holds, pattern whose group is replaced).
KEYS = [
    ("AKIA", re.compile(r"\bAKIA([0-9A-Z]{16})\b")),
    ("ghp_", re.compile(r"\bghp_([A-Za-z0-9]{36})\b")),
    ("github_pat_", re.compile(r"\bgithub_pat_([A-Za-z0-9_]{50,100})\b")),
    ("glpat-", re.compile(r"\bglpat-([A-Za-z0-9_\-]{20,40})\b")),
    ("xox", re.compile(r"\bxox[abprs]-([A-Za-z0-9\-]{20,100})")),
    ("AIza", re.compile(r"\bAIza([A-Za-z0-9_\-]{35})\b")),
    ("sk-", re.compile(r"\bsk-([A-Za-z0-9_\-]{20,200})\b")),
    ("eyJ", re.compile(r"\beyJ([A-Za-z0-9_\-]{10,2000}\.eyJ[A-Za-z0-9_\-]{10,4000}\.[A-Za-z0-9_\-]{10,2000})")),
    ("PRIVATE KEY-----", re.compile(r"-----BEGIN (?:[A-Z]{2,9} ){0,2}PRIVATE KEY-----([A-Za-z0-9+/=\s]{40,20000}?)-----END ")),
]
_P = r"[A-ZÄÖÜÀ-ÖØ-Þ][^\W\d_]{1,30}"
#: Street addresses in English, German, French and Spanish: (words that one of them holds, pattern).
STREETS = [
    (("Street", "St", "Avenue", "Ave", "Road", "Rd", "Lane", "Boulevard", "Blvd", "Drive", "Court", "Square"), re.compile(rf"(?<![\w.])\d{{1,5}} (?:{_P} ){{1,3}}(?:Street|St|Avenue|Ave|Road|Rd|Lane|Boulevard|Blvd|Drive|Court|Square)\b")),
    (("straße", "strasse", "gasse", "weg", "platz", "allee"), re.compile(r"\b[A-ZÄÖÜ][a-zäöüß]{1,30}(?:straße|strasse|gasse|weg|platz|allee) \d{1,4}[a-z]?\b")),
    (("rue", "avenue", "boulevard", "place"), re.compile(rf"(?<![\w.])\d{{1,4}},? (?:rue|avenue|boulevard|place) (?:de la |du |des |de |d['’])?{_P}(?:[ -]{_P}){{0,2}}")),
    (("Calle", "Avenida", "Plaza", "Paseo"), re.compile(rf"\b(?:Calle|Avenida|Plaza|Paseo) (?:de la |del |de )?{_P}(?: {_P}){{0,2}},? \d{{1,4}}\b")),
]
#: Words in addresses that stay.
STAY = frozenset("Street St Avenue Ave Road Rd Lane Boulevard Blvd Drive Court Square Calle Avenida Plaza Paseo".split())
STREET_ENDS = ("straße", "strasse", "gasse", "weg", "platz", "allee")
TITLED = re.compile(rf"\b({'|'.join(sorted(TITLES, key=len, reverse=True))})\.? ((?-i:{NAME})(?: {NAME}){{0,2}})")
#: Words that begin with a capital: only where one of them is a known name or title are names sought.
CAPITALISED = re.compile(r"[A-ZÀ-ÖØ-Þ]\w*|[Α-ΩΆ-ΏА-ЯЁ]\w*")
SMALL_TITLES = tuple(t for t in TITLES if not t[0].isupper())

#: (start, end, kind, the canonical form of what stands there)
Span = tuple[int, int, str, str]


def luhn(digits: str) -> bool:
    """The check sum of payment cards."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    code = text[4:] + text[:4]
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in code)) % 97 == 1


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def script_of(name: str) -> str:
    c = ord(name[0])
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 else "latin"


def emails(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Addresses around each @, looked at no further than an address can reach."""
    at = text.find("@")
    while at >= 0:
        left, right = LOCAL.search(text, max(0, at - 65), at), DOMAIN.match(text, at + 1, at + 256)
        if left and right:
            yield left.start(), right.end(), "email", text[left.start() : right.end()].lower()
        at = text.find("@", at + 1)


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches around numbers, in order and apart."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    at = np.flatnonzero((code >= 0x30) & (code <= 0x39))
    if len(at) < 4:
        return []
    edge = np.flatnonzero(np.diff(at) > GAP + 1)
    first, last = np.concatenate(([0], edge + 1)), np.concatenate((edge, [len(at) - 1]))
    out: list[tuple[int, int]] = []
    for i in np.flatnonzero(last - first >= 3):
        a, b = max(0, int(at[first[i]]) - REACH), min(len(text), int(at[last[i]]) + 1 + REACH)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def numbers(text: str) -> Iterator[Span]:
    """IBANs, cards, IPv4 addresses, social security and phone numbers, one kind after the other."""
    near = windows(text)
    every = lambda p: (m for a, b in near for m in p.finditer(text, a, b))
    yield from ((m.start(), m.end(), "iban", code) for m in every(IBAN) if iban_valid(code := m[0].replace(" ", "")))
    yield from ((m.start(), m.end(), "card", code) for m in every(CARD) if ISSUER.fullmatch(code := _digits(m[0])) and luhn(code))
    yield from ((m.start(), m.end(), "ip", m[0]) for m in every(IP))
    yield from ((m.start(), m.end(), "ssn", _digits(m[0])) for m in every(SSN))
    for m in every(PHONE):
        number = _digits(m[0])
        if 9 <= len(number) <= 15 and not IP.fullmatch(m[0]):
            yield m.start(), m.end(), "phone", number[1:] if len(number) == 11 and number[0] == "1" else number


def names(text: str) -> Iterator[Span]:
    """Names after titles, and after known given names."""
    for m in TITLED.finditer(text):
        gender, at = TITLES[m[1]], m.start(2)
        parts = list(re.finditer(NAME, m[2]))
        upper = 0
        while upper < len(parts) and parts[upper][0][0].isupper():
            upper += 1
        for i, p in enumerate(parts[:upper]):
            own = p[0].casefold()
            kind = "given" if upper > 1 and i < upper - 1 or own in GENDER and upper == 1 else "family"
            script, known = GENDER.get(own, (script_of(p[0]), gender))
            yield at + p.start(), at + p.end(), f"{kind}-{script}-{known if kind == 'given' else 'n'}", own
    for m in NAMED.finditer(text):
        script, gender = GENDER[m[1].casefold()]
        yield m.start(1), m.end(1), f"given-{script}-{gender}", m[1].casefold()
        yield m.start(2), m.end(2), f"family-{script_of(m[2])}-n", m[2].casefold()


def found_in(text: str) -> Iterator[Span]:
    """All that looks like an entity; of overlapping ones the first given here stands."""
    if "@" in text:
        yield from emails(text)
    for mark, pattern in KEYS:
        if mark in text:
            yield from ((m.start(1), m.end(1), "secret", m[1]) for m in pattern.finditer(text))
    low = text.lower()
    if any(w in low for w in SECRET_WORDS):
        yield from ((m.start(1), m.end(1), "secret", m[1]) for m in SECRET.finditer(text))
    yield from numbers(text)
    capitals = set(CAPITALISED.findall(text))
    for marks, pattern in STREETS:
        if any(w in capitals for w in marks) if marks[0][0].isupper() else any(w in text for w in marks):
            yield from ((m.start(), m.end(), "street", m[0]) for m in pattern.finditer(text))
    if not capitals.isdisjoint(FIRST_PARTS) or (not text.isascii() and any(t in text for t in SMALL_TITLES)):
        yield from names(text)


def detect(text: str | None) -> list[Span]:
    """Entities of a whole text, in order, without overlap. The work grows with the text, whatever it holds."""
    found = list(found_in(text)) if text else []
    if len(found) < 2:
        return found
    taken = bytearray(len(text))
    out: list[Span] = []
    for s in found:
        if taken.find(1, s[0], s[1]) < 0:
            taken[s[0] : s[1]] = b"\1" * (s[1] - s[0])
            out.append(s)
    return sorted(out)


#: A known given name before a capitalised one.
NAMED = re.compile(rf"\b({'|'.join(sorted({n for names in GIVEN.values() for n in names}, key=lambda n: (-len(n), n)))}) ((?=[A-ZÄÖÜÉÑА-ЯΑ-Ω]){NAME})")
FIRST_PARTS = frozenset({n for own in GIVEN.values() for n in own} | {t for t in TITLES if t[0].isupper()})


class Stream:
    """Pseudo-random numbers that a key, kind, entity and attempt decide."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self._seed = hmac.new(key, f"{kind}\0{attempt}\0{value}".encode(errors="surrogatepass"), hashlib.sha256).digest()
        self._buffer, self._n = b"", 0

    def below(self, n: int) -> int:
        if len(self._buffer) < 4:
            self._buffer += hashlib.sha256(self._seed + self._n.to_bytes(4, "big")).digest()
            self._n += 1
        x, self._buffer = int.from_bytes(self._buffer[:4], "big"), self._buffer[4:]
        return x % n

    def like(self, text: str) -> str:
        """Digits, small and capital letters replaced by others of their sort; all else stays."""
        out = []
        for c in text:
            if c.isdecimal():
                out.append(chr(0x30 + self.below(10)))
            elif "a" <= c <= "z":
                out.append(chr(0x61 + self.below(26)))
            elif "A" <= c <= "Z":
                out.append(chr(0x41 + self.below(26)))
            else:
                out.append(c)
        return "".join(out)


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """The canonical form of the entity that replaces another of the same kind.

    It has the format of the entity for PATIENCE attempts; with each as many more it is a character
    or syllable longer, so that no format, however short, can be used up.
    """
    s = Stream(key, kind, value, attempt)
    more = attempt // PATIENCE
    if kind == "email":
        local, domain = value.split("@", 1)
        labels = domain.split(".")
        # registered names that stand for examples stay; of others the end stays
        stay = 2 if labels[-2] == "example" and len(labels) > 2 else 1
        return f"{s.like(local + 'a' * more)}@{'.'.join([*map(s.like, labels[:-stay]), *labels[-stay:]])}"
    if kind == "ip":
        parts = [len(p) for p in value.split(".")]
        for i in range(4):  # shorter parts grow first; beyond them, an address of the longer kind
            step = min(3 - parts[i], more)
            parts[i], more = parts[i] + step, more - step
        if more:
            return "2001:db8:" + ":".join(f"{s.below(1 << 16):x}" for _ in range(6))
        low = {1: (1, 9), 2: (10, 99), 3: (100, 254)}
        return ".".join(str(low[n][0] + s.below(low[n][1] - low[n][0] + 1)) for n in parts)
    if kind == "card":
        body = value[0] + s.like(value[1:-1] + "0" * more)
        return next(body + c for c in "0123456789" if luhn(body + c))
    if kind == "phone":
        return str(2 + s.below(8)) + s.like(value[1:] + "0" * more)
    if kind == "iban":
        body = s.like(value[4:] + "0" * more)
        check = 98 - int("".join(str(int(c, 36)) for c in f"{body}{value[:2]}00")) % 97
        return f"{value[:2]}{check:02d}{body}"
    if kind == "secret" and re.fullmatch("[0-9a-f]+", value):
        return "".join("0123456789abcdef"[s.below(16)] for _ in range(len(value) + more))
    if kind in ("ssn", "secret"):
        return s.like(value + "0" * more)
    if kind == "street":
        word = lambda size: "".join(SYLLABLES["latin"][s.below(16)] for _ in range(size)).capitalize()

        def other(m: re.Match) -> str:
            if m[0][0].isdigit():
                return str(1 + s.below(9)) + s.like(m[0][1:])
            end = next((e for e in STREET_ENDS if m[0].endswith(e)), "")
            return m[0] if m[0] in STAY else word(2 + more) + end

        return re.sub(rf"\d+|{_P}", other, value)
    sort, script, gender = kind.split("-")
    if sort == "given" and not attempt:
        names = GIVEN[script, gender]
        return names[s.below(len(names))].casefold()
    parts = SYLLABLES[script]
    return "".join(parts[s.below(len(parts))] for _ in range(2 + more + (sort == "family"))) + (ENDINGS[script, gender] if sort == "given" else "")


def written(kind: str, original: str, value: str) -> str:
    """The canonical surrogate in the format of the original: its separators, prefix and case; what is longer stands at the end."""
    if kind in ("card", "ssn", "iban", "phone"):
        body = [c for c in original if c.isalnum()]
        filled = iter([*body[: max(0, len(body) - len(value))], *value])  # a country code that the canonical form leaves out stays
        return "".join(next(filled) if c.isalnum() else c for c in original) + "".join(filled)
    if kind == "email":
        mirror = original.upper() == original and original.lower() != original
        if mirror or len(original) != len(value):
            return value.upper() if mirror else value
        return "".join(v.upper() if o.isupper() else v for o, v in zip(original, value, strict=True))
    if kind in ("ip", "secret", "street"):
        return value
    return value.upper() if len(original) > 1 and original.isupper() else value.capitalize()


def replace(text: str, spans: list[Span], attempts: Callable[[str, str], int], key: bytes) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with all spans replaced, and where the surrogates stand in it."""
    out, at, size, places = [], 0, 0, []
    for start, end, kind, value in spans:
        new = written(kind, text[start:end], surrogate(key, kind, value, attempts(kind, value)))
        out += [text[at:start], new]
        size += start - at
        places.append((kind.split("-")[0], size, size + len(new)))
        size += len(new)
        at = end
    return "".join([*out, text[at:]]), places


SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string())]))
PLACE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
REDRAWN = "array<struct<kind:string,value:string,attempt:int>>"


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (__row, __text, __u): the rows with __spans, the entities of the text."""
    names = ("start", "end", "kind", "value")
    for batch in batches:
        found = [[dict(zip(names, s, strict=True)) for s in detect(t.as_py())] for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, SPAN)], [*batch.schema.names, "__spans"])


def redrawn(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, attempt) of the distinct entities whose first surrogate will not do, with the attempt that will.

    A surrogate must differ from all entities of its kind in the corpus and from those of all other
    entities. Of entities that draw the same one, the one with the fewest attempts keeps it, then
    the first in order. Shuffles rows of entities only. Ends, since formats grow with the attempts.
    """

    @F.pandas_udf("string")
    def draw(kind: pd.Series, value: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, *x) for x in zip(kind, value, attempt, strict=True)], dtype=object)

    now = settle(entities.withColumn("attempt", F.lit(0)).withColumn("new", draw("kind", "value", "attempt")), "pii-draws")
    real = entities.select("kind", F.col("value").alias("new"), F.lit(True).alias("real"))
    while True:
        # one entity keeps each surrogate, if that is no entity itself; grouped before anything meets, for many draw the same one
        first = now.groupBy("kind", "new").agg(F.min(F.struct("attempt", "value")).alias("first"))
        kept = first.join(real, ["kind", "new"], "left").filter("real is null").select("kind", "first.value", F.lit(False).alias("lost"))
        judged = now.join(kept, ["kind", "value"], "left").select("kind", "value", "attempt", "new", F.coalesce("lost", F.lit(True)).alias("again"))
        judged = settle(judged, "pii-draws")
        forget(now)
        if judged.filter("again").isEmpty():
            return judged.filter("attempt > 0").select("kind", "value", "attempt")
        more = F.col("attempt") + F.col("again").cast("int")
        new = F.when(F.col("again"), draw("kind", "value", more)).otherwise(F.col("new"))
        now = settle(judged.select("kind", "value", more.alias("attempt"), new.alias("new")), "pii-draws")
        forget(judged)


def pseudonymize(docs: DataFrame, key: bytes, text_col: str = "text", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Replace personal data in whole texts by keyed surrogates.

    Detected are e-mail addresses, phone numbers, IPv4 addresses, payment cards (by issuer and check
    sum), US social security numbers, IBANs (by check sum), credentials after words such as token or
    of a known form, private keys, street addresses, and names after titles or with a known given
    name. A surrogate keeps kind, format, script and, for given names, gender. The same entity gets
    the same surrogate in all texts, in the format of each mention; different entities get different
    ones, none of which is an entity of the corpus: distinct entities are held against each other and
    drawn again until this is so, longer ones if a format is used up. Which ones were drawn again is
    broadcast, or, beyond ``max_broadcast``, joined to the rows that hold them.

    The rows are written to the shared folder with the places of their entities, once; rows without
    an entity are not looked at again. All columns of ``docs`` are kept, in order, with the new text;
    ``entities`` is added (kind, start, end of each surrogate), replacing a column of that name. Null
    texts stay null; empty texts, repeated rows and empty tables are as usual.
    Lowers the session's Arrow batch limits where they are larger (common.bound_batches).
    """
    spark = docs.sparkSession
    bound_batches(spark)
    keep = docs.drop("entities")
    own = F.struct(F.lit(0).alias("__none"), *[F.col(f"`{c}`") for c in keep.columns if c != text_col])
    rows = keep.select(own.alias("__row"), F.col(text_col).alias("__text"), F.monotonically_increasing_id().alias("__u"))
    schema = rows.withColumn("__spans", F.array().cast("array<struct<start:int,end:int,kind:string,value:string>>")).schema
    rows = settle(rows.mapInArrow(_spans, schema), "pii-spans")
    held = rows.select("__u", F.explode("__spans").alias("s")).select("__u", "s.kind", "s.value").distinct()
    again = settle(redrawn(settle(held.select("kind", "value").distinct(), "pii-entities"), key), "pii-again")
    some = F.size("__spans") > 0
    few = again.limit(max_broadcast + 1).count() <= max_broadcast
    table = {(r["kind"], r["value"]): r["attempt"] for r in again.collect()} if few else {}
    busy = rows.filter(some)
    if few:
        busy = busy.withColumn("__again", F.array().cast(REDRAWN))
    else:
        name = F.concat_ws("\0", "kind", "value").alias("k")
        held = settle(held.select("__u", name), "pii-mentions")
        table_of = settle(again.select(name, F.struct("kind", "value", "attempt").alias("x")).join(held.groupBy("k").agg(F.count("*").alias("n")), "k"), "pii-again")
        by_row = join_by_key(held, table_of, "k").groupBy("__u").agg(F.collect_list("x").alias("__again"))
        busy = busy.join(by_row, "__u", "left")
    busy = busy.select("__row", "__text", "__spans", "__again")
    shared = spark.sparkContext.broadcast(table)
    schema = busy.select("__row", "__text").withColumn("__entities", F.array().cast("array<struct<kind:string,start:int,end:int>>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        redone = shared.value
        for batch in batches:
            texts, places = [], []
            for text, found, more in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                extra = {(x["kind"], x["value"]): x["attempt"] for x in more or ()}
                spans = [(x["start"], x["end"], x["kind"], x["value"]) for x in found]
                new, where = replace(text, spans, lambda k, v: extra.get((k, v)) or redone.get((k, v), 0), key)  # noqa: B023
                texts.append(new)
                places.append([{"kind": k, "start": a, "end": b} for k, a, b in where])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(places, PLACE)], ["__row", "__text", "__entities"])

    idle = rows.filter(~some).select("__row", "__text", F.array().cast(schema["__entities"].dataType).alias("__entities"))
    out = busy.mapInArrow(run, schema).union(idle)
    return out.select(*[F.col("__text" if c == text_col else f"__row.`{c}`").alias(c) for c in keep.columns], F.col("__entities").alias("entities"))
