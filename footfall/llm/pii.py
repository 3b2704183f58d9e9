"""Personal data: expressions propose spans, checksums confirm them, words nearby weigh them.

Every search is linear in the text: matches begin at a sign they must contain (``@``, ``+``) or
at the start of a run of digits, so no expression is tried from each character of a long run.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: In the order in which spans that start together are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn")
KINDS = BASE_KINDS + ADDED_KINDS

LOCAL_SIGNS = frozenset(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
)
DIGIT = re.compile(r"[0-9]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
IBAN_SIGN = re.compile(r" ?[A-Z0-9]")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

#: Signs of an IBAN without its spaces, and those of the countries of the register.
IBAN_SIGNS = range(15, 35)
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO",
        16: "BE",
        18: "DK FI FK FO GL NL SD",
        19: "MK SI",
        20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST",
        26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA",
        30: "JO KW MU YE",
        31: "MT SC",
        32: "LC",
        33: "RU",
    }.items()
    for country in countries.split()
}

#: How sure a span is before its surroundings are read, and the words that make it surer.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
CONTEXT = {
    "email": ("mail", "contact", "write to"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "credit", "debit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "anruf", "contact"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "taxpayer"),
}
AGAINST = ("version", "example", "isbn", "order no", "serial")
#: Characters read on either side, and what one hit changes.
NEAR, STEP = 40, 0.2
#: Added kinds below this score are not reported; base kinds always are.
REPORT = 0.5


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_SIGNS:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
            at = text.find("@", done)
        else:
            # A run of local signs has no @ in it, so nothing before this one can match later.
            done = at + 1
            at = text.find("@", done)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for found in IP.finditer(text):
        parts = (p.lstrip("0") or "0" for p in found[0].split("."))
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            yield found.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for found in CARD.finditer(text):
        if found.end() - found.start() > 2 * 19:
            continue
        digits = found[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for found in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in found[0]) <= 15:
            yield found.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """From each start, the end at a word border that passes: that of the country's length, or
    else the farthest that runs into none of those. A start that fails hides none behind it."""
    sure, others = [(0, 0)], []
    for found in IBAN_START.finditer(text):
        compact, end, ends = found[0], found.end(), {}
        while len(compact) < IBAN_SIGNS[-1] and (sign := IBAN_SIGN.match(text, end)):
            compact, end = compact + sign[0][-1], sign.end()
            behind = text[end : end + 1]
            border = not (behind.isascii() and behind.isalnum())
            if border and len(compact) in IBAN_SIGNS and mod97(compact):
                ends[len(compact)] = end
        own = ends.get(IBAN_LENGTHS.get(compact[:2]))
        if own and found.start() >= sure[-1][1]:
            sure.append((found.start(), own))
        elif ends:
            others.append((found.start(), list(ends.values())))
    sure.append((len(text), len(text)))
    done = 0
    for start, ends in others:
        at = bisect(sure, (start, len(text)))
        fitting = [end for end in ends if end <= sure[at][0]]
        if fitting and start >= max(done, sure[at - 1][1]):
            done = max(fitting)
            yield start, done
    yield from sure[1:-1]


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    return (found.span() for found in SSN.finditer(text))


FINDERS = {
    "email": _emails,
    "ip": _ips,
    "card": _cards,
    "phone": _phones,
    "iban": _ibans,
    "ssn": _ssns,
}


def score(text: str, kind: str, start: int, end: int) -> float:
    """The prior of the kind, moved by one step for a word nearby that speaks for or against."""
    around = (text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]).lower()
    value = PRIOR[kind]
    value += STEP * any(word in around for word in CONTEXT[kind])
    value -= STEP * any(word in around for word in AGAINST)
    return round(min(1.0, max(0.0, value)), 3)


def find_spans(text: str | None) -> list[Span]:
    """All spans of a text by start, then by kind as listed in ``KINDS``; end is exclusive."""
    if not text:
        return []
    digits = DIGIT.search(text) is not None
    found = []
    for kind in KINDS:
        if kind == "email" or digits:
            for start, end in FINDERS[kind](text):
                sure = score(text, kind, start, end)
                if kind in BASE_KINDS or sure >= REPORT:
                    found.append(Span(kind, start, end, sure))
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType(), False),
            T.StructField("start", T.IntegerType(), False),
            T.StructField("end", T.IntegerType(), False),
            T.StructField("score", T.DoubleType(), False),
        ]
    ),
    False,
)


def find_pii(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``spans``: an array of (kind, start, end, score) in code points.

    Of the kinds email, ip, card and phone every match that passes its check is reported, with
    the score its surroundings give; of the added kinds iban and ssn those with a score of
    ``REPORT`` or more. Kinds are searched one by one, so spans of two kinds may overlap. A null
    or empty text has no spans. An own column ``spans`` is replaced. Without ``keep_text`` the
    text is left out of the result.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "spans"])
    kept = [c for c in docs.columns if keep_text or c != text_col]
    fields = [f for f in docs.schema.fields if f.name in kept]
    schema = T.StructType([*fields, T.StructField("spans", SPANS, False)])
    at = docs.columns.index(text_col)
    places = [docs.columns.index(c) for c in kept]
    span = pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [s._asdict() for s in find_spans(text.as_py())] for text in batch.column(at)
            ]
            columns = [batch.column(i) for i in places]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(spans, pa.list_(span))], names=[*kept, "spans"]
            )

    return docs.mapInArrow(run, schema)


def redacted(text: Column | str, spans: Column | str, least: float = 0.0) -> Column:
    """The text with each span of at least that score replaced by its kind in brackets.

    Of spans that overlap, the first is replaced and the rest of the others goes with it. Null
    stays null.
    """
    text, spans = (F.col(x) if isinstance(x, str) else x for x in (text, spans))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    joined = F.aggregate(
        F.filter(spans, lambda s: s["score"] >= least),
        start,
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= acc["at"],
                F.concat(
                    acc["out"],
                    F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                    F.lit("["),
                    s["kind"],
                    F.lit("]"),
                ),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
        lambda acc: F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))
        ),
    )
    return F.when(text.isNotNull(), joined)
