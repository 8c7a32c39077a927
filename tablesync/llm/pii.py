"""Personal data in whole texts: patterns propose, validators confirm, context scores.

Regular expressions propose spans (email, ip, card, phone, iban, ssn); a
checksum or range test confirms them (octets, Luhn, mod-97, SSN ranges); words
in the ``CONTEXT_CHARS`` characters before a span raise its score, a denying
word (order, ticket, version ...) lowers it.  The four base kinds are reported
whatever their score; an added kind needs ``MIN_SCORE``.

Every pattern runs in time linear in the text: digit runs are matched
possessively from their start, and an email is grown to the left of its ``@``,
which gives the leftmost non-overlapping matches of the plain patterns; an IBAN
is cut from its start, so words after it are not taken for its end.  One
scan, one Arrow pass, no shuffle.

Edge cases: null or empty text has no spans; a null id stays null; repeated
rows give repeated results; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import arrow_map, balanced

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
MIN_SCORE = 0.5
CONTEXT_CHARS = 40

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
IBAN_REST = re.compile(r"(?: ?[A-Z0-9]){1,30}+")
# characters of an IBAN by country (IBAN registry)
IBAN_LENGTH = {c: int(n) for n, names in (x.split(":") for x in (
    "15:NO", "16:BE", "18:DK FI FO GL NL SD FK", "19:MK SI", "20:AT BA EE KZ LT LU XK MN", "21:CH HR LI LV",
    "22:BG BH CR DE GB GE IE ME RS VA", "23:AE GI IL IQ OM TL SO", "24:AD CZ ES MD PK RO SA SE SK TN VG",
    "25:LY PT ST", "26:IS TR", "27:BI DJ FR GR IT MC MR SM", "28:AL AZ BY CY DO GT HU LB NI PL SV", "29:BR EG PS QA UA",
    "30:JO KW MU YE", "31:MT SC", "32:LC", "33:RU")) for c in names.split()}
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
DIGIT = re.compile(r"[0-9]")

START_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
SUPPORT = {
    "email": re.compile(r"\b(?:e-?mail|contact|write|kontakt|courriel|correo)\b", re.I),
    "ip": re.compile(r"\b(?:ip|host|server|address|adresse)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|amex|credit|karte|carte|tarjeta)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|call|mobile|fax|telefon|appelez|llame)\b", re.I),
    "iban": re.compile(r"\b(?:iban|bank|account|konto|compte|cuenta)\b", re.I),
    "ssn": re.compile(r"\b(?:ssn|social security)\b", re.I),
}
DENIAL = re.compile(r"\b(?:version|order|invoice|ticket|serial|isbn|part no|example)\b", re.I)
SUPPORT_WEIGHT, DENIAL_WEIGHT = 0.2, -0.2

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[Span]:
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        left = at
        while left > floor and text[left - 1] in LOCAL:
            left -= 1
        if left < at and (m := DOMAIN.match(text, at + 1)):
            out.append((left, m.end()))
            floor = m.end()
        at = text.find("@", at + 1)
    return out


def ips(text: str) -> list[Span]:
    return [m.span() for m in IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]


def cards(text: str) -> list[Span]:
    return [m.span() for m in CARD.finditer(text)
            if len(m[0]) <= 37 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d)]


def phones(text: str) -> list[Span]:
    return [m.span() for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]


def ibans(text: str) -> list[Span]:
    """A start is cut at its country's length; of an unlisted country, at the
    shortest length that the checksum confirms.  At most 20 lengths a start."""
    out, floor = [], 0
    for m in IBAN_START.finditer(text):
        start = m.start()
        if start < floor or not (rest := IBAN_REST.match(text, m.end())):
            continue
        ends = [i - start for i in range(m.end(), rest.end()) if text[i] != " "]
        own = IBAN_LENGTH.get(m[0][:2])
        for n in (own,) if own else range(15, min(34, 4 + len(ends)) + 1):
            if n > 4 + len(ends):
                continue
            end = start + ends[n - 5] + 1
            if text[end:end + 1].isascii() and text[end:end + 1].isalnum():
                continue
            if mod97(text[start:end].replace(" ", "")):
                out.append((start, end))
                floor = end
                break
    return out


def ssns(text: str) -> list[Span]:
    return [m.span() for m in SSN.finditer(text)
            if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000"]


FINDERS: dict[str, Callable[[str], list[Span]]] = {
    "email": emails, "ip": ips, "card": cards, "phone": phones, "iban": ibans, "ssn": ssns}


def score(text: str, kind: str, start: int) -> float:
    before = text[max(0, start - CONTEXT_CHARS):start]
    s = START_SCORE[kind]
    if SUPPORT[kind].search(before):
        s += SUPPORT_WEIGHT
    if DENIAL.search(before):
        s += DENIAL_WEIGHT
    return round(min(1.0, max(0.0, s)), 3)


def find_spans(text: str) -> list[dict]:
    """All spans of a text by start, then kind: kind, start, end (code points,
    end exclusive), score."""
    wanted = ["email"] if "@" in text else []
    if DIGIT.search(text):
        wanted += [k for k in KINDS[1:] if k != "phone" or "+" in text]
    out = []
    for order, kind in enumerate(KINDS):
        if kind in wanted:
            for start, end in FINDERS[kind](text):
                s = score(text, kind, start)
                if kind in BASE_KINDS or s >= MIN_SCORE:
                    out.append((start, order, {"kind": kind, "start": start, "end": end, "score": s}))
    return [x[2] for x in sorted(out, key=lambda x: x[:2])]


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``pii``, an array of (kind, start, end, score)."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                     ("end", pa.int64()), ("score", pa.float64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in balanced(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(map(find_spans, texts), spans_type)], ["id", "pii"])

    out = arrow_map(slim, find, f"id {id_type}, "
                    "pii array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    return out.withColumnRenamed("id", id_col)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, SHA-256 of the base spans, all spans as text."""
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    kinds = F.col("pii")["kind"]
    counts = [F.size(F.filter(kinds, lambda k: k == kind)).cast("long").alias(f"n_{kind}")  # noqa: B023
              for kind in BASE_KINDS]
    return found.select(F.col(id_col), *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("pii")).alias("spans"))
