"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score.

The base kinds (email, ip, card, phone) are fixed patterns with fixed checks; what passes is always
reported. The other kinds are found by the method alone: account numbers (iban), confirmed by the
length of their country and the remainder modulo 97; social security numbers (ssn), by the ranges
that were never issued; numbers of the French register (nir), by their key modulo 97; telephone
numbers without a country code (local), for which no check exists.

The score of a span is a probability. Its log-odds are a prior of the kind, plus the weight of a
check that was passed, plus that of words which speak for the kind or against personal data among
the ``NEAR`` characters before and ``AFTER`` after it. Spans of the method's own kinds are reported
from ``LEAST_SCORE`` on, so kinds whose check says little need a word nearby. They never overlap a
base span nor each other; the higher score goes first, then the earlier start.

Spans are in code points, the end exclusive. All patterns take time linear in the text, whatever
it holds. Texts are read as a whole, one row at a time, and nothing is gathered.

Defined cases: a null text is empty and has no span; repeated rows give repeated rows; a null id
stays null; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obligo.llm.common import documents, prepare, text

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "nir", "local")
BASE = KINDS[:4]
SPAN = "struct<kind:string,start:bigint,end:bigint,score:double>"

# The fixed patterns (fixed values), in parts that are matched once from where they can begin.
LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = range(12, 20), range(9, 16)

# Patterns of the method's own kinds.
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[\x20-]?[A-Z0-9])")
GROUPED = re.compile(r"[A-Z0-9]{4}(?:([\x20-])[A-Z0-9]{4})(?:\1[A-Z0-9]{4}){1,6}+(?:\1[A-Z0-9]{1,3})?")
SOLID = re.compile(r"[A-Z0-9]{15,34}+")
SSN = re.compile(r"(?<![0-9.+-])([0-9]{3})([\x20-])([0-9]{2})\2([0-9]{4})(?![0-9]|[.-][0-9])")
NIR = re.compile(
    r"(?<![0-9])[12]\x20?[0-9]{2}\x20?(?:0[1-9]|1[0-2])\x20?(?:[0-9]{2}|2[AB])\x20?[0-9]{3}\x20?"
    r"[0-9]{3}\x20?[0-9]{2}(?![0-9])")
LOCAL = re.compile(r"(?<![0-9.+])(?:\([0-9]{2,5}\)\x20?[0-9]|0[0-9]|[2-9][0-9]{2}[\x20.-][0-9])"
                   r"(?:[\x20./-]?[0-9]){5,11}+(?![0-9]|[.-][0-9])")

# Length of an account number by country (fixed values).
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22,
    "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28,
    "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23,
    "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30,
    "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22,
    "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}

NEAR, AFTER = 48, 16
WORDS = {
    "email": "e-?mail|mail|contact|write|courriel|correo|kontakt",
    "ip": "ip|address|host|server|client|login|logged|adresse",
    "card": "card|visa|mastercard|amex|credit|debit|cvv|cvc|carte|tarjeta|karte|kreditkarte",
    "phone": "phone|telephone|tel|mobile|cell|call|fax|whatsapp|téléphone|teléfono|telefon|handy",
    "iban": "iban|account|bank|bic|swift|compte|cuenta|konto",
    "ssn": "ssn|social|security|taxpayer|tin",
    "nir": "nir|sécurité|sociale|insee|social|security",
}
WORDS["local"] = WORDS["phone"]
FOR = {kind: re.compile(rf"\b(?:{words})\b", re.IGNORECASE) for kind, words in WORDS.items()}
AGAINST = re.compile(r"\b(?:example|sample|test|dummy|fake|version|release|invoice|order|sku|isbn|"
                     r"part|serial|model|chapter|section|page)\b", re.IGNORECASE)
# Log-odds: prior of a kind's pattern, weight of the check it passed, weights of words nearby.
PRIOR = {"email": 3.0, "ip": 1.0, "card": -2.0, "phone": 1.0, "iban": -2.0, "ssn": -1.5,
         "nir": -3.0, "local": -1.5}
CHECKED = {"email": 0.0, "ip": 0.5, "card": 2.3, "phone": 0.5, "iban": 4.5, "ssn": 0.3,
           "nir": 4.0, "local": 0.0}
SPEAKS_FOR, SPEAKS_AGAINST = 2.5, -1.5
LEAST_SCORE = 0.7


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of those before."""
    doubled = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def mod_97(account: str) -> bool:
    """Whether an account number without blanks has remainder 1, letters read as 10 to 35."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(value: str) -> Iterator[tuple[int, int]]:
    done = 0  # end of the last span; a local part holds no @
    at = value.find("@")
    while at >= 0:
        domain = DOMAIN.match(value, at + 1)
        start = done + len(value[done:at].rstrip(LOCAL_PART))
        if domain and start < at:
            yield start, domain.end()
            done = domain.end()
        else:
            done = max(done, at + 1)
        at = value.find("@", at + 1)


def addresses(value: str) -> Iterator[tuple[int, int]]:
    """Every four numbers of a dotted chain, where none is over 255."""
    for chain in DOTTED.finditer(value):
        parts = chain[0].split(".")
        start = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def cards(value: str) -> Iterator[tuple[int, int]]:
    for m in DIGITS.finditer(value):
        digits = m[0].replace(" ", "").replace("-", "")
        if len(digits) in CARD_DIGITS and luhn(digits):
            yield m.span()


def phones(value: str) -> Iterator[tuple[int, int]]:
    if "+" in value:
        for m in PHONE.finditer(value):
            if sum(c in "0123456789" for c in m[0]) in PHONE_DIGITS:
                yield m.span()


def accounts(value: str) -> Iterator[tuple[int, int]]:
    for m in IBAN.finditer(value):
        size = IBAN_LENGTHS.get(m[0][:2])
        for pattern in (SOLID, GROUPED):
            form = size and pattern.match(value, m.start())
            if not form:
                continue
            # Blanks may join the next word to the number: it ends where its country says.
            end = m.start() + (size if pattern is SOLID else size + (size - 1) // 4)
            found = value[m.start():end]
            solid = found.replace(" ", "").replace("-", "")
            if end <= form.end() and len(solid) == size and not value[end:end + 1].isalnum() \
                    and mod_97(solid):
                yield m.start(), end
                break


def social_numbers(value: str) -> Iterator[tuple[int, int]]:
    for m in SSN.finditer(value):
        if m[1] not in ("000", "666") and m[1] < "900" and m[3] != "00" and m[4] != "0000":
            yield m.span()


def register_numbers(value: str) -> Iterator[tuple[int, int]]:
    for m in NIR.finditer(value):
        solid = m[0].replace(" ", "")
        # Departments of Corsica count as 19 and 18 in the key.
        body = int(solid[:-2].replace("2A", "19").replace("2B", "18"))
        if 97 - body % 97 == int(solid[-2:]):
            yield m.span()


def local_phones(value: str) -> Iterator[tuple[int, int]]:
    for m in LOCAL.finditer(value):
        if sum(c in "0123456789" for c in m[0]) in range(7, 13):
            yield m.span()


FINDERS = (emails, addresses, cards, phones, accounts, social_numbers, register_numbers,
           local_phones)


def score(kind: str, value: str, start: int, end: int) -> float:
    """Probability that a confirmed span is personal data, from the words around it."""
    around = f"{value[max(0, start - NEAR):start]}\n{value[end:end + AFTER]}"
    odds = PRIOR[kind] + CHECKED[kind]
    if FOR[kind].search(around):
        odds += SPEAKS_FOR
    if AGAINST.search(around):
        odds += SPEAKS_AGAINST
    return 1 / (1 + math.exp(-odds))


def spans_of(value: str) -> list[tuple[int, int, int, float]]:
    """Start, number of the kind, end and score of all spans, by start, then kind."""
    found = [(s, k, e, score(kind, value, s, e))
             for k, kind in enumerate(BASE) for s, e in FINDERS[k](value)]
    added = [(s, k, e, score(KINDS[k], value, s, e))
             for k in range(len(BASE), len(KINDS)) for s, e in FINDERS[k](value)]
    added = sorted((x for x in added if x[3] >= LEAST_SCORE), key=lambda x: (-x[3], x[0], x[1]))
    if added:
        taken = bytearray(len(value))
        for s, _, e, _ in found:
            taken[s:e] = b"\1" * (e - s)
        for s, k, e, p in added:
            if not any(taken[s:e]):
                taken[s:e] = b"\1" * (e - s)
                found.append((s, k, e, p))
    return sorted(found)


def masked(value: str, spans: list[tuple[int, int, int, float]]) -> str:
    """The text with the name of the kind in place of each span; overlapping spans are one."""
    out, done, last = [], 0, 0
    for start, kind, end, _ in spans:
        if start >= last:
            out += [value[done:start], f"[{KINDS[kind].upper()}]"]
        last = max(last, end)
        done = last
    return "".join(out) + value[done:]


def personal_data(spark: SparkSession, docs: DataFrame, mask: bool = False) -> DataFrame:
    """doc_id and the spans (kind, start, end, score) of every text, by start, then kind.

    ``mask`` adds the text with all spans masked as a column ``masked``.
    """
    prepare(spark)

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                         ("end", pa.int64()), ("score", pa.float64())]))
        for batch in batches:
            values = batch.column(1).to_pylist()
            spans = [spans_of(v) for v in values]
            columns = {
                "doc_id": batch.column(0),
                "spans": pa.array([
                    [{"kind": KINDS[k], "start": s, "end": e, "score": p} for s, k, e, p in x]
                    for x in spans
                ], spans_type),
            }
            if mask:
                columns["masked"] = pa.array(map(masked, values, spans), pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text().alias("text")).mapInArrow(
        over, f"doc_id {id_type}, spans array<{SPAN}>" + (", masked string" if mask else ""))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    found = personal_data(spark, documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id", *[of(k).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
        F.array_max(F.transform("spans", lambda s: s["score"])).alias("highest_score"),
        *[of(k).alias(f"n_{k}") for k in KINDS[len(BASE):]])
