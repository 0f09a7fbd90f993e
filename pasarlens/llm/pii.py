"""Personal data: expressions propose spans, checksums confirm them, nearby words adjust the score.

Positions are code points, end exclusive. Results in special cases: a null text is the empty text and has no spans; a null id is
passed on; repeated rows are searched one by one; an empty table gives an empty result; other columns are ignored. A text of
any length is searched whole; spans of different kinds may overlap, and equal starts are listed in the order of the kinds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.llm.scratch import bounded_batches

#: The kinds in the order in which spans are listed; the first four are the base and always stay.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "secret")

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Characters of an IBAN by country.
IBAN_LENGTHS = {
    word[:2]: int(word[2:])
    for word in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 "
        "FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 "
        "LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 "
        "SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
    ).split()
}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|[0-9a-f]{32,64})(?![A-Za-z0-9])")
_DIGIT = re.compile(r"[0-9]")

#: Score before context, and the words that raise it when they stand near.
START = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.3, "secret": 0.3}
CONTEXT = {
    "email": "mail e-mail contact write",
    "ip": "ip host server address login",
    "card": "card visa credit payment pay",
    "phone": "phone tel call mobile fax",
    "iban": "iban bank account konto compte",
    "ssn": "ssn social security",
    "secret": "token secret key password api",
}
_NEAR = {kind: re.compile("|".join(map(re.escape, words.split())), re.IGNORECASE) for kind, words in CONTEXT.items()}
RAISE = 0.3
#: Characters looked at before and after a span.
REACH = 40
#: Spans beyond the base stay from this score on.
LEAST_SCORE = 0.5


def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(values)) % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From one @ to the next: the name is the run of name characters before it, no further back than the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _NAME:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        # a run that ended at an @ without a match is not walked again: the next @ lies beyond it
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(_small(p) for p in m.group().split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m.group())) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """A match may run on into a BIC, a year or another number, so it may also end at a blank in it: where the country's length is
    reached, or for other countries wherever the checksum holds, the longest first."""
    at = 0
    while m := _IBAN.search(text, at):
        start, at = m.start(), m.start() + 1
        ends = [m.end(), *(i for i in range(m.end() - 1, start, -1) if text[i] == " ")]
        bare = {end: text[start:end].replace(" ", "") for end in ends}
        if own := IBAN_LENGTHS.get(text[start : start + 2]):
            ends = [end for end in ends if len(bare[end]) == own] + ends[:1]
        for end in ends:
            if 15 <= len(bare[end]) <= 34 and mod97(bare[end]):
                yield start, end
                at = end
                break


def spans_of(text: str) -> list[tuple[str, int, int, float]]:
    """Kind, start, end and score of every span, by kind as listed and then by start."""
    digits = _DIGIT.search(text) is not None
    proposed = {
        "email": _emails(text) if "@" in text else (),
        "ip": _ips(text) if digits and "." in text else (),
        "card": _cards(text) if digits else (),
        "phone": _phones(text) if digits and "+" in text else (),
        "iban": _ibans(text) if digits else (),
        "ssn": (m.span() for m in _SSN.finditer(text)) if digits and "-" in text else (),
        "secret": (m.span() for m in _SECRET.finditer(text)) if digits else (),
    }
    found = []
    for kind, spans in proposed.items():
        for start, end in spans:
            near = f"{text[max(0, start - REACH) : start]} {text[end : end + REACH]}"
            score = min(1.0, START[kind] + RAISE * (_NEAR[kind].search(near) is not None))
            if kind in BASE_KINDS or score >= LEAST_SCORE:
                found.append((kind, start, end, score))
    return found


def redacted(text: str) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    out, done = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e, _ in spans_of(text)):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [
            [{"kind": k, "start": s, "end": e, "score": p} for k, s, e, p in spans_of(text or "")]
            for text in batch.column(1).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(SPAN))], ["doc_id", "spans"])


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: its id and all spans with their scores. No shuffle."""
    bounded_batches(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_search, f"doc_id bigint, spans {SPANS}")


def redact_pii(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns with spans replaced in the text; null texts stay null."""
    bounded_batches(df.sparkSession)
    place = df.columns.index(text_col)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array(
                [None if t is None else redacted(t) for t in batch.column(place).to_pylist()], batch.column(place).type
            )
            yield batch.set_column(place, batch.schema.field(place), texts)

    return df.mapInArrow(replace, df.schema)
