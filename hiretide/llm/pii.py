"""Personal data in texts: expressions propose spans, checksums confirm, context words weigh.

Four base kinds are found by their expression and test alone: ``email``, ``ip`` (parts at most
255), ``card`` (12 to 19 digits, Luhn), ``phone`` (leading ``+``, 9 to 15 digits). Four more kinds
(``iban``, ``ssn``, ``local_phone``, and ``secret``: access keys and named passwords) are kept by score: a proposal starts at its kind's prior, a passed checksum (IBAN: mod 97) and
each kind of context word near it raise the score, and it counts from ``MIN_SCORE``.

Null and empty texts have no spans. Rows are independent: ties, repeated rows and equal ids each
give one row; long texts are searched whole, in time linear in their length. Columns other than
the id and the text are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hiretide.llm.common import arrow_map, type_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "local_phone", "secret")
MIN_SCORE = 0.6

Span = tuple[int, int, str, float]

# The part of an address from the @ on; what stands before it is found leftwards from the @, so that
# a long run of letters without an @ costs nothing.
_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can begin only where a run of digits does: the parts before it are greedy.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(
    r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
_KEY = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])")
_SIGN = re.compile(r"[=:]")
# A quoted value ends at its quote; an unclosed or bare one at a blank or mark.
_VALUE = re.compile(r">?[ \t]*+(?:\"(?P<double>(?:[^\"\\\r\n]|\\.){8,}+)\"|'(?P<single>(?:[^'\\\r\n]|\\.){8,}+)'"
                    r"|\\?[\"'`]?(?P<bare>[^\s\"'`<>,;]{8,}+))")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\W\d_]+")

#: Score of a bare proposal, and the words that raise it by ``CONTEXT_GAIN`` when one is near.
PRIORS = {"iban": 0.3, "ssn": 0.4, "local_phone": 0.35, "secret": 0.3}
CHECKSUM_GAIN, CONTEXT_GAIN, CONTEXT_CHARS = 0.5, 0.35, 60
CONTEXT = {
    "iban": frozenset(("iban", "account", "bank", "konto", "compte", "cuenta", "transfer")),
    "ssn": frozenset(("ssn", "social", "security", "taxpayer")),
    "local_phone": frozenset(("phone", "tel", "telephone", "call", "mobile", "cell", "fax",
                              "telefon", "téléphone", "teléfono")),
    # The word that names the value stands right before it.
    "secret": frozenset(("password", "passwd", "pwd", "secret", "token", "apikey", "passwort")),
}


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[Span]:
    last = 0
    for m in _AT.finditer(text):
        at = start = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            last = m.end()
            yield start, last, "email", 1.0


def base_spans(text: str) -> list[Span]:
    """Spans of the base kinds, by start and then kind as listed."""
    found: list[Span] = list(_emails(text)) if "@" in text else []
    for m in _IP.finditer(text):
        if all(int(p) <= 255 for p in m.groups() if len(p) < 4000) and all(
                len(p.lstrip("0")) <= 3 for p in m.groups()):
            found.append((m.start(), m.end(), "ip", 1.0))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card", 1.0))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                found.append((m.start(), m.end(), "phone", 1.0))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _score(kind: str, text: str, start: int, end: int, checksum: bool) -> float:
    if kind == "secret":
        near = text[max(0, start - 16):start]
    else:
        near = text[max(0, start - CONTEXT_CHARS):start] + " " + text[end:end + CONTEXT_CHARS // 2]
    context = any(w in CONTEXT[kind] for w in _WORD.findall(near.lower()))
    return round(PRIORS[kind] + CHECKSUM_GAIN * checksum + CONTEXT_GAIN * context, 2)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Proposals that pass mod 97, of each the longest: capitals behind one may look like its last groups."""
    m = _IBAN.search(text)
    while m:
        start, end = m.span()
        while end > start and not mod97(text[start:end].replace(" ", "")):
            end = text.rfind(" ", start, end)
            if len(text[start:max(end, start)].replace(" ", "")) < 15:
                end = start
        if end > start:
            yield start, end
        m = _IBAN.search(text, end if end > start else start + 4)


def _secrets(text: str) -> Iterator[tuple[int, int, float]]:
    """Values that follow a name and a sign, then access keys by their form alone."""
    m = _SIGN.search(text)
    while m:
        sign, after = m.span()
        while sign and text[sign - 1] in " \t":
            sign -= 1
        named = _score("secret", text, sign, after, False)
        value = _VALUE.match(text, after) if named >= MIN_SCORE or text.startswith(
            ("AKIA", "ASIA"), after) else None
        if value:
            start, after = value.span(value.lastgroup)
            # An access key's fixed form confirms it, as a checksum does.
            yield start, after, round(named + CHECKSUM_GAIN * text.startswith(("AKIA", "ASIA"), start), 2)
        m = _SIGN.search(text, after)
    if "AKIA" in text or "ASIA" in text:
        for m in _KEY.finditer(text):
            yield *m.span(), _score("secret", text, *m.span(), True)


def scored_spans(text: str, base: list[Span]) -> list[Span]:
    """Further spans whose score suffices and that no base span overlaps, nor one found before. A
    secret may hold such spans, so that nothing of it is left beside them."""
    found: list[Span] = []
    taken = bytearray()  # a 1 for each character of a span

    def take(start: int, end: int) -> None:
        taken[start:end] = b"\1" * (end - start)

    def add(kind: str, start: int, end: int, score: float) -> None:
        if score < MIN_SCORE:
            return
        if not taken:
            taken.extend(bytes(len(text)))
            for s in base:
                take(*s[:2])
        if taken.find(0, start, end) >= 0 and (kind == "secret" or taken.find(1, start, end) < 0):
            found.append((start, end, kind, score))
            take(start, end)

    if any(c in text for c in "0123456789"):
        for start, end in _ibans(text):
            add("iban", start, end, _score("iban", text, start, end, True))
        for kind, pattern in (("ssn", _SSN), ("local_phone", _LOCAL_PHONE)):
            for m in pattern.finditer(text):
                add(kind, *m.span(), _score(kind, text, *m.span(), False))
    for start, end, score in _secrets(text):
        add("secret", start, end, score)
    return found


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and these with the scored ones, each by start and kind."""
    base = base_spans(text)
    more = scored_spans(text, base)
    return base, sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2]))) if more else base


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind, _ in spans)


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id and ``found``, an array of (kind, start, stop, score) in code points."""
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("stop", T.LongType()), T.StructField("score", T.DoubleType())])

    def run(batch: pa.RecordBatch):
        spans = [[{"kind": k, "start": a, "stop": b, "score": s}
                  for a, b, k, s in all_spans(t)[1]] if t else []
                 for t in batch.column(1).to_pylist()]
        yield [batch.column(0), spans]

    return arrow_map(df.select(id_col, text_col), run,
                     [(id_col, type_of(df, id_col)), ("found", T.ArrayType(span))])


def digest_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: counts and digest of the base spans, and all spans as text."""

    def run(batch: pa.RecordBatch):
        rows = []
        for text in batch.column(1).to_pylist():
            base, every = all_spans(text) if text else ([], [])
            kinds = [s[2] for s in base]
            rows.append((*(kinds.count(k) for k in BASE_KINDS),
                         hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
        yield [batch.column(0), *map(list, zip(*rows))] if rows else [batch.column(0), *[[]] * 6]

    return arrow_map(df.select(id_col, text_col), run, [
        (id_col, type_of(df, id_col)), *((f"n_{k}", T.LongType()) for k in BASE_KINDS),
        ("base_sha256", T.StringType()), ("spans", T.StringType())])


def redact_text(text: str) -> str:
    """``text`` with each span, or run of overlapping spans, replaced by its first kind's name."""
    out, last = [], 0
    for start, end, kind, _ in all_spans(text)[1]:
        if start >= last:
            out += [text[last:start], f"<{kind.upper()}>"]
        last = max(last, end)
    return "".join(out) + text[last:] if out else text


def redact_pii(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with personal data in ``text_col`` replaced; null stays null, other columns stay."""
    names, arrow_at = df.columns, df.columns.index(text_col)

    def run(batch: pa.RecordBatch):
        texts = batch.column(arrow_at).to_pylist()
        columns = [batch.column(i) for i in range(batch.num_columns)]
        columns[arrow_at] = [t and redact_text(t) for t in texts]
        yield columns

    return arrow_map(df, run, [(n, type_of(df, n)) for n in names])
