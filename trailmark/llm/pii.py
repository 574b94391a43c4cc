"""Personal data in whole texts.

Regular expressions propose spans, validators confirm them, and words near
a span move its score.  Four base kinds are proposed by fixed expressions,
leftmost and without overlap inside a kind; a match that its validator
rejects is dropped and not tried again:

* ``email``;
* ``ip``, four parts of at most 255;
* ``card``, 14 to 19 digits that pass Luhn;
* ``phone``, a leading plus and 10 to 15 digits.

Base spans always stay.  The method adds further kinds, whose score starts
from the proposal, grows with a validator and with context words within
``CONTEXT`` characters before or behind the span, and must reach ``LEAST_SCORE``:

* ``iban``: country, check digits and account, confirmed by mod 97;
* ``card13``: 13 digits that pass Luhn next to a card word;
* ``id``: a 3-2-4 digit number next to an identity word;
* ``local_phone``: 7 to 12 digits in groups next to a telephone word.

Added spans that overlap a base span, or an added one of a higher score,
are dropped.

Every expression is linear in the length of the text.  Texts are narrow
work without a shuffle.  Defined cases: a null text is an empty one without
spans; repeated rows each give a row; other columns are not carried.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import each_text, map_texts

CONTEXT = 40
LEAST_SCORE = 0.6
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "card13", "id", "local_phone")

# The expressions of the base kinds, written so that a search
# never starts again inside a run that has already failed.  An email is
# found from its at sign; its local part is the run before that.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Proposals of the added kinds and their context words
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_THIRTEEN = re.compile(r"(?<![0-9])[0-9]{13}(?![0-9])")
_IDENTITY = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{2,4}\)?(?:[\x20./-][0-9]{2,4}){2,4}(?![0-9-])")
_CARD_WORDS = re.compile(r"card|karte|carte|tarjeta|visa|credit", re.I)
_IDENTITY_WORDS = re.compile(r"\b(?:ssn|social|security|identity|passport|ausweis|identité|dni)\b", re.I)
_PHONE_WORDS = re.compile(r"\b(?:phone|call|tel|telephone|mobile|fax|telefon|téléphone|teléfono)\b", re.I)
_ACCOUNT_WORDS = re.compile(r"\b(?:iban|account|bank|konto|compte|cuenta)\b", re.I)

Span = tuple[int, str, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(account: str) -> bool:
    """An IBAN without spaces is valid if, its first four characters moved
    to the end and letters read as 10 to 35, it leaves 1 when divided by 97."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def base_spans(text: str) -> list[Span]:
    """Spans of the four base kinds by start, then kind."""
    found: list[tuple[int, int, int]] = []
    if "@" in text:
        free = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                found.append((start, 0, m.end()))
                free = m.end()
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if 14 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return [(a, BASE_KINDS[k], b) for a, k, b in sorted(found)]


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans of the added kinds, disjoint from ``base`` and each other."""
    def near(words, m) -> float:
        before = words.search(text, max(0, m.start() - CONTEXT), m.start())
        return 0.4 if before or words.search(text, m.end(), m.end() + CONTEXT) else 0.0

    scored = []
    for m in _IBAN.finditer(text):
        if len(bare := m[0].replace(" ", "")) <= 34 and mod97(bare):
            scored.append((0.8 + near(_ACCOUNT_WORDS, m) / 2, m.start(), "iban", m.end()))
    for m in _THIRTEEN.finditer(text):
        if luhn(m[0]):
            scored.append((0.4 + near(_CARD_WORDS, m), m.start(), "card13", m.end()))
    for m in _IDENTITY.finditer(text):
        scored.append((0.3 + near(_IDENTITY_WORDS, m), m.start(), "id", m.end()))
    for m in _LOCAL_PHONE.finditer(text):
        if 7 <= len(_digits(m[0])) <= 12:
            scored.append((0.3 + near(_PHONE_WORDS, m), m.start(), "local_phone", m.end()))
    scored = sorted((s for s in scored if s[0] >= LEAST_SCORE), key=lambda s: (-s[0], s[1], KINDS.index(s[2])))
    kept: list[Span] = []
    if scored:
        taken = bytearray(len(text))
        for start, _, end in base:
            taken[start:end] = b"\1" * (end - start)
        for _, start, kind, end in scored:
            if not any(taken[start:end]):
                taken[start:end] = b"\1" * (end - start)
                kept.append((start, kind, end))
    return kept


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, each by start and then kind as listed."""
    if not any(c in text for c in "0123456789@"):
        return [], []
    base = base_spans(text)
    every = sorted(base + added_spans(text, base), key=lambda s: (s[0], KINDS.index(s[1])))
    return base, every


def joined(spans: list[Span]) -> str:
    return ",".join([f"{kind}:{start}:{end}" for start, kind, end in spans])


def _digest(text: str) -> tuple:
    base, every = find(text)
    kinds = [kind for _, kind, _ in base]
    return (*(kinds.count(k) for k in BASE_KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every))


def detect(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``id_col``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``,
    ``base_sha256`` and ``spans`` (kind:start:end in code points)."""
    return map_texts(docs, id_col, text_col, lambda: _digest,
                     [*((f"n_{k}", pa.int64(), "long") for k in BASE_KINDS),
                      ("base_sha256", pa.string(), "string"), ("spans", pa.string(), "string")])


def redact_text(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets;
    spans that overlap are replaced as one, by the kind that starts first."""
    out, at = [], 0
    for start, kind, end in find(text)[1]:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(text_col: str = "text") -> Column:
    """The column with personal data replaced; null stays null."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return each_text(batches, lambda t: None if t is None else redact_text(t), pa.string())

    return F.arrow_udf(run, "string")(F.col(text_col).cast("string"))
