"""Base spans against the plain expressions, and the added kinds."""

import hashlib
import random
import re

import pytest

from trailmark.llm import pii

PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    found = []
    for kind, expression in PLAIN:
        for m in re.finditer(expression, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), [k for k, _ in PLAIN].index(kind), m.end()))
    return [(a, PLAIN[k][0], b) for a, k, b in sorted(found)]


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0


def test_base_spans_of_random_texts():
    rng = random.Random(7)
    pieces = ["a", "b.", "@", "x@y.de", ".", "-", "+", "1", "25", "255", "256", "4111 1111 1111 1111", "+49 (30) 1234567",
              " ", "10.0.0.1", "\n", "é", "٣", "%", "_", "(", ")", "0", "00", "4539578763621486", "+1"]
    for _ in range(20000):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 12)))
        assert pii.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("text, spans", [
    ("pay to DE89 3704 0044 0532 0130 00 now", "iban:7:34"),
    ("pay to DE88 3704 0044 0532 0130 00 now", ""),
    ("visa card 4222222222222 ok", "card13:10:23"),
    ("number 4222222222222 ok", ""),
    ("her ssn is 123-45-6789.", "id:11:22"),
    ("123-45-6789 is my SSN", "id:0:11"),
    ("4222222222222 is my Visa card", "card13:0:13"),
    ("123-45-6789" + " " * 41 + "SSN", ""),
    ("part 123-45-6789.", ""),
    ("call 555-123-4567 today", "local_phone:5:17"),
    ("codes 555-123-4567 today", ""),
    ("mail a@b.co, 10.1.2.3", "email:5:11,ip:13:21"),
])
def test_added_kinds(text, spans):
    assert pii.joined(pii.find(text)[1]) == spans
    assert pii.find(text)[0] == plain_spans(text)


def test_operator(docs_of):
    texts = {1: "mail a.b+c@example.org and 10.0.0.1", 2: None, 3: "", 4: "é 4111-1111-1111-1111 é +49 30 123456789",
             5: "7" * 50000 + " " + "a" * 50000 + "@"}
    got = {r.doc_id: r for r in pii.detect(docs_of([*texts.items(), (1, texts[1])])).collect()}
    for i, text in texts.items():
        base = plain_spans(text or "")
        assert got[i].base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k, _ in PLAIN] == [sum(x == k for _, x, _ in base) for k, _ in PLAIN]
        assert set(pii.joined(base).split(",")) <= set(got[i].spans.split(","))
    assert pii.detect(docs_of([])).count() == 0
    assert pii.detect(docs_of([(1, "a"), (1, "a"), (None, "b")])).count() == 3


def test_redaction(docs_of):
    rows = [(1, "write to a@b.org, or +1 555 123 4567!"), (2, None), (3, "nothing here")]
    got = docs_of(rows).select("doc_id", pii.redacted("text").alias("t")).collect()
    assert {r.doc_id: r.t for r in got} == {1: "write to <email>, or <phone>!", 2: None, 3: "nothing here"}
