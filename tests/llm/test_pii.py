import hashlib
import random
import re

from mercatura.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    """The base items by plain regular expressions."""
    digits = lambda m: re.sub(r"[^0-9]", "", m.group())
    found = [(*m.span(), "email") for m in EMAIL.finditer(text)]
    found += [(*m.span(), "ip") for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    found += [
        (*m.span(), "card")
        for m in CARD.finditer(text)
        if 14 <= len(digits(m)) <= 19 and pii.luhn(digits(m))
    ]
    found += [(*m.span(), "phone") for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(found, key=lambda x: (x[0], pii.KINDS.index(x[2])))


def base(text):
    return [x for x in pii.find_spans(text) if x[2] in pii.BASE_KINDS]


def test_against_regular_expressions():
    draw = random.Random(5)
    pieces = [*"a1.@+- ()09é", "12", "255", "256", "4387513035237269", "a.b@c.de", "+1 (988) 555-2485", "1.2.3.4"]
    for _ in range(30000):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 14)))
        assert base(text) == brute(text), text


def test_added_kinds_and_bounds():
    text = "IBAN: DE89 3704 0044 0532 0130 00 and ftp://me:pw@host.example/x account no. 12345678."
    found = {kind: text[a:b] for a, b, kind in pii.find_spans(text)}
    assert found["account"] == "12345678"
    assert found["address"] == "me:pw@host.example"
    assert [text[a:b] for a, b, k in pii.find_spans(text) if k == "account"][0] == "DE89 3704 0044 0532 0130 00"
    for clean in ("on account of the 12 apostles", "accounts 123456", "iban", "see http://host/a", "ratio 3:4"):
        assert pii.find_spans(clean) == [], clean
    long = "a" * 300_000 + "@" + "b" * 300_000
    assert pii.find_spans(long) == [] and len(pii.find_spans("x@y.z " * 20_000)) == 20_000


def test_cues_in_any_letter_case():
    cues = (
        "account no. ", "account number: ", "passport no: ", "customer id: ", "member id ", "ssn id#", "konto nr. ",
        "kontonummer: ", "acct = ",
    )
    for cue in cues:
        for form in (cue, cue.capitalize(), cue.title(), cue.upper(), cue.swapcase()):
            for before in ("", "\u0130\u212a \u00c9\U0001f600 "):
                text = f"{before}{form}C1234567."
                assert [(text[a:b], k) for a, b, k in pii.find_spans(text)] == [("C1234567", "account")], text
                assert pii.masked(text) == f"{before}{form}[account]."
    for clean in ("Account Now 12345678", "ACCOUNTS 123456", "My\u0130ban: 12345678", "CUSTOMER \u0130D: 12345678"):
        assert pii.find_spans(clean) == [], clean


def test_rows(spark):
    docs = spark.createDataFrame(
        [(1, "a@b.c 1.2.3.4", 0), (1, "", 0), (None, None, 0)], "doc_id long, text string, spans int"
    )
    got = sorted(map(tuple, pii.find_pii(docs).collect()), key=repr)
    spans = "email:0:5,ip:6:13"
    empty = hashlib.sha256(b"").hexdigest()
    assert got == sorted(
        [
            (1, 1, 1, 0, 0, hashlib.sha256(spans.encode()).hexdigest(), spans),
            (1, 0, 0, 0, 0, empty, ""), (None, 0, 0, 0, 0, empty, ""),
        ],
        key=repr,
    )
    assert pii.find_pii(docs.limit(0)).count() == 0
    assert [r[0] for r in docs.select(pii.mask("text")).collect()] == ["[email] [ip]", "", None]
