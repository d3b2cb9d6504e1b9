"""Personal data against a brute-force version with plain patterns."""

import re

import pytest

from docweave.llm import pii
from tests.llm.brute import read

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def valid(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "", re.A) if valid(k, m.group())]


TRICKY = [
    None, "", " ", "a@b.c", "a@b.c_d@e.f", "a@b", "x.y+z%w-v@a-b.c-d.e!", "@a.b a@.b a@b. a@b..c", "é@b.c öa@b.cé",
    "1.2.3.4.5.6.7.8", "0001.2.3.0255 256.1.1.1 1.2.3.256 1.2.3", "99999999999999999999.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111-1", "4111  1111 1111 1111", "4111111111111111 4111111111111112",
    "+1 (555) 555-0100.", "+12", "+1 2", "+1234567 ", "+1234567890123456", "++12345678  9 ", "+1 415 5550100 4111111111111111",
    "😀 a@b.c 😀 1.2.3.4 😀 +1 415 555 0100", "1" * 20000, "a" * 20000 + "@b.c", "a@b.c " * 3000 + "9.9.9.9 " * 700,
    "1-" * 9000, "+1" + "-" * 9000, "DE89 3704 0044 0532 0130 00 and DE89370400440532013001", "ssn 123-45-6789, 123-45-6789",
]


def spans_of(df):
    return [(r["n"], [(s["kind"], s["start"], s["end"]) for s in r["pii_spans"]]) for r in df.collect()]


def test_base_spans_equal_plain_patterns(spark):
    df = spark.createDataFrame(list(enumerate(TRICKY)), "n int, text string")
    for n, found in spans_of(pii.find_pii(df)):
        assert [s for s in found if s[0] in pii.BASE_KINDS] == brute(TRICKY[n]), TRICKY[n] and TRICKY[n][:60]


def test_query_equals_brute_force(spark):
    import hashlib

    d = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in read(d, "documents")}
    rows = pii.q_op3(spark, d).collect()
    assert len(rows) == len(texts)
    some = 0
    for r in rows:
        want = brute(texts[r["doc_id"]])
        some += bool(want)
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[0] == k for s in want) for k in pii.BASE_KINDS]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
    assert some > 20


def test_checksums_and_context(spark):
    rows = [("DE89 3704 0044 0532 0130 00",), ("DE88 3704 0044 0532 0130 00",), ("my ssn: 123-45-6789",), ("no. 123-45-6789",), ("ssn 000-45-6789",)]
    got = [[s["kind"] for s in r["pii_spans"] if s["kind"] in pii.ADDED_KINDS] for r in pii.find_pii(spark.createDataFrame(rows, "text string")).collect()]
    assert got == [["iban"], [], ["ssn"], [], []]
    a, b = (r["pii_spans"][0]["score"] for r in pii.find_pii(spark.createDataFrame([("4111111111111111",), ("card 4111111111111111",)], "text string")).collect())
    assert b > a


@pytest.mark.parametrize("text,want", [
    (None, None), ("", ""), ("plain", "plain"), ("a@b.c", "[EMAIL]"), ("x a@1.2.3.4 y", "x [EMAIL] y"),
    ("é a@b.c, +1 415 555 0100!", "é [EMAIL], [PHONE]!"), ("1.2.3.4 a@b.c", "[IP] [EMAIL]"),
])
def test_redact(spark, text, want):
    assert pii.redact(spark.createDataFrame([(1, text)], "doc_id int, text string")).collect()[0]["text"] == want


def test_empty_table_clashing_names_and_repeats(spark):
    df = spark.createDataFrame([(None, "a@b.c", 7, "k"), (None, "a@b.c", 7, "k")], "doc_id long, text string, kind int, start string")
    out = pii.find_pii(df)
    assert out.columns == ["doc_id", "text", "kind", "start", "pii_spans"] and out.count() == 2
    assert pii.redact(df).select("text").collect()[0][0] == "[EMAIL]"
    assert pii.find_pii(df.limit(0)).count() == 0


@pytest.mark.parametrize("after", ["", " Please", " BIC COBADEFFXXX", " COBADEFF", " 12345 67", " GB82 WEST 1234 5698 7654 32", " I am", ".", "\nNO12"])
@pytest.mark.parametrize("iban", ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00"])
def test_iban_before_capitals_and_digits(spark, iban, after):
    text = f"REF AB12 {iban}{after}"
    spans = pii.find_pii(spark.createDataFrame([(text,)], "text string")).first()["pii_spans"]
    found = [text[s["start"]:s["end"]] for s in spans if s["kind"] == "iban"]
    assert found == [iban] + ["GB82 WEST 1234 5698 7654 32"] * ("GB82" in after)


def test_columns_with_the_operators_own_names(spark):
    df = spark.createDataFrame([("mail a@b.c now", "m", "s", 1, 2)], "text string, pii_of_m_email string, PII_OF_s_ip string, pii_in_spans int, pii_in_cover int")
    out = pii.find_pii(df)
    assert out.columns == [*df.columns, "pii_spans"] and [tuple(x)[:3] for x in out.first()["pii_spans"]] == [("email", 5, 10)]
    assert tuple(pii.redact(df).first()) == ("mail [EMAIL] now", "m", "s", 1, 2)
