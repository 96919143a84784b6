"""Phone numbers of international groupings, whatever their area code."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from endmark.llm import pii

PHONES = {
    "+1 (017) 555-7713": "+1", "+1 (117) 555-7713": "+1", "+1-212-555-0199": "+1", "+5 (212) 555-0199": "+5", "+33 6 12 34 56 78": "+33", "+33612345678": "+33", "+33 (0)1 23 45 67 89": "+33",
    "+49 30 123456": "+49", "+49 (0)171 1234567": "+49", "+49 89/1234-567": "+49", "+34 612 34 56 78": "+34", "+34 612 345 678": "+34", "+34 91 123 45 67": "+34", "+44 20 7946 0958": "+44", "+351 912 345 678": "+351",
}
NOT = ("+1 234", "1 + 2", "+12 345", "a+12345678b+1", "+1234567890123456")


def test_international_numbers(spark):
    d = spark.createDataFrame([(f"call {p}, or not",) for p in PHONES] + [(f"x {n} y",) for n in NOT], "text string")
    got = [(r.text, [(p.kind, p.pseudonym) for p in r.pii]) for r in pii.pseudonymise(d, "k").collect()]
    for (phone, code), (text, found) in zip(PHONES.items(), got, strict=False):
        (kind, new), = found
        assert kind == "phone" and text == f"call {new}, or not"
        assert new.startswith(code) and new != phone
        assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", phone)
    assert [t for t, _ in got[len(PHONES):]] == [f"x {n} y" for n in NOT]


def test_numbers_behind_a_phone_number_stay_their_own(spark):
    text = "+33 6 12 34 56 78 4111 1111 1111 1111; +49 30 1234567 4111 1111 1111 1111; +49 30 1234567 2024-02-29; +49 30 1234567 123-45-6789; +49 30 1234567 10.0.0.255"
    row = pii.pseudonymise(spark.createDataFrame([(text,)], "text string"), "k").first()
    assert [p.kind for p in row.pii] == ["phone", "card", "phone", "card", "phone", "date", "phone", "ssn", "phone", "ipv4"]


BEHIND = ("", " 100 apples", " 12 pcs", ", 7 days", " 1999 was", " 3.5 km", " +33 6 12 34 56 78", " 2024-02-29", " 250,000 people", " 5")


def test_a_number_behind_is_no_part_of_a_phone_number(spark):
    """One phone has one pseudonym, whatever quantity, year, page or phone follows; that stays as it is."""
    phones = ("+44 20 7946 0958", "+49 30 901820", "+49 171 1234567", "+49 1512 345 6789", "+33 1 23 45 67 89", "+55 11 1234 5678", "+55 11 91234 5678", "+39 06 1234 5678", "+1 212 555 0199", "+48 22 123 45 67", "+31 20 123 4567", "+86 138 0013 8000", "+351 21 123 4567", "+61 2 9374 4000")
    texts = [(f"call {p}{b}", p, b) for p in phones for b in BEHIND]
    got = {r.text0: (r.text, r.pii) for r in pii.pseudonymise(spark.createDataFrame(texts, "text string, phone string, behind string").withColumn("text0", F.col("text")), "k").collect()}
    for p in phones:
        new = got[f"call {p}"][1][0].pseudonym
        assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", p) and new != p
        for b in BEHIND:
            text, found = got[f"call {p}{b}"]
            assert text.startswith(f"call {new}"), (p, b, text)
            if "+" not in b and "-" not in b:
                assert text == f"call {new}{b}" and len(found) == 1, (p, b, text)


def test_numbers_of_unusual_length(spark):
    """A number that fits no length of its country, or of a country that isn't listed, is still found whole."""
    for p in ("+44 1234 5678", "+49 555 0100", "+999 12 345 678", "+298 20 12 34 56"):
        row = pii.pseudonymise(spark.createDataFrame([(f"x {p}.",)], "text string"), "k").first()
        assert [x.kind for x in row.pii] == ["phone"] and re.sub(r"\d", "0", row.text) == re.sub(r"\d", "0", f"x {p}."), (p, row.text)
