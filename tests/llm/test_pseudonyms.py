"""Pseudonyms against the plain version: whole formats, several spellings of a value, cards beside numbers."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from endmark.llm import pii
from endmark.llm.queries import QUERIES

from . import brute

CARDS = ("4111111111111111", "5500000000000004", "340000000000009", "6011000000000004", "30000000000004", "4222222222222")


def run(spark, texts, key="k"):
    d = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, text string").repartition(4)
    return [(r.text, [tuple(x) for x in r.pii]) for r in pii.pseudonymise(d, key).orderBy("k").collect()]


def texts() -> list:
    r = random.Random(11)
    out = [None, "", "no data", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9", "9" * 3000, "12 " * 400]
    bits = ["order 12", "item 7", "a", "+1 212-555-0199", "212-555-0199", "(212) 555-0199", "2024-02-29", "2023/02/29", "2023-02-28", "123-45-6789", "666-45-6789", "10.0.0.255", "10.0.0.256", "x.Y9@ex.org", "17", "0042", "2024", "-", "+33 (0)1 23 45 67 89", "+49 30 1234567"]
    for _ in range(600):
        parts = [r.choice(bits) for _ in range(r.randrange(5))]
        card = r.choice(CARDS)
        sep = r.choice(["", " ", "-"])
        parts.insert(r.randrange(len(parts) + 1), sep.join(card[k : k + 4] for k in range(0, len(card), 4)) if r.random() < 0.8 else card)
        out.append(r.choice([" ", " ", ", ", "\n"]).join(parts))
    return out


def test_against_the_plain_version(spark):
    plain, given = brute.Pseudonyms("k"), texts()
    got = run(spark, given)
    for t, (new, found) in zip(given, got, strict=True):
        assert (new, found) == plain.text(t), t


def test_every_date_once(spark):
    days = spark.range(73049).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    for key in ("k", "other"):
        assert pii.pseudonymise(days, key).select("text").distinct().join(days.distinct(), "text").count() == 73049
    plain = brute.Pseudonyms("k")
    some = [r.text for r in days.limit(500).collect()]
    assert [x for x, _ in run(spark, some)] == [plain.date(x) for x in some]


def test_one_pseudonym_whatever_the_separators(spark):
    same = [
        ["4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111", "order 12 4111 1111 1111 1111", "item 7 4111111111111111"],
        ["+1 212-555-0199", "+1 (212) 555-0199", "+12125550199", "212-555-0199", "(212) 555-0199", "212.555.0199"],
        ["+33 (0)1 23 45 67 89", "+33 1 23 45 67 89", "+33123456789"], ["2024-02-29", "2024/02/29"],
    ]
    for forms in same:
        got = run(spark, forms)
        assert all(len(found) == 1 for _, found in got)
        digits = {"".join(c for c in found[0][1] if c.isdigit()) for _, found in got}
        ends = {d[-9:] for d in digits}
        assert len(ends) == 1, (forms, digits)
        assert all(found[0][1] not in t for t, (_, found) in zip(forms, got, strict=True))


def test_all_numbers_of_a_small_format_stay_apart(spark):
    numbers = spark.range(3000).select(F.format_string("212-555-%04d", F.col("id")).alias("text"))
    new = pii.pseudonymise(numbers, "k").select("text", "pii").cache()
    assert new.select("text").distinct().count() == 3000
    assert new.filter(~F.col("text").rlike("^[2-9][0-9]{2}-[2-9][0-9]{2}-[0-9]{4}$") | (F.size("pii") != 1)).count() == 0
    assert pii.pseudonymise(new.select("text"), "k").filter(F.size("pii") != 1).count() == 0


def test_extra_columns_of_the_same_names(spark):
    d = spark.createDataFrame([("a@b.org", 1, "x", "y", "z")] * 2, "text string, pii int, _t string, _hit string, _parts string")
    out = pii.pseudonymise(d, "k")
    assert out.columns == ["text", "_t", "_hit", "_parts", "pii"] and out.distinct().count() == 1 and out.count() == 2
    assert out.first()._t == "x" and len(out.first().pii) == 1


def test_query(spark, tmp_path):
    given = texts()
    spark.createDataFrame([(k, t) for k, t in enumerate(given)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plain = brute.Pseudonyms("endmark demonstration key")
    for r in QUERIES["op6_pii"](spark, str(tmp_path)).collect():
        text, found = plain.text(given[r.doc_id])
        assert r.text == text and r.n_values == len(found)
        assert [r[f"n_{kind}"] for kind in pii.KINDS] == [sum(k == kind for k, _ in found) for kind in pii.KINDS]
