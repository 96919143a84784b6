"""Format-preserving pseudonyms for personal data.

E-mail addresses, phone, card and social security numbers, IPv4 addresses and dates are found by one regex and
validated (Luhn sum, octets, calendar, number ranges); what fails stays as it is. A valid value is read as a list
of digits in mixed radix - decimal digits, letters, octets, or a day number in two parts whose radices multiply to the number of
days - and goes through a Feistel network on that list: in each round the entries at every other place are shifted, modulo
their radix, by a keyed digest of the rest. That is a permutation of the format's values: equal values get equal pseudonyms
in all documents, different ones different, and a pseudonym is valid itself (check digits are recomputed). The key is a parameter.

Separators are no part of a value: the digits are permuted and then laid into the format found, so a card or phone number keeps one
pseudonym however it is written. A phone number's country code is read from its digits by E.164 and kept, a trunk prefix `(0)` too. It ends with
the fewest whole digit groups that make a number of its country's length, so a number behind it stays as it is and one phone keeps one pseudonym; numbers
of 3-3-4 digits joined by hyphens or dots, or with the area code in brackets, are North American without a plus sign and get the pseudonym of the same
number with +1. A run of digit groups is searched for cards: every stretch of whole groups of 13 to 19 digits with a valid
check digit counts, usual groupings before others, then leftmost and longest, so a number beside a card doesn't hide it.

Only DataFrame functions are used; there is no shuffle. Null texts are empty texts without values; repeated rows
and extra columns are kept, columns named like the results replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, text_of
from .secret_scan import running

ROUNDS = 8
KINDS = ("email", "ipv4", "phone", "date", "ssn", "card")
_NATIONAL = r"(?:\([2-9]\d\d\)[ ]?|[2-9]\d\d[-.])[2-9]\d\d[-.]\d{4}(?![\d-])"
_DATE = r"(?:19|20)\d{2}(?:-\d{2}-\d{2}|/\d{2}/\d{2})(?![\d/-])"
_SSN = r"\d{3}-\d{2}-\d{4}(?![\d-])"
# a digit of a number with what may stand before it, not running on into a social security number, date or address behind it; and not into a card either
_NO = rf"[ ]\d{{3}}-\d\d-\d{{4}}|[ ](?:19|20)\d\d[-/]\d\d[-/]\d\d|[ ]{_NATIONAL}|[ ]\d{{1,3}}\.\d{{1,3}}\.\d{{1,3}}\."
_DIGIT = rf"(?:(?!{_NO})[ ./-]?\(?\d\)?)"
_STEP = rf"(?:(?![ -]\d{{4}}[ -]\d{{4}}[ -]\d{{4}}|{_NO})[ ./-]?\(?\d\)?)"
# How many digits the national numbers of countries have, by country code (a German mobile number begins 15, 16 or 17).
NATIONAL_LENGTHS = {
    "1": (10, 10), "7": (10, 10), "20": (8, 10), "27": (9, 9), "30": (10, 10), "31": (9, 9), "32": (8, 9), "33": (9, 9), "34": (9, 9), "36": (8, 9), "39": (8, 11), "40": (9, 9), "41": (9, 9), "43": (8, 12), "44": (10, 10),
    "45": (8, 8), "46": (7, 9), "47": (8, 8), "48": (9, 9), "49(?=[ ./(0)-]*1[5-7])": (10, 11), "49": (7, 11), "51": (8, 9), "52": (10, 10), "53": (8, 8), "54": (10, 11), "55": (10, 11), "56": (9, 9), "57": (10, 10),
    "58": (10, 10), "60": (9, 10), "61": (9, 9), "62": (9, 12), "63": (10, 10), "64": (8, 10), "65": (8, 8), "66": (8, 9), "81": (9, 10), "82": (9, 10), "84": (9, 10), "86": (10, 11), "90": (10, 10), "91": (10, 10),
    "92": (10, 10), "93": (9, 9), "94": (9, 9), "95": (8, 10), "98": (10, 10), "212": (9, 9), "213": (8, 9), "216": (8, 8), "234": (8, 10), "254": (9, 9), "351": (9, 9), "352": (8, 9), "353": (8, 9), "354": (7, 7), "355": (9, 9),
    "356": (8, 8), "357": (8, 8), "358": (8, 10), "359": (8, 9), "370": (8, 8), "371": (8, 8), "372": (7, 8), "373": (8, 8), "374": (8, 8), "375": (9, 9), "380": (9, 9), "381": (8, 9), "385": (8, 9), "386": (8, 8), "420": (9, 9),
    "421": (9, 9), "852": (8, 8), "853": (8, 8), "880": (10, 10), "886": (9, 9), "961": (7, 8), "962": (8, 9), "966": (9, 9), "971": (8, 9), "972": (8, 9), "973": (8, 8), "974": (8, 8),
}


def _countries() -> str:
    """A form for each pair of lengths: the country code, a trunk prefix and the fewest whole groups of so many digits."""
    forms = []
    for least, most in dict.fromkeys(NATIONAL_LENGTHS.values()):
        codes = "|".join(code for code, lengths in NATIONAL_LENGTHS.items() if lengths == (least, most))
        forms.append(rf"(?:{codes})(?:[ ./-]?\(0\))?{_DIGIT}{{{least},{most}}}?(?!\d)")
    return rf"(?<![0-9A-Za-z])\+(?:{'|'.join(forms)})"


_COUNTRIES = _countries()
# Forms of the kinds, tried in this order at each place.
FORMS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ipv4": r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)",
    "phone": r"\+\d{1,3}(?:[ -]?\(?\d{3}\)?[ -]\d{3}[ -]\d{4}|[ .-]?(?:\(0\) ?)?\d(?:[ .-]\d{2}){4}|[ .-]\d{3}(?:[ .-]\d{2}){3}|[ .-]\d{3}(?:[ .-]\d{3}){2}|[ .-]\d{2}[ .-]\d{3}(?:[ .-]\d{2}){2})(?!\d)"
    # any other grouping: the fewest whole groups whose digits are as many as the country's numbers have, else the fewest of 10 to 15 digits, else of 8 or 9
    rf"|{_COUNTRIES}|(?<![0-9A-Za-z])\+\d{_STEP}{{9,14}}?(?!\d)|(?<![0-9A-Za-z])\+\d{_STEP}{{7,8}}?(?!\d)"
    rf"|(?<![\d.+-]){_NATIONAL}",
    "date": rf"(?<![\d/-]){_DATE}",
    "ssn": rf"(?<![\d-]){_SSN}",
    # a run of digit groups that may hold cards, ending before any other kind; possessive, so a run of any length takes no stack
    "card": rf"(?<!\d)\d(?:(?![ -](?:{_DATE}|{_SSN}|{_NATIONAL}|\d{{1,3}}\.\d{{1,3}}\.\d{{1,3}}\.\d))[ -]?\d){{12,}}+(?!\d)",
}
ANY = "|".join(FORMS.values())
# E.164 country codes of one and two digits, others of three.
COUNTRY = "^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2}|0)"
# How card numbers are usually grouped, by the lengths of the groups.
USUAL = "^(?:1[3-9]|4-4-4-4(?:-[1-3])?|4-6-[45]|4-3-3-3)$"
#: Days from 1900-01-01 to 2099-12-31: 73049 = 17 x 4297.
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)


def _digits(m: Column) -> Column:
    return F.split(F.regexp_replace(m, "[^0-9]", ""), "").cast("array<int>")


def luhn_sum(digits: Column) -> Column:
    """Sum of a digit list whose last entry is the check digit, every second one from the right doubled."""
    n = F.size(digits)
    doubled = F.transform(digits, lambda d, i: F.when((n - i) % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d)


def _day(m: Column) -> Column:
    return F.try_to_timestamp(F.translate(m, "/", "-"), F.lit("yyyy-MM-dd"))


def kind_of(m: Column) -> Column:
    """The kind of a match, null if it isn't valid; runs of digits, in which cards are yet to be found, have the kind card."""
    octets = F.split(m, "\\.")
    area = F.substring(m, 1, 3)
    social = ~area.isin("000", "666") & ~m.startswith("9") & (F.substring(m, 5, 2) != "00") & (F.substring(m, 8, 4) != "0000")
    return (
        F.when(F.contains(m, F.lit("@")), "email")
        .when(m.startswith("+"), F.when(F.size(_digits(m)).between(8, 15), "phone"))
        .when(m.rlike(r"^\d+\.\d+\.\d+\.\d+$"), F.when(F.forall(octets, lambda o: o.cast("int") <= 255), "ipv4"))
        .when(m.rlike(r"^\d{4}([-/])\d\d\1\d\d$"), F.when(_day(m).isNotNull(), "date"))
        .when(m.rlike(r"^\d{3}-\d\d-\d{4}$"), F.when(social, "ssn"))
        .when(F.char_length(F.regexp_replace(m, "[^0-9]", "")) == 10, "phone")
        .otherwise("card")
    )


def feistel(values: Column, radices: Column, tweak: Column, key: str) -> Column:
    """The permutation of the lists below radices that key and tweak name."""

    def turn(v: Column, r: Column, radices: Column) -> Column:
        rest = F.array_join(F.transform(F.filter(v, lambda x, i: i % 2 != r % 2), lambda x: x.cast("string")), ".")
        salt = F.concat_ws("|", F.lit(key), tweak, r.cast("string"), rest)

        def shift(x: Column, i: Column) -> Column:
            by = F.conv(F.substring(F.sha2(F.concat_ws("|", salt, i.cast("string")), 256), 1, 12), 16, 10).cast("long")
            return F.when((i % 2 == r % 2) & (F.get(radices, i) > 1), ((x + by) % F.get(radices, i)).cast("int")).otherwise(x)

        return F.transform(v, shift)

    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return _let(F.struct(values.alias("v"), radices.alias("r")), lambda x: F.aggregate(rounds, x["v"], lambda v, r: turn(v, r, x["r"])))


def _let(value: Column, of) -> Column:
    """of(value) with value computed once."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _laid(m: Column, digits: Column) -> Column:
    """m with its digits replaced in order."""
    return F.array_join(F.zip_with(F.split(m, "[0-9]", -1), digits.cast("array<string>"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def _tens(digits: Column) -> Column:
    return F.transform(digits, lambda d: F.lit(10))


_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _email(m: Column, key: str) -> Column:
    """Letters and digits before the @ permuted within their alphabets; the domain stays."""

    def entry(c: Column) -> Column:
        one = F.struct(F.lit(0).alias("v"), F.lit(1).alias("r"), F.lit("").alias("of"))
        for alphabet in _ALPHABETS:
            at = F.instr(F.lit(alphabet), c) - 1
            inside = F.struct(at.cast("int").alias("v"), F.lit(len(alphabet)).alias("r"), F.lit(alphabet).alias("of"))
            one = F.when((F.length(c) == 1) & (at >= 0), inside).otherwise(one)
        return one

    def spelled(e: Column) -> Column:
        out = feistel(F.transform(e, lambda x: x["v"]), F.transform(e, lambda x: x["r"]), F.lit("email"), key)
        letters = F.zip_with(e, out, lambda x, y: F.when(x["r"] > 1, F.substr(x["of"], y + 1, F.lit(1))))
        return F.array_join(F.zip_with(letters, F.split(F.substring_index(m, "@", 1), ""), lambda a, b: F.coalesce(a, b)), "")

    return F.concat(_let(F.transform(F.split(F.substring_index(m, "@", 1), ""), entry), spelled), F.lit("@"), F.substring_index(m, "@", -1))


def _phone(m: Column, key: str) -> Column:
    """Country code, trunk prefix and separators kept, all other digits permuted. The area code and exchange of ten digits in country 1 keep
    whether they begin below 2, so valid numbers stay valid."""
    national = ~m.startswith("+")
    all_ = F.regexp_replace(m, "[^0-9]", "")
    code = F.when(national, F.lit("1")).otherwise(F.regexp_extract(all_, COUNTRY, 0))
    kept = F.when(national, 0).otherwise(F.length(code) + F.when(m.rlike(r"^\+\d{1,3}[ .-]?\(0\)"), 1).otherwise(0))

    def turned(x: Column) -> Column:
        digits = F.split(F.substr(x["all"], x["kept"] + 1), "").cast("array<int>")
        return _let(digits, lambda d: _let(F.transform(d, lambda c, i: entry(c, (x["code"] == "1") & (F.size(d) == 10) & i.isin(0, 3))), lambda es: placed(x, es)))

    def entry(d: Column, first: Column) -> Column:
        low = F.when(first & (d >= 2), 2).otherwise(0)
        return F.struct((d - low).alias("v"), F.when(first, F.when(d >= 2, 8).otherwise(2)).otherwise(10).alias("r"), low.alias("low"))

    def placed(x: Column, es: Column) -> Column:
        out = feistel(F.transform(es, lambda e: e["v"]), F.transform(es, lambda e: e["r"]), F.concat(F.lit("phone|"), x["code"]), key)
        fixed = F.slice(F.split(x["all"], "").cast("array<int>"), F.lit(1), x["kept"])
        return _laid(m, F.concat(fixed, F.zip_with(out, es, lambda d, e: d + e["low"])))

    return _let(F.struct(all_.alias("all"), code.alias("code"), kept.alias("kept")), turned)


def _ipv4(m: Column, key: str) -> Column:
    octets = F.split(m, "\\.").cast("array<int>")
    return F.array_join(feistel(octets, F.array(*[F.lit(256)] * 4), F.lit("ipv4"), key).cast("array<string>"), ".")


def _date(m: Column, key: str) -> Column:
    day = F.datediff(_day(m).cast("date"), F.lit(FIRST_DAY).cast("date"))
    out = feistel(F.array(F.floor(day / DAYS[1]).cast("int"), day % DAYS[1]), F.array(*map(F.lit, DAYS)), F.lit("date"), key)
    new = _let(out, lambda x: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), F.get(x, F.lit(0)) * DAYS[1] + F.get(x, F.lit(1))), "yyyy-MM-dd"))
    return F.when(F.contains(m, F.lit("/")), F.translate(new, "-", "/")).otherwise(new)


def _ssn(m: Column, key: str) -> Column:
    """Ranges without the forbidden ones: area below 900 but 000 and 666, group and serial from 1."""
    area, group, serial = (F.substring(m, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    values = F.array(F.when(area > 666, area - 2).otherwise(area - 1), group - 1, serial - 1)
    out = feistel(values, F.array(F.lit(898), F.lit(99), F.lit(9999)), F.lit("ssn"), key)
    back = lambda x: F.concat_ws("-", F.lpad(F.when(F.get(x, F.lit(0)) > 664, F.get(x, F.lit(0)) + 2).otherwise(F.get(x, F.lit(0)) + 1).cast("string"), 3, "0"), F.lpad((F.get(x, F.lit(1)) + 1).cast("string"), 2, "0"), F.lpad((F.get(x, F.lit(2)) + 1).cast("string"), 4, "0"))
    return _let(out, back)


def _card(m: Column, key: str) -> Column:
    """First digit and separators kept, check digit recomputed."""

    def turned(d: Column) -> Column:
        body = F.slice(d, F.lit(2), F.size(d) - 2)
        tweak = F.concat_ws("|", F.lit("card"), F.size(d).cast("string"), F.get(d, F.lit(0)).cast("string"))
        return _let(F.concat(F.slice(d, 1, 1), feistel(body, _tens(body), tweak, key)), checked)

    def checked(d: Column) -> Column:
        return _laid(m, F.concat(d, F.array((10 - luhn_sum(F.concat(d, F.array(F.lit(0)))) % 10) % 10)))

    return _let(_digits(m), turned)


_OF = {"email": _email, "ipv4": _ipv4, "phone": _phone, "date": _date, "ssn": _ssn}
_ITEMS = "array<struct<kind:string,pseudonym:string>>"


def _stretches(groups: Column) -> Column:
    """For a list of digit groups, the disjoint stretches (at, n) of whole groups that are cards."""

    def here(i: Column) -> Column:
        few = F.transform(F.sequence(F.lit(1), F.least(F.lit(19), F.size(groups) - i)), lambda n: F.struct(n.alias("n"), F.slice(groups, i + 1, n).alias("gs")))
        long_enough = F.filter(few, lambda x: F.char_length(F.array_join(x["gs"], "")).between(13, 19))
        valid = F.filter(long_enough, lambda x: luhn_sum(_digits(F.array_join(x["gs"], ""))) % 10 == 0)
        usual = F.filter(valid, lambda x: F.array_join(F.transform(x["gs"], lambda g: F.char_length(g).cast("string")), "-").rlike(USUAL))
        most = lambda xs: F.coalesce(F.array_max(F.transform(xs, lambda x: x["n"])), F.lit(0))
        return F.struct(most(usual).alias("usual"), most(valid).alias("any"))

    def walk(best: Column) -> Column:
        start = F.struct(F.lit(0).alias("next"), F.array().cast("array<struct<at:int,n:int>>").alias("taken"))

        def step(s: Column, i: Column) -> Column:
            own = F.get(best, i)
            covers = F.exists(F.slice(best, i + 2, F.greatest(own["any"] - 1, F.lit(0))), lambda x: x["usual"] > 0)
            n = F.when(s["next"] > i, 0).when(own["usual"] > 0, own["usual"]).when(~covers, own["any"]).otherwise(0)
            return F.when(n > 0, F.struct((i + n).alias("next"), F.concat(s["taken"], F.array(F.struct(i.alias("at"), n.alias("n")))).alias("taken"))).otherwise(s)

        return F.aggregate(F.sequence(F.lit(0), F.size(groups) - 1), start, step, lambda s: s["taken"])

    return _let(F.transform(F.sequence(F.lit(0), F.size(groups) - 1), here), walk)


def _cards(m: Column, key: str) -> Column:
    """(now, items) of a run of digit groups: the cards in it replaced. Groups are joined by one character each."""

    def of(groups: Column) -> Column:
        ends = running(F.transform(groups, lambda g: F.char_length(g) + 1), lambda a, b: a + b)
        placed = lambda x, e: F.struct((F.get(e, x["at"]) - F.char_length(F.get(groups, x["at"]))).alias("start"), (F.get(e, x["at"] + x["n"] - 1) - 1).alias("end"))
        return _let(ends, lambda e: _let(F.transform(_stretches(groups), lambda x: placed(x, e)), written))

    def written(cards: Column) -> Column:
        new = F.transform(cards, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), _card(F.substr(m, c["start"], c["end"] - c["start"] + 1), key).alias("now")))
        return _let(new, joined)

    def joined(cards: Column) -> Column:
        before = lambda i: F.when(i == 0, 0).otherwise(F.coalesce(F.get(cards, F.greatest(i - 1, F.lit(0)))["end"], F.lit(0)))
        pieces = F.transform(cards, lambda c, i: F.concat(F.substr(m, before(i) + 1, c["start"] - before(i) - 1), c["now"]))
        now = F.concat(F.array_join(pieces, ""), F.substr(m, before(F.size(cards)) + 1))
        return F.struct(now.alias("now"), F.transform(cards, lambda c: F.struct(F.lit("card").alias("kind"), c["now"].alias("pseudonym"))).cast(_ITEMS).alias("items"))

    return _let(F.split(m, "[ -]"), of)


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    """(now, items): what a match is replaced by, and the values in it (none if it isn't valid)."""
    one = lambda name: lambda now: F.struct(now.alias("now"), F.array(F.struct(F.lit(name).alias("kind"), now.alias("pseudonym"))).cast(_ITEMS).alias("items"))
    out = F.struct(m.alias("now"), F.array().cast(_ITEMS).alias("items"))
    for name, of in _OF.items():
        out = F.when(kind == name, _let(of(m, key), one(name))).otherwise(out)
    return F.when(kind == "card", _cards(m, key)).otherwise(out)


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """docs with the personal data in the text replaced, and pii: array of (kind, pseudonym) in order."""
    docs = docs.drop(*[c for c in ("pii",) if c != text])
    t, hit, parts = fresh(docs, "t", "hit", "parts")
    d = docs.withColumn(t, text_of(text)).withColumn(hit, F.col(t).rlike(ANY))
    named = F.transform(F.regexp_extract_all(F.col(t), F.lit(ANY), F.lit(0)), lambda m: F.struct(m.alias("m"), kind_of(m).alias("kind")))
    d = d.withColumn(parts, F.when(F.col(hit), F.transform(named, lambda x: pseudonym(x["m"], x["kind"], key))))
    between = F.split(F.col(t), ANY, -1)
    now = F.array_join(F.zip_with(between, F.transform(parts, lambda x: x["now"]), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    pii = F.flatten(F.transform(F.col(parts), lambda x: x["items"]))
    return d.withColumn(text, F.when(F.col(hit), now).otherwise(F.col(text))).withColumn("pii", F.when(F.col(hit), pii).otherwise(F.array().cast(_ITEMS))).drop(t, hit, parts)
