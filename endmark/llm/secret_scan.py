"""Secret scan over a trigram inverted index.

Each rule's regex gives a Boolean trigram query. The index holds postings for the trigrams that the queries
name (their number is bounded by the rules): documents are dealt into blocks by their key's digest, and a
block's row for a trigram lists its documents, so no posting list grows beyond a block. Within a block the
lists of a query's alternatives are intersected and the results united. Only candidates are verified with the regex itself;
rules without mandatory trigrams scan every text.

Only DataFrame functions are used. The key is a digest of doc_id and text: rows that share it have the same
candidates (should two differ, both are verified, so nothing is lost). Null texts are empty; every row gives a
row, repeated ones too; an empty table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, text_of
from .trigrams import trigram_query


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0  # this group must have `least` characters
    least: int = 0

    @property
    def query(self) -> list[frozenset[str]]:
        return trigram_query(self.pattern)


# Patterns of secrets in order of precedence. For the runs of one class (access, hex) the least length
# stands in the pattern: such a run ends where the class does, so its matches are those of the plain pattern that are long enough.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", "AKIA[A-Z0-9]{14,}"),
    Rule("hex", "[0-9a-f]{16,}"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)
SPAN = "array<struct<start:int,kind_no:int,end:int>>"
BLOCK = 4096  # documents, about


def _key(docs: DataFrame, key: str, text: str) -> Column:
    return F.xxhash64(F.col(key), text_of(text))


def trigram_index(docs: DataFrame, trigrams: list[str], key: str = "doc_id", text: str = "text", blocks: int | None = None) -> DataFrame:
    """(block, trigram int, postings array<long>): the keys of the documents of a block that hold a trigram, by its place in the list."""
    blocks = blocks or max(1, docs.count() // BLOCK)
    low = docs.select(_key(docs, key, text).alias("key"), F.lower(text_of(text)).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(k)) for k, t in enumerate(trigrams)]))
    rows = low.select("key", F.explode(held).alias("trigram"))
    return rows.groupBy(F.pmod("key", F.lit(blocks)).alias("block"), "trigram").agg(F.collect_set("key").alias("postings"))


def candidates(index: DataFrame, trigrams: list[str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, rules array<int>): for the rules with mandatory trigrams, the documents that hold what one of a query's alternatives asks for."""
    place = {t: k for k, t in enumerate(trigrams)}
    lists = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "postings"))).alias("of"))
    none = F.array().cast("array<bigint>")
    posting = lambda t: F.coalesce(F.element_at("of", F.lit(place[t])), none)
    found = []
    for no, rule in enumerate(rules):
        if all(rule.query):
            alternatives = [reduce(F.array_intersect, map(posting, sorted(x))) for x in rule.query]
            named = F.lit(no).alias("rule")
            found.append(F.transform(reduce(F.array_union, alternatives), lambda k: F.struct(k.alias("key"), named)))  # noqa: B023
    one = lists.select(F.explode(F.concat(*found)).alias("x")) if found else lists.select(F.struct(F.lit(0).cast("long").alias("key"), F.lit(0).alias("rule")).alias("x")).limit(0)
    return one.groupBy("x.key").agg(F.collect_set("x.rule").alias("rules"))


def running(values: Column, of) -> Column:
    """Running totals of an array under an associative function, in log2(n) rounds: in round k each adds what stands 2^k before."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(values) + 1)).cast("int"))
    step = lambda acc, k: F.transform(acc, lambda x, i: F.coalesce(of(x, F.get(acc, i - F.pow(F.lit(2), k).cast("int"))), x))
    return F.aggregate(rounds, values, step)


def spans(text: Column, rule: Rule, no: int) -> Column:
    """Leftmost non-overlapping matches of a rule as (start, kind_no, end) in code points, end exclusive. The regex cuts the text
    into the pieces between matches; lengths of pieces and matches add up to places."""
    pattern = F.lit(rule.pattern)
    between, matches = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    measured = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    sizes = F.zip_with(F.slice(between, F.lit(1), F.size(matches)), matches, lambda a, b: (F.char_length(a) + F.char_length(b)))
    ends = running(sizes, lambda a, b: a + b)
    found = F.transform(F.arrays_zip(ends.alias("end"), matches.alias("m"), measured.alias("g")), lambda x: F.struct((x["end"] - F.char_length(x["m"])).alias("start"), F.lit(no).alias("kind_no"), x["end"].alias("end"), F.char_length(x["g"]).alias("n")))
    kept = F.filter(found, lambda x: x["n"] >= rule.least)
    return F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["kind_no"].alias("kind_no"), x["end"].alias("end"))).cast(SPAN)


def secret_scan(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, blocks: int | None = None) -> DataFrame:
    """docs with secrets: array of (start, kind_no, end) sorted by start and rule; kind_no is the rule's place."""
    docs = docs.drop(*[c for c in ("secrets",) if c != text])
    own, at, todo, t = fresh(docs, "key", "at", "todo", "t")
    trigrams = sorted({g for rule in rules for x in rule.query for g in x})
    narrow = docs.select(key, text)
    todos = candidates(trigram_index(narrow, trigrams, key, text, blocks), trigrams, rules).select(F.col("key").alias(at), F.col("rules").alias(todo))
    # keys are digests, equal only for equal rows; Spark broadcasts the candidates if few, else shuffles and splits hot keys
    out = docs.withColumn(own, _key(docs, key, text)).join(todos, F.col(own) == F.col(at), "left").withColumn(t, text_of(text))
    none = F.array().cast(SPAN)
    found = []
    for no, rule in enumerate(rules):
        asked = F.array_contains(todo, F.lit(no)) if all(rule.query) else F.col(t).rlike(rule.pattern)
        found.append(F.when(asked, spans(F.col(t), rule, no)).otherwise(none))
    return out.withColumn("secrets", F.sort_array(F.concat(*found))).drop(own, at, todo, t)


def redact(scanned: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """scanned with each secret (overlapping ones together) in the text replaced by mark; without the column secrets."""
    chars, ends = fresh(scanned, "chars", "ends")
    some = F.size("secrets") > 0
    d = scanned.withColumn(chars, F.when(some, F.split(text, "")))
    d = d.withColumn(ends, F.when(some, running(F.transform("secrets", lambda x: x["end"]), lambda a, b: F.when(b.isNotNull(), F.greatest(a, b)))))
    before = lambda i: F.coalesce(F.get(F.col(ends), i - 1), F.lit(0))
    part = lambda x, i: F.when(x["start"] >= before(i), F.concat(F.array_join(F.slice(F.col(chars), before(i) + 1, x["start"] - before(i)), ""), F.lit(mark))).otherwise("")
    last = F.element_at(F.col(ends), -1)
    clean = F.concat(F.array_join(F.transform("secrets", part), ""), F.array_join(F.slice(F.col(chars), last + 1, F.greatest(F.size(chars) - last, F.lit(0))), ""))
    return d.withColumn(text, F.when(some, clean).otherwise(F.col(text))).drop(chars, ends, "secrets")
