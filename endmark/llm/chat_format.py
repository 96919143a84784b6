"""Chat formatting of conversations whose turns hold typed content parts.

A visitor takes each turn's parts in order: a text is written as `<|text|>` and the text, escaped, and an image, audio clip or
document as a placeholder, with its reference, its place and the number of tokens it will expand to recorded beside it.
A turn is `<|turn|>role`, its parts, `<|end|>`; a turn without parts has one empty text. Control strings inside roles and texts get one U+2060
after their first character, which `unescape` takes away again; strings that already look escaped get one more. A part is escaped and
read back by itself and a control string stands between any two, so no control string can form across their edges and
any parts come back unchanged. The loss mask lists the spans of the assistant's text parts.

Only DataFrame functions are used. Turns are ordered by turn (nulls first), ties by role, then content as written. Null roles, texts and
parts are empty; null conversation ids form one conversation. A conversation is one row of the result and is gathered
as such; turns are formatted before they are gathered. Repeated rows are repeated turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .secret_scan import running

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
PART = "struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
# Pixels a side of an image patch, tokens of a second of audio and of a page.
PATCH, PER_SECOND, PER_PAGE = 28, 25, 512

#: What follows the first character of a control string: <| of any template, <s> </s>, [INST] [/INST], <<SYS>> <</SYS>>.
_REST = "(?=\\||/?s>|</?SYS>>|/?INST\\])"
MARK = "\u2060"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, f"([<\\[]{MARK}*){_REST}", f"$1{MARK}")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, f"([<\\[]{MARK}*){MARK}{_REST}", "$1")


def part(kind: str, **values: Column) -> Column:
    """A part of one kind; values: text, uri, width, height, seconds, pages."""
    names = ("text", "uri", "width", "height", "seconds", "pages")
    return F.struct(F.lit(kind).alias("kind"), *[values.get(n, F.lit(None)).alias(n) for n in names]).cast(PART)


def _tokens(p: Column) -> Column:
    """Tokens that an attachment's placeholder expands to; a missing measure counts as one unit."""
    patches = F.ceil(F.coalesce(p["width"], F.lit(PATCH)) / PATCH) * F.ceil(F.coalesce(p["height"], F.lit(PATCH)) / PATCH)
    return F.when(p["kind"] == "image", patches).when(p["kind"] == "audio", F.ceil(F.coalesce(p["seconds"], F.lit(1.0)) * PER_SECOND)).otherwise(F.coalesce(p["pages"], F.lit(1)) * PER_PAGE).cast("long")


def flatten_parts(parts: Column) -> Column:
    """Array of (kind, written, uri, tokens): what the template writes for each part in order. Unknown kinds are read as text, no part as an empty one."""

    def visit(p: Column) -> Column:
        mark = F.lit(None).cast("string")
        for kind, placeholder in PLACEHOLDERS.items():
            mark = F.when(p["kind"] == kind, F.lit(placeholder)).otherwise(mark)
        written = F.coalesce(mark, F.concat(F.lit(TEXT), escape(F.coalesce(p["text"], F.lit("")))))
        kind = F.when(mark.isNotNull(), p["kind"]).otherwise("text")
        return F.struct(kind.alias("kind"), written.alias("written"), F.when(mark.isNotNull(), p["uri"]).alias("uri"), F.when(mark.isNotNull(), _tokens(p)).alias("tokens"))

    given = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    return F.transform(F.when(F.size(given) > 0, given).otherwise(F.array(part("text"))), visit)


def format_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", learn: str = "assistant") -> DataFrame:
    """(conv, n_turns, formatted, loss, attachments, attachment_tokens), a row for each conversation. loss: array of (turn, start, length) and
    attachments: array of (turn, start, kind, uri, tokens), both with the turn's number from 0 and code points within the turn as written."""
    one = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), flatten_parts(F.col(parts)).alias("flat"))
    lengths = F.transform("flat", lambda p: F.char_length(p["written"]))
    one = one.withColumn("head", F.concat(F.lit(TURN), escape(F.col("role")))).withColumn("ends", running(lengths, lambda a, b: a + b))
    placed = F.zip_with("flat", "ends", lambda p, e: F.struct((F.char_length("head") + e - F.char_length(p["written"])).alias("start"), F.char_length(p["written"]).alias("length"), p["kind"].alias("kind"), p["uri"].alias("uri"), p["tokens"].alias("tokens")))
    one = one.withColumn("parts", placed).withColumn("content", F.array_join(F.transform("flat", lambda p: p["written"]), ""))
    row = F.struct("turn", "role", "content", "head", "parts")
    out = one.groupBy("conv").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    texts = lambda r, k: F.transform(F.filter(r["parts"], lambda p: (p["kind"] == "text") & (r["role"] == learn)), lambda p: F.struct(k.alias("turn"), (p["start"] + len(TEXT)).alias("start"), (p["length"] - len(TEXT)).alias("length")))
    others = lambda r, k: F.transform(F.filter(r["parts"], lambda p: p["kind"] != "text"), lambda p: F.struct(k.alias("turn"), p["start"].alias("start"), p["kind"].alias("kind"), p["uri"].alias("uri"), p["tokens"].alias("tokens")))
    out = out.select(
        F.col("conv").alias(conv), F.size("rows").cast("long").alias("n_turns"), F.array_join(F.transform("rows", lambda r: F.concat(r["head"], r["content"], F.lit(END))), "").alias("formatted"),
        F.flatten(F.transform("rows", texts)).alias("loss"), F.flatten(F.transform("rows", others)).alias("attachments"))
    return out.withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]))


def _turns(formatted: Column) -> Column:
    """The turns as written, from the role to the end. Live control strings are none but the template's."""
    return F.regexp_extract_all(formatted, F.lit(f"(?s){TURN}(.*?){END}".replace("|", "\\|")), F.lit(1))


def _split(turn: Column) -> tuple[Column, Column]:
    """A turn's marks (the placeholders and `<|text|>`), and what stands before the first and after each of them."""
    mark = "|".join([TEXT, *PLACEHOLDERS.values()]).replace("|", "\\|").replace(">\\|<", ">|<")
    return F.regexp_extract_all(turn, F.lit(mark), F.lit(0)), F.split(turn, mark, -1)


def read_parts(formatted: Column) -> Column:
    """Array of (role, parts) of a formatted conversation; parts: array of (kind, text), the text unescaped, null for an attachment."""
    kind = lambda mark: F.regexp_replace(mark, "[<>|]", "")
    part_of = lambda mark, text: F.struct(kind(mark).alias("kind"), F.when(mark == TEXT, unescape(text)).alias("text"))

    def turn(t: Column) -> Column:
        marks, texts = _split(t)
        return F.struct(unescape(F.get(texts, F.lit(0))).alias("role"), F.zip_with(marks, F.slice(texts, F.lit(2), F.size(texts)), part_of).alias("parts"))

    return F.transform(_turns(formatted), turn)


def read_back(formatted: Column) -> Column:
    """Array of (role, text) of a formatted conversation: the texts of a turn in order, unescaped, nothing between."""
    text = lambda parts: F.array_join(F.transform(F.filter(parts, lambda p: p["kind"] == "text"), lambda p: p["text"]), "")
    return F.transform(read_parts(formatted), lambda t: F.struct(t["role"].alias("role"), text(t["parts"]).alias("text")))


def under_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    turns = F.regexp_extract_all(formatted, F.lit(f"(?s){TURN}.*?{END}".replace("|", "\\|")), F.lit(0))
    cut = F.transform(loss, lambda x: F.struct(F.get(turns, x["turn"]).alias("of"), x["start"].alias("start"), x["length"].alias("length")))
    return F.transform(cut, lambda x: unescape(x["of"].substr(x["start"] + 1, x["length"])))
