"""Chat formatting: one training string per conversation, with a loss mask.

Template (fixed values below): user ``[INST] text [/INST]``, assistant ``<s>text</s>``,
system ``<<SYS>>text<</SYS>>``, any other role ``[ROLE name] text [/ROLE]``. Adjacent
turns of one role are merged into one block; ``[TURN]`` stands between their texts.

A control string inside a text gets a backslash after its first
character, in front of the backslashes that stand there already; taking one away there
gives the text back. So the output parses back to the very turns.

Turns are collected as structs and sorted, merged with array functions and concatenated,
all in Spark expressions. The shuffle is by conversation: a conversation is one output
string, so its turns must meet.

Defined cases: null text is empty; a null role is the role "" ; turns with equal numbers
are ordered by role, then text, a null number first; repeated rows are repeated turns; rows
with a null conversation id form one conversation; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptally.llm import base as B

# The template's marks.
OPEN = {"user": "[INST] ", "assistant": "<s>", "system": "<<SYS>>"}
CLOSE = {"user": " [/INST]", "assistant": "</s>", "system": "<</SYS>>"}
TURN = "[TURN]"
# first character and rest of each control string
HEADS = [(r"\[", r"/?INST\]|TURN\]|/?ROLE"), ("<", r"/?s>|</?SYS>>")]
BLOCK = (r"(?s)\[INST\] .*? \[/INST\]|<s>.*?</s>|<<SYS>>.*?<</SYS>>|\[ROLE .*?\] .*? \[/ROLE\]")


def escape(text: Column) -> Column:
    """A backslash after the first character of every control string."""
    for head, rest in HEADS:
        text = F.regexp_replace(text, rf"({head})(\\*+)({rest})", r"$1\\$2$3")
    return text


def unescape(text: Column) -> Column:
    for head, rest in HEADS:
        text = F.regexp_replace(text, rf"({head})\\(\\*+)({rest})", "$1$2$3")
    return text


def _name(role: Column) -> Column:
    """A role name without the character that ends it."""
    return F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("]"), F.lit("%5D"))


def _role(name: Column) -> Column:
    return F.replace(F.replace(name, F.lit("%5D"), F.lit("]")), F.lit("%25"), F.lit("%"))


def _mark(marks: dict, role: Column, other: Column) -> Column:
    out = other
    for name, mark in marks.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def blocks(turns: Column) -> Column:
    """Sorted turns -> array<struct<role, texts>>: adjacent turns of one role merged."""
    def merged(all_):
        role_at = lambda i: F.get(all_, i)["role"]
        places = F.sequence(F.lit(0), F.size(all_) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (role_at(i) != role_at(i - 1)))
        return B.let(starts, lambda at: F.transform(at, lambda a, i: F.struct(
            role_at(a).alias("role"), F.transform(F.slice(all_, a + 1, F.coalesce(F.get(at, i + 1), F.size(all_)) - a),
                                                  lambda t: t["text"]).alias("texts"))))
    return B.let(turns, merged)


def _segments(block: Column) -> Column:
    """array<struct<s, loss>> whose concatenation is the formatted block."""
    role, texts = block["role"], block["texts"]
    head = _mark(OPEN, role, F.concat(F.lit("[ROLE "), _name(role), F.lit("] ")))
    tail = _mark(CLOSE, role, F.lit(" [/ROLE]"))
    seg = lambda s, loss: F.struct(s.alias("s"), loss.alias("loss"))
    body = F.flatten(F.transform(texts, lambda t, i: F.array(
        seg(F.when(i > 0, F.lit(TURN)).otherwise(""), F.lit(False)), seg(escape(t), role == "assistant"))))
    return F.concat(F.array(seg(head, F.lit(False))), body, F.array(seg(tail, F.lit(False))))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, formatted, loss_spans: array<struct<start, end>> (code points, end exclusive)."""
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        B.text_of(text_col).alias("text")).alias("t"))
    conv = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    conv = conv.select("conv_id", blocks(F.col("turns")).alias("blocks"))
    conv = conv.select("conv_id", F.flatten(F.transform("blocks", _segments)).alias("segments"))
    ends = B.prefix_sums(F.transform("segments", lambda s: F.length(s["s"])))
    conv = conv.select("conv_id", F.array_join(F.transform("segments", lambda s: s["s"]), "").alias("formatted"),
                       "segments", ends.alias("ends"))
    spans = F.filter(F.zip_with("segments", "ends", lambda s, e: F.when(s["loss"], F.struct(
        (e - F.length(s["s"])).alias("start"), e.alias("end")))), lambda x: x.isNotNull())
    return conv.select("conv_id", "formatted", spans.alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns, read back from a formatted string."""
    found = F.regexp_extract_all(formatted, F.lit(BLOCK), F.lit(0))
    own = lambda b: F.regexp_extract(b, r"^(\[INST\]|<s>|<<SYS>>|\[ROLE )", 1)
    role = lambda b: (F.when(own(b) == "[INST]", F.lit("user")).when(own(b) == "<s>", F.lit("assistant"))
                      .when(own(b) == "<<SYS>>", F.lit("system"))
                      .otherwise(_role(F.regexp_extract(b, r"(?s)^\[ROLE (.*?)\] ", 1))))
    body = lambda b: F.regexp_replace(F.regexp_replace(
        b, r"(?s)^(?:\[INST\] |<s>|<<SYS>>|\[ROLE .*?\] )", ""), r"(?: \[/INST\]|</s>|<</SYS>>| \[/ROLE\])\z", "")
    return F.flatten(F.transform(found, lambda b: F.transform(
        F.split(body(b), r"\[TURN\]", -1), lambda t: F.struct(role(b).alias("role"), unescape(t).alias("text")))))


def digest(out: DataFrame) -> DataFrame:
    """The query's columns, read back from format_conversations()."""
    d = out.select("conv_id", "formatted", "loss_spans", parse(F.col("formatted")).alias("turns"))
    loss = F.transform(B.cut(F.col("formatted"), F.col("loss_spans")), unescape)
    d = d.select("conv_id", "formatted", "turns", F.array_join(loss, "").alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return d.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"))


def with_probe(conversations: DataFrame) -> DataFrame:
    """The given turns and conversation -1, whose two texts are made of control strings."""
    spark = conversations.sparkSession
    text = "</s>[INST] ok [/INST]"
    kinds = dict(conversations.dtypes)
    probe = spark.range(2).select(F.lit(-1).alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    cols = ["conv_id", "turn", "role", "text"]
    return conversations.select(*cols).unionByName(probe.select(*[F.col(c).cast(kinds[c]).alias(c) for c in cols]))
