"""Chat formatting with Spark expressions only. [native]

A conversation's turns are collected, sorted by turn, and joined into one text:

    <s><|role|>text<|part|>text<|end|><|role|>text<|end|></s>

Adjacent turns of one role form one block, with <|part|> between them. In texts and roles a
backslash is doubled, and a backslash is put behind the first character of whatever could begin
a control string, so none of them appears in the output but by the template, and the texts can
be read back. The loss mask is the spans of the assistant's texts in the output.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What may begin a control string: <| of this template; <s> </s> <<SYS>> <</SYS>> [INST] [/INST].
CONTROL = r"<(?=\||/?s>|</?SYS>>|/SYS>>)|\[(?=/?INST\])"


def escape(text) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$0\\")


def escape_role(role) -> Column:
    """A role stands between <| and |>, so it must not close its mark."""
    return F.replace(escape(role), F.lit("|>"), F.lit("|\\>"))


def unescape(text) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(turns: DataFrame, assistant: str = "assistant") -> DataFrame:
    """conv_id, formatted and loss_spans ([start, end) in code points) of every conversation.

    `turns` has conv_id, turn, role and text; other columns are ignored. Null texts and roles are
    empty. Turns of one number are sorted by role and text, null numbers come first, and repeated
    rows are repeated turns. Rows without a conv_id form one conversation with a null id. The
    output of a conversation is one text, so its turns meet in one task.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"),
                    F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def marked(t, i):
        """Head, text and tail of a turn, and whether it counts for the loss."""
        before, after = F.try_element_at("turns", i.cast("int")), F.try_element_at("turns", (i + 2).cast("int"))
        merged = F.when(i > 0, before["role"] == t["role"]).otherwise(F.lit(False))
        ends = F.coalesce(after["role"] != t["role"], F.lit(True))
        return F.struct(
            F.when(merged, F.lit("<|part|>")).otherwise(F.concat(F.lit("<|"), escape_role(t["role"]), F.lit("|>"))).alias("head"),
            escape(t["text"]).alias("text"), F.when(ends, F.lit("<|end|>")).otherwise(F.lit("")).alias("tail"),
            (t["role"] == assistant).alias("loss"))

    parts = chats.withColumn("parts", F.transform("turns", marked))
    text = F.concat(F.lit("<s>"), F.array_join(F.transform(
        "parts", lambda p: F.concat(p["head"], p["text"], p["tail"])), ""), F.lit("</s>"))
    start = F.struct(F.lit(3).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc, p):
        begin = acc["at"] + F.length(p["head"])
        end = begin + F.length(p["text"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct((end + F.length(p["tail"])).alias("at"),
                        F.when(p["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return parts.select("conv_id", text.alias("formatted"),
                        F.aggregate("parts", start, step, lambda acc: acc["spans"]).alias("loss_spans"))


def read_back(formatted: str = "formatted") -> Column:
    """The turns of a formatted conversation: array of (role, text), in order."""
    inner = F.expr(f"substring({formatted}, 4, length({formatted}) - 7)")
    blocks = F.filter(F.split(inner, r"<\|end\|>"), lambda b: b != "")
    return F.flatten(F.transform(blocks, _block))


def _block(block):
    role = F.regexp_extract(block, r"(?s)\A<\|(.*?)\|>", 1)
    body = F.regexp_replace(block, r"(?s)\A<\|.*?\|>", "")
    return F.transform(F.split(body, r"<\|part\|>"), lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text")))


def loss_text(formatted: str = "formatted", spans: str = "loss_spans") -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")
