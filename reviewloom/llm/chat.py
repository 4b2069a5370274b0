"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted by turn (null
turns first; rows of one turn by role, then text). Adjacent turns of one role are
merged into a block that keeps its turns apart by a separator, so reading back
gives every turn. Control strings inside roles and texts are escaped: a backslash
is doubled, and one is put behind the first character of every control string.

Null roles and texts count as empty, repeated rows are turns of their own, rows
without conv_id form a conversation of their own. Other columns are ignored. A
conversation is one row of output, so its turns meet in one task by nature.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import common


@dataclass(frozen=True)
class Template:
    """Markers of a block: start, role, text, next turn of the same role, end.

    Every marker and every string of `controls` must begin with a character other
    than a backslash; none may be a single character.
    """

    start: str = "<|turn|>"
    text: str = "<|text|>"
    more: str = "<|more|>"
    end: str = "<|end|>"
    trained_role: str = "assistant"
    controls: Sequence[str] = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

    def __post_init__(self) -> None:
        opened = all(any(m.startswith(c) for c in self.controls) for m in (self.start, self.text, self.more, self.end))
        if not opened or any(len(c) < 2 or "\\" in c for c in self.controls):
            raise ValueError("markers must begin with a control string of two or more characters, without backslash")


def escape(text: Column, t: Template) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in t.controls:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return out


def unescape(text: Column, t: Template) -> Column:
    for c in t.controls:
        text = F.replace(text, F.lit(f"{c[0]}\\{c[1:]}"), F.lit(c))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def quoted(marker: str) -> str:
    return f"\\Q{marker}\\E"


def format_conversations(turns: DataFrame, t: Template = Template()) -> DataFrame:
    """conv_id, formatted: one string for each conversation."""
    text, role = (F.coalesce(c, F.lit("")).alias(c) for c in ("text", "role"))
    # sorted as they are: escaped texts sort otherwise
    plain = turns.select("conv_id", F.struct("turn", role, text).alias("turn")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("turn")).alias("turns")
    )
    escaped = F.transform("turns", lambda x: F.struct(escape(x["role"], t).alias("role"), escape(x["text"], t).alias("text")))
    sorted_turns = plain.withColumn("turns", escaped)
    last = F.size("turns") - 1
    # places at which the role changes; the turns from one to the next make a block
    starts = F.filter(
        F.sequence(F.lit(0), last), lambda i: (i == 0) | (F.expr("turns")[i]["role"] != F.expr("turns")[F.greatest(i - 1, F.lit(0))]["role"])
    )
    blocks = sorted_turns.withColumn("starts", starts).withColumn(
        "stops", F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array(F.size("turns")))
    )

    def block(i: Column, k: Column) -> Column:
        own = F.slice("turns", i + 1, F.element_at("stops", k + 1) - i)
        merged = F.array_join(F.transform(own, lambda x: x["text"]), t.more)
        return F.concat(F.lit(t.start), F.element_at(own, 1)["role"], F.lit(t.text), merged, F.lit(t.end))

    return blocks.select("conv_id", F.array_join(F.transform("starts", block), "").alias("formatted"))


def read_turns(formatted: Column, t: Template = Template()) -> Column:
    """The turns (role, text) of a formatted conversation."""
    blocks = F.filter(F.split(formatted, quoted(t.end)), lambda b: b != "")

    def turns_of(block: Column) -> Column:
        body = F.split(F.substring(block, len(t.start) + 1, 2**31 - 1), quoted(t.text), 2)
        role = unescape(F.element_at(body, 1), t)
        texts = F.split(F.element_at(body, 2), quoted(t.more))
        return F.transform(texts, lambda x: F.struct(role.alias("role"), unescape(x, t).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def loss_spans(formatted: Column, t: Template = Template()) -> Column:
    """Spans (start, length) in code points of the trained role's texts, in order; start counts from 1."""
    blocks = F.filter(F.split(formatted, quoted(t.end)), lambda b: b != "")
    head = F.lit(t.start + t.trained_role + t.text)

    def step(acc: Column, block: Column) -> Column:
        texts = F.split(F.substring(block, len(t.start + t.trained_role + t.text) + 1, 2**31 - 1), quoted(t.more))

        def inner(a: Column, x: Column) -> Column:
            span = F.struct(a["at"].alias("start"), F.length(x).cast("int").alias("length"))
            return F.struct(
                (a["at"] + F.length(x) + len(t.more)).cast("int").alias("at"),
                F.concat(a["spans"], F.array(span)).alias("spans"),
            )

        begin = F.struct((acc["at"] + F.length(head)).cast("int").alias("at"), acc["spans"].alias("spans"))
        spans = F.when(F.startswith(block, head), F.aggregate(texts, begin, inner)["spans"]).otherwise(acc["spans"])
        return F.struct(
            (acc["at"] + F.length(block) + len(t.end)).cast("int").alias("at"), spans.alias("spans")
        )

    none = F.expr("cast(array() AS array<struct<start: int, length: int>>)")
    return F.aggregate(blocks, F.struct(F.lit(1).alias("at"), none.alias("spans")), step)["spans"]


def loss_text(formatted: Column, spans: Column, t: Template = Template()) -> Column:
    """All text under the mask, unescaped."""
    cut = F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"], s["length"]), t))
    return F.array_join(cut, "")


def digest(formatted: DataFrame, t: Template = Template()) -> DataFrame:
    """What reading the formatted strings back gives, as counts and SHA-256."""
    turns = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    read = formatted.select(
        "conv_id", "formatted", read_turns(F.col("formatted"), t).alias("turns"), loss_spans(F.col("formatted"), t).alias("spans")
    )
    read = read.withColumn("loss", loss_text(F.col("formatted"), F.col("spans"), t))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one whose texts are control strings of another template."""
    own = common.table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    say = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", say), (-7, 1, "assistant", say)], "conv_id long, turn long, role string, text string")
    return digest(format_conversations(own.unionByName(extra)))
