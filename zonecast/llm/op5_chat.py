"""Operator 5: chat formatting as a grammar round trip, in DataFrame functions only.

A conversation is rendered turn by turn as ``<|im_start|>role\\ntext<|im_end|>\\n`` and parsed back by one
deterministic grammar: cut at end marks, role up to the first newline, no mark inside a text, then undo
escapes. If the turns
read back differ from the source, the texts of the turns that do not round trip alone are escaped (one
backslash more between ``<`` and ``|`` of every control-like string ``<|``, ``<\\|``, ``<\\\\|``, ...) and the whole
is rendered and read back again; a conversation that still differs raises an error. Ordinary texts are
never changed. Roles are escaped like URL parts where they hold a newline, ``<`` or ``%``.

Output per conversation: formatted text, the turns read back, and the loss mask as code point ranges
of assistant content in the formatted text. One aggregation by conv_id is the only shuffle; a
conversation is one value of the result by definition.

Defined results: null text or role is empty; turns are ordered by turn (nulls first), then role, then text;
repeated rows are turns of their own; rows with a null conv_id form one conversation; an empty table gives no
rows. Only conv_id, turn, role and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LEARNED_ROLE = "assistant"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    for plain, code in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for plain, code in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), escape_role(role), F.lit("\n"), text, F.lit(END + "\n"))


def parse(formatted: Column) -> Column:
    """Turns (role, body, text) of a rendered conversation; body is the text as it stands there. The grammar
    has no control mark inside a body: such a turn has no text (null), and so differs from any source."""
    def turn(part: Column) -> Column:
        content = F.substr(part, F.lit(len(START) + 1))
        at = F.locate("\n", content)
        body = F.substr(content, at + 1)
        return F.struct(unescape_role(F.substr(content, F.lit(1), at - 1)).alias("role"), body.alias("body"),
                        F.when(~F.contains(body, F.lit("<|")), unescape_text(body)).alias("text"))

    parts = F.split(formatted, r"\Q" + END + "\n\\E")
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)


def _joined(turns: Column, piece) -> Column:
    return F.array_join(F.transform(turns, piece), "")


def _same(parsed: Column, source: Column) -> Column:
    return F.transform(parsed, lambda t: F.struct(t["role"], t["text"])) == \
        F.transform(source, lambda t: F.struct(t["role"], t["text"]))


def format_chat(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns (read back), loss_spans."""
    source = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    grouped = source.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("source"))
    plain = (grouped.withColumn("formatted", _joined(F.col("source"), lambda t: render_turn(t["role"], t["text"])))
             .withColumn("turns", parse(F.col("formatted"))))

    def alone(t: Column) -> Column:
        rendered = render_turn(t["role"], t["text"])
        return F.when(_same(parse(rendered), F.array(t)), rendered).otherwise(
            render_turn(t["role"], escape_text(t["text"])))

    escaped = (plain.withColumn("formatted", F.when(_same(F.col("turns"), F.col("source")), F.col("formatted"))
                                .otherwise(_joined(F.col("source"), alone)))
               .withColumn("turns", parse(F.col("formatted"))))
    checked = escaped.withColumn("turns", F.when(_same(F.col("turns"), F.col("source")), F.col("turns")).otherwise(
        F.raise_error(F.concat(F.lit("no round trip for conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))))
    return checked.select("conv_id", "formatted", "turns", loss_spans(F.col("turns")).alias("loss_spans"))


def loss_spans(turns: Column) -> Column:
    """Code point ranges [start, end) of assistant bodies in the formatted text."""
    def step(state: Column, t: Column) -> Column:
        start = state["at"] + len(START) + F.length(escape_role(t["role"])) + 1
        end = start + F.length(t["body"])
        span = F.struct(start.alias("start"), end.alias("end"))
        spans = F.when(t["role"] == LEARNED_ROLE, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((end + len(END) + 1).alias("at"), spans.alias("spans"))

    empty = F.expr("named_struct('at', 0, 'spans', cast(array() as array<struct<start:int,end:int>>))")
    return F.aggregate(turns, empty, step, lambda s: s["spans"])


def chat_digest(formatted: DataFrame) -> DataFrame:
    """What a reader of ``formatted`` finds: turn and loss digests per conversation."""
    body = F.transform("loss_spans", lambda s: unescape_text(
        F.substr(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return formatted.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(_joined(F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), 256)
        .alias("turns_sha256"),
        F.array_join(body, "").alias("loss"), F.length("formatted").cast("bigint").alias("formatted_chars"),
    ).select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("bigint").alias("loss_chars"),
             F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
