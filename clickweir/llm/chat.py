"""Chat formatting with a grammar round trip, in SQL expressions.

A conversation is a row of turns, each between marks that say its role:

    system      <<SYS>>text<</SYS>>
    user        [INST]text[/INST]
    assistant   <s>text</s>
    any other   <<ROLE>>role<<TEXT>>text<</ROLE>>

A turn is rendered as it is, parsed again and compared with its source. Where it differs, its content
conflicts with the grammar and is escaped: every mark in it, or mark that is escaped already, gets one
more backslash after its first character; the parser takes one away. That is repeated until the parsed
turn is the source (one pass is enough, as the tests show). Then the whole conversation is parsed and
compared. Loss falls on what assistants say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Fixed values of the grammar.
_MARKS = r"/?s>|/?INST\]|</?SYS>>|</?ROLE>>|<TEXT>>"
_PLAIN = rf"([<\[])(\\*)({_MARKS})"
_ESCAPED = rf"([<\[])\\(\\*)({_MARKS})"
_TURN = r"(?s)<<SYS>>.*?<</SYS>>|\[INST\].*?\[/INST\]|<s>.*?</s>|<<ROLE>>.*?<<TEXT>>.*?<</ROLE>>"
_PASSES = 2


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def opening(role: Column) -> Column:
    """What stands before the text of a turn; the role of other turns is escaped as texts are."""
    return F.when(role == "system", "<<SYS>>").when(role == "user", "[INST]").when(role == "assistant", "<s>").otherwise(
        F.concat(F.lit("<<ROLE>>"), escaped(role), F.lit("<<TEXT>>")))


def closing(role: Column) -> Column:
    return F.when(role == "system", "<</SYS>>").when(role == "user", "[/INST]").when(role == "assistant", "</s>").otherwise(
        F.lit("<</ROLE>>"))


def parse(rendered: Column) -> Column:
    """``array<struct<role, text>>`` of the turns of a rendered conversation. Marks alternate, so the first
    closing mark ends a turn; contents are unescaped."""
    def turn(part: Column) -> Column:
        def between(left: str, right: str) -> Column:
            return F.substring(part, F.lit(len(left) + 1), F.length(part) - len(left) - len(right))
        other = between("<<ROLE>>", "<</ROLE>>")
        role = (F.when(part.startswith("<<SYS>>"), "system").when(part.startswith("[INST]"), "user")
                .when(part.startswith("<s>"), "assistant").otherwise(unescaped(F.substring_index(other, "<<TEXT>>", 1))))
        text = (F.when(part.startswith("<<SYS>>"), between("<<SYS>>", "<</SYS>>"))
                .when(part.startswith("[INST]"), between("[INST]", "[/INST]"))
                .when(part.startswith("<s>"), between("<s>", "</s>"))
                .otherwise(F.substring(other, F.instr(other, F.lit("<<TEXT>>")) + len("<<TEXT>>"), F.length(other))))
        return F.struct(role.alias("role"), unescaped(text).alias("text"))
    return F.transform(F.regexp_extract_all(rendered, F.lit(_TURN), F.lit(0)), turn)


def turns(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, rendered, begin, length`` of each row: NULL roles and texts are empty.
    ``rendered`` is escaped as little as the round trip needs; ``begin`` and ``length`` say where in it the
    (escaped) text stands."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    out = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), text.alias("content"))
    for _ in range(_PASSES):
        rendered = F.concat(opening(F.col("role")), F.col("content"), closing(F.col("role")))
        back = parse(rendered)
        same = F.coalesce((F.size(back) == 1) & (F.get(back, F.lit(0))["role"] == F.col("role")) & (F.get(back, F.lit(0))["text"] == F.col("text")), F.lit(False))
        out = out.withColumn("same", same)
        out = out.withColumn("content", F.when(F.col("same"), F.col("content")).otherwise(escaped(F.col("content")))).drop("same")
    begin = opening(F.col("role"))
    return out.select(
        "conv_id", "turn", "role", "text", F.concat(begin, F.col("content"), closing(F.col("role"))).alias("rendered"),
        F.length(begin).alias("begin"), F.length("content").alias("length"))


def formatted(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, loss_spans`` (``array<struct<start, end>>`` in
    code points of ``formatted``), ``round_trip``. Rows are taken by turn, those of one turn by role and
    text; rows without a conversation are one conversation, of a NULL id. An empty table gives no rows.

    Turns are rendered and checked row by row. What is gathered for a conversation is its own text, which
    is also the row that comes out."""
    each = turns(rows)
    order = ["turn", "role", "text"]
    before = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    number = Window.partitionBy("conv_id").orderBy(*order)
    placed = each.select(
        "conv_id", F.row_number().over(number).alias("n"), "role", "text", "rendered",
        (F.coalesce(F.sum(F.length("rendered")).over(before), F.lit(0)) + F.col("begin")).alias("start"), "length")
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("n", "role", "text", "rendered", "start", "length"))).alias("t"))
    whole = gathered.select("conv_id", "t", F.array_join(F.transform("t", lambda x: x["rendered"]), "").alias("formatted"))
    source = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    spans = F.transform(F.filter("t", lambda x: x["role"] == "assistant"), lambda x: F.struct(
        x["start"].alias("start"), (x["start"] + x["length"]).alias("end")))
    return whole.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"), "formatted", spans.alias("loss_spans"),
        (parse(F.col("formatted")) == source).alias("round_trip"))


def read_back(chats: DataFrame) -> DataFrame:
    """From formatted conversations alone: ``conv_id, turns`` (as parsed), ``turns_text`` (role, line break,
    text, line break of each turn), ``loss_text`` (what the loss falls on, unescaped), ``formatted``."""
    rows = chats.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"])
    return rows.select("conv_id", "turns", F.array_join(said, "").alias("turns_text"), F.array_join(loss, "").alias("loss_text"), "formatted")
