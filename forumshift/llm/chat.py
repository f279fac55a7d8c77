"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it as context, and only
its reply trainable (``loss_start``/``loss_end``: code points of ``text``, end exclusive).  What
follows the last assistant turn is kept in one more example in which nothing is trainable, so
the output holds every conversation whole.

Turns are marked ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside roles and texts ``&`` becomes
``&amp;`` and ``<|`` becomes ``&lt;|`` (in roles a line break becomes ``&nl;``), which
``unescape`` undoes exactly.

An example's text is a prefix of its conversation's one formatted string, so a long conversation
is formatted once and its examples are cut from it one at a time.

Cases: a null role or text is empty; rows of one turn number (repeated rows too) are ordered by
role, then text; null turn numbers come first, null conversation ids are one conversation; a
conversation without assistant turns has the context-only example alone; an empty table gives
no examples; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("&nl;"))


def _unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&nl;"), F.lit("\n")))


def examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """conv_id, example (its last turn's place, from 1), text, loss_start, loss_end."""
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("said"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "said")
    said = escape(F.col("said"))
    rows = rows.withColumn("head", F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n")))
    rows = rows.withColumn("marked", F.concat("head", said, F.lit(END)))
    rows = (rows.withColumn("example", F.row_number().over(order).cast("long"))
            .withColumn("stop", F.sum(F.length("marked")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("more", F.lead(F.lit(1)).over(order)))
    reply = F.col("role") == "assistant"
    # a null start marks a turn that ends no example
    start = F.when(reply, F.col("stop") - F.length("marked") + F.length("head")).when(F.col("more").isNull(), F.col("stop"))
    end = F.when(reply, F.col("stop") - len(END)).otherwise(F.col("stop"))
    turn = F.struct("example", "marked", start.alias("loss_start"), end.alias("loss_end"), "stop")
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    ends = F.transform(F.filter("turns", lambda t: t["loss_start"].isNotNull()),
                       lambda t: F.struct(t["example"], t["stop"], t["loss_start"], t["loss_end"]))
    made = whole.select("conv_id", F.array_join(F.transform("turns", lambda t: t["marked"]), "").alias("whole"),
                        F.inline(ends).alias("example", "stop", "loss_start", "loss_end"))
    return made.select("conv_id", "example", F.expr("substring(whole, 1, cast(stop AS int))").alias("text"),
                       "loss_start", "loss_end")


def read_back(made: DataFrame) -> DataFrame:
    """Per conversation, from the examples alone: conv_id, turns (array of role, text), losses
    (trainable texts in order), formatted_chars."""
    loss = F.expr("substring(text, cast(loss_start + 1 AS int), cast(loss_end - loss_start AS int))")
    got = made.select("conv_id", "example", "text", F.length("text").alias("chars"),
                      F.when(F.col("loss_end") > F.col("loss_start"), unescape(loss)).alias("loss"))
    got = got.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("whole"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))).alias("losses"))
    parts = F.split("whole", r"<\|im_start\|>")
    parts = F.slice(parts, F.lit(2), F.size(parts))       # nothing stands before the first mark

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        size = F.length(part) - F.length(role) - 1 - len(END)
        return F.struct(_unescape_role(role).alias("role"),
                        unescape(F.substr(part, F.length(role) + 2, size)).alias("text"))

    return got.select("conv_id", F.transform(parts, turn).alias("turns"),
                      F.transform("losses", lambda x: x["loss"]).alias("losses"), "formatted_chars")
