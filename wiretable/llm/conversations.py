"""Chat formatting by quotation linking, in DataFrame functions only.

Lines are read with their quote level (the number of leading ``>``).  Passages are
neighbouring lines of one level without a blank line between; passages and single
lines are normalised (lower case, single blanks) and hashed.  A message answers the
earlier message of its conversation that first said what it quotes: the outermost
level counts first, then the longest quotation, then the latest original.  Chains
of answers are followed by doubling to the message that answers none, the thread.
Messages are returned without their quotations in reply order: by conversation,
thread and turn, so each message comes after the one it answers.

Only conversations with a quotation are taken apart into lines.  Originals are one
row per conversation and passage (a partial aggregation), so a common line or a
conversation of any size adds no pairs; nothing is gathered per conversation, and
the order is a range-partitioned sort.

Defined results: null texts are empty messages; rows with null conversation or turn
answer nothing and are their own thread; rows with equal conversation and turn share
their links and are all kept; a quotation without original links nothing; lines with
any number of ``>`` and texts with any run of blanks are read in one pass; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wiretable.llm.frames import stored

#: Signs and blanks before a quoted line.  Possessive: a group that repeats recurses once per sign.
MARKS = r"^[ \t>]*+"
BLANKS = " \t\n\u000b\f\r"
#: One message in the text format of a conversation.
FORMAT = "<|%s|>\n%s<|end|>\n"


def level(line: Column) -> Column:
    marks = F.regexp_extract(line, MARKS, 0)
    return F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))


def normal(line: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(F.regexp_replace(line, MARKS, ""), r"\s+", " ")))


def without_quotes(text: Column) -> Column:
    """The lines of level 0, without the blank lines around them."""
    own = F.filter(F.split(text, "\n"), lambda line: level(line) == 0)
    return F.btrim(F.array_join(own, "\n"), F.lit(BLANKS))


def passages(messages: DataFrame) -> DataFrame:
    """conv_id, turn, depth, print, size: passages and lines of the conversations that quote."""
    quoting = messages.where(F.col("text").rlike(r"(?m)^[ \t]*+>")).select("conv_id").distinct()
    some = messages.join(quoting, "conv_id", "left_semi").where("turn is not null").distinct()
    lines = some.select("conv_id", "turn", F.xxhash64("text").alias("version"),
                        F.posexplode(F.split("text", "\n")).alias("line", "body"))
    lines = lines.select("conv_id", "turn", "version", "line", level(F.col("body")).alias("depth"),
                         normal(F.col("body")).alias("words"))
    message = W.partitionBy("conv_id", "turn", "version").orderBy("line")
    fresh = (F.col("words") == "") | (F.lag("words", 1, "").over(message) == "") | (
        F.lag("depth", 1, -1).over(message) != F.col("depth"))
    runs = lines.withColumn("fresh", fresh.cast("int")).withColumn(
        "run", F.sum("fresh").over(message.rowsBetween(W.unboundedPreceding, 0))).where("words != ''")
    whole = runs.groupBy("conv_id", "turn", "version", "run", "depth").agg(
        F.sort_array(F.collect_list(F.struct("line", "words"))).alias("parts")).select(
        "conv_id", "turn", "depth", F.array_join(F.transform("parts", lambda p: p["words"]), " ").alias("words"))
    units = whole.unionByName(runs.select("conv_id", "turn", "depth", "words"))
    return units.select("conv_id", "turn", "depth", F.xxhash64("words").alias("print"), F.length("words").alias("size"))


def answers(units: DataFrame) -> DataFrame:
    """conv_id, turn, parent: the message that each quoting message answers."""
    originals = units.where("depth = 0").groupBy("conv_id", "print", "size").agg(F.min("turn").alias("origin"))
    quoted = units.where("depth > 0").join(originals, ["conv_id", "print", "size"]).where("origin < turn")
    best = F.max(F.struct((-F.col("depth")).alias("near"), "size", "origin"))
    return quoted.groupBy("conv_id", "turn").agg(best.alias("best")).select(
        "conv_id", "turn", F.col("best.origin").alias("parent"))


def threads(links: DataFrame) -> DataFrame:
    """conv_id, turn, parent, thread (the first message of the chain), depth (answers up to it)."""
    now = stored(links.select("conv_id", "turn", "parent", F.col("parent").alias("thread"), F.lit(1).cast("bigint").alias("depth")))
    while True:
        above = now.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("next"), F.col("depth").alias("more"))
        joined = now.join(above, ["conv_id", "thread"], "left")
        if not joined.where("next is not null").head(1):
            return now
        now = stored(joined.select("conv_id", "turn", "parent", F.coalesce("next", "thread").alias("thread"),
                                   (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")))


def reply_ordered(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", ordered: bool = True) -> DataFrame:
    """conv_id, thread, turn, depth, parent, role, text (without quotations) and formatted, of every message."""
    messages = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    linked = threads(answers(stored(passages(messages.select("conv_id", "turn", "text")))))
    out = messages.join(linked, ["conv_id", "turn"], "left").select(
        "conv_id", F.coalesce("thread", "turn").alias("thread"), "turn", F.coalesce("depth", F.lit(0)).alias("depth"),
        "parent", "role", without_quotes(F.col("text")).alias("text"))
    out = out.withColumn("formatted", F.format_string(FORMAT, F.coalesce(F.col("role").cast("string"), F.lit("")), F.col("text")))
    return out.orderBy("conv_id", "thread", "turn") if ordered else out
