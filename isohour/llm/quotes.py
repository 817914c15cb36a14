"""Quotation linking: replies find the messages that they quote, and lose the quotes.

Lines that begin with ``>`` signs are quoted, as deep as they have signs. A message falls into passages: runs
of lines of one level, cut at blank lines. A quoted passage and each of its lines are normalised (lower
case, white space as one space) and hashed; own passages and lines of earlier messages of the same conversation
are hashed alike and joined. A message answers the earlier message that its shallowest matched
level quotes with the most characters, the latest one among equals. Reply order is the order of paths: the path
of a message is its parent's path and its own turn, found by doubling; messages that answer nothing start
a path of their own. Sorting by (conv_id, path) is the reply-ordered conversation, with no
conversation gathered in one place.

Defined results: a null text is empty; a quote without a match names no parent and is dropped all the
same; repeated (conv_id, turn) rows are kept and share a path; a null conv_id or turn matches nothing and its path
is its turn. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from isohour.llm.common import fixed

QUOTED = r"(?m)^[ \t]*>"
PREFIX = r"^[ \t]*(?:>[ \t]?)*"


def level_of(line: Column) -> Column:
    prefix = F.regexp_extract(line, PREFIX, 0)
    return F.length(prefix) - F.length(F.replace(prefix, F.lit(">"), F.lit("")))


def normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def passages(text: Column) -> Column:
    """Array of (level, text): runs of lines of one level; blank lines end a run and belong to none."""
    none = F.array().cast("array<struct<level:int,text:string>>")
    lines = F.transform(
        F.split(text, "\r?\n", -1),
        lambda x: F.struct(level_of(x).cast("int").alias("level"), F.regexp_replace(x, PREFIX, "").alias("text")),
    )

    def add(state: Column, line: Column) -> Column:
        done, last = state["done"], state["last"]
        blank = F.trim(line["text"]) == ""
        joins = last.isNotNull() & (last["level"] == line["level"]) & ~blank
        longer = F.struct(line["level"].alias("level"), F.concat(last["text"], F.lit("\n"), line["text"]).alias("text"))
        closed = F.when(last.isNull(), done).otherwise(F.concat(done, F.array(last)))
        return F.struct(
            F.when(joins, done).otherwise(closed).alias("done"),
            F.when(joins, longer).when(~blank, line).otherwise(F.lit(None)).alias("last"),
        )

    zero = F.struct(none.alias("done"), F.lit(None).cast("struct<level:int,text:string>").alias("last"))
    end = F.aggregate(lines, zero, add)
    both = F.transform(F.array(end), lambda e: F.when(e["last"].isNull(), e["done"]).otherwise(F.concat(e["done"], F.array(e["last"]))))
    return both[0]


def unquoted(text: Column) -> Column:
    """The message without quoted lines."""
    own = F.filter(F.split(text, "\r?\n", -1), lambda x: level_of(x) == 0)
    return F.when(text.rlike(QUOTED), F.trim(F.array_join(own, "\n"))).otherwise(text)


def units(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, hash, size) of every passage and line."""
    split = messages.select("conv_id", "turn", F.explode(passages(F.col("text"))).alias("p"))
    parts = split.select("conv_id", "turn", "p.level", F.explode(F.array_distinct(F.concat(F.array("p.text"), F.split("p.text", "\n")))).alias("part"))
    parts = parts.select("conv_id", "turn", "level", normal(F.col("part")).alias("part")).where("part <> ''")
    return parts.select("conv_id", "turn", "level", F.xxhash64("part").alias("hash"), F.length("part").alias("size")).distinct()


def link(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, reply_to, path and text without quotes, one row per message."""
    rows = messages.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    quoting = rows.where(F.col("text").rlike(QUOTED))
    talks = quoting.select("conv_id").distinct()
    quoted = units(quoting).where("level > 0")
    own = units(rows.join(talks, "conv_id")).where("level = 0").select("conv_id", "hash", F.col("turn").alias("source"))
    matched = quoted.join(own, ["conv_id", "hash"]).where("source < turn")
    weighed = matched.groupBy("conv_id", "turn", "level", "source").agg(F.sum("size").alias("weight"))
    best = F.max(F.struct(-F.col("level"), "weight", "source")).alias("best")
    parents = fixed(weighed.groupBy("conv_id", "turn").agg(best).select("conv_id", "turn", F.col("best.source").alias("reply_to")), "parents")

    state = parents.select("conv_id", "turn", F.array("turn").alias("path"), F.col("reply_to").alias("up"))
    while state.where("up IS NOT NULL").limit(1).count():
        above = state.select("conv_id", F.col("turn").alias("up"), F.col("path").alias("more"), F.col("up").alias("next"))
        joined = state.join(above, ["conv_id", "up"], "left")
        path = F.when(F.col("up").isNull(), F.col("path")).otherwise(F.concat(F.coalesce("more", F.array("up")), "path"))
        state = fixed(joined.select("conv_id", "turn", path.alias("path"), F.col("next").alias("up")), "paths")
    paths = state.select("conv_id", "turn", "path").join(parents, ["conv_id", "turn"])
    result = rows.join(paths, ["conv_id", "turn"], "left")
    return result.select("conv_id", "turn", "role", "reply_to", F.coalesce("path", F.array("turn")).alias("path"), unquoted(F.col("text")).alias("text"))


def conversations(linked: DataFrame) -> DataFrame:
    """One row per conversation: its messages (role, text) in reply order."""
    said = F.array_sort(F.collect_list(F.struct("path", "role", "text")))
    return linked.groupBy("conv_id").agg(F.transform(said, lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text"))).alias("messages"))
