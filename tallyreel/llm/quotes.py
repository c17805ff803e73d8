"""Conversations in reply order, rebuilt from the quotes in their messages. DataFrame functions only.

A line's quote level is the number of ``>`` signs it begins with. Consecutive lines of one level are
a passage. A message's own words are its lines of level 0. Every own passage, every own line and the
own words as a whole are hashed after normalising (lower case; anything but letters and digits is one
space), and the conversation's earliest message that says it is its origin. Quoted passages, and their
single lines, are hashed alike and joined to the origins. A message replies to what its lowest linked
quote level quotes: the whole passage before single lines, then the latest origin.

Threads follow from reply to reply by pointer jumping; a reply always comes after what it quotes.
A conversation is put in order by thread (its first message's turn), then by turn: so replies follow
what they answer, without their quotes.

Origins are one row per (conversation, passage), combined before the shuffle, so that a passage that
thousands of messages share stays one row; links join against that. Positions in a conversation above
``max_group_rows`` messages are numbered piece by piece.

Rows: NULL text has no words and no quotes. A quote that no earlier turn says links nothing, and
neither does one without letters or digits. A message cannot quote its own turn. Rows that repeat
(conv_id, turn) share the thread of that turn and are ordered by role and text. NULL conv_id or turn:
the row keeps its place in order (NULL last) and is no origin. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyreel.llm.common import settle
from tallyreel.operators.split_window import RowNumber, find_hot_groups, ordered_columns

# White space and signs up to the last sign. A repeated group would recurse once a repetition in the JVM.
MARKS = r"^[\s>]*>"


def normalised_hash(text: Column) -> Column:
    """NULL where nothing is left to compare."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain != "", F.unhex(F.md5(plain.cast("binary"))))


def with_passages(messages: DataFrame) -> DataFrame:
    """Adds ``passages``: an array of (level, body) for runs of lines of one quote level."""
    lines = F.split(F.coalesce("text", F.lit("")), "\r?\n")
    levels = F.transform(
        lines,
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", "")).alias("level"),
            F.regexp_replace(line, MARKS + r" ?", "").alias("body"),
        ),
    )
    rows = messages.withColumn("_lines", levels)
    count = F.size("_lines")
    # Where a run of one level begins; each ends where the next begins.
    starts = F.filter(
        F.sequence(F.lit(0), count - 1),
        lambda i: (i == 0) | (F.get("_lines", i)["level"] != F.get("_lines", F.greatest(i - 1, F.lit(0)))["level"]),
    )
    rows = rows.withColumn("_starts", starts)
    passages = F.transform(
        F.col("_starts"),
        lambda start, k: F.struct(
            F.get("_lines", start)["level"].alias("level"),
            F.transform(
                F.slice("_lines", start + 1, F.coalesce(F.get("_starts", k + 1), count) - start), lambda line: line["body"]
            ).alias("lines"),
        ),
    )
    return rows.withColumn("passages", passages).drop("_lines", "_starts")


def own_words(passages: Column) -> Column:
    own = F.filter(passages, lambda p: p["level"] == 0)
    return F.trim(F.array_join(F.flatten(F.transform(own, lambda p: p["lines"])), "\n"))


def origins(rows: DataFrame) -> DataFrame:
    """(conv_id, hash, origin): the earliest turn that says a passage, a line, or everything in a message."""
    own = F.filter("passages", lambda p: p["level"] == 0)
    said = F.concat(
        F.transform(own, lambda p: F.array_join(p["lines"], "\n")),
        F.flatten(F.transform(own, lambda p: p["lines"])),
        F.array(F.col("own_text")),
    )
    spoken = rows.filter("conv_id is not null and turn is not null").select("conv_id", "turn", F.explode(F.array_distinct(said)).alias("said"))
    hashed = spoken.select("conv_id", "turn", normalised_hash(F.col("said")).alias("hash")).filter("hash is not null")
    return hashed.groupBy("conv_id", "hash").agg(F.min("turn").alias("origin"))


def quotations(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, level, part, hash): quoted passages (part 0) and their single lines (part 1)."""
    quoting = rows.filter("quoted > 0 and conv_id is not null and turn is not null")
    passages = quoting.select("conv_id", "turn", F.explode(F.filter("passages", lambda p: p["level"] > 0)).alias("p"))
    parts = passages.select(
        "conv_id",
        "turn",
        F.col("p.level").alias("level"),
        F.posexplode(F.array(F.array(F.array_join("p.lines", "\n")), F.col("p.lines"))).alias("part", "texts"),
    )
    texts = parts.select("conv_id", "turn", "level", "part", F.explode("texts").alias("text"))
    hashed = texts.select("conv_id", "turn", "level", "part", normalised_hash(F.col("text")).alias("hash"))
    return hashed.filter("hash is not null").distinct()


def links(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, parent, linked): the turn that a turn replies to, and how many quotes found their origin."""
    joined = quotations(rows).join(origins(rows), ["conv_id", "hash"]).filter("origin < turn")
    best = F.min(F.struct(F.col("level"), F.col("part"), (-F.col("origin")).alias("back")))
    return joined.groupBy("conv_id", "turn").agg((-best["back"]).alias("parent"), F.count("*").alias("linked"))


def threads(linked: DataFrame) -> DataFrame:
    """(conv_id, turn, root): the first turn of the thread, by pointer jumping over the reply links."""
    roots = settle(linked.select("conv_id", "turn", F.col("parent").alias("root")))
    while True:
        up = roots.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("_up"))
        after = settle(roots.join(up, ["conv_id", "root"], "left").select("conv_id", "turn", F.coalesce("_up", "root").alias("root"), F.col("_up").isNotNull().alias("_moved")))
        if not after.filter("_moved").take(1):
            return after.select("conv_id", "turn", "root")
        roots = after.drop("_moved")


def reply_order(messages: DataFrame, max_group_rows: int = 1_000_000) -> DataFrame:
    """One row per message: conv_id, position, turn, role, parent, thread, quoted, linked, text, formatted.

    ``messages``: (conv_id, turn, role, text). ``text`` comes without quotes, ``formatted`` as a chat turn.
    """
    rows = with_passages(messages.select("conv_id", "turn", "role", "text"))
    rows = rows.withColumns(
        {
            "own_text": own_words(F.col("passages")),
            "quoted": F.size(F.filter("passages", lambda p: p["level"] > 0)),
        }
    )
    found = settle(links(rows))
    placed = rows.select("conv_id", "turn", "role", F.col("own_text").alias("text"), "quoted")
    placed = placed.join(found, ["conv_id", "turn"], "left").join(threads(found), ["conv_id", "turn"], "left")
    placed = placed.select(
        "conv_id",
        "turn",
        "role",
        "parent",
        F.coalesce("root", "turn").alias("thread"),
        "quoted",
        F.coalesce("linked", F.lit(0).cast("long")).alias("linked"),
        "text",
    )
    hot = find_hot_groups(messages, ["conv_id"], max_group_rows)
    numbered = ordered_columns(placed, ["conv_id"], ["thread", "turn", "role", "text"], {"position": RowNumber()}, hot)
    form = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>\n"))
    return numbered.select(
        "conv_id", "position", "turn", "role", "parent", "thread", "quoted", "linked", "text", form.alias("formatted")
    )
