"""Chat formatting of preference pairs.

A pair is two conversations, chosen and rejected.  Their longest common turn
prefix is rendered once, as the prompt; what follows in either is its
completion.  The mask of a completion lists the character spans a trainer takes
into the loss: the text and end mark of assistant turns, never role headers or
other roles' turns.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import checkpointed, column, free_name
from storelens.llm.neighbours import with_next

TRAINED = "assistant"
ASKED = "user"
END = "<|end|>\n"


def conversations(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """(conv_id, turns): one row a conversation, its turns by number (null first), then role and text.

    turns is a list of (role, text, times).  Rows that repeat a numbered turn are copies
    of it: one turn, times says how many.  Turns without a number can't be told from
    copies and stand as often as they are said.  Repeats are counted before any list is
    made; a null role or text is empty.  Each row without conv_id is a conversation of its
    own, so no list holds them all.
    """
    rows = turns.select(column(turns, conv_id).alias("conv_id"), column(turns, turn).alias("turn"),
                        F.coalesce(column(turns, role), F.lit("")).alias("role"),
                        F.coalesce(column(turns, text), F.lit("")).alias("text"))
    said = rows.where(F.col("conv_id").isNotNull()).groupBy("conv_id", "turn", "role", "text").agg(
        F.count("*").alias("times"))
    listed = said.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "times"))).alias("turns"))

    def spoken(t: Column) -> Column:
        numbered = t["turn"].isNotNull()
        one = F.struct(t["role"].alias("role"), t["text"].alias("text"),
                       F.when(numbered, t["times"]).otherwise(F.lit(1).cast("bigint")).alias("times"))
        return F.array_repeat(one, F.when(numbered, F.lit(1)).otherwise(t["times"].cast("int")))

    alone = rows.where(F.col("conv_id").isNull()).select("conv_id", F.array(F.struct(
        "role", "text", F.lit(1).cast("bigint").alias("times"))).alias("turns"))
    return listed.select("conv_id", F.flatten(F.transform("turns", spoken)).alias("turns")).unionByName(alone)


def reply_pairs(talks: DataFrame) -> DataFrame:
    """(conv_id, chosen, rejected) from conversations without labels of their own.

    A conversation's tail is what follows its last user turn before the last assistant turn:
    the reply, in one turn or several, and any turns after it.  chosen is the whole
    conversation; rejected is its turns up to the tail, then the tail of the next conversation
    that has one, by ascending conv_id (null first, those by a hash of the tail; after the
    last comes the first): a fluent reply to another prompt, which may begin alike.
    A conversation without an assistant turn has no tail: rejected is chosen.
    """
    size = F.size("turns")

    def last(marks: Column) -> Column:
        """Place of the last true mark, 0 if none."""
        back = F.array_position(F.reverse(marks), True).cast("int")
        return F.when(back > 0, F.size(marks) - back + 1).otherwise(F.lit(0))

    said = talks.withColumn("turns", F.transform(
        "turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    reply = said.withColumn("reply", last(F.transform("turns", lambda t: t["role"] == TRAINED)))
    asked = reply.withColumn("cut", F.when(F.col("reply") == 0, size).otherwise(
        last(F.transform(F.slice("turns", F.lit(1), F.col("reply")), lambda t: t["role"] == ASKED))))
    # written once: the search for next tails reads it several times
    parted = checkpointed(asked.select("conv_id", F.slice("turns", F.lit(1), F.col("cut")).alias("before"),
                                       F.slice("turns", F.col("cut") + 1, size - F.col("cut")).alias("tail")))
    # a conversation without an id is one turn; the tie of the others is never asked
    text = F.array_join(F.transform("tail", lambda t: F.concat_ws(":", t["role"], t["text"])), "\n")
    tie = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
    ended = parted.where(F.size("tail") > 0).withColumn(
        "tie", F.when(F.col("conv_id").isNull(), tie).otherwise(F.lit(0).cast("bigint")))
    paired = with_next(ended, "conv_id", "tie", {"other": "tail"}).select("conv_id", "before", "tail", "other")
    open_ended = parted.where(F.size("tail") == 0).withColumn("other", F.col("tail"))
    return paired.unionByName(open_ended).select("conv_id", F.concat("before", "tail").alias("chosen"),
                                                 F.concat("before", "other").alias("rejected"))


def _spoken(t: Column) -> Column:
    """A turn's header, text and end mark; a '<|' in the text can't open a mark of its own."""
    return F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), F.replace(t["text"], F.lit("<|"), F.lit("< |")), F.lit(END))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _spoken), "")


def _mask(turns: Column) -> Column:
    """Spans start-end (code points of the rendered turns, end exclusive), comma-joined."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(seen: Column, t: Column) -> Column:
        end = seen["at"] + F.length(_spoken(t))
        start = seen["at"] + F.length(t["role"]) + 5            # <| |> and a new line
        span = F.array(F.concat_ws("-", start.cast("string"), end.cast("string")))
        return F.struct(end.alias("at"), F.when(t["role"] == TRAINED, F.concat(seen["spans"], span))
                        .otherwise(seen["spans"]).alias("spans"))

    return F.aggregate(turns, zero, step, lambda seen: F.array_join(seen["spans"], ","))


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two turn lists."""
    differs = F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y))
    first = F.array_position(differs, True).cast("int")
    return F.when(first == 0, F.least(F.size(a), F.size(b))).otherwise(first - 1)


def format_preferences(pairs: DataFrame, *, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Replace chosen and rejected (lists of (role, text) turns) by n_common, prompt,
    chosen, rejected, chosen_mask and rejected_mask; other columns pass.

    Pairs of equal conversations have the whole as prompt and empty completions.
    """
    new = ("n_common", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask")
    names = [c for c in pairs.columns if c not in (chosen, rejected) and c.lower() not in new]
    left, right = free_name(pairs.withColumn("n_common", F.lit(0)), "one", "other")
    a, b = F.col(left), F.col(right)
    cut = pairs.select(*[column(pairs, c) for c in names], column(pairs, chosen).alias(left),
                       column(pairs, rejected).alias(right)).withColumn("n_common", common_turns(a, b))

    def after(turns: Column) -> Column:
        return F.slice(turns, F.col("n_common") + 1, F.greatest(F.size(turns) - F.col("n_common"), F.lit(0)))

    return cut.select(*[f"`{c}`" for c in names], "n_common",
                      _rendered(F.slice(a, F.lit(1), F.col("n_common"))).alias("prompt"),
                      _rendered(after(a)).alias("chosen"), _rendered(after(b)).alias("rejected"),
                      _mask(after(a)).alias("chosen_mask"), _mask(after(b)).alias("rejected_mask"))
