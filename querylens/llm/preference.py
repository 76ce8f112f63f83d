"""Pairs of a chosen and a rejected conversation as one prompt and two masked completions.

Both conversations are laid turn by turn beside each other. The turns up to
the first difference are the prompt, rendered once. What follows in each is its
completion. A mask tells which characters a model is to learn: what the
assistant says after the prompt, with the mark that ends its turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BEGIN = "<|"
BEGIN_END = "|>\n"
END = "<|end|>\n"
ASSISTANT = "assistant"


def rendered(role: Column, text: Column) -> Column:
    """One turn in the chat template; a NULL role or text is an empty one."""
    nothing = F.lit("")
    return F.concat(F.lit(BEGIN), F.coalesce(role, nothing), F.lit(BEGIN_END), F.coalesce(text, nothing), F.lit(END))


def _conversations(turns: DataFrame, conv_id: str, turn: str, role: str, text: str, name: str) -> DataFrame:
    """(pair_id, ``name``): the turns of each conversation in order; ties are ordered by role and text."""
    one = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    # A conversation is one value of the result, so its turns meet in one row.
    return turns.groupBy(F.col(conv_id).alias("pair_id")).agg(F.sort_array(F.collect_list(one)).alias(name))


def _common_prefix(a: Column, b: Column) -> Column:
    """Number of turns that both conversations have in common from the beginning."""
    length = F.least(F.size(a), F.size(b))

    def differs(i: Column) -> Column:
        x, y = F.get(a, i), F.get(b, i)
        return (x["role"] != y["role"]) | (x["text"] != y["text"])

    at = F.when(length > 0, F.sequence(F.lit(0), length - 1)).otherwise(F.array().cast("array<int>"))
    different = F.filter(at, differs)
    return F.when(F.size(different) > 0, F.get(different, F.lit(0))).otherwise(length)


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: rendered(t["role"], t["text"])), "")


def _learnt(turns: Column) -> Column:
    """(start, end) of the characters of a rendered completion that the mask lets through."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(state: Column, t: Column) -> Column:
        end = state["at"] + F.char_length(rendered(t["role"], t["text"]))
        start = state["at"] + F.char_length(F.concat(F.lit(BEGIN), t["role"], F.lit(BEGIN_END)))
        # The line break after the end mark belongs to the template alone.
        span = F.array(F.struct(start.alias("start"), (end - 1).alias("end")))
        more = F.when(t["role"] == ASSISTANT, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), more.alias("spans"))

    return F.aggregate(turns, zero, add, lambda s: s["spans"])


def preference_pairs(
    chosen: DataFrame,
    rejected: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask) for the conversations both tables have.

    The two conversations of a pair have the same id. ``n_common`` counts the
    turns of the longest common prefix, ``prompt`` is their text in the chat
    template, ``chosen`` and ``rejected`` what follows. The masks are lists of
    (start, end) characters of the completions to learn from.

    Turns are compared by role and text. NULL roles and texts are empty; turns with
    the same number are ordered by role and text; a NULL turn comes first. A
    NULL id pairs with nothing. Equal conversations have empty completions and
    masks, those without a common turn an empty prompt. Empty tables give an
    empty one; other columns are not read.
    """
    a = _conversations(chosen.where(F.col(conv_id).isNotNull()), conv_id, turn, role, text, "a")
    b = _conversations(rejected.where(F.col(conv_id).isNotNull()), conv_id, turn, role, text, "b")
    pairs = a.join(b, "pair_id").withColumn("n_common", _common_prefix(F.col("a"), F.col("b")))

    def rest(name: str) -> Column:
        return F.slice(F.col(name), F.col("n_common") + 1, F.size(name))

    pairs = pairs.withColumns({"shared": F.slice("a", F.lit(1), F.col("n_common")), "a": rest("a"), "b": rest("b")})
    return pairs.select(
        "pair_id",
        F.col("n_common").cast("long").alias("n_common"),
        _joined(F.col("shared")).alias("prompt"),
        _joined(F.col("a")).alias("chosen"),
        _joined(F.col("b")).alias("rejected"),
        _learnt(F.col("a")).alias("chosen_mask"),
        _learnt(F.col("b")).alias("rejected_mask"),
    )


def with_shortened_reply(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``turns`` with the last assistant reply of each conversation cut to the first half of its characters.

    A worse answer to the same conversation, where no rejected one is at hand.
    """
    replies = turns.where((F.col(role) == ASSISTANT) & F.col(conv_id).isNotNull())
    last = replies.groupBy(F.col(conv_id).alias("_conv")).agg(F.max(turn).alias("_last"))
    joined = turns.join(last, (F.col(conv_id) == F.col("_conv")) & (F.col(turn) == F.col("_last")), "left")
    shorter = F.substring(F.col(text), F.lit(1), F.floor(F.char_length(text) / 2).cast("int"))
    cut = F.when(F.col("_last").isNotNull() & (F.col(role) == ASSISTANT), shorter).otherwise(F.col(text))
    return joined.withColumn(text, cut).drop("_conv", "_last")
