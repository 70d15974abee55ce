"""Chat formatting of preference pairs, in DataFrame expressions only.

Chosen and rejected conversations are long tables (pair_id, turn, role, text). Turns are compared
place by place after ranking them inside their conversation by ``turn`` (then role and text); the
longest common prefix is rendered once as the prompt, the rest of each side as its completion. A
turn is rendered as ``<|role|>\\ntext\\n<|end|>\\n``; in completions only what assistants say, with
its end mark, is trained on: masks are (start, length) in characters of the completion.

A null role or text is empty. A side without turns is an empty conversation. Repeated rows are
turns of their own. If both sides are equal, everything is prompt and both completions are empty.
An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the rendered format, and the role that is trained on.
OPEN, CLOSE, END, TRAINED = "<|", "|>\n", "\n<|end|>\n", "assistant"
TURN = "struct<turn:bigint,role:string,text:string>"


def _turns(side: DataFrame, name: str) -> DataFrame:
    """A conversation's turns in order; a pair's row holds them anyway once rendered."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return side.groupBy("pair_id").agg(F.sort_array(F.collect_list(turn)).alias(name))


def _render(turns: Column) -> Column:
    parts = F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(END)))
    return F.array_join(parts, "")


def _mask(turns: Column) -> Column:
    """Spans of the trained turns' texts with their end marks, in characters of the rendered text."""
    long = lambda c: c.cast("long")
    head = lambda t: F.length(t["role"]) + len(OPEN) + len(CLOSE)
    tail = lambda t: F.length(t["text"]) + len(END)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    step = lambda a, t: F.struct(
        (a["at"] + long(head(t) + tail(t))).alias("at"),
        F.when(t["role"] == TRAINED, F.concat(a["spans"], F.array(F.struct(
            (a["at"] + long(head(t))).alias("start"), long(tail(t)).alias("length")))))
        .otherwise(a["spans"]).alias("spans"))
    return F.aggregate(turns, start, step, lambda a: a["spans"])


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """pair_id, common_turns, prompt, chosen, chosen_mask, rejected, rejected_mask; one row per pair_id of either side."""
    none = F.array().cast(f"array<{TURN}>")
    both = _turns(chosen, "_c").join(_turns(rejected, "_r"), "pair_id", "full")
    both = both.withColumns({"_c": F.coalesce("_c", none), "_r": F.coalesce("_r", none)})
    differ = F.zip_with("_c", "_r", lambda a, b: ~(a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"])))
    # the shorter side is padded with nulls, which differ from any turn
    first = F.array_position(differ, True)
    both = both.withColumn("common_turns", F.when(first == 0, F.size("_c")).otherwise(first - 1).cast("int"))
    rest = lambda c: F.slice(c, F.col("common_turns") + 1, F.greatest(F.size(c) - F.col("common_turns"), F.lit(0)))
    both = both.withColumns({"_p": F.slice("_c", F.lit(1), F.col("common_turns")), "_c": rest("_c"), "_r": rest("_r")})
    return both.select("pair_id", "common_turns", _render(F.col("_p")).alias("prompt"),
                       _render(F.col("_c")).alias("chosen"), _mask(F.col("_c")).alias("chosen_mask"),
                       _render(F.col("_r")).alias("rejected"), _mask(F.col("_r")).alias("rejected_mask"))


def reply_pairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs from plain conversations: each as chosen, and as rejected with another's last reply in place of its own.

    The other is the conversation whose conv_id differs in the last bit; without a reply there,
    the rejected reply is empty. The last reply is the assistant turn of the largest ``turn``
    (of equals, the greater text). Rows without a conv_id form no pair.
    """
    rows = conversations.where("conv_id is not null").select("conv_id", "turn", "role", "text")
    last = (rows.where(F.col("role") == TRAINED).groupBy("conv_id")
            .agg(F.max(F.struct(F.col("turn").alias("turn"), F.coalesce("text", F.lit("")).alias("text"))).alias("_l")))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1).cast("long")).alias("conv_id"), F.col("_l.text").alias("_other"))
    swap = last.join(other, "conv_id", "left").select("conv_id", F.col("_l.turn").alias("_turn"), F.col("_l.text").alias("_own"),
                                                      F.coalesce("_other", F.lit("")).alias("_other"))
    chosen = rows.withColumnRenamed("conv_id", "pair_id")
    reply = ((F.col("role") == TRAINED) & F.col("turn").eqNullSafe(F.col("_turn"))
             & (F.coalesce("text", F.lit("")) == F.col("_own")))
    rejected = rows.join(swap, "conv_id", "left").select(
        F.col("conv_id").alias("pair_id"), "turn", "role", F.when(reply, F.col("_other")).otherwise(F.col("text")).alias("text"))
    return chosen, rejected
