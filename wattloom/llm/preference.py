"""Preference pairs for training: common prompt once, two completions with masks.

The turns of a chosen and a rejected conversation are put in order (by turn number,
role, text). Their longest common prefix of equal turns is rendered once as the prompt;
what follows in either is its completion. A mask lists the spans of a completion to
train on: texts of assistant turns with their end mark. Everything runs as window and
grouping expressions after one shuffle by pair.

Rows: a null role or text is empty text. A turn without pair or conversation id belongs
to no pair and is left out. A pair with one conversation has an empty other side; two
equal conversations have empty completions. Repeated turns are turns. Offsets count
code points. Other columns are ignored. A pair's turns are one row of the result, so a
task holds the conversations of a pair, not more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the rendering.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
TRAINED_ROLE = "assistant"


def label_by_table(turns: DataFrame, pairs: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Turns with ``pair_id`` and ``side`` from a table (pair_id, chosen_id, rejected_id)."""
    sides = pairs.select(
        "pair_id",
        F.explode(
            F.array(
                F.struct(F.lit("chosen").alias("side"), F.col("chosen_id").alias(conversation)),
                F.struct(F.lit("rejected").alias("side"), F.col("rejected_id").alias(conversation)),
            )
        ).alias("s"),
    ).select("pair_id", "s.side", f"s.{conversation}")
    return turns.join(sides, conversation)


def label_neighbours(turns: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Turns with ``pair_id`` and ``side``: conversation 2k is chosen over 2k + 1."""
    return turns.select(
        conversation,
        "turn",
        "role",
        "text",
        F.shiftright(conversation, 1).alias("pair_id"),
        F.when(F.col(conversation).bitwiseAND(1) == 0, "chosen").otherwise("rejected").alias("side"),
    )


def replaced_replies(turns: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Turns with ``pair_id`` and ``side``: every conversation is chosen over itself with its
    last assistant turn replaced by the last one of its neighbour (2k and 2k + 1 lend to
    each other), so that a pair shares all turns before.

    The pair is named by the conversation; the rejected side carries the id of the neighbour,
    or of the conversation itself if that has no assistant turn; the reply is then empty. A
    conversation without an assistant turn has two equal sides.
    """
    clean = turns.where(F.col(conversation).isNotNull()).select(
        F.col(conversation).alias("id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    from_last = Window.partitionBy("id", "role").orderBy(F.col("turn").desc_nulls_last(), F.desc("text"))
    last = (F.col("role") == TRAINED_ROLE) & (F.row_number().over(from_last) == 1)
    marked = clean.withColumn("last", last)
    lent = marked.where("last").select(
        F.col("id").bitwiseXOR(F.lit(1)).alias("id"), F.col("id").alias("lender"), F.col("text").alias("reply")
    )
    reply = F.when(F.col("last"), F.coalesce("reply", F.lit(""))).otherwise(F.col("text"))
    sides = F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("id").alias(conversation), F.col("text").alias("text")),
        F.struct(F.lit("rejected").alias("side"), F.coalesce("lender", "id").alias(conversation), reply.alias("text")),
    )
    return marked.join(lent, "id", "left").select(
        F.col("id").alias("pair_id"), "turn", "role", F.inline(sides)
    )


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: t["rendered"]), "")


def _spans(turns: Column, before: Column) -> Column:
    """[start, stop) of the trained text of each assistant turn; the line feed after the
    end mark is not trained."""
    return F.transform(
        F.filter(turns, lambda t: t["role"] == TRAINED_ROLE),
        lambda t: F.struct(
            (t["stop"] - F.length(t["rendered"]) + t["lead"] - before).alias("start"), (t["stop"] - 1 - before).alias("stop")
        ),
    )


def format_pairs(turns: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """One row per pair from turns with ``pair_id`` and ``side`` (chosen or rejected):
    chosen_id, rejected_id, n_common, prompt, chosen, rejected, chosen_mask and
    rejected_mask (arrays of start and stop in the completion)."""
    clean = turns.where(F.col(conversation).isNotNull() & F.col("pair_id").isNotNull()).select(
        "pair_id",
        "side",
        F.col(conversation).alias("id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    head = F.concat(F.lit(TURN_START), F.col("role"), F.lit("\n"))
    rendered = clean.withColumn("lead", F.length(head)).withColumn(
        "rendered", F.concat(head, F.col("text"), F.lit(f"{TURN_END}\n"))
    )
    upto = Window.partitionBy("pair_id", "side").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    placed = rendered.repartition("pair_id").withColumn("stop", F.sum(F.length("rendered")).over(upto))
    entry = F.struct("stop", "lead", "role", "text", "rendered")
    side = lambda name: F.sort_array(F.collect_list(F.when(F.col("side") == name, entry)))
    pairs = placed.groupBy("pair_id").agg(
        F.max(F.when(F.col("side") == "chosen", F.col("id"))).alias("chosen_id"),
        F.max(F.when(F.col("side") == "rejected", F.col("id"))).alias("rejected_id"),
        side("chosen").alias("c"),
        side("rejected").alias("r"),
    )
    shorter = F.least(F.size("c"), F.size("r"))
    same = F.zip_with(
        F.slice("c", 1, shorter), F.slice("r", 1, shorter), lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"])
    )
    first_other = F.array_position(same, False)
    pairs = pairs.withColumn("n_common", F.when(first_other > 0, first_other - 1).otherwise(shorter).cast("int"))
    rest = lambda name: F.slice(name, F.col("n_common") + 1, F.size(name))
    before = F.when(F.col("n_common") > 0, F.get("c", F.col("n_common") - 1)["stop"]).otherwise(F.lit(0))
    return pairs.select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        F.col("n_common").cast("long").alias("n_common"),
        _joined(F.slice("c", 1, F.col("n_common"))).alias("prompt"),
        _joined(rest("c")).alias("chosen"),
        _joined(rest("r")).alias("rejected"),
        _spans(rest("c"), before).alias("chosen_mask"),
        _spans(rest("r"), before).alias("rejected_mask"),
    )


def mask_text(mask: str) -> Column:
    """A mask as start:stop texts, comma-joined."""
    return F.array_join(F.transform(mask, lambda s: F.concat_ws(":", s["start"].cast("string"), s["stop"].cast("string"))), ",")
