"""Input adapters: long turn tables (one row per turn) -> nested records.

Nothing is dropped: every turn of the table is found in some record, whatever
its length.  Chat records hold all turns of a conversation, so they are
collected in two steps (blocks of turns, then the blocks of a conversation);
alpaca and openorca records pair neighbouring turns inside blocks of turns, so
no conversation is one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Role names of the long table and their ShareGPT speakers.
SHAREGPT_FROM = {"user": "human", "assistant": "gpt", "system": "system"}

#: Turns of a conversation that are collected together before the whole is.
TURNS_PER_BLOCK = 256


def _collect(long_df: DataFrame, key: str, elem, out_col: str) -> DataFrame:
    block = F.floor(F.col("turn") / TURNS_PER_BLOCK)
    blocks = (long_df.groupBy(key, block.alias("_block"))
              .agg(F.array_sort(F.collect_list(F.struct(F.col("turn"), elem.alias("_e")))).alias("_t")))
    whole = blocks.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_block", "_t"))).alias("_b"))
    return whole.select(key, F.flatten(F.transform("_b", lambda b: F.transform(b["_t"], lambda x: x["_e"])))
                        .alias(out_col))


def messages_records(long_df: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, messages array<struct<role, content>>) in turn order."""
    return _collect(long_df, key, F.struct(F.col("role").alias("role"), F.col("text").alias("content")), "messages")


def sharegpt_records(long_df: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, conversations array<struct<from, value>>)."""
    speaker = F.lit(None).cast("string")
    for role, frm in SHAREGPT_FROM.items():
        speaker = F.when(F.col("role") == F.lit(role), F.lit(frm)).otherwise(speaker)
    return _collect(long_df, key, F.struct(speaker.alias("from"), F.col("text").alias("value")), "conversations")


#: Turns of a conversation whose exchanges are put together at once.
EXCHANGE_BLOCK = 64
_SYSTEM_BLOCKS = 1024


def exchanges(long_df: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, turn, record_id, system, question, reply): a record for each user
    turn with the assistant turn right after it.  A turn without partner is a
    record of its own, with NULL for what it lacks.  The conversation's first
    system turn goes to all its records; it, a later system turn or a turn of
    any other role is a record only where it would not be found otherwise.
    Turns without a key pair with nothing and have no system turn.

    The texts move once, to blocks of neighbouring turns, so a conversation of
    any length is many tasks; a reply that opens a block is handed to the block
    before it as well, and a block's last user turn, without its text, to the
    next.  What a block has to know of its conversation, the first system turn
    and whether there are other turns, comes to it in the same exchange, from
    an aggregate that moves system texts alone."""
    turn_type = long_df.schema["turn"].dataType
    block = F.coalesce(F.floor(F.col("turn") / EXCHANGE_BLOCK), F.lit(0))
    # turns without a key are spread, as they do not meet
    block = F.when(F.col(key).isNull(), F.pmod(F.xxhash64("role", "text"), F.lit(_SYSTEM_BLOCKS))).otherwise(block)
    turns = long_df.select(F.col(key).alias("_k"), "turn", "role", F.col("text").cast("string").alias("text"), block.alias("_b"))
    is_system = F.col("role") == "system"
    none = F.lit(None).cast("string")

    place = F.pmod(F.col("turn"), F.lit(EXCHANGE_BLOCK))
    back = F.when((place == 0) & (F.col("role") == "assistant"), F.struct((F.col("_b") - 1).alias("b"), F.col("text").alias("t")))
    on = F.when((place == EXCHANGE_BLOCK - 1) & (F.col("role") == "user"), F.struct((F.col("_b") + 1).alias("b"), none.alias("t")))
    given = F.array_compact(F.array(F.struct(F.col("_b").alias("b"), F.col("text").alias("t")), back, on))
    dealt = turns.select("_k", "_b", "turn", "role", F.explode(F.when(F.col("_k").isNull(), F.slice(given, 1, 1)).otherwise(given)).alias("g"))
    dealt = dealt.select("_k", F.col("g.b").alias("_block"), F.struct(
        "turn", "role", F.col("g.t").alias("text"), (F.col("g.b") == F.col("_b")).alias("own")).alias("_turn"))

    heads = (turns.where("_k is not null").groupBy("_k")
             .agg(F.min(F.when(is_system, F.col("turn"))).alias("first"),
                  F.min_by("text", F.when(is_system, F.col("turn"))).alias("system"),
                  F.count(F.lit(1)).alias("n"), F.collect_set("_b").alias("_blocks")))
    heads = heads.select("_k", F.explode("_blocks").alias("_block"), F.struct("first", "system", "n").alias("_head"))
    blocks = (dealt.withColumn("_head", F.lit(None).cast(heads.schema["_head"].dataType))
              .unionByName(heads.withColumn("_turn", F.lit(None).cast(dealt.schema["_turn"].dataType)))
              .groupBy("_k", "_block").agg(F.collect_list("_turn").alias("_turns"), F.first("_head", ignorenulls=True).alias("_head")))

    record = lambda turn, question, reply, own: F.struct(
        turn.cast(turn_type).alias("turn"), question.alias("question"), reply.alias("reply"), own.alias("own"))
    several = F.array  # a turn's records
    empty = F.array().cast(f"array<struct<turn:{turn_type.simpleString()},question:string,reply:string,own:string>>")
    keyed = F.col("_k").isNotNull()

    def records_of(x: Column) -> Column:
        reply = lambda y: keyed & (y["role"] == "assistant") & (y["turn"] == x["turn"] + 1)
        asked = lambda y: keyed & (y["role"] == "user") & (y["turn"] == x["turn"] - 1)
        replies = F.transform(F.filter("_turns", reply), lambda y: record(x["turn"], x["text"], y["text"], none))
        question = F.when(F.size(replies) > 0, replies).otherwise(several(record(x["turn"], x["text"], none, none)))
        answer = F.when(F.exists("_turns", asked), empty).otherwise(several(record(x["turn"], none, x["text"], none)))
        system = x["role"] == "system"
        found = F.coalesce(system & (x["turn"] == F.col("_head.first")) & (F.col("_head.n") > 1), F.lit(False))
        other = F.when(found, empty).otherwise(several(record(
            x["turn"], F.when(system, none).otherwise(x["text"]), none, F.when(system, x["text"]))))
        return F.when(x["role"] == "user", question).when(x["role"] == "assistant", answer).otherwise(other)

    found = blocks.select("_k", "_head", F.explode(F.flatten(F.transform(
        F.filter("_turns", lambda x: x["own"]), records_of))).alias("r"))
    return found.select(F.col("_k").alias(key), F.col("r.turn").alias("turn"),
                        F.concat(F.col("_k").cast("string"), F.lit("#"), F.col("r.turn").cast("string")).alias("record_id"),
                        F.coalesce("r.own", "_head.system").alias("system"), "r.question", "r.reply")


def alpaca_records(long_df: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, record_id, instruction, input, output): user turn, system text, reply."""
    return exchanges(long_df, key).select(key, "record_id", F.col("question").alias("instruction"),
                                          F.col("system").alias("input"), F.col("reply").alias("output"))


def openorca_records(long_df: DataFrame, key: str = "conv_id", with_system: bool = True) -> DataFrame:
    """(key, record_id, [system_prompt,] question, response)."""
    system = [F.col("system").alias("system_prompt")] if with_system else []
    return exchanges(long_df, key).select(key, "record_id", *system, "question", F.col("reply").alias("response"))
