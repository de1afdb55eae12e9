"""Chat prompts, message templates, conversation context, stop strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.operators.ordered import ordered_scan
from chronoweave.session import stage

PART_TURNS = 1_000  # turns of a conversation in one list

# Role markers of the prompt format.
OPEN = "<|im_start|>"
CLOSE = "<|im_end|>"
END = "</s>"


def _block(role: str, text: Column) -> Column:
    return F.concat(F.lit(f"{OPEN}{role}\n"), text, F.lit(f"\n{CLOSE}\n"))


def prompt_input(system: Column, user: Column) -> Column:
    return F.concat(_block("system", system), _block("user", user), F.lit(f"{OPEN}assistant\n"))


def prompt_output(answer: Column) -> Column:
    return F.concat(answer, F.lit(f"\n{CLOSE}{END}"))


def chat_prompt(system: str | Column, user: Column, answer: Column, *, separate: bool = False) -> Column:
    """Prompt text, or ``struct(input, output)`` if ``separate``."""
    system = F.lit(system) if isinstance(system, str) else system
    head, tail = prompt_input(system, user), prompt_output(answer)
    if separate:
        return F.struct(head.alias("input"), tail.alias("output"))
    return F.concat(head, tail)


def message_text(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit("\n"), text, F.lit(f"{CLOSE}\n"))


def apply_template(messages: Column, *, add_generation_prompt: bool = False) -> Column:
    """``array<struct<role, text>>`` to template text."""
    body = F.array_join(F.transform(messages, lambda m: message_text(m["role"], m["text"])), "")
    return F.concat(body, F.lit(f"{OPEN}assistant\n")) if add_generation_prompt else body


def context_parts(
    turns: DataFrame,
    conversation: str,
    turn: str,
    role: str,
    text: str,
    *,
    asked: DataFrame | None = None,
    part_turns: int = PART_TURNS,
) -> DataFrame:
    """What each user turn is answered from, in pieces: ``conversation, turn, part, n_parts, messages``.

    Turns are numbered and laid in parts of ``part_turns`` once. A context is a prefix of its
    conversation, so it reads the parts up to its own, the last one cut short: no list is longer
    than a part, and a long conversation lies in many tasks. ``asked`` (``conversation, turn``) limits what is built to some turns.
    """
    numbered = stage(ordered_scan(turns.select(conversation, turn, role, text), [conversation], [turn], number="__n"))
    placed = numbered.withColumn("part", F.floor((F.col("__n") - 1) / part_turns))
    line = F.struct("__n", F.col(role).alias("role"), F.col(text).alias("text"))
    parts = placed.groupBy(conversation, "part").agg(F.array_sort(F.collect_list(line)).alias("__turns"))
    users = placed.where(F.col(role) == "user").select(conversation, turn, "__n", (F.col("part") + 1).alias("n_parts"))
    if asked is not None:
        users = users.join(asked.select(conversation, turn), [conversation, turn], "left_semi")
    each = users.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_parts") - 1)))
    seen = F.slice("__turns", F.lit(1), F.least(F.col("__n") - F.col("part") * part_turns, F.lit(part_turns)).cast("int"))
    messages = F.transform(seen, lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text")))
    return each.join(parts, [conversation, "part"]).select(conversation, turn, "part", "n_parts", messages.alias("messages"))


def conversation_contexts(
    turns: DataFrame,
    conversation: str,
    turn: str,
    role: str,
    text: str,
    *,
    system: str,
    tokenizer=None,
    max_tokens: int | None = None,
    asked: DataFrame | None = None,
    part_turns: int = PART_TURNS,
) -> DataFrame:
    """The context each user turn is answered from: system message, history, message.

    Every user turn gives one, which holds its whole history; with ``asked`` only those turns
    do. With ``max_tokens`` and a ``tokenizer``, contexts that are longer are left out; a running
    token total decides that before anything is collected. A context of one part is ready; the
    pieces of longer ones are put together, which is all that a task ever holds of them.
    """
    fitting = turns
    if max_tokens is not None:
        sized = turns.withColumn("__size", tokenizer.floor(message_text(F.col(role), F.col(text))))
        sized = ordered_scan(sized, [conversation], [turn], running={"__total": "__size"})
        opening = F.lit(f"{OPEN}system\n{system}{CLOSE}\n")
        closing = F.lit(f"{OPEN}assistant\n")
        fitting = sized.where(F.col("__total") + tokenizer.floor(opening) + tokenizer.floor(closing) <= max_tokens)

    pieces = context_parts(fitting, conversation, turn, role, text, asked=asked, part_turns=part_turns)
    short = pieces.where("n_parts = 1").select(conversation, turn, "messages")
    long = pieces.where("n_parts > 1").groupBy(conversation, turn).agg(F.array_sort(F.collect_list(F.struct("part", "messages"))).alias("__pieces"))
    long = long.select(conversation, turn, F.flatten(F.transform("__pieces", lambda p: p["messages"])).alias("messages"))
    first = F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("text")))
    return short.unionByName(long).withColumn("messages", F.concat(first, F.col("messages")))


def ends_with_stop(text: Column, stops: Sequence[str], slack: int = 5) -> Column:
    """Number of stop strings found in the tail of a text.

    The tail is ``slack`` longer than the stop string; shorter texts do not count.
    """
    hits = [
        F.when(
            (F.length(text) >= len(s) + slack) & F.contains(F.right(text, F.lit(len(s) + slack)), F.lit(s)), 1
        ).otherwise(0)
        for s in stops
    ]
    total = hits[0]
    for h in hits[1:]:
        total = total + h
    return total
