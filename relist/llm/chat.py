"""Chat formatting by a finite-state machine over roles and a declarative template.

A template names the control strings that open and close a turn of each role and whether the text
between them counts for the loss. NEXT lists the roles that may follow a role (None: the start). A turn
whose role may not follow the one before is marked, and formatted all the same. The state after a turn
is its role, so one look at the turn before suffices: turns are sorted within the conversation and
formatted row by row, and a conversation is never collected.

Control strings inside texts and roles are broken by a backslash behind their first character, backslashes are
doubled; reading drops each backslash and keeps the character behind it, so formatting is reversible.

Digests of whole conversations are sequential by nature: `digests` reads the sorted rows as a stream
and holds one running hash, whatever the length of the conversation.

Defined cases: null texts and null roles count as empty; turns are in the order of (turn, role, text), null
turns first; repeated rows are turns of their own; a null conv_id is one conversation. Roles without an entry in the
template are written with their name and count for no loss. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    before: str
    after: str
    loss: bool = False


TEMPLATE = {
    "system": Turn("<<SYS>>\n", "\n<</SYS>>\n"),
    "user": Turn("[INST] ", " [/INST]\n"),
    "assistant": Turn("<s>", "</s>\n", loss=True),
}
#: Any other role: its name stands between the first two strings, its text between the last two.
OTHER = ("<<ROLE>>", "<</ROLE>>", "<<END>>\n")
NEXT = {None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}


def controls(template: dict[str, Turn] = TEMPLATE) -> list[str]:
    marks = [m.strip() for t in template.values() for m in (t.before, t.after)] + [m.strip() for m in OTHER]
    return sorted(set(marks), key=lambda m: (-len(m), m))


def escape(text: Column, template: dict[str, Turn] = TEMPLATE) -> Column:
    """Backslashes doubled, control strings broken behind their first character."""
    broken = "|".join(f"(?<={re.escape(m[0])})(?={re.escape(m[1:])})" for m in controls(template))
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), broken, r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _strings(role: Column, template: dict[str, Turn]) -> tuple[Column, Column, Column]:
    """The opening and closing strings of a role, and its loss flag."""
    before = F.concat(F.lit(OTHER[0]), escape(role, template), F.lit(OTHER[1]))
    after, loss = F.lit(OTHER[2]), F.lit(False)
    for name, turn in template.items():
        before = F.when(role == name, F.lit(turn.before)).otherwise(before)
        after = F.when(role == name, F.lit(turn.after)).otherwise(after)
        loss = F.when(role == name, F.lit(turn.loss)).otherwise(loss)
    return before, after, loss


def _order(conv_id: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in (conv_id, "turn", "role", "text")]


def format_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 template: dict[str, Turn] = TEMPLATE) -> DataFrame:
    """One row per turn, in order within its partition: conv_id, turn, role, text, segments, formatted, allowed.

    segments: array of (text, loss), joined they are `formatted`; joined over the turns, the conversation.
    """
    rows = conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), *[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    before, after, loss = _strings(F.col("role"), template)
    by_turn = Window.partitionBy("conv_id").orderBy(*_order("conv_id")[1:])
    last = F.lag("role").over(by_turn)
    follows = F.lit(False)
    for state, roles in NEXT.items():
        here = last.isNull() if state is None else last == state
        follows = follows | (F.coalesce(here, F.lit(False)) & F.col("role").isin(*roles))
    rows = rows.withColumn("allowed", follows)
    body = escape(F.col("text"), template)
    segments = F.array(*[F.struct(s.alias("text"), flag.alias("loss")) for s, flag in ((before, F.lit(False)), (body, loss), (after, F.lit(False)))])
    return rows.withColumn("segments", segments).withColumn("formatted", F.concat_ws("", "segments.text"))


def read_turns(formatted: DataFrame, template: dict[str, Turn] = TEMPLATE) -> DataFrame:
    """Rows with a `formatted` turn, with role_read, text_read and loss_read recovered from that alone."""
    known = "|".join(f"(?:{re.escape(t.before)}(.*){re.escape(t.after)})" for t in template.values())
    other = f"(?:{re.escape(OTHER[0])}(.*?){re.escape(OTHER[1])}(.*){re.escape(OTHER[2])})"
    whole = f"(?s)^(?:{known}|{other})$"
    part = lambda k: F.regexp_extract("formatted", whole, k)
    role, text, loss = unescape(part(len(template) + 1)), part(len(template) + 2), F.lit(False)
    for k, (name, turn) in enumerate(template.items(), 1):
        mine = F.col("formatted").startswith(turn.before)
        role, text, loss = F.when(mine, F.lit(name)).otherwise(role), F.when(mine, part(k)).otherwise(text), F.when(mine, F.lit(turn.loss)).otherwise(loss)
    return formatted.withColumns({"role_read": role, "text_read": unescape(text), "loss_read": loss})


_DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, valid boolean"


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation -> one row for each, with running hashes only."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    started, conv, state, done = False, None, None, []

    def close():
        n, turns, chars, loss, size, valid = state
        done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size, valid))

    def batch_of():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done) if done else [()] * len(names), types)], names)

    for batch in batches:
        for own, role, text, loss, size, allowed in zip(*(c.to_pylist() for c in batch.columns)):
            if not started or own != conv:
                if started:
                    close()
                started, conv, state = True, own, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, True]
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            if loss:
                state[2] += len(text)
                state[3].update(text.encode())
            state[4] += size
            state[5] = state[5] and allowed
        if done:
            yield batch_of()
            done = []
    if started:
        close()
    yield batch_of()


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from what is read back: counts and SHA-256 of its turns and of its text under the loss mask."""
    read = read_turns(formatted).repartition("conv_id").sortWithinPartitions(*_order("conv_id"))
    return read.select("conv_id", "role_read", "text_read", "loss_read", F.length("formatted").cast("long"), "allowed").mapInArrow(_stream, _DIGESTS)
