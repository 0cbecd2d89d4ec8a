"""Chat formatting by event-sourced reconstruction (operator 6).

Input is a log of events, not of messages. Events of a conversation are ordered by their sequence number and folded
into final messages:

* `start`  opens message `message_id` with a role and an optional first text,
* `delta`  appends streamed text to the latest generation of that message,
* `edit`   replaces the text of the message with the given one,
* `regenerate` throws the text of the message away; the deltas that follow are its new generation,
* `delete` removes the message.

The fold runs per message first (so a long conversation is spread over its messages), and only the finished, escaped
and rendered messages of one conversation are put together, in the order in which they were started.

The template is `<|im_start|>role\ntext<|im_end|>\n` per message. Inside roles and texts `<`, any number of
backslashes and `|` get one backslash more, so no control string can be forged and taking one away restores the text.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from latticeframe.llm.common import map_rows

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Roles whose texts are trained on
LOSS_ROLES = ("assistant",)
EVENTS = "conv_id long, seq long, message_id string, kind string, role string, text string"

_message = re.compile(re.escape(OPEN) + r"(.*?)\n(.*?)" + re.escape(CLOSE) + r"\n", re.DOTALL)
_escaped = re.compile(r"<(\\*)\\\|")
_escaped_role = re.compile(r"\\(\\|n)")

# --- template ------------------------------------------------------------------------------------------------------


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def escape_role(role: Column) -> Column:
    """A role ends with its line, so line breaks in it are escaped first."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape(text: str) -> str:
    return _escaped.sub(r"<\1|", text)


def unescape_role(role: str) -> str:
    return _escaped_role.sub(lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def parse(formatted: str) -> list[tuple[str, int, int]]:
    """(role, start and end of the escaped text in `formatted`) of every message, from the formatted string alone."""
    out, at = [], 0
    while at < len(formatted):
        m = _message.match(formatted, at)
        if m is None:
            raise ValueError(f"no message at {at}")
        out.append((unescape_role(m[1]), m.start(2), m.end(2)))
        at = m.end()
    return out


# --- events --------------------------------------------------------------------------------------------------------


def events_of_turns(turns: DataFrame) -> DataFrame:
    """A log behind finished turns: a start, a streamed draft that is given up, and the text that replaces it.

    A model's draft is regenerated and streamed anew in two deltas, any other one is edited and then added to.


    Null texts and roles are empty. Rows with the same conversation and turn stay messages of their own, ordered by
    role and text; null turns come first; a null conversation is one of its own.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")
    )
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("n", F.row_number().over(order).cast("long"))
    half = F.floor(F.length("text") / 2).cast("int")
    left, right = F.left("text", half), F.substring(F.col("text"), half + 1, F.length("text"))
    model = F.col("role").isin(*LOSS_ROLES)

    def event(step: int, kind: str | Column, said: Column) -> Column:
        kind = F.lit(kind) if isinstance(kind, str) else kind
        return F.struct(F.lit(step).alias("step"), kind.alias("kind"), said.alias("text"))

    steps = F.array(
        event(0, "start", F.lit("")),
        event(1, "delta", right),
        event(2, F.when(model, "regenerate").otherwise("edit"), F.when(~model, left)),
        event(3, "delta", F.when(model, left).otherwise(F.lit(""))),
        event(4, "delta", right),
    )
    return rows.select("conv_id", "role", "n", F.explode(steps).alias("e")).select(
        "conv_id",
        (F.col("n") * 5 + F.col("e.step")).alias("seq"),
        F.col("n").cast("string").alias("message_id"),
        "e.kind",
        F.when(F.col("e.step") == 0, F.col("role")).alias("role"),
        "e.text",
    )


def fold(events: DataFrame) -> DataFrame:
    """Final messages `conv_id, first_seq, message_id, role, text` of a log.

    The last start, edit or regeneration of a message decides where its text begins; later deltas are appended in
    order of `seq` (ties: by kind and text). An empty log gives no messages; extra columns are ignored; a text may have
    any length. A message without a start has an empty role unless another event names
    one (the latest does). Deleted messages are gone; unknown kinds and null texts add nothing. Equal events count
    as often as they are there.
    """
    e = events.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("message_id").cast("string").alias("message_id"),
        F.struct(
            F.col("seq").cast("long").alias("seq"),
            F.col("kind").cast("string").alias("kind"),
            F.col("text").cast("string").alias("text"),
            F.col("role").cast("string").alias("role"),
        ).alias("e"),
    )
    told = e.groupBy("conv_id", "message_id").agg(F.sort_array(F.collect_list("e")).alias("log"))
    resets = F.filter(
        F.transform(F.col("log"), lambda x, i: F.when(x["kind"].isin("start", "edit", "regenerate"), i)),
        lambda i: i.isNotNull(),
    )
    told = told.withColumn("begin", F.coalesce(F.array_max(resets), F.lit(0)))
    parts = F.transform(
        F.filter(F.col("log"), lambda x, i: (i >= F.col("begin")) & x["kind"].isin("start", "edit", "delta")),
        lambda x: F.coalesce(x["text"], F.lit("")),
    )
    roles = F.filter(F.transform(F.col("log"), lambda x: x["role"]), lambda r: r.isNotNull())
    gone = F.exists("log", lambda x: F.coalesce(x["kind"] == "delete", F.lit(False)))
    return told.filter(~gone).select(
        "conv_id",
        F.get("log", F.lit(0))["seq"].alias("first_seq"),
        "message_id",
        F.coalesce(F.element_at(F.when(F.size(roles) > 0, roles).otherwise(F.array(F.lit(""))), -1), F.lit("")).alias("role"),
        F.array_join(parts, "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """`conv_id, formatted`: the messages of each conversation in the order of their first events."""
    one = F.concat(
        F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"), escape(F.col("text")), F.lit(CLOSE), F.lit("\n")
    )
    rows = messages.select("conv_id", F.struct("first_seq", "message_id", one.alias("one")).alias("m"))
    told = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("m"))
    return told.select("conv_id", F.array_join(F.col("m.one"), "").alias("formatted"))


def with_loss_mask(rendered: DataFrame) -> DataFrame:
    """`conv_id, formatted, loss_spans`: where the texts to train on stand in `formatted` (code points)."""

    def make():
        def rows(ids, texts):
            return [
                (i, t, [(a, b) for role, a, b in parse(t) if role in LOSS_ROLES])
                for i, t in zip(ids, texts, strict=True)
            ]

        return rows

    return map_rows(
        rendered.select("conv_id", "formatted"),
        "conv_id long, formatted string, loss_spans array<struct<start:long,end:long>>",
        make,
    )


def digest(masked: DataFrame) -> DataFrame:
    """What can be read back from the formatted strings and their loss masks."""

    def make():
        def rows(ids, texts, spans):
            out = []
            for i, t, mask in zip(ids, texts, spans, strict=True):
                turns = parse(t)
                whole = "".join(f"{role}\n{unescape(t[a:b])}\n" for role, a, b in turns)
                loss = "".join(unescape(t[m["start"] : m["end"]]) for m in mask)
                sha = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
                out.append((i, len(turns), sha[0], len(loss), sha[1], len(t)))
            return out

        return rows

    return map_rows(
        masked,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
        make,
    )
