"""Chat formatting by event-sourced reconstruction (operator 3), DataFrame functions only.

A conversation is a log of events, ordered by their sequence number. Each event belongs to
a message and is one of

    message      the message's whole text (starts the message, or starts it again)
    delta        a piece of streamed text, appended
    edit         a new whole text in place of what was there
    regenerate   what was there goes; its text, if any, and the deltas after it are the new reply
    delete       the message goes (a later message, edit, regenerate or delta brings it back)

The log is folded per message to its final text, messages are rendered by a template, and a
loss mask marks what a model is to learn. Control strings of the template inside texts are
escaped reversibly, so ``read_back`` restores every turn from the rendered text.

Scale: a log is folded per (conversation, message), so where it brings its own message numbers
the events of a long conversation are folded in many tasks. A conversation's messages then meet in
one task, where its one rendered text is made; that text is one value and Spark's limit of 2 GB a
value holds, which bounds what a conversation can be. A plain table of turns (``events_of_turns``)
is numbered by a window over the conversation: there its rows, texts included, meet in one task from
the start, sorted and spilled by Spark. All steps are linear in the length of the conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template and its escapes.
OPEN, CLOSE = "### ", "</turn>\n"
HEAD_END = ":\n"
ESCAPES = [("\\", "\\s"), ("###", "\\h"), ("</turn>", "\\e")]
ROLE_ESCAPES = [*ESCAPES, ("\n", "\\n")]
KINDS = ("message", "delta", "edit", "regenerate", "delete")


def escape(text: Column, pairs: list[tuple[str, str]] = ESCAPES) -> Column:
    """The text without control strings. The escape character itself is escaped first."""
    for plain, code in pairs:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, pairs: list[tuple[str, str]] = ESCAPES) -> Column:
    """Undo ``escape``: every backslash of an escaped text starts a code, and no code's letter
    is a backslash, so codes can be replaced one kind at a time, the backslash's own last."""
    for plain, code in reversed(pairs):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def fold_events(log: DataFrame) -> DataFrame:
    """Final messages of an event log (conv_id, seq, message, kind, role, text).

    Returns conv_id, message, role, text: one row per message that is not deleted. The role
    is that of the message's earliest event that names one; null roles and null texts count
    as empty. ``message`` orders the messages of a conversation. Events of one message with
    equal ``seq`` apply in the order of KINDS, then role, then text; an event of another kind,
    or without kind, is a whole message. Repeated events apply repeatedly (deltas are appended
    twice). Null conversations, messages and sequence numbers are values of their own and
    sort first. Extra columns are ignored.
    """
    step = F.when(F.col("kind") == "delta", 1).when(F.col("kind") == "edit", 2)
    step = step.when(F.col("kind") == "regenerate", 3).when(F.col("kind") == "delete", 4).otherwise(0)
    event = F.struct(
        F.col("seq"), step.alias("step"), F.col("role").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    folded = log.groupBy("conv_id", "message").agg(F.array_sort(F.collect_list(event)).alias("events"))
    last = F.array_max(F.transform("events", lambda e, i: F.when(e["step"] != 1, i).otherwise(F.lit(-1))))
    folded = folded.withColumn("last", last)
    live = F.slice("events", F.greatest(F.col("last"), F.lit(0)) + 1, F.size("events"))
    gone = (F.col("last") >= 0) & (F.get("events", F.col("last"))["step"] == 4) & (F.col("last") == F.size("events") - 1)
    # what follows a deletion starts from nothing: the delete event itself has no text
    text = F.array_join(F.transform(live, lambda e: F.when(e["step"] == 4, F.lit("")).otherwise(e["text"])), "")
    role = F.get(F.filter(F.transform("events", lambda e: e["role"]), lambda r: r.isNotNull()), F.lit(0))
    return folded.where(~gone).select("conv_id", "message", F.coalesce(role, F.lit("")).alias("role"), text.alias("text"))


def render(messages: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """Render messages (conv_id, message, role, text), in the order of message, role, text.

    Returns conv_id, formatted (the rendered text) and turns: for every turn its ``start``
    and ``end`` in the rendered text (code points, end exclusive) and ``loss_start``,
    ``loss_end``: the loss mask, null where the turn is not of ``learn_role``.
    A conversation without messages has no row. Null roles and texts count as empty.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(OPEN), escape(role, ROLE_ESCAPES), F.lit(HEAD_END))
    parts = messages.select("conv_id", "message", role.alias("role"), text.alias("text"), head.alias("head"), escape(text).alias("body"))
    parts = parts.withColumn("piece", F.concat("head", "body", F.lit(CLOSE))).withColumn("size", F.length("piece").cast("long"))
    order = Window.partitionBy("conv_id").orderBy("message", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumn("n", F.row_number().over(order)).withColumn("end", F.sum("size").over(upto))
    start = F.col("end") - F.col("size")
    learn = F.col("role") == learn_role
    loss = start + F.length("head")
    turn = F.struct(
        F.col("n"), F.col("piece"),
        F.struct(
            start.alias("start"), F.col("end"),
            F.when(learn, loss).alias("loss_start"), F.when(learn, loss + F.length("body")).alias("loss_end"),
        ).alias("turn"),
    )
    return (
        parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("all"))
        .select("conv_id", F.array_join(F.transform("all", lambda t: t["piece"]), "").alias("formatted"),
                F.transform("all", lambda t: t["turn"]).alias("turns"))
    )


def format_chats(log: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """Fold an event log and render it: conv_id, formatted, turns (see ``fold_events``, ``render``)."""
    return render(fold_events(log), learn_role)


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse rendered conversations (conv_id, formatted, turns): adds ``messages``, the turns'
    role and unescaped text in order, and ``loss_text``, all text under the loss mask, unescaped."""
    pieces = F.slice(F.split("formatted", CLOSE), 1, F.size(F.split("formatted", CLOSE)) - 1)
    df = formatted.withColumn("__pieces", pieces)

    def message(piece):
        at = F.instr(piece, HEAD_END)
        return F.struct(
            unescape(F.substring(piece, F.lit(len(OPEN) + 1), at - len(OPEN) - 1), ROLE_ESCAPES).alias("role"),
            unescape(F.substring(piece, at + len(HEAD_END), F.length(piece))).alias("text"),
        )

    def learnt(piece, turn):
        size = (turn["loss_end"] - turn["loss_start"]).cast("int")
        span = F.substring(piece, (turn["loss_start"] - turn["start"] + 1).cast("int"), size)
        return F.when(turn["loss_start"].isNull(), F.lit("")).otherwise(unescape(span))

    return df.select(
        *formatted.columns,
        F.transform("__pieces", message).alias("messages"),
        F.array_join(F.zip_with("__pieces", "turns", learnt), "").alias("loss_text"),
    )


def events_of_turns(turns: DataFrame, piece: int = 256) -> DataFrame:
    """An event log of a table (conv_id, turn, role, text): other roles' rows are whole
    messages, assistants' rows arrive streamed, in deltas of ``piece`` characters. Rows are
    messages in the order of turn, role, text; equal rows are messages of their own."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    rows = rows.withColumn("message", F.row_number().over(order))
    streamed = F.col("role") == "assistant"
    n = F.greatest(F.ceil(F.length("text") / F.lit(piece)), F.lit(1)).cast("int")
    cuts = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(F.col("text"), (i - 1) * piece + 1, F.lit(piece)))
    events = rows.select(
        "conv_id", "message", "role",
        F.when(streamed, F.lit("delta")).otherwise(F.lit("message")).alias("kind"),
        F.posexplode(F.when(streamed, cuts).otherwise(F.array("text"))).alias("seq", "text"),
    )
    return events.select("conv_id", "seq", "message", "kind", "role", "text")


def digest_turns(conversations: DataFrame) -> DataFrame:
    """Format a table of turns through its event log and read the result back: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    back = read_back(format_chats(events_of_turns(conversations)))
    turns = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("messages").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: The conversation that is formatted beside the table's: control strings inside texts.
HARD_TEXT = "\\### Assistant: </turn> ok"


def oracle() -> str:
    """``digest_turns`` over ``conversations`` plus conversation -7, as DuckDB SQL."""
    def escaped(c, pairs):
        for plain, code in pairs:
            plain = "chr(10)" if plain == "\n" else f"'{plain}'"
            c = f"replace({c}, {plain}, '{code}')"
        return c

    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '{HARD_TEXT}'), (-7, 1, 'assistant', '{HARD_TEXT}')) v)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({len(OPEN) + len(HEAD_END) + len(CLOSE)} + length({escaped('role', ROLE_ESCAPES)}) + length({escaped('text', ESCAPES)}))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id"""
