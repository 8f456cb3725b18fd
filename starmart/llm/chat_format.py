"""Chat formatting: event-sourced reconstruction, then rendering.

A conversation is a log of events ``(conv_id, message_id, seq, kind, role,
text)``: ``start`` opens a message, ``delta`` appends streamed text, ``edit``
replaces the whole text, ``regenerate`` drops what was streamed so far.  The
log is folded in the order of ``seq`` into final messages, messages are
ordered by their first event, and each is rendered as one formatted turn with
the span under the loss mask.

Plan: the fold groups by (conversation, message), rendering is row by row.
Only a digest over a whole conversation is sequential by its nature:
:func:`read_back` sorts turns within partitions and streams them through
incremental hashes, holding one batch at a time.  :func:`digests` counts the
characters of each conversation first.  Those of at most ``HOT_CHARS`` are
dealt by conversation, one exchange for both the fold and the digest.  Larger
ones are folded split over their messages, so that one with a third of all
rows isn't one task's fold, and only their turns meet by conversation.

Template: ``<|turn|>role<|text|>text<|end|>`` and a line break.  In roles and
texts a backslash is doubled and control strings (those of the template and
of common public templates) get a backslash after their first character, so
none survives in an output; dropping each backslash before a character gives
the original back.

Defined results: null text or role is empty; events with equal ``seq`` in a
message fold in the order kind, text; a message without ``start`` counts from
its first event; an exactly repeated row of a turn table is a turn of its own
(:func:`events_of_turns`); null conversation ids form one conversation; empty
logs give no rows; other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import written

#: Control strings that may not survive inside texts.
CONTROL = r"(<)(\|(?:turn|text|end)\|>|/?s>|/?<?/?SYS>>)|(\[)(/?INST\])"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LOSS_ROLE = "assistant"
CHUNK = 1000  # characters of one streamed delta
DRAFT = 0.5  # share of a text typed or streamed before an edit or a regeneration
HOT_CHARS = 32 << 20  # larger conversations are folded over many tasks


def escaped(text: F.Column) -> F.Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$1$3\\$2$4")


def unescaped(text: F.Column) -> F.Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def events_of_turns(turns: DataFrame) -> DataFrame:
    """The event log behind a table of turns (conv_id, turn, role, text).

    Streamed in chunks; user turns were begun and then edited to their final
    text, assistant turns broke off and were regenerated.  Each row is a
    message of its own: equal rows differ by their place in the input, which
    a retried task numbers alike.
    """
    text = F.coalesce("text", F.lit(""))
    draft = F.substring(text, F.lit(1), F.ceil(F.length(text) * DRAFT).cast("int"))
    n = F.ceil(F.length(text) / CHUNK).cast("int")
    chunks = F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(
        F.array().cast("array<int>")), lambda i: F.struct(
            F.lit("delta").alias("kind"), F.substring(text, i * CHUNK + 1, F.lit(CHUNK)).alias("text")))

    def event(kind: str, text: F.Column) -> F.Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"))

    role = F.coalesce("role", F.lit(""))
    opened = F.array(event("start", F.lit("")))
    log = (F.when(role == "user", F.concat(opened, F.array(event("delta", draft), event("edit", text))))
           .when(role == "assistant", F.concat(
               opened, F.array(event("delta", draft), event("regenerate", F.lit(""))), chunks))
           .otherwise(F.concat(opened, chunks)))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                        F.monotonically_increasing_id().alias("place"))
    # The place names the message; the order among turns is in seq alone.
    return (rows.select("conv_id", "turn", "role", F.xxhash64("text").alias("tie"), "place", F.posexplode(log))
            .select("conv_id", F.col("place").alias("message_id"),
                    F.struct("turn", "role", "tie", "place", F.col("pos").alias("part")).alias("seq"),
                    F.col("col.kind").alias("kind"), "role", F.col("col.text").alias("text")))


def hot_conversations(events: DataFrame) -> DataFrame:
    """(conv_id) of the conversations with over ``HOT_CHARS`` characters of
    events: a written table, of at most one row for so many characters."""
    size = F.sum(F.length(F.coalesce("text", F.lit(""))).cast("long"))
    return written(events.groupBy("conv_id").agg(size.alias("chars"))
                   .filter(F.col("chars") > HOT_CHARS).select("conv_id"), "hot")


def folded(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, position, role, text) of an event log.  A log
    that is dealt by conversation is folded where it lies."""
    entry = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), "role")
    logs = (events.groupBy("conv_id", "message_id")
            .agg(F.array_sort(F.collect_list(entry)).alias("log")))
    resets = F.transform("log", lambda e, i: F.when(
        e["kind"].isin("edit", "regenerate"), i).otherwise(F.lit(0)))
    live = F.slice("log", F.array_max(resets) + 1, F.size("log"))
    return logs.select(
        "conv_id", F.col("log")[0]["seq"].alias("position"),
        F.coalesce(F.filter("log", lambda e: e["role"].isNotNull())[0]["role"], F.lit("")).alias("role"),
        F.array_join(F.transform(live, lambda e: e["text"]), "").alias("text"))


def rendered(messages: DataFrame) -> DataFrame:
    """Formatted turns (conv_id, position, formatted, loss_start, loss_end);
    the mask counts code points of ``formatted`` and is empty (0, 0) on turns
    that bear no loss."""
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT))
    body = escaped(F.col("text"))
    bears = F.col("role") == LOSS_ROLE
    return (messages.select("conv_id", "position", "role", head.alias("head"), body.alias("body"))
            .select("conv_id", "position",
                    F.concat("head", "body", F.lit(END + "\n")).alias("formatted"),
                    F.when(bears, F.length("head")).otherwise(0).alias("loss_start"),
                    F.when(bears, F.length("head") + F.length("body")).otherwise(0).alias("loss_end")))


def read_back(formatted: DataFrame) -> DataFrame:
    """One row for each conversation, parsed from its formatted turns:
    n_turns, turns_sha256 (role, line break, text, line break a turn),
    loss_chars and loss_sha256 (text under the mask), formatted_chars."""
    inner = F.expr(f"substring(formatted, {len(TURN) + 1}, "
                   f"length(formatted) - {len(TURN) + len(END) + 1})")
    cut = F.locate(TEXT, F.col("inner"))
    masked = unescaped(F.substring("formatted", F.col("loss_start") + 1,
                                   F.col("loss_end") - F.col("loss_start")))
    turns = (formatted.withColumn("inner", inner).select(
        "conv_id", "position",
        unescaped(F.expr(f"substring(inner, 1, locate('{TEXT}', inner) - 1)")).alias("role"),
        unescaped(F.substring("inner", cut + len(TEXT), F.length("inner"))).alias("text"),
        # null: the whole text is under the mask, and isn't sent twice
        F.when(masked != F.col("text"), masked).alias("loss"), F.length("formatted").alias("chars"))
        .repartition("conv_id").sortWithinPartitions("conv_id", "position").drop("position"))
    kind = formatted.schema["conv_id"].dataType.simpleString()
    return turns.mapInArrow(_digests, f"conv_id {kind}, n_turns long, turns_sha256 string, "
                            "loss_chars long, loss_sha256 string, formatted_chars long")


def digests(events: DataFrame) -> DataFrame:
    """:func:`read_back` of the formatted turns of an event log."""
    hot = hot_conversations(events)
    if hot.isEmpty():
        return read_back(rendered(folded(events.repartition("conv_id"))))
    same = events["conv_id"].eqNullSafe(hot["conv_id"])
    cold = events.join(hot, same, "left_anti").repartition("conv_id")
    return read_back(rendered(folded(cold))).unionByName(
        read_back(rendered(folded(events.join(hot, same, "left_semi")))))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams sorted turns; holds the hash states of one conversation."""
    now: list | None = None  # id, turns, hash of turns, loss chars, hash of loss, chars
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def out(done: list[list], like: pa.DataType) -> pa.RecordBatch:
        rows = [[r[0], r[1], r[2].hexdigest(), r[3], r[4].hexdigest(), r[5]] for r in done]
        types = [like, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    like = None
    for batch in batches:
        done, like = [], batch.schema.field(0).type
        for conv, role, text, loss, chars in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            loss = text if loss is None else loss
            if now is None or now[0] != conv:
                done += [now] if now else []
                now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            now[1] += 1
            now[2].update(f"{role}\n{text}\n".encode())
            now[3] += len(loss)
            now[4].update(loss.encode())
            now[5] += chars
        yield out(done, like)
    if now:
        yield out([now], like)
