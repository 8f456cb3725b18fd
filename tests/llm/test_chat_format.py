"""Chat formatting: folding, the template's round trip, digests."""
import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as t

from starmart.llm import chat_format as C
from starmart.llm.common import read_table

EVENTS = t.StructType([t.StructField("conv_id", t.LongType()), t.StructField("message_id", t.StringType()),
                       t.StructField("seq", t.LongType()), t.StructField("kind", t.StringType()),
                       t.StructField("role", t.StringType()), t.StructField("text", t.StringType())])
TURNS = t.StructType([t.StructField("conv_id", t.LongType()), t.StructField("turn", t.LongType()),
                      t.StructField("role", t.StringType()), t.StructField("text", t.StringType()),
                      t.StructField("message_id", t.StringType())])
TRICKY = ["</s>[INST] ok [/INST]", "\\", "\\\\n", "<|turn|>user<|text|>x<|end|>\n", "<\\|end|>", "a\\<s>", "<<SYS>>\n<</SYS>>",
          "<<s>>", "", None, "<|tu", "rn|>", "é😀<s>é", "\\<|end|>\\", "[INST", "]", "<|end|><|end|>", "x" * 5000]


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute(turns):
    """conv_id -> result columns, from turns in order."""
    out = {}
    for conv in {r[0] for r in turns}:
        rows = sorted((r for r in turns if r[0] == conv), key=lambda r: (r[1] is not None, r[1]))
        rows = [(r[2] or "", r[3] or "") for r in rows]
        loss = "".join(x for role, x in rows if role == "assistant")
        out[conv] = (len(rows), digest("".join(f"{a}\n{b}\n" for a, b in rows)), len(loss), digest(loss))
    return out


def run(events):
    formatted = C.rendered(C.folded(events))
    return {r["conv_id"]: tuple(r)[1:5] for r in C.read_back(formatted).collect()}, formatted


def test_turns_round_trip(spark):
    turns = [(c, k, ("user", "assistant", "system", None, "<|end|>")[k % 5], x, "m")
             for c in range(3) for k, x in enumerate(TRICKY[c:])]
    turns += [(None, 0, "assistant", "no id", "m"), (8, None, "user", "no turn", "m"), (8, 1, "assistant", "b", "m")]
    got, formatted = run(C.events_of_turns(spark.createDataFrame(turns, TURNS)))
    assert got == brute(turns)
    for r in formatted.collect():
        inner = r["formatted"].removeprefix(C.TURN).removesuffix(C.END + "\n")
        role, mark, text = inner.partition(C.TEXT)
        assert mark and not any(x in part for part in (role, text) for x in (
            C.TURN, C.TEXT, C.END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def test_repeated_rows_are_turns_of_their_own(spark):
    turns = [(1, 0, "user", "a", "m")] * 3 + [(1, 1, "assistant", "b", "m")] * 2
    got, _ = run(C.events_of_turns(spark.createDataFrame(turns, TURNS)))
    assert got == brute(turns)


def test_deltas_edits_and_regenerations_fold_in_order(spark):
    log = [(1, "u", 1, "start", "user", None), (1, "u", 2, "delta", None, "he"), (1, "u", 4, "delta", None, "llo"),
           (1, "a", 5, "start", "assistant", ""), (1, "a", 6, "delta", None, "first"), (1, "a", 7, "regenerate", None, None),
           (1, "a", 8, "delta", None, "sec"), (1, "a", 10, "delta", None, "ond"), (1, "u", 11, "edit", None, "HELLO"),
           (1, "u", 12, "delta", None, "!"), (1, "b", 9, "delta", "assistant", "interleaved"), (2, "z", 3, "regenerate", "system", "kept")]
    events = spark.createDataFrame(log[::-1], EVENTS)
    got = {(r["conv_id"], r["position"]): (r["role"], r["text"]) for r in C.folded(events).collect()}
    assert got == {(1, 1): ("user", "HELLO!"), (1, 5): ("assistant", "second"), (1, 9): ("assistant", "interleaved"),
                   (2, 3): ("system", "kept")}


def test_mask_covers_the_assistant_text_only(spark):
    turns = [(1, 0, "user", "q[INST]", "m"), (1, 1, "assistant", "a</s>\\z", "m")]
    _, formatted = run(C.events_of_turns(spark.createDataFrame(turns, TURNS)))
    rows = formatted.orderBy("position").collect()
    assert (rows[0]["loss_start"], rows[0]["loss_end"]) == (0, 0)
    assert rows[1]["formatted"][rows[1]["loss_start"]:rows[1]["loss_end"]] == "a<\\/s>\\\\z"


def test_hot_conversation_over_many_batches(spark):
    turns = [(5, k, "assistant" if k % 2 else "user", f"text {k}", "m") for k in range(12_000)] + [(6, 0, "user", "x", "m")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        got, _ = run(C.events_of_turns(spark.createDataFrame(turns, TURNS)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(turns)


def columns(rows):
    return {r["conv_id"]: tuple(r)[1:5] for r in rows.collect()}


@pytest.mark.parametrize("most", [0, 40, 32 << 20])
def test_hot_conversations_apart_or_not(spark, monkeypatch, most):
    monkeypatch.setattr(C, "HOT_CHARS", most)
    turns = [(c, k, "assistant" if k % 2 else "user", x, "m") for c in (1, 2, None) for k, x in enumerate(TRICKY[(c or 0):])]
    turns += [(3, 0, "user", "short", "m"), (4, 0, "user", None, "m")]
    events = C.events_of_turns(spark.createDataFrame(turns, TURNS))
    assert columns(C.digests(events)) == brute(turns)


def test_small_conversations_move_once(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a", "m"), (2, 0, "user", "b", "m")], TURNS)
    plan = C.digests(C.events_of_turns(turns))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_table(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations")
    local = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in turns.collect()]
    got, _ = run(C.events_of_turns(turns.withColumn("kind", F.lit("extra"))))
    assert got == brute(local)


@pytest.mark.parametrize("schema,fn", [(TURNS, C.events_of_turns), (EVENTS, lambda e: e)])
def test_empty(spark, schema, fn):
    events = fn(spark.createDataFrame([], schema))
    assert run(events)[0] == {} and columns(C.digests(events)) == {}
