"""Language ID: held-out accuracy and defined rows."""
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from starmart.llm import lang_id as L
from starmart.llm.common import read_table
from tests.llm.data import ODD, frame


def model_of(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return docs, L.train(docs.filter(~L.held_out()))


def test_held_out_accuracy(spark):
    docs, model = model_of(spark, "/root/testdata/sf0.01")
    got = L.languages(docs, model).join(docs.select("doc_id", "lang", "text"), "doc_id").withColumn("h", L.held_out())
    rows = got.filter("h").collect()
    assert len(rows) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_and_ids_of_predicted_rows_are_not_read(spark, sf_dir):
    docs, model = model_of(spark, sf_dir)
    mixed = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("s"))
    a, b = (sorted(map(tuple, L.languages(d, model).collect())) for d in (docs, mixed))
    assert a == b


def test_awkward_rows(spark, sf_dir):
    _, model = model_of(spark, sf_dir)
    texts = [*ODD, "1234 !!", "the of and " * 50_000]
    docs = frame(spark, texts, ids=[*range(len(texts) - 1), None])
    rows = {r["doc_id"]: r for r in L.languages(docs, model).collect()}
    for i, x in enumerate(texts[:-1]):
        letters = any(c.isalpha() for c in x or "")
        assert (rows[i]["lang_pred"] != "und") == letters and (letters or rows[i]["score"] == 0)
    assert rows[None]["lang_pred"] == "en"


def test_whole_texts_count(spark, sf_dir):
    """A long text whose beginning is in another language."""
    docs, model = model_of(spark, sf_dir)
    by = {r["lang"]: r["text"] for r in docs.filter("length(text) > 2000").collect()}
    text = by["fr"][:300] + " " + by["de"] * 5
    assert L.languages(frame(spark, [text]), model).first()["lang_pred"] == "de"


def test_windows_cover_every_byte_once():
    from starmart.llm import textnp as T
    texts = ["", "a" * 5, None, "é" * 500, "xyz" * 200]
    data, offsets = T.utf8(pa.array(texts))
    x, text, used = L.cut_windows(data, offsets, 192)
    for i, t in enumerate(texts):
        assert b"".join(x[k, :used[k]].tobytes() for k in np.flatnonzero(text == i)) == (t or "").encode()


def test_without_labels_all_is_und(spark):
    docs = frame(spark, ["some text", None]).withColumn("lang", F.lit(None).cast("string"))
    assert L.train(docs) is None
    assert {r["lang_pred"] for r in L.languages(docs, None).collect()} == {"und"}


def test_empty_table(spark):
    docs = frame(spark, [])
    assert L.train(docs) is None and L.languages(docs, None).collect() == []


def plain_scores(model, text):
    """The network by its definition: one window, filter and place at a time."""
    spec, raw, total = model.spec, text.encode(), np.zeros(len(model.langs))
    for at in range(0, len(raw), spec.window):
        window = raw[at:at + spec.window]
        values = model.E.astype(float)[list(window) + [0] * (spec.window - len(window) + model.span)]
        pooled = []
        for k, width in enumerate(w for w in spec.widths for _ in range(spec.filters)):
            kernel = model.W[:width * spec.embed, k].astype(float).reshape(width, spec.embed)
            best = max(float((values[i:i + width] * kernel).sum()) for i in range(spec.window))
            pooled.append(max(best + float(model.b[k]), 0.0))
        z = np.array(pooled) @ model.V.astype(float) + model.c
        e = np.exp(z - z.max())
        total += len(window) * e / e.sum()
    return total / len(raw)


def test_registered_result_is_the_plain_forward_pass(spark, sf_dir):
    from starmart.llm.queries import op2_language_id
    docs, model = model_of(spark, sf_dir)
    got = {r["doc_id"]: r for r in op2_language_id(spark, sf_dir).collect()}
    every = docs.select("doc_id", "text").orderBy("doc_id").collect()
    assert len(got) == len(every)
    texts = [r for r in every if any(c.isalpha() for c in r["text"] or "")]
    for r in every:
        if r not in texts:
            assert (got[r["doc_id"]]["lang_pred"], got[r["doc_id"]]["score"]) == ("und", 0.0)
    # The plain version takes some 10 ms a window: it runs the shortest and the longest texts.
    texts.sort(key=lambda r: len(r["text"]))
    for r in [*texts[:40], *texts[-4:]]:
        p, row = plain_scores(model, r["text"]), got[r["doc_id"]]
        assert abs(row["score"] - p.max()) < 1e-3 and p[model.langs.index(row["lang_pred"])] > p.max() - 1e-3
