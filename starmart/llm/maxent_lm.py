"""Language-model scores from a hashed maximum-entropy model.

``P(word | history) = P(class | history) * P(word | class, history)``, both
softmaxes over sums of hashed feature rows: the word before (bigram), the one
before that (skip) and both (trigram) for the class; bigram and skip, hashed
with the class, for the word inside it.  The most frequent words make up the
classes, by count; two more classes are the end of a text and the tail.  A
tail word's share of its class is its count plus one, and one share is left
for words never seen, so the probabilities of all words add up to one.
Biases are the logarithms of the counts; the feature rows are learned.

Training sees every learning document once: ``rounds`` jobs take a slice
each; every task starts from the shared rows, makes AdaGrad gradient updates
on its part, and sends the rows it touched; a row's next value is the mean
over the tasks, weighted with the tokens that used it.  The rows are bounded
by parameters (about 5 MB), so they are what the driver passes on.

Plan: one shuffle of word counts, all words of all learning documents.  Texts
are read once more and encoded: model words become 16-bit ids in a written
table, from which training and scoring read.  Counts of at most ``head``
frequent words go to the tasks; the occurrences of rarer words alone meet
their counts in a join (the head is cut at a count, so no rare word is
frequent), added up by row.

Defined results: a null text is empty and has one token, its end; a null id
learns and isn't held out; repeated rows are scored each and count each; an
empty table gives an empty result; other columns are ignored.  With nothing
to learn from every token is unseen.  Very long texts are scored whole.
Scores vary in their last digits with the partitions of the input, as sums of
gradients do.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import trimmed, written

LOG10 = float(np.log(10.0))
#: Bound of a weight, so that sums of three stay far from the ends of floats.
LIMIT = np.float32(8)


@dataclass(frozen=True)
class Spec:
    #: Classes of words, and words of a class.
    classes: int = 62
    size: int = 64
    #: Hashed rows of each feature.
    rows: int = 4096
    rounds: int = 2
    rate: float = 0.1
    #: Tokens of a gradient update, tokens scored at once.
    batch: int = 4096
    #: Most words whose counts go to the tasks.
    head: int = 1 << 17
    held: int = 300_000

    @property
    def words(self) -> int:
        return self.classes * self.size


DEFAULT = Spec()


@dataclass
class Model:
    """What tasks need: counts of frequent words and the feature rows."""

    spec: Spec
    #: Frequent words by count; the first ``spec.words`` have classes.
    head: list[str]
    counts: np.ndarray
    n_texts: int
    tokens: int
    types: int
    W: np.ndarray = field(init=False)

    def __post_init__(self):
        s = self.spec
        self.known = min(len(self.head), s.words)
        inside = self.counts[:self.known].astype(np.float64)
        self.tail_types = max(self.types - self.known - (self.n_texts > 0), 0)
        #: The tail's counts, one more for each word of it and for all unseen.
        self.tail_total = self.tokens - self.n_texts - inside.sum() + self.tail_types + 1
        # Both softmaxes have one width; what lies beyond a layer's own is shut.
        width = max(s.classes + 2, s.size)
        shares = np.zeros(width)
        word = np.zeros((s.classes, width))
        at = np.arange(self.known)
        word[at // s.size, at % s.size] = inside + 1
        shares[:s.classes] = word.sum(axis=1)
        shares[s.classes], shares[s.classes + 1] = self.tail_total, self.n_texts + 1
        with np.errstate(divide="ignore"):
            self.class_bias = np.maximum(np.log(shares / shares.sum()), -1e4).astype(np.float32)
            self.word_bias = np.maximum(np.log(word / np.maximum(word.sum(axis=1, keepdims=True), 1)), -1e4).astype(
                np.float32)
        self.W = np.zeros((5 * s.rows, width), dtype=np.float32)


def _mixed(kind: int, a: np.ndarray, b: np.ndarray, rows: int) -> np.ndarray:
    """Row of a feature: a public multiply-and-shift mix of its ids."""
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return kind * rows + (x % np.uint64(rows)).astype(np.int64)


def histories(texts: list[np.ndarray], spec: Spec) -> tuple[np.ndarray, ...]:
    """Tokens of all texts, each ended, with the two tokens before each and
    the text they belong to."""
    length = np.array([len(x) + 1 for x in texts], dtype=np.int64)
    end, start = spec.words + 1, spec.words + 2
    token = np.full(int(length.sum()), end, dtype=np.int64)
    text = np.repeat(np.arange(len(texts)), length)
    first = np.cumsum(length) - length
    at = np.arange(len(token)) - np.repeat(first, length)
    if len(token):
        token[at < np.repeat(length - 1, length)] = np.concatenate(texts)
    before = np.where(at >= 1, np.roll(token, 1), start)
    skip = np.where(at >= 2, np.roll(token, 2), start)
    return token, before, skip, text


def _divisors(z: np.ndarray) -> np.ndarray:
    """The softmax's divisor of each row; ``z`` becomes its numerators."""
    np.exp(z, out=z)  # logits are bounded: biases are shares, weights within LIMIT
    return np.einsum("ij->i", z)


def _row_sums(g: np.ndarray, order: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sums of rows of ``g`` by group: group i has the ``count[i]`` rows
    ``order[first[i]:]``.

    Most groups are small: their rows are added for all groups at once.
    ``reduceat``, which takes its time by groups and columns, gets what lies
    behind, two floats a number."""
    out = g.take(order.take(first), axis=0)
    for k in range(1, 3):
        more = np.flatnonzero(count > k)
        if not len(more):
            return out
        out[more] += g.take(order.take(first[more] + k), axis=0)
    more = np.flatnonzero(count > 3)
    if len(more):
        size = count[more] - 3
        begin = np.cumsum(size) - size
        rest = g.take(order.take(np.repeat(first[more] + 3 - begin, size) + np.arange(int(size.sum()))), axis=0)
        pairs = rest.view(np.complex64) if rest.shape[1] % 2 == 0 else rest
        out[more] += np.add.reduceat(pairs, begin, axis=0).view(np.float32)
    return out


class Layers:
    """Both softmaxes over a batch of tokens."""

    def __init__(self, model: Model, W: np.ndarray):
        self.m, self.s, self.W = model, model.spec, W

    def prepared(self, token: np.ndarray, before: np.ndarray, skip: np.ndarray):
        s, W = self.s, self.W
        kind = np.where(token < s.words, token // s.size, token - s.words + s.classes)
        rows = (_mixed(0, before, before, s.rows), _mixed(1, skip, skip, s.rows), _mixed(2, before, skip, s.rows))
        z = W.take(rows[0], axis=0)
        z += W.take(rows[1], axis=0)
        z += W.take(rows[2], axis=0)
        z += self.m.class_bias
        inner = np.flatnonzero(token < s.words)
        k = kind[inner]
        inner_rows = (_mixed(3, before[inner], k, s.rows), _mixed(4, skip[inner], k, s.rows))
        y = W.take(inner_rows[0], axis=0)
        y += W.take(inner_rows[1], axis=0)
        y += self.m.word_bias.take(k, axis=0)
        return kind, rows, z, inner, token[inner] % s.size, inner_rows, y

    def log_probability(self, token: np.ndarray, before: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """Natural logarithm of each token's probability (of a tail word:
        its class's)."""
        kind, _, z, inner, word, _, y = self.prepared(token, before, skip)
        out = z[np.arange(len(z)), kind].astype(np.float64)
        out -= np.log(_divisors(z))
        own = y[np.arange(len(y)), word]
        out[inner] += own - np.log(_divisors(y))
        return out

    def gradients(self, token: np.ndarray, before: np.ndarray, skip: np.ndarray):
        """(feature rows, gradient of each token's logits) of both layers."""
        kind, rows, g, inner, word, inner_rows, h = self.prepared(token, before, skip)
        g /= _divisors(g)[:, None]
        h /= _divisors(h)[:, None]
        g[np.arange(len(g)), kind] -= 1
        h[np.arange(len(h)), word] -= 1
        return [(r, g) for r in rows] + [(r, h) for r in inner_rows]


def fitted(model: Model, texts: Iterator[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The rows after gradient updates over ``texts``, starting at the
    model's, and how many tokens used each."""
    s = model.spec
    W = model.W.copy()
    layers = Layers(model, W)
    narrow = np.uint16 if len(W) <= 1 << 16 else np.int64  # short keys are sorted by radix
    used = np.zeros(len(W), dtype=np.int64)
    power = np.zeros(len(W), dtype=np.float32)
    for some in _some(texts, 16 * s.batch):
        token, before, skip, _ = histories(some, s)
        for at in range(0, len(token), s.batch):
            cut = slice(at, at + s.batch)
            for rows, g in layers.gradients(token[cut], before[cut], skip[cut]):
                if not len(rows):
                    continue
                order = np.argsort(rows.astype(narrow), kind="stable")
                r = rows.take(order)
                first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                count = np.diff(np.r_[first, len(r)])
                total = _row_sums(g, order, first, count)
                row = r.take(first)
                used[row] += count
                power[row] += np.einsum("ij,ij->i", total, total) / np.float32(total.shape[1])
                total *= (s.rate / np.sqrt(power[row] + 1e-6))[:, None]
                W[row] = np.clip(W[row] - total, -LIMIT, LIMIT)
    return W, used


def _some(texts: Iterator[np.ndarray], tokens: int) -> Iterator[list[np.ndarray]]:
    """Lists of texts of about ``tokens`` tokens."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text) + 1
        if size >= tokens:
            yield held
            held, size = [], 0
    if held:
        yield held


def _ids(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=np.uint16) for x in column.to_pylist()]


# --- jobs ------------------------------------------------------------------------

def word_counts(docs: DataFrame, text_col: str, spec: Spec) -> DataFrame:
    """(word, c) over all texts of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def sent() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({
                "word": pa.array(list(held), pa.binary()).cast(pa.string()),
                "c": pa.array(list(held.values()), pa.int64())})
            held.clear()
            return out

        for batch in trimmed(batches):
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                held.update(text.lower().split())
                if len(held) >= spec.held:
                    yield sent()
        yield sent()

    return (docs.select(F.coalesce(F.col(text_col), F.lit(""))).mapInArrow(count, "word string, c long")
            .groupBy("word").agg(F.sum("c").alias("c")))


def counted(learning: DataFrame, text_col: str, spec: Spec) -> tuple[Model, DataFrame]:
    """A model with its counts, feature rows still zero; and the word table."""
    counts = written(word_counts(learning, text_col, spec), "words")
    step = F.floor(F.log2("c") * 8)
    sizes = (counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("types"), F.sum("c").alias("tokens"))
             .orderBy(F.desc("step")).collect())
    least, total = None, 0
    for r in sizes:
        total += r["types"]
        if total > spec.head:
            break
        least = r["step"]
    head = [] if least is None else counts.filter(step >= least).collect()
    head = sorted(((-r["c"], r["word"]) for r in head))
    n_texts = learning.count()
    tokens = sum(r["tokens"] for r in sizes) + n_texts
    types = sum(r["types"] for r in sizes) + (n_texts > 0)
    return Model(spec, [w for _, w in head], np.array([-c for c, _ in head], dtype=np.int64),
                 n_texts, tokens, types), counts


def encoded(docs: DataFrame, model: Model, id_col: str, text_col: str, held: F.Column) -> DataFrame:
    """One written row for each input row: ids of its words, what frequent
    words add to its scores, and its rare words."""
    spec, tail = model.spec, model.spec.words
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"row long, id {kind}, held_out boolean, n_tokens long, n_tail long, n_known long, base double, "
              "tail double, ids binary, rare array<struct<word:string,n:long>>")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w.encode(): i for i, w in enumerate(model.head)}
        shares = np.log10(model.counts + 1.0)
        for batch in trimmed(batches):
            out: dict[str, list] = {k: [] for k in ("n_tokens", "n_tail", "n_known", "base", "tail", "ids")}
            words, times, ends = [], [], [0]
            for text in batch.column(3).cast(pa.binary()).to_pylist():
                tokens = text.lower().split()
                at = np.fromiter(map(place.get, tokens, repeat(-1)), dtype=np.int64, count=len(tokens))
                seen = at[at >= 0]
                out["n_tokens"].append(len(tokens) + 1)
                out["n_known"].append(len(seen))
                out["base"].append(float(shares[seen].sum()))
                out["tail"].append(float(shares[seen[seen >= tail]].sum()))
                out["n_tail"].append(int((at < 0).sum() + (at >= tail).sum()))
                out["ids"].append(np.where((at < 0) | (at >= tail), tail, at).astype(np.uint16).tobytes())
                if len(seen) < len(tokens):
                    rare = Counter(tokens[i] for i in np.flatnonzero(at < 0))
                    words += rare
                    times += rare.values()
                ends.append(len(words))
            rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(words, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())], ["word", "n"]))
            yield pa.RecordBatch.from_pydict({
                "row": batch.column(0), "id": batch.column(1), "held_out": batch.column(2),
                **{k: pa.array(out[k], pa.int64()) for k in ("n_tokens", "n_tail", "n_known")},
                **{k: pa.array(out[k], pa.float64()) for k in ("base", "tail")},
                "ids": pa.array(out["ids"], pa.binary()), "rare": rare})

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       held.alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return written(rows.mapInArrow(encode, schema), "encoded")


def trained(model: Model, rows: DataFrame) -> Model:
    """The model after gradient updates over the learning rows of
    :func:`encoded`."""
    spec, tasks = model.spec, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = model.W.shape[1]
    schema = "feature int, task int, used long, weights binary"

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        W, used = fitted(model, (x for batch in trimmed(batches) for x in _ids(batch.column(0))))
        at = np.flatnonzero(used)
        yield pa.RecordBatch.from_pydict({
            "feature": pa.array(at, pa.int32()), "used": pa.array(used[at], pa.int64()),
            "task": pa.array(np.full(len(at), TaskContext.get().partitionId()), pa.int32()),
            "weights": pa.array([W[i].tobytes() for i in at], pa.binary())}).select(
                ["feature", "task", "used", "weights"])

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in trimmed(batches):
            for feature, _, used, weights in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                have = total.setdefault(feature, [0, np.zeros(width)])
                have[0] += used
                have[1] += used * np.frombuffer(weights, dtype=np.float32)
        yield pa.RecordBatch.from_pydict({
            "feature": pa.array(list(total), pa.int32()),
            "weights": pa.array([(w / n).astype(np.float32).tobytes() for n, w in total.values()], pa.binary())})

    learning = rows.filter("not held_out")
    for k in range(spec.rounds):
        part = learning.filter(F.pmod(F.xxhash64("row"), F.lit(spec.rounds)) == k).select("ids")
        sent = part.mapInArrow(update, schema).repartition(min(tasks, 64), "feature")
        got = (sent.sortWithinPartitions("feature", "task")
               .mapInArrow(mean, "feature int, weights binary").collect())
        for feature, weights in got:
            model.W[feature] = np.frombuffer(weights, dtype=np.float32)
    return model


def text_scores(docs: DataFrame, held: F.Column, id_col: str = "doc_id", text_col: str = "text",
                spec: Spec = DEFAULT) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of
    every row; rows where ``held`` is true aren't learned from."""
    model, counts = counted(docs.filter(~held), text_col, spec)
    rows = encoded(docs, model, id_col, text_col, held)
    trained(model, rows)
    share = float(np.log10(model.tokens + model.types + 1))
    tail_share = float(np.log10(model.tail_total))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layers = Layers(model, model.W)
        for batch in trimmed(batches):
            ids, total = _ids(batch.column(1)), np.zeros(len(batch))
            done = 0
            for some in _some(iter(ids), 16 * spec.batch):
                token, before, skip, text = histories(some, spec)
                for at in range(0, len(token), spec.batch):
                    cut = slice(at, at + spec.batch)
                    p = layers.log_probability(token[cut], before[cut], skip[cut])
                    total[done:done + len(some)] += np.bincount(text[cut], weights=p, minlength=len(some))
                done += len(some)
            yield pa.RecordBatch.from_pydict({"row": batch.column(0), "model": pa.array(total / LOG10, pa.float64())})

    scored = (rows.select("row", "ids", *(c for c in rows.columns if c not in ("row", "ids", "rare")))
              .transform(lambda d: _beside(d, score, "model double")))
    met = (rows.select("row", F.explode("rare").alias("x")).select("row", "x.word", "x.n")
           .join(counts, "word", "left").groupBy("row")
           .agg(F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"),
                F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("rare_share")))
    rare = F.coalesce("rare_share", F.lit(0.0))
    ends = float(np.log10(model.n_texts + 1))
    return scored.join(met, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(model.n_texts > 0)))
        .cast("long").alias("n_known"),
        F.lit(int(model.tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + rare + F.lit(ends) - F.col("n_tokens") * F.lit(share)).alias("base_score"),
        (F.col("model") + F.col("tail") + rare - F.col("n_tail") * F.lit(tail_share)).alias("score"))


def _beside(df: DataFrame, fn, more: str) -> DataFrame:
    """``df`` without ``ids`` with the column that ``fn`` makes of its first
    two, row for row."""
    keep = [f for f in df.schema.fields if f.name != "ids"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keep) + f", {more}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (made,) = fn(iter([batch]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(f.name)) for f in keep] + [made.column(1)],
                names=[f.name for f in keep] + [made.schema.names[1]])

    return df.mapInArrow(run, schema)


__all__ = ["DEFAULT", "Model", "Spec", "text_scores"]
