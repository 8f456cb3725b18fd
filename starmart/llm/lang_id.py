"""Language ID: a byte convolutional network in numpy.

A text is cut into windows of a fixed number of bytes, all of them.  Bytes
are embedded; filters of several widths slide over a window; each filter's
response is rectified and max-pooled; a softmax layer gives the window's
language.  A text's probabilities are the means over its windows, weighted by
their bytes.  Training is Adam on the driver over a bounded sample of labelled
windows; prediction is one pass over Arrow batches, without a shuffle.

Bounds (parameters of :class:`Spec`): ``train_docs`` labelled rows for each
language, ``train_windows`` windows of each row.  The sample is chosen by a
hash of the row id, the same at every size; predictions read text only.

Defined results: null or letterless text is ``und`` with score 0; without any
labelled row every text is ``und``; a null id is not held out and not trained
on; repeated rows get equal results; empty tables give empty ones; long texts
are read to the end; other columns are ignored.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm import textnp as T
from starmart.llm.common import map_batches


@dataclass(frozen=True)
class Spec:
    window: int = 192
    widths: tuple[int, ...] = (2, 3, 4, 5)
    filters: int = 8  # of each width
    embed: int = 6
    train_docs: int = 500  # labelled rows of a language, at most about
    train_windows: int = 4  # of a row
    epochs: int = 10
    batch: int = 128
    rate: float = 0.004
    seed: int = 7


DEFAULT = Spec()


class ByteCNN:
    """Parameters and the forward pass; ``fit`` trains them."""

    def __init__(self, langs: list[str], spec: Spec = DEFAULT):
        rng = np.random.default_rng(spec.seed)
        self.langs, self.spec = langs, spec
        self.span = max(spec.widths)
        n = len(spec.widths) * spec.filters
        f32 = np.float32
        self.E = rng.normal(0, 0.3, (256, spec.embed)).astype(f32)
        self.E[0] = 0  # padding
        # One matrix for all widths: a narrow filter has zero rows behind it.
        self.live = np.zeros((self.span * spec.embed, n), dtype=f32)
        for i, w in enumerate(spec.widths):
            self.live[:w * spec.embed, i * spec.filters:(i + 1) * spec.filters] = 1
        self.W = (rng.normal(0, 0.25, self.live.shape) * self.live).astype(f32)
        self.b = np.zeros(n, dtype=f32)
        self.V = rng.normal(0, 0.1, (n, len(langs))).astype(f32)
        self.c = np.zeros(len(langs), dtype=f32)

    def patches(self, x: np.ndarray) -> np.ndarray:
        """(windows, positions, span * embed) of byte windows (windows, bytes)."""
        padded = np.zeros((len(x), x.shape[1] + self.span - 1), dtype=np.uint8)
        padded[:, :x.shape[1]] = x
        e = self.E[padded]
        d = self.spec.embed
        out = np.empty((len(x), x.shape[1], self.span * d), dtype=np.float32)
        for j in range(self.span):
            out[:, :, j * d:(j + 1) * d] = e[:, j:j + x.shape[1]]
        return out

    def responses(self, p: np.ndarray) -> np.ndarray:
        return (p.reshape(-1, p.shape[2]) @ self.W).reshape(*p.shape[:2], -1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        parts = []
        for i in range(0, len(x), 128):  # small enough for the caches
            pooled = self.responses(self.patches(x[i:i + 128])).max(axis=1) + self.b
            z = np.maximum(pooled, 0) @ self.V + self.c
            e = np.exp(z - z.max(axis=1, keepdims=True))
            parts.append(e / e.sum(axis=1, keepdims=True))
        return np.concatenate(parts) if parts else np.zeros((0, len(self.langs)), np.float32)

    def fit(self, x: np.ndarray, y: np.ndarray) -> ByteCNN:
        spec, rng = self.spec, np.random.default_rng(self.spec.seed)
        names = ("E", "W", "b", "V", "c")
        m = {k: np.zeros_like(getattr(self, k)) for k in names}
        v = {k: np.zeros_like(getattr(self, k)) for k in names}
        weight = (len(y) / (len(self.langs) * np.bincount(y, minlength=len(self.langs)).clip(1)))[y]
        step, d = 0, spec.embed
        for _ in range(spec.epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), spec.batch):
                i = order[at:at + spec.batch]
                xb, rows = x[i].copy(), np.arange(len(i))[:, None]
                # Short texts are common: some windows are cut at a random byte.
                cut = np.where(rng.random(len(i)) < 0.3, rng.integers(12, xb.shape[1], len(i)), xb.shape[1])
                xb[np.arange(xb.shape[1])[None, :] >= cut[:, None]] = 0
                p = self.patches(xb)
                r = self.responses(p)
                top = r.argmax(axis=1)
                pooled = np.take_along_axis(r, top[:, None, :], 1)[:, 0] + self.b
                h = np.maximum(pooled, 0)
                z = h @ self.V + self.c
                e = np.exp(z - z.max(axis=1, keepdims=True))
                g = e / e.sum(axis=1, keepdims=True)
                g[np.arange(len(i)), y[i]] -= 1
                g *= (weight[i] / len(i))[:, None]
                g = g.astype(np.float32)
                gh = (g @ self.V.T) * (pooled > 0)
                best = p[rows, top]  # (windows, filters, span * embed)
                grad = {"V": h.T @ g, "c": g.sum(0), "b": gh.sum(0),
                        "W": np.einsum("bfk,bf->kf", best, gh) * self.live}
                back = gh[:, :, None] * self.W.T[None]
                ge = np.zeros_like(self.E)
                wide = np.concatenate([xb, np.zeros((len(i), self.span), np.uint8)], axis=1)
                for j in range(self.span):
                    np.add.at(ge, wide[rows, top + j], back[:, :, j * d:(j + 1) * d])
                ge[0] = 0
                grad["E"] = ge
                step += 1
                for k in names:
                    m[k] = 0.9 * m[k] + 0.1 * grad[k]
                    v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                    move = m[k] / (1 - 0.9 ** step) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
                    setattr(self, k, (getattr(self, k) - spec.rate * move).astype(np.float32))
        return self


def cut_windows(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of a block of texts: (windows, size) bytes padded with
    zeros, the text of each, and its number of bytes."""
    length = np.diff(offsets)
    per = -(-length // size)
    text = np.repeat(np.arange(len(length)), per)
    at = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    start = offsets[:-1][text] + at * size
    used = np.minimum(size, offsets[1:][text] - start)
    spot = np.arange(size)[None, :]
    x = data[np.minimum(start[:, None] + spot, max(len(data) - 1, 0))] if len(data) else np.zeros((0, size), np.uint8)
    x[spot >= used[:, None]] = 0
    return x, text, used


def predicted(column: pa.Array, model: ByteCNN) -> tuple[np.ndarray, np.ndarray]:
    """Index of the best language and its mean probability, for each text."""
    data, offsets = T.utf8(column)
    best, score = np.zeros(len(column), dtype=int), np.zeros(len(column))
    for i, j in T.blocks(offsets):
        x, text, used = cut_windows(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i],
                                    model.spec.window)
        p = model.probabilities(x) * used[:, None]
        total = np.zeros((j - i, len(model.langs)))
        for k in range(len(model.langs)):
            total[:, k] = np.bincount(text, weights=p[:, k], minlength=j - i)
        total /= np.maximum(total.sum(axis=1, keepdims=True), 1e-9)
        best[i:j], score[i:j] = total.argmax(axis=1), total.max(axis=1)
    return best, score


def sample_windows(labelled: DataFrame, id_col: str, text_col: str, lang_col: str,
                   spec: Spec) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The bounded training sample: evenly spaced windows of rows chosen by a
    hash of their id, about ``train_docs`` of each language."""
    usable = labelled.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    counts = {r[0]: r[1] for r in usable.groupBy(lang_col).count().collect()}
    langs = sorted(counts)
    if not langs:
        return np.zeros((0, spec.window), np.uint8), np.zeros(0, int), []
    scale = 1 << 30
    odds = F.create_map(*(F.lit(x) for k, n in counts.items()
                          for x in (k, min(scale, scale * spec.train_docs // n + 1))))
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(spec.seed)), F.lit(scale))
    chosen = usable.filter(draw < odds[F.col(lang_col)]).select(text_col, lang_col)

    def some(batch: pa.RecordBatch) -> dict:
        data, offsets = T.utf8(batch.column(0))
        length = np.diff(offsets)
        rows, windows = [], []
        for i in np.flatnonzero(length):
            last = max(int(length[i]) - spec.window, 0)
            for at in np.unique(np.linspace(0, last, spec.train_windows).astype(int)):
                piece = data[offsets[i] + at:min(offsets[i] + at + spec.window, offsets[i + 1])]
                rows.append(i)
                windows.append(piece.tobytes())
        return {"bytes": pa.array(windows, pa.binary()),
                "lang": batch.column(1).take(pa.array(rows, pa.int32()))}

    most = 2 * spec.train_docs * spec.train_windows * len(langs)
    got = map_batches(chosen, some, "bytes binary, lang string").limit(most).collect()
    got = sorted((r[0], r[1]) for r in got)
    x = np.zeros((len(got), spec.window), dtype=np.uint8)
    for i, (window, _) in enumerate(got):
        x[i, :len(window)] = np.frombuffer(window, dtype=np.uint8)
    return x, np.array([langs.index(lang) for _, lang in got], dtype=int), langs


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", spec: Spec = DEFAULT) -> ByteCNN | None:
    x, y, langs = sample_windows(labelled, id_col, text_col, lang_col, spec)
    return ByteCNN(langs, spec).fit(x, y) if langs and len(x) else None


def languages(docs: DataFrame, model: ByteCNN | None, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("_some"),
                       text_col)

    def label(batch: pa.RecordBatch) -> dict:
        some = np.asarray(batch.column(1).to_pylist(), dtype=bool)
        names, score = np.full(len(batch), "und", dtype=object), np.zeros(len(batch))
        if model is not None and len(batch):
            best, p = predicted(batch.column(2), model)
            names = np.where(some, np.array(model.langs, dtype=object)[best], "und")
            score = np.where(some, p, 0.0)
        return {id_col: batch.column(0), "lang_pred": pa.array(names, pa.string()),
                "score": pa.array(np.clip(score, 0, 1), pa.float64())}

    return map_batches(rows, label, f"`{id_col}` {kind}, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> F.Column:
    """True for rows that no model learns from (null ids: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
