"""Phrase collocations from a prefix-free parse of the corpus.

Texts are cut into pieces at sentence and line marks, pieces into words; a
text is the stream of its words with a stop after each piece.  A word whose
content hash is 0 modulo ``period`` triggers a new chunk, so equal passages
are cut alike wherever they stand.  A chunk is its own tokens and, as overlap,
the next two.  The distinct chunks with their parse frequencies are the
dictionary.  Everything is counted inside the distinct chunks, weighted with
those frequencies: an n-gram belongs to the chunk that owns its first word, so
overlaps are counted once and the counts equal those of the whole corpus.

Plan: one shuffle of chunks (copies collapse in the task, then before the
exchange) writes the dictionary.  One pass over it counts words; another
deals three-word grams, packed, to buckets by their first two words, so a
bucket knows the whole count of its pairs and of their continuations, and only
phrases of at least ``least`` occurrences leave it.  (A row holds all buckets
of one shuffle partition, taken apart behind the exchange.)
Pairs of two hot words (more than a quarter of an average task's share each;
at most four for each shuffle partition, so the list is bounded) are dealt by
the whole gram and their partial counts added afterwards: no bucket grows
with one pair.  The parts of a phrase meet their counts in one join, in which
words are salted; one aggregate by phrase takes the lowest cut and the
longest cover, and the ranking keeps ``top`` rows a group before it shuffles.

Defined results: a null text is empty; a null group is ``und``; repeated rows
count as often as they stand; texts without a phrase give nothing; an empty
table gives an empty result; other columns are ignored.  Very long texts are
parsed whole.  Ties: a higher count first, then the phrase in UTF-8 order;
among cuts the smaller ``k``.
"""
from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import partition_keys, trimmed, written

PIECES = re.compile(rb"[.,;:!?\x0A-\x0D]")
#: Tokens a chunk repeats from its successor: one less than the longest phrase.
OVERLAP = 2
#: The stop behind a piece; no word, as texts are cut there.
STOP = b"."


@dataclass(frozen=True)
class Mining:
    """Phrases of ``least`` occurrences or more; ``top`` rows a group; one
    word in ``period`` starts a chunk; a phrase goes when a longer one that
    holds it has at least ``cover`` percent of its occurrences."""

    least: int = 10
    top: int = 2000
    period: int = 16
    cover: int = 50
    #: Chunks, or grams, a task holds before it sends them.
    held: int = 400_000
    #: Buckets of a shuffle partition.
    buckets: int = 8


DEFAULT = Mining()


def chunks(text: bytes, period: int) -> Iterator[tuple[bytes, int]]:
    """(chunk, own words) of a text: own tokens, then ``OVERLAP`` more."""
    stream: list[bytes] = []
    for piece in PIECES.split(text.lower()):
        words = piece.split()
        if words:
            stream += words
            stream.append(STOP)
    starts = [i for i, w in enumerate(stream) if not crc32(w) % period and w != STOP]
    if stream and (not starts or starts[0]):
        starts.insert(0, 0)
    starts.append(len(stream))
    stream += [STOP] * OVERLAP
    for s, e in zip(starts, starts[1:]):
        yield b" ".join(stream[s:e + OVERLAP]), e - s - stream[s:e].count(STOP)


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def dictionary(docs: DataFrame, text_col: str, group_col: str, spec: Mining) -> DataFrame:
    """(grp, chunk, own, n): the distinct chunks with their frequencies."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for group, found in held.items():
                keys = list(found)
                yield pa.RecordBatch.from_pydict({
                    "grp": pa.array([group] * len(keys), pa.string()), "chunk": _strings([k[0] for k in keys]),
                    "own": pa.array([k[1] for k in keys], pa.int64()),
                    "n": pa.array(list(found.values()), pa.int64())})
            held.clear()

        for batch in trimmed(batches):
            for group, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(),
                                   strict=True):
                before = len(held[group])
                held[group].update(chunks(text, spec.period))
                size += len(held[group]) - before
                if size >= spec.held:
                    yield from sent()
                    size = 0
        yield from sent()

    texts = docs.select(F.coalesce(F.col(group_col).cast("string"), F.lit("und")).alias("grp"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parsed = texts.mapInArrow(parse, "grp string, chunk string, own long, n long")
    return written(parsed.groupBy("grp", "chunk", "own").agg(F.sum("n").alias("n"))
                   .sortWithinPartitions("grp"), "dictionary")


def word_counts(parsed: DataFrame, spec: Mining) -> DataFrame:
    """(grp, phrase, f): occurrences of single words, ``least`` at least."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)

        def sent() -> Iterator[pa.RecordBatch]:
            for group, found in held.items():
                found.pop(STOP, None)
                yield pa.RecordBatch.from_pydict({
                    "grp": pa.array([group] * len(found), pa.string()), "phrase": _strings(list(found)),
                    "f": pa.array(list(found.values()), pa.int64())})
            held.clear()

        for batch in trimmed(batches):
            single = defaultdict(list)
            for group, chunk, n in _rows(batch):
                words = chunk.split()[:-OVERLAP]
                if n == 1:
                    single[group] += words
                else:
                    found = held[group]
                    for w in words:
                        found[w] += n
            for group, words in single.items():
                held[group].update(words)
            if sum(map(len, held.values())) >= spec.held:
                yield from sent()
        yield from sent()

    return (parsed.select("grp", "chunk", "n").mapInArrow(count, "grp string, phrase string, f long")
            .groupBy("grp", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= spec.least))


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes, int]]:
    return zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(),
               batch.column(2).to_pylist(), strict=True)


def _grams(chunk: bytes) -> Iterator[bytes]:
    """Each own token with the two behind it, stops included."""
    tokens = chunk.split()
    return map(b" ".join, zip(tokens, tokens[1:], tokens[2:]))


def _packed(once: list[bytes], more: list[bytes]) -> bytes:
    """Grams of one occurrence, and those of more with their count."""
    return zstandard.ZstdCompressor(level=1).compress(b"\n".join(once) + b"\r" + b"\n".join(more))


def _unpacked(data: bytes, into: Counter) -> None:
    once, more = zstandard.ZstdDecompressor().decompress(data).split(b"\r")
    if once:
        into.update(once.split(b"\n"))
    for line in more.split(b"\n") if more else ():
        gram, n = line.split(b"\t")
        into[gram] += int(n)


def phrase_counts(parsed: DataFrame, hot: dict[str, frozenset], tasks: int, spec: Mining) -> DataFrame:
    """(grp, phrase, words, f) of two and three words with ``least``
    occurrences or more.  ``hot``: the hot words of each group."""
    per, buckets = spec.buckets, max(1, tasks * spec.buckets)
    none: frozenset = frozenset()
    keys = partition_keys(parsed.sparkSession, tasks)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)

        def sent() -> Iterator[pa.RecordBatch]:
            for group, found in held.items():
                often = hot.get(group, none)
                once: list[list[bytes]] = [[] for _ in range(buckets)]
                more: list[list[bytes]] = [[] for _ in range(buckets)]
                for gram, n in found.items():
                    first, second, third = gram.split(b" ")
                    if first == STOP or second == STOP:
                        continue
                    key = crc32(second, crc32(first))
                    if first in often and second in often:
                        key = crc32(third, key)
                    if n == 1:
                        once[key % buckets].append(gram)
                    else:
                        more[key % buckets].append(b"%s\t%d" % (gram, n))
                full = [t for t in range(0, buckets, per) if any(once[t:t + per]) or any(more[t:t + per])]
                yield pa.RecordBatch.from_pydict({
                    "task": pa.array([keys[t // per] for t in full], pa.int32()),
                    "grp": pa.array([group] * len(full), pa.string()),
                    "data": pa.array([[_packed(once[b], more[b]) for b in range(t, t + per)] for t in full],
                                     pa.list_(pa.binary()))})
            held.clear()

        for batch in trimmed(batches):
            single = defaultdict(list)
            for group, chunk, n in _rows(batch):
                if n == 1:
                    single[group] += _grams(chunk)
                else:
                    found = held[group]
                    for gram in _grams(chunk):
                        found[gram] += n
            for group, grams in single.items():
                held[group].update(grams)
            if sum(map(len, held.values())) >= spec.held:
                yield from sent()
        yield from sent()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found = None, Counter()

        def done() -> Iterator[pa.RecordBatch]:
            group, often = now[-1], hot.get(now[-1], none)
            pairs: dict[tuple[bytes, bytes], int] = defaultdict(int)
            out = []
            for gram, n in found.items():
                first, second, third = gram.split(b" ")
                pairs[first, second] += n
                if n >= spec.least and third != STOP:
                    out.append((gram, 3, n, False))
            for (first, second), n in pairs.items():
                part = first in often and second in often
                if part or n >= spec.least:
                    out.append((first + b" " + second, 2, n, part))
            if out:
                phrase, words, f, part = zip(*out)
                yield pa.RecordBatch.from_pydict({
                    "grp": pa.array([group] * len(out), pa.string()), "phrase": _strings(list(phrase)),
                    "words": pa.array(words, pa.int32()), "f": pa.array(f, pa.int64()),
                    "part": pa.array(part, pa.bool_())})

        for batch in trimmed(batches):
            for *bucket, group, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (*bucket, group) != now:
                    if now is not None:
                        yield from done()
                    now, found = (*bucket, group), Counter()
                _unpacked(data, found)
        if now is not None:
            yield from done()

    packed = parsed.select("grp", "chunk", "n").mapInArrow(deal, "task int, grp string, data array<binary>")
    dealt = (packed.repartition(tasks, "task").select("task", "grp", F.posexplode("data").alias("bucket", "data"))
             .select("task", "bucket", "grp", "data").sortWithinPartitions("task", "bucket", "grp"))
    counted = written(dealt.mapInArrow(count, "grp string, phrase string, words int, f long, part boolean"),
                      "phrases")
    whole = counted.filter("not part").drop("part")
    added = (counted.filter("part").groupBy("grp", "phrase", "words").agg(F.sum("f").alias("f"))
             .filter(F.col("f") >= spec.least))
    return whole.unionByName(added)


def collocations(docs: DataFrame, text_col: str = "text", group_col: str = "lang",
                 spec: Mining = DEFAULT) -> DataFrame:
    """(grp, rank, phrase, a, l, r, n, score): the best phrases of each group."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parsed = dictionary(docs, text_col, group_col, spec)
    totals = parsed.groupBy("grp").agg(F.sum(F.col("n") * F.col("own")).alias("n"))
    words = written(word_counts(parsed, spec), "words")
    total = totals.agg(F.sum("n")).first()[0] or 0
    # At most 4 x tasks rows: the counts of more would pass the total.
    often = defaultdict(set)
    for group, word in words.filter(F.col("f") * (4 * tasks) >= total).select("grp", "phrase").collect():
        often[group].add(word.encode())
    phrases = phrase_counts(parsed, {g: frozenset(w) for g, w in often.items()}, tasks, spec)
    return ranked(phrases, words, totals, spec)


def ranked(phrases: DataFrame, words: DataFrame, totals: DataFrame, spec: Mining) -> DataFrame:
    """The lowest cut of each phrase, without those that a longer one covers."""
    w = F.split("phrase", " ")

    def part(*at: int):
        return F.concat_ws(" ", *(w[i] for i in at))

    def cut(k: int, side: str, of, n: int):
        return F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), of.alias("part"),
                        F.pmod(F.xxhash64("phrase"), F.lit(16 if n == 1 else 4)).cast("int").alias("salt"))

    two = F.array(cut(1, "l", part(0), 1), cut(1, "r", part(1), 1))
    three = F.array(cut(1, "l", part(0), 1), cut(1, "r", part(1, 2), 2),
                    cut(2, "l", part(0, 1), 2), cut(2, "r", part(2), 1))
    wanted = (phrases.select("grp", "phrase", F.col("f").alias("a"),
                             F.explode(F.when(F.col("words") == 2, two).otherwise(three)).alias("c"))
              .select("grp", "phrase", "a", "c.*"))

    def salted(counts: DataFrame, n: int) -> DataFrame:
        return counts.select("grp", F.col("phrase").alias("part"), "f",
                             F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("salt"))

    parts = salted(words, 16).unionByName(salted(phrases.filter("words = 2"), 4))
    found = wanted.join(parts, ["grp", "part", "salt"])
    none = F.lit(None).cast("long")

    def side(k: int, s: str):
        return F.when((F.col("k") == k) & (F.col("side") == s), F.col("f")).alias(f"{s}{k}")

    cuts = found.select("grp", "phrase", "a", *(side(k, s) for k in (1, 2) for s in "lr"), none.alias("cover"))
    covers = (phrases.filter("words = 3")
              .select("grp", F.explode(F.array(part(0, 1), part(1, 2))).alias("phrase"), none.alias("a"),
                      *(none.alias(f"{s}{k}") for k in (1, 2) for s in "lr"), F.col("f").alias("cover")))
    each = (cuts.unionByName(covers).groupBy("grp", "phrase")
            .agg(*(F.max(c).alias(c) for c in ("a", "l1", "r1", "l2", "r2", "cover")))
            .filter("a is not null")
            .filter(F.col("cover").isNull() | (100 * F.col("cover") < spec.cover * F.col("a"))))

    def scored(k: int):
        exact = "decimal(15,0)"
        score = F.expr(f"(cast(a as {exact}) * cast(a as {exact}) * cast(1000000 as decimal(7,0))) "
                       f"div (cast(l{k} as {exact}) * cast(r{k} as {exact}))")
        return F.when(F.col(f"l{k}").isNotNull(), F.struct(
            score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))

    best = each.select("grp", "phrase", "a", F.least(scored(1), scored(2)).alias("cut"))
    order = Window.partitionBy("grp").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    top = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= spec.top)
    return (top.join(F.broadcast(totals) if _few(totals) else totals, "grp")
            .select("grp", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n",
                    "cut.score"))


def _few(totals: DataFrame, most: int = 10_000) -> bool:
    """Groups are few enough to be broadcast (their number is counted)."""
    return totals.limit(most + 1).count() <= most


__all__ = ["DEFAULT", "Mining", "chunks", "collocations"]
