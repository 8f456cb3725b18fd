"""N-gram Jaccard join: size-banded tiles, hashed bitmaps, exact intersection.

Texts in lower case (A-Z) are sets of hashes of 5-word shingles (fewer words:
one shingle).  Texts with equal sets are one class.  Two classes link when
``100 * |x & y| >= 75 * |x | y|``.  Components of all links are formed and each
document gets the smallest id of its own; for that, links inside a component
that is known already aren't looked for.  ``class_links`` and ``jaccard_links``
find every link: they take the tiles of step 2 and compare all pairs in them.

1. *Shared shingles.*  With overlap of at least 3/4 of the larger set, the
   ``n/4 + l`` smallest hashes of both sets share l or more (prefix filter;
   l = n/10).  Those are dealt by hash, packed as arrays; what comes back is
   each class's shingles that another class has too, with the number of
   classes.  Classes with fewer than l can't link and are done: a passage that
   many documents share doesn't make them candidates.
2. *Tiles.*  Of what is left, sorted from rare to frequent, a class needs only
   the first ``s - l + 1`` of its s shared shingles.  A tile is one of those
   shingles and a band of sizes (ratio 4/3): its own band and visitors from
   the band below hold all pairs whose sizes allow a link.
3. *First links.*  In a few rounds each class looks at its neighbours in a
   few of its tiles and is compared exactly with the one whose bitmap promises
   most, if that lies in another component.  Near copies, however many, grow
   together by a few comparisons a member, not by all pairs.
4. *The rest.*  Tiles whose members still lie in several components compare
   all of them across components, by bitmaps: bits set in one signature and
   not in the other bound the overlap from above.  Large tiles are cut into
   salted blocks.  Pairs that pass are intersected exactly as sorted arrays,
   so no link between components is missed whatever the rounds before found.

Hot groups: a shingle that is very frequent in a batch is sent marked as hot,
to any task, and need not meet; one that only proves frequent where it meets
is passed on from there as it comes in, so no task holds all its classes.
Component minima are aggregated before
their shuffle and joined back in joins that Spark splits when skewed.
The texts read again for exact sets are selected by broadcast up to a bound on
their number (8 bytes each), by a shuffle beyond it.

Defined results: null text and text without words have 0 shingles and link
with nothing; equal rows are one class; a null id never names a component
unless all its ids are null; empty tables give empty results; other columns
are ignored or (``first_of_each``) kept.  Shingles are hashes of 64 bits.
Classes are told apart by 128 bits: their ids have 64, and sets whose ids
clash (some 70 pairs among 5 * 10^10 texts) take ids from the other 64.
"""
from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starmart.llm import textnp as T
from starmart.llm.common import map_batches, trimmed, written
from starmart.llm.components import components
from starmart.operators.bloom import bit_filter

WORDS = 5
NUM, DEN = 75, 100  # similarity
BAND = math.log(DEN / NUM)
BITS = 1024
#: A shingle in more texts of one pack (of about so many bytes of text) than
#: this is sent as hot.
BATCH_HOT = 64
PACK_BYTES = 4 << 20
HOT = 2**31 - 1
#: A shingle of more classes than this, seen among so many entries that a task
#: holds, is hot as well.
MET_HOT, HELD = 4096, 4 << 20
#: Target bytes of packed shingles in a task, members of a block of a tile.
TASK_BYTES = 16 << 20
BLOCK = 1024
#: Tiles before a row's own that tell where a pair has met already.
BEFORE = 4
#: Rounds of first links; in each, the first tiles of a class and one of so
#: many others, and the neighbours looked at on either side.
ROUNDS, SKETCH, PART, REACH = 2, 4, 8, 16
#: Members of a salted block of a tile in these rounds.
NEAR = 128
#: At most so many 8-byte text hashes are broadcast.
BROADCAST_KEYS = 2_000_000


# --- sets ---------------------------------------------------------------------

def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = T.utf8(column)
    for i, j in T.blocks(offsets):
        part, off = T.LOWER[data[offsets[i]:offsets[j]]], offsets[i:j + 1] - offsets[i]
        starts, ends = T.runs(T.NOT_SPACE[part], off)
        words = np.searchsorted(starts, off)
        hashes = T.byte_spans(part, starts, ends)
        at, grams = T.windows(hashes, words, WORDS)
        cut = np.searchsorted(at, words)
        for r in range(j - i):
            n = words[r + 1] - words[r]
            if n >= WORDS:
                yield np.unique(grams[cut[r]:cut[r + 1]])
            elif n:
                few = T.span_hashes(hashes, words[r:r + 1], words[r + 1:r + 2])
                yield T.mix64(few + np.uint64(n))
            else:
                yield np.zeros(0, dtype=np.uint64)


class ClassIds:
    """Ids of sets: the first ``bits`` of a hash of 128, or its other half for
    those whose first half is known to clash.  Fewer bits than 64 only make
    clashes frequent (for tests)."""

    def __init__(self, clash: frozenset[int] = frozenset(), bits: int = 64):
        self.clash, self.bits = clash, bits

    def __call__(self, shingles: np.ndarray) -> int:
        return self.pair(shingles)[0]

    def pair(self, shingles: np.ndarray) -> tuple[int, int]:
        """The id of a set, and what tells it from others with that id."""
        digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
        one = int.from_bytes(digest[:8], "big", signed=True) >> (64 - self.bits)
        other = int.from_bytes(digest[8:], "big", signed=True)
        return (other, one) if one in self.clash else (one, other)


def least_overlap(n: int) -> int:
    """Overlap that a set of n needs with any set it links to."""
    return -(-NUM * n // DEN)


def level(n: int) -> int:
    """The l of the prefix filter (grows with n)."""
    return max(1, n // 10)


def prefix_length(n: int) -> int:
    return n - least_overlap(n) + level(n)


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = np.sort(np.concatenate([x, y]), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return DEN * common >= NUM * (len(x) + len(y) - common)


def signature(shingles: np.ndarray) -> bytes:
    bits = np.zeros(BITS, dtype=bool)
    bits[(shingles >> np.uint64(20)) % np.uint64(BITS)] = True
    return np.packbits(bits).tobytes()


# --- 1: shared shingles -------------------------------------------------------

def text_rows(docs: DataFrame, id_col: str, text_col: str, class_id: ClassIds) -> DataFrame:
    """(id, kh, cid, n, tell) of every row: hash of the text, class, set size,
    what tells classes with one id apart."""
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batch: pa.RecordBatch) -> dict:
        sizes, ids = [], []
        for s in shingle_sets(batch.column(1)):
            sizes.append(len(s))
            ids.append(class_id.pair(s) if len(s) else (None, None))
        return {"id": batch.column(0), "kh": batch.column(2),
                "cid": pa.array([i for i, _ in ids], pa.int64()), "n": pa.array(sizes, pa.int64()),
                "tell": pa.array([i for _, i in ids], pa.int64())}

    return map_batches(docs.select(id_col, text_col, F.xxhash64(text_col).alias("kh")), rows,
                       f"id {kind}, kh long, cid long, n long, tell long")


def packed_prefixes(docs: DataFrame, text_col: str, buckets: int, class_id: ClassIds) -> DataFrame:
    """(bucket, hot, shingles, cids, marks): the prefixes of some texts'
    classes as arrays, dealt by shingle.  Hot rows hold shingles known to be
    frequent; ``marks`` tells their bucket."""
    names = ["bucket", "hot", "shingles", "cids", "marks"]
    kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]

    def pack(column: pa.Array) -> pa.RecordBatch:
        seen: dict[int, np.ndarray] = {}
        for s in shingle_sets(column):
            if len(s):
                seen.setdefault(class_id(s), s[:prefix_length(len(s))])
        rows: list[tuple] = []
        if seen:
            t = np.concatenate(list(seen.values()))
            c = np.repeat(np.fromiter(seen, dtype=np.int64, count=len(seen)), [len(x) for x in seen.values()])
            order = np.argsort(t)
            t, c = t[order], c[order]
            first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
            count = np.diff(np.r_[first, len(t)])
            hot = np.repeat(count > BATCH_HOT, count)
            marks = t[first][count > BATCH_HOT]
            place = (T.mix64(t) % np.uint64(buckets)).astype(np.int64)
            mark_place = (T.mix64(marks) % np.uint64(buckets)).astype(np.int64)
            cold = np.flatnonzero(~hot)
            cold = cold[np.argsort(place[cold], kind="stable")]
            edges = np.searchsorted(place[cold], np.arange(buckets + 1))
            for b in np.union1d(np.flatnonzero(np.diff(edges)), mark_place):
                own = cold[edges[b]:edges[b + 1]]
                rows.append((int(b), False, t[own].tobytes(), c[own].tobytes(), marks[mark_place == b].tobytes()))
            if hot.any():  # to any bucket: nothing has to meet
                rows.append((int(c[hot][0]) % buckets, True, t[hot].tobytes(), c[hot].tobytes(), b""))
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            for i, j in T.blocks(T.utf8(batch.column(0))[1], PACK_BYTES):
                yield pack(batch.column(0).slice(i, j - i))

    return docs.select(text_col).mapInArrow(
        run, "bucket int, hot boolean, shingles binary, cids binary, marks binary")


def shared_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, shingle, df) of shingles that two or more classes have; the df of
    hot ones is ``HOT`` everywhere, so all classes sort them alike.

    Entries are held until their shingle proves hot; then those and all later
    ones are passed on, so that what is held doesn't grow with one shingle.
    """

    def rows(c, t, df) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(c), 1 << 16):
            part = slice(i, i + (1 << 16))
            yield pa.RecordBatch.from_pydict({
                "cid": pa.array(c[part], pa.int64()), "shingle": pa.array(t[part].view(np.int64), pa.int64()),
                "df": pa.array(df[part], pa.int32())})

    def gathered() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct held entries in order, with the shingle's count."""
        t, c = np.concatenate(ts), np.concatenate(cs)
        ts.clear()
        cs.clear()
        order = np.lexsort((c, t))
        t, c = t[order], c[order]
        del order
        once = np.ones(len(t), dtype=bool)
        once[1:] = (t[1:] != t[:-1]) | (c[1:] != c[:-1])
        t, c = t[once], c[once]
        first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])[:len(t)]
        count = np.diff(np.r_[first, len(t)])
        return t, c, np.repeat(count, count)

    ts, cs, marks = [], [], np.zeros(0, dtype=np.uint64)
    held, most = 0, HELD
    for batch in trimmed(batches):
        for _, hot, t, c, m in zip(*(col.to_pylist() for col in batch.columns), strict=True):
            t, c = np.frombuffer(t, dtype=np.uint64), np.frombuffer(c, dtype=np.int64)
            if hot:
                yield from rows(c, t, np.full(len(c), HOT, dtype=np.int32))
                continue
            if m:
                marks = np.union1d(marks, np.frombuffer(m, dtype=np.uint64))
            ts.append(t)
            cs.append(c)
            held += len(t)
        if held > most:
            t, c, count = gathered()
            marks = np.union1d(marks, t[count > MET_HOT])
            go = np.isin(t, marks)
            yield from rows(c[go], t[go], np.full(int(go.sum()), HOT, dtype=np.int32))
            ts, cs, held = [t[~go]], [c[~go]], int((~go).sum())
            most = max(HELD, 2 * held)
    if not held:
        return
    t, c, count = gathered()
    df = np.where(np.isin(t, marks), HOT, count).astype(np.int32)
    yield from rows(c[df > 1], t[df > 1], df[df > 1])


# --- 2: tiles -----------------------------------------------------------------

def tiles(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """(shingle, band, cid, n, place): the shingles that a class may meet
    others by, numbered by hash."""
    need = F.ceil(F.col("n") * NUM / DEN).cast("long")
    need = F.greatest(F.lit(1), F.floor(need / 10)).cast("long")  # level of the smallest partner
    by = Window.partitionBy("cid")
    # Packs that share a class may both send its hot shingles: distinct, on
    # the same exchange by class that the join and the windows use.
    return (shared.repartition("cid").distinct().join(classes.select("cid", "n"), "cid")
            .withColumn("s", F.count("*").over(by))
            .withColumn("r", F.row_number().over(by.orderBy("df", "shingle")))
            .filter(F.col("r") <= F.col("s") - need + 1)
            .withColumn("place", F.row_number().over(by.orderBy("shingle")))
            .select("shingle", F.floor(F.log("n") / BAND).cast("int").alias("band"), "cid", "n", "place"))


# --- 3: exact comparison ------------------------------------------------------

def exact_sets(docs: DataFrame, text_col: str, chosen: DataFrame, few: bool, class_id: ClassIds) -> DataFrame:
    """(cid, n, shingles, bits) of the classes chosen by one text hash each,
    one row a class."""
    keys = chosen.select("kh")
    texts = docs.select(text_col, F.xxhash64(text_col).alias("kh")).join(
        F.broadcast(keys) if few else keys, "kh", "left_semi").select(text_col)

    def sets(batch: pa.RecordBatch) -> dict:
        got = list(shingle_sets(batch.column(0)))
        got = {class_id(s): s for s in got if len(s)}
        return {"cid": pa.array(list(got), pa.int64()),
                "n": pa.array([len(s) for s in got.values()], pa.int64()),
                "shingles": pa.array([s.tobytes() for s in got.values()], pa.binary()),
                "bits": pa.array([signature(s) for s in got.values()], pa.binary())}

    return map_batches(texts, sets, "cid long, n long, shingles binary, bits binary").dropDuplicates(["cid"])


def exact_links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) of a written table whose sets link, by intersection
    of sorted arrays."""
    needed = pairs.select(F.explode(F.array("u", "v")).alias("cid")).distinct()
    few = 2 * pairs.count() <= BROADCAST_KEYS
    one = sets.select("cid", "shingles").join(F.broadcast(needed) if few else needed, "cid", "left_semi")
    x = one.select(F.col("cid").alias("u"), F.col("shingles").alias("x"))
    y = one.select(F.col("cid").alias("v"), F.col("shingles").alias("y"))

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        xs, ys = batch.column(2), batch.column(3)
        good = [linked(np.frombuffer(a.as_buffer(), dtype=np.uint64), np.frombuffer(b.as_buffer(), dtype=np.uint64))
                for a, b in zip(xs, ys, strict=True)]
        return batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    met = pairs.join(x, "u").join(y, "v").select("u", "v", "x", "y")
    return map_batches(met, compare, "u long, v long")


def overlap_bound(bits: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Largest possible overlap of the sets of rows i and j."""
    only_i = np.bitwise_count(bits[i] & ~bits[j]).sum(axis=1, dtype=np.int64)
    only_j = np.bitwise_count(bits[j] & ~bits[i]).sum(axis=1, dtype=np.int64)
    return np.minimum(n[i] - only_i, n[j] - only_j)


def best_partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, score, partner): of rows sorted by tile (shingle, band, cid, n,
    label, bits), each row's most promising neighbour of another component."""
    for batch in trimmed(batches):
        col = {k: batch.column(k).to_numpy() for k in ("shingle", "band", "salt", "cid", "n", "label")}
        bits = np.stack([np.frombuffer(b, dtype=np.uint64) for b in batch.column("bits").to_pylist()]
                        or [np.zeros(BITS // 64, np.uint64)])
        n, rows = col["n"], batch.num_rows
        score, partner = np.zeros(rows), np.zeros(rows, dtype=np.int64)
        for d in range(1, min(REACH, rows - 1) + 1):
            i = np.flatnonzero((col["shingle"][d:] == col["shingle"][:-d]) & (col["band"][d:] == col["band"][:-d])
                               & (col["salt"][d:] == col["salt"][:-d]) & (col["label"][d:] != col["label"][:-d]))
            j = i + d
            most = overlap_bound(bits, n, i, j)
            go = DEN * most >= NUM * (n[i] + n[j] - most)
            i, j, share = i[go], j[go], most[go] / (n[i] + n[j] - most)[go]
            for a, b in ((i, j), (j, i)):
                more = share > score[a]
                score[a[more]], partner[a[more]] = share[more], col["cid"][b[more]]
        hit = score > 0
        yield pa.RecordBatch.from_pydict({"cid": pa.array(col["cid"][hit]), "score": pa.array(score[hit]),
                                          "partner": pa.array(partner[hit])})


def with_labels(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("label", F.col("cid"))
    return rows.join(labels.withColumnRenamed("u", "cid"), "cid", "left").withColumn(
        "label", F.coalesce("m", "cid")).drop("m")


def first_links(tile: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links that join most classes of each component, and the components
    they make."""
    links, labels = None, None
    # Large tiles are dealt in salted blocks: neighbours, not all pairs, count.
    large = written(tile.groupBy("shingle", "band").agg(F.ceil(F.count("*") / NEAR).cast("int").alias("blocks"))
                    .filter("blocks > 1"), "large")
    for k in range(ROUNDS):
        # The same tiles for all their members, others in each round, and a
        # few of every class; neighbours by an order of the round's own.
        draw = F.pmod(F.xxhash64("shingle", F.lit(k)), F.lit(PART)) == 0
        order = F.xxhash64("cid", F.lit(k))
        some = (tile.filter((F.col("place") <= SKETCH) | draw).drop("place")
                .join(large, ["shingle", "band"], "left")
                .withColumn("salt", F.pmod(order, F.coalesce("blocks", F.lit(1))).cast("int")))
        dealt = (with_labels(some, labels).join(sets.select("cid", "bits"), "cid")
                 .select("shingle", "band", "salt", "cid", "n", "label", "bits")
                 .repartition("shingle", "band", "salt").sortWithinPartitions("shingle", "band", "salt", order))
        best = dealt.mapInArrow(best_partners, "cid long, score double, partner long").groupBy("cid").agg(
            F.max(F.struct("score", "partner"))["partner"].alias("p"))
        pairs = written(best.select(F.least("cid", "p").alias("u"), F.greatest("cid", "p").alias("v")).distinct(),
                        "pairs")
        new = written(exact_links(pairs, sets), "links")
        if links is not None and new.isEmpty():
            break
        links = new if links is None else links.unionByName(new)
        labels = components(links)
    return links, labels


# --- 4: tiles that still lie in several components ----------------------------

def tile_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of sorted tile rows (tile, s, t, salt, visitor, cid, n,
    label, before, bits): of different components, sizes and bitmaps allowing
    a link.

    Row i is compared with row i + d for all d while tiles reach that far, so
    any number of small tiles costs a few array operations.  A pair that
    shares one of its classes' tiles just before this one has met there, and
    isn't repeated here (in the first tile of two classes it never has).
    """
    kept: pa.Table | None = None

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if rows.num_rows < 2:
            return
        col = {k: rows.column(k).to_numpy() for k in
               ("shingle", "band", "s", "t", "salt", "visitor", "cid", "n", "label",
                *(f"p{k}" for k in range(1, BEFORE + 1)))}
        bits = np.stack([np.frombuffer(b, dtype=np.uint64) for b in rows.column("bits").to_pylist()])
        new = np.zeros(rows.num_rows, dtype=bool)
        for k in ("shingle", "band", "s", "t"):
            new[1:] |= col[k][1:] != col[k][:-1]
        tile, n = np.cumsum(new), col["n"]
        u, v = [], []
        for d in range(1, rows.num_rows):
            same = tile[d:] == tile[:-d]
            if not same.any():
                break
            i = np.flatnonzero(same & (col["label"][d:] != col["label"][:-d])
                               & ~(col["visitor"][d:] & col["visitor"][:-d]))
            j = i + d
            cross = (col["s"][i] == col["t"][i]) | (col["salt"][i] != col["salt"][j])
            small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            go = cross & (DEN * small >= NUM * large)
            i, j = i[go], j[go]
            most = overlap_bound(bits, n, i, j)
            go = DEN * most >= NUM * (n[i] + n[j] - most)
            i, j = i[go], j[go]
            met = np.zeros(len(i), dtype=bool)
            for k in range(1, BEFORE + 1):
                for m in range(1, BEFORE + 1):
                    met |= (col[f"p{k}"][i] == col[f"p{m}"][j]) & (col[f"p{k}"][i] != 0)
            a, b = col["cid"][i[~met]], col["cid"][j[~met]]
            u.append(np.minimum(a, b))
            v.append(np.maximum(a, b))
        if u:
            found = np.unique(np.stack([np.concatenate(u), np.concatenate(v)], axis=1), axis=0)
            for k in range(0, len(found), 1 << 16):
                part = found[k:k + (1 << 16)]
                yield pa.RecordBatch.from_pydict({"u": pa.array(part[:, 0]), "v": pa.array(part[:, 1])})

    for batch in trimmed(batches):
        table = pa.Table.from_batches([batch])
        kept = pa.concat_tables([kept, table]) if kept is not None else table
        last = np.ones(kept.num_rows, dtype=bool)
        for k in ("shingle", "band", "s", "t"):
            x = kept.column(k).to_numpy()
            last &= x == x[-1] if len(x) else last
        cut = int(np.argmax(last)) if kept.num_rows else 0  # the last tile may go on
        yield from pairs(kept.slice(0, cut))
        kept = kept.slice(cut).combine_chunks()
    if kept is not None:
        yield from pairs(kept)


def open_pairs(tile: DataFrame, labels: DataFrame | None, sets: DataFrame) -> DataFrame:
    """Candidate pairs across components, distinct; without labels, of all
    classes."""
    marked = with_labels(tile.drop("place"), labels)
    both = marked.withColumn("visitor", F.lit(False)).unionByName(
        marked.withColumn("band", F.col("band") + 1).withColumn("visitor", F.lit(True)))
    still = (both.groupBy("shingle", "band").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("k"),
        F.bool_or(~F.col("visitor")).alias("own"))
        .filter("lo < hi and own").select("shingle", "band", F.ceil(F.col("k") / BLOCK).cast("int").alias("blocks")))
    salt = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    tiles_of = Window.partitionBy("cid", "band").orderBy("shingle")
    before = {f"p{k}": F.lag("shingle", k, 0).over(tiles_of) for k in range(1, BEFORE + 1)}
    rows = (both.join(still, ["shingle", "band"]).withColumn("salt", salt)
            .repartition("cid").withColumns(before)
            .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("s", F.least("salt", "o")).withColumn("t", F.greatest("salt", "o")))
    bits = sets.select("cid", "bits")
    key = ["shingle", "band", "s", "t"]
    dealt = (rows.join(bits, "cid").select(*key, "salt", "visitor", "cid", "n", "label", *before, "bits")
             .repartition(*key).sortWithinPartitions(*key))
    return dealt.mapInArrow(tile_pairs, "u long, v long").distinct()


# --- the join -----------------------------------------------------------------

def classed(docs: DataFrame, id_col: str, text_col: str, bits: int = 64) -> tuple[DataFrame, DataFrame, ClassIds]:
    """(rows, classes, class_id): every row's (id, kh, cid, n), its classes
    with their first member by id, then text hash.  Ids that clash are few
    (n^2 / 2^65 of n classes) and come to the driver."""
    order = F.struct(F.col("id").isNull().alias("last"), "id", "kh")
    class_id = ClassIds(bits=bits)
    while True:
        rows = written(text_rows(docs, id_col, text_col, class_id), "rows")
        classes = written(rows.filter("cid is not null").groupBy("cid").agg(
            F.first("n").alias("n"), F.min("kh").alias("kh"), F.min(order).alias("first"),
            F.count("*").alias("copies"), (F.min("tell") != F.max("tell")).alias("clash")), "classes")
        clash = {r["cid"] for r in classes.filter("clash").select("cid").collect()}
        if not clash:
            return rows.drop("tell"), classes.drop("clash"), class_id
        class_id = ClassIds(class_id.clash | clash, bits)


def tiled(docs: DataFrame, id_col: str, text_col: str,
          bits: int = 64) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rows, classes, tile, sets): :func:`classed`, and what can link."""
    spark = docs.sparkSession
    rows, classes, class_id = classed(docs, id_col, text_col, bits)
    total = classes.agg(F.sum("n")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total * 0.35 * 16 / TASK_BYTES))
    shared = packed_prefixes(docs, text_col, 4 * tasks, class_id).repartition(tasks, "bucket").mapInArrow(
        shared_shingles, "cid long, shingle long, df int")
    tile = written(tiles(shared, classes), "tiles")
    chosen = written(tile.select("cid").distinct().join(classes, "cid").select("cid", "kh"), "chosen")
    sets = written(exact_sets(docs, text_col, chosen, chosen.count() <= BROADCAST_KEYS, class_id), "sets")
    return rows, classes, tile, sets


def joined(docs: DataFrame, id_col: str, text_col: str, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(rows, of_class): every row's (id, kh, cid, n); and for each class the
    first member of its component."""
    rows, classes, tile, sets = tiled(docs, id_col, text_col, bits)
    first, joined_now = first_links(tile, sets)
    rest = written(exact_links(written(open_pairs(tile, joined_now, sets), "pairs"), sets), "links")
    label = joined_now if rest.isEmpty() else components(first.unionByName(rest))
    named = classes.select("cid", "first").join(label.withColumnRenamed("u", "cid"), "cid", "left").withColumn(
        "m", F.coalesce("m", "cid"))
    least = named.groupBy("m").agg(F.min("first").alias("least"))
    return rows, written(named.select("cid", "m").join(least, "m").select("cid", "least"), "of_class")


def class_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, links): links (u, v), u < v, of all classes that link;
    their number grows with the square of a group of near copies."""
    rows, classes, tile, sets = tiled(docs, id_col, text_col)
    return rows, classes, written(exact_links(written(open_pairs(tile, None, sets), "pairs"), sets), "links")


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, n_links) of every row: the other rows it links to,
    rows of its own class included; null ids and repeated rows count."""
    rows, classes, links = class_links(docs, id_col, text_col)
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    met = both.join(classes.select(F.col("cid").alias("v"), "copies"), "v").groupBy("u").agg(
        F.sum("copies").alias("others"))
    of_class = classes.select("cid", "copies").join(met.withColumnRenamed("u", "cid"), "cid", "left").select(
        "cid", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return rows.join(of_class, "cid", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       bits: int = 64) -> DataFrame:
    """(id, n_shingles, component_id) of every row; ``bits`` of a class id."""
    rows, of_class = joined(docs, id_col, text_col, bits)
    return rows.join(of_class, "cid", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("cid").isNull(), F.col("id")).otherwise(F.col("least.id")).alias("component_id"))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, all columns unchanged: the
    smallest id, then text hash; one of rows that repeat both.  Rows without
    words stay.  Only rows that may go (by a bit filter of bounded size) are
    moved; the others stay in their partitions."""
    rows, of_class = joined(docs, id_col, text_col)
    own = F.struct(F.col("id").isNull().alias("last"), "id", "kh")
    gone = written(rows.join(of_class, "cid").filter(own != F.col("least")).select(
        F.col("id").alias("__llm_id"), F.col("kh").alias("__llm_kh")).distinct(), "gone")
    twice = written(rows.filter("cid is not null").groupBy(F.col("id").alias("__llm_id"), F.col("kh").alias("__llm_kh"))
                    .count().filter("count > 1").drop("count"), "twice")
    same = F.col(id_col).eqNullSafe(F.col("__llm_id")) & (F.xxhash64(text_col) == F.col("__llm_kh"))
    marks = gone.unionByName(twice).select(F.xxhash64("__llm_id", "__llm_kh").alias("__llm_at"))
    parted = bit_filter(marks, "__llm_at").passed(docs, F.xxhash64(id_col, F.xxhash64(text_col)), "__llm_may")
    sure = parted.filter("not __llm_may").drop("__llm_may")
    kept = parted.filter("__llm_may").drop("__llm_may").join(gone, same, "left_anti")
    if twice.isEmpty():
        return sure.unionByName(kept)
    again = kept.join(twice, same, "left_semi").dropDuplicates([id_col, text_col])
    return sure.unionByName(kept.join(twice, same, "left_anti")).unionByName(again)
