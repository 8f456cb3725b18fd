"""Benchmark decontamination by winnowing, in DataFrame operations only.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in
lower case.  A window is 13 consecutive words of a benchmark item (a shorter
item is one window).  The fingerprint of a window is the least hash of its
6-word grams, so a document keeps the minimum gram hash of each sliding window
and equal windows always share their fingerprint: no shared span of 13 words
is missed.  Fingerprints met in the benchmark are hits; each is extended to
the windows that chose it, and those are compared word for word.  Windows of
short items are found the same way, for each length that occurs.

Plan: the first pass writes a row a document with its distinct fingerprints
(about 0.2 a word).  They meet the benchmark's in a semi join: by broadcast if
Spark sees from the written table's size that it fits, else by hash, the
fingerprints of one text already distinct.  Only texts with hits are read
again (selected by broadcast up to a bound on their number), once for all
copies; rows after that are candidate windows.  Texts are
keyed by 128 bits of their content, so a group of copies is one key.

Defined results: null text has no words and is never contaminated; items
without words are none; a null item id counts as the empty string; repeated
items are one; repeated documents get equal rows, one for each input row;
empty tables give empty or clean results; other columns are ignored
(``contamination``) or kept (``decontaminated``).  Whole texts are used.
"""
from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import content_key, written

WINDOW, GRAM = 13, 6
SHARE = 20  # contaminated: SHARE * hit words >= words
#: At most so many 16-byte keys of texts with hits are broadcast.
BROADCAST_KEYS = 1_000_000


def words_of(text: F.Column) -> F.Column:
    """The words in order (null text: none): what lies between runs of other
    characters, without the empty ends."""
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, ascii_uppercase, ascii_lowercase))
    parts = F.split(F.coalesce(lowered, F.lit("")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.transform(F.array(parts), _without_ends)[0]


def _without_ends(parts: F.Column) -> F.Column:
    first = (parts[0] == "").cast("int")
    last = ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")
    return F.slice(parts, first + 1, F.size(parts) - first - last)


def with_words(df: DataFrame) -> DataFrame:
    """Adds _words and _g1, the hash of each word, for column ``_text``."""
    return (df.withColumn("_words", words_of(F.col("_text")))
            .withColumn("_n", F.size("_words"))
            .withColumn("_g1", F.transform("_words", lambda w: F.xxhash64(w))))


def _combined(one: str, shift: int, other: str, with_: Callable, n: F.Column) -> F.Column:
    """The first n of ``with_(one[i], other[i + shift])``."""
    moved = F.slice(other, shift + 1, F.greatest(F.size(other) - shift, F.lit(0)))
    return F.slice(F.zip_with(one, moved, with_), 1, F.greatest(n, F.lit(0)))


def _tagger(tag: F.Column) -> Callable:
    """Fingerprints of short windows differ by the window's length."""
    return lambda x: F.xxhash64(x, tag)


#: k-gram hash from two shorter ones: k -> (first, its length, second).
_GRAM_OF = {2: (1, 1), 3: (2, 1), 4: (2, 2), 5: (4, 1), 6: (4, 2)}


def with_prints(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds _p{L} for each window length L: the fingerprint of every window of
    L words, in order.  Gram hashes and sliding minima are built by doubling,
    a few array operations whatever the length."""

    def add(name: str, value: F.Column) -> None:
        nonlocal df
        if name not in df.columns:
            df = df.withColumn(name, value)

    def gram(k: int) -> str:
        if k > 1:
            a, b = _GRAM_OF[k]
            one, other = gram(a), gram(b)
            add(f"_g{k}", _combined(one, a, other, lambda x, y: F.xxhash64(x, y), F.size("_g1") - (k - 1)))
        return f"_g{k}"

    for length in lengths:
        k = min(length, GRAM)
        span, least, wide = length - k + 1, gram(k), 1
        while wide < span:
            step = min(wide, span - wide)
            name = f"_m{k}_{wide + step}"
            add(name, _combined(least, step, least, lambda x, y: F.least(x, y),
                                F.size(f"_g{k}") - (wide + step - 1)))
            least, wide = name, wide + step
        tag = F.lit(length)
        add(f"_p{length}", F.col(least) if length == WINDOW else F.transform(least, _tagger(tag)))
    return df


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window, length, print, items): the distinct windows of all items with
    the sorted distinct ids of those that hold them."""
    item = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = with_words(items.select(item.alias("item"), F.col(text_col).alias("_text"))).filter("_n > 0")
    cut = rows.select("item", F.least("_n", F.lit(WINDOW)).alias("length"), F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("_n") - (WINDOW - 1), F.lit(1))),
        lambda i: F.slice("_words", i, WINDOW))).alias("_words"))
    grouped = (cut.groupBy(F.array_join("_words", " ").alias("window"), "length")
               .agg(F.sort_array(F.collect_set("item")).alias("items")))
    again = grouped.withColumn("_g1", F.transform(F.split("window", " "), lambda w: F.xxhash64(w)))
    again = with_prints(again, list(range(1, WINDOW + 1)))
    pick = F.coalesce(*(F.when(F.col("length") == n, F.get(f"_p{n}", F.lit(0))) for n in range(1, WINDOW + 1)))
    return again.select("window", "length", pick.alias("print"), "items")


def bin_of(value: F.Column, bins: F.Column) -> F.Column:
    """The bin of a print, from 0."""
    return F.pmod(value, bins).cast("int")


def in_bins(prints: F.Column) -> F.Column:
    """Prints dealt into as many bins as the root of their number, so that a
    place of a long text with many hits is looked up among few of them."""
    bins = F.ceil(F.sqrt(F.size(prints))).cast("int")
    return F.transform(F.sequence(F.lit(0), bins - 1), lambda b: F.filter(prints, lambda p: bin_of(p, bins) == b))


def matches(docs: DataFrame, items: DataFrame, id_cols: list[str], text_col: str = "text",
            item_col: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, found): each document's id columns, ``_key`` and ``_n``
    words; and for keys with occurring windows n_hit and the items."""
    bench = written(benchmark_windows(items, item_col, item_text), "windows")
    lengths = sorted({WINDOW, *(r[0] for r in bench.select("length").distinct().collect())})
    base = docs.select(*id_cols, content_key(F.col(text_col)).alias("_key"),
                       F.col(text_col).alias("_text"))
    prints = written(
        with_prints(with_words(base), lengths).select(
            *id_cols, "_key", "_n",
            F.array_distinct(F.concat(*(F.col(f"_p{n}") for n in lengths))).alias("_prints")),
        "prints")
    known = written(bench.select("print").distinct(), "known")
    hits = written(
        prints.select("_key", F.explode("_prints").alias("print")).join(known, "print", "left_semi")
        .groupBy("_key").agg(F.collect_set("print").alias("_hits"))
        .withColumn("_hits", in_bins(F.col("_hits"))), "hits")

    # Only texts with hits, once for all copies, cut into words again.  Copies
    # collapse before the shuffle; few keys select the texts by broadcast.
    texts = docs.select(content_key(F.col(text_col)).alias("_key"), F.col(text_col).alias("_text"))
    if hits.count() <= BROADCAST_KEYS:
        texts = texts.join(F.broadcast(hits.select("_key")), "_key", "left_semi")
    texts = texts.groupBy("_key").agg(F.first("_text").alias("_text")).join(hits, "_key")
    cut = with_prints(with_words(texts), lengths)

    def chosen(length: int) -> F.Column:
        spots = F.transform(f"_p{length}", lambda p, i: F.when(
            F.array_contains(F.element_at("_hits", bin_of(p, F.size("_hits")) + 1), p), F.struct(
                (i + 1).alias("at"), F.lit(length).alias("length"),
                F.array_join(F.slice("_words", i + 1, length), " ").alias("window"))))
        return F.filter(spots, lambda s: s.isNotNull())

    candidates = cut.select("_key", F.explode(F.concat(*(chosen(n) for n in lengths))).alias("c"))
    met = candidates.select("_key", "c.at", "c.length", "c.window").join(
        bench.select("window", "length", "items"), ["window", "length"])

    def add(acc, span):
        end = span["at"] + span["length"]
        return F.struct(F.greatest(acc["end"], end).alias("end"),
                        (acc["hit"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], span["at"]))).alias("hit"))

    spans = F.array_sort(F.collect_set(F.struct("at", "length")))
    found = met.groupBy("_key").agg(
        spans.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    total = F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit")), add, lambda a: a["hit"])
    # Written, so that Spark can split a hot key of the join with documents.
    return prints.select(*id_cols, "_key", "_n"), written(found.select(
        "_key", total.cast("long").alias("n_hit"), "items"), "found")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """One row for each document: words, hit words, items and the verdict."""
    every, found = matches(docs, items, [id_col], text_col, item_col, item_text)
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    none = F.array().cast("array<string>")
    held = F.coalesce("items", none)
    return every.join(found, "_key", "left").select(
        id_col, F.col("_n").cast("long").alias("n_words"), hit.alias("n_hit"),
        F.size(held).cast("long").alias("n_items"),
        F.sha2(F.array_join(held, ",").cast("binary"), 256).alias("items_sha256"),
        ((hit > 0) & (SHARE * hit >= F.col("_n"))).alias("contaminated"))


def decontaminated(docs: DataFrame, items: DataFrame, text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, all columns unchanged."""
    every, found = matches(docs, items, [], text_col, item_col, item_text)
    bad = written(every.join(found, "_key").filter(SHARE * F.col("n_hit") >= F.col("_n"))
                  .select(F.col("_key").alias("__llm_key")).distinct(), "contaminated")
    return docs.join(bad, content_key(F.col(text_col)) == F.col("__llm_key"), "left_anti")
