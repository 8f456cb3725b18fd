"""CSV ingest and RAW normalisation."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.constants import INDEX_ALIASES, INDEX_COLUMN, RESERVED_RENAMES, SAMPLE_SEED
from starmart.session import scratch_dir
from starmart.sources.csv_split import read_split_csv
from starmart.sources.tables import scan_table, write_table

_BAD = "__malformed"
#: A sample is taken in one scan while the tasks' bounded heaps hold at most
#: so many rows together (they meet in one task).
ONE_SCAN_ROWS = 4_000_000


def read_csv(spark: SparkSession, path: str, na_values: Sequence[str] | None = None,
             multi_line: bool | str = False) -> DataFrame:
    """CSV with a header, every column kept as text.

    All files must have the first file's header, in its order (letter case
    aside): Spark raises when one differs.  A record with more or fewer
    fields than the header is an error too, whichever columns are read, and
    so are the halves of a quoted line break; the message names
    ``multi_line``.  ``escape='"'`` keeps a doubled quote inside a quoted
    field as part of one value.  Only the empty field is NULL unless
    ``na_values`` lists more markers (pandas-style ``NA``, ``NULL``, ...).

    Records are lines by default, so every file splits into many tasks.
    ``multi_line=True`` accepts line breaks inside quoted fields (as pandas
    does) at the price of one task per file; ``multi_line="split"`` does too,
    in many tasks a file and with two scans of it (see ``csv_split.py``).
    """
    split = multi_line == "split"
    reader = spark.read.option("inferSchema", False).option("escape", '"').option("multiLine", bool(multi_line) and not split)
    head = reader.csv(path).first()
    if head is None:
        raise ValueError(f"{path} holds no header")
    raw = [x or "" for x in head]
    if split:
        df = read_split_csv(spark, path, raw, _BAD)
    else:
        df = (reader.option("header", True).option("enforceSchema", False).option("columnPruning", False)
              .option("columnNameOfCorruptRecord", _BAD)
              .schema(T.StructType([T.StructField(c, T.StringType()) for c in [*raw, _BAD]])).csv(path))
    names = [c or f"_c{i}" for i, c in enumerate(raw)]
    df = df.toDF(*names, _BAD)
    # Reading a data column keeps the check legal in a bare count.
    whole = F.col(_BAD).isNull() & (F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) >= 0)
    refuse = F.raise_error(F.concat(
        F.lit(f"not {len(names)} fields (a line break inside quotes needs multi_line=True): "), F.col(_BAD)))
    df = df.filter(F.when(whole, F.lit(True)).otherwise(refuse.cast("boolean"))).drop(_BAD)
    if na_values:
        markers = list(na_values)
        df = df.select(*[F.when(F.col(f"`{c}`").isin(markers), F.lit(None))
                         .otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return df


def lower_columns(df: DataFrame) -> DataFrame:
    """S3: lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def normalise_index(df: DataFrame) -> DataFrame:
    """The unnamed leading index column becomes ``trans_index``; add a
    unique one when absent (unique, not consecutive: consecutive ids would
    force a global order, and nothing downstream reads the column)."""
    for alias in INDEX_ALIASES:
        if alias in df.columns and INDEX_COLUMN not in df.columns:
            df = df.withColumnRenamed(alias, INDEX_COLUMN)
    if INDEX_COLUMN not in df.columns:
        df = df.select(F.monotonically_increasing_id().cast("string").alias(INDEX_COLUMN), "*")
    return df


def consecutive_index(df: DataFrame, column: str = INDEX_COLUMN) -> DataFrame:
    """S2, opt-in: ``column`` counts the rows 0 to n - 1 (as text), in the
    order in which the scan holds them, without a sort.

    The rows of every partition are counted first; a running total over those
    counts (one row a partition) is where a partition's own numbers begin.
    Both scans have to read the same rows in the same partitions, as scans of
    unchanged files do; the order of files is the scan's.
    """
    own = F.monotonically_increasing_id()  # partition number, then row number
    rest = df.drop(column) if column in df.columns else df
    counts = rest.groupBy(F.spark_partition_id().alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    # Partitions are at most some 100,000; a row of two numbers for each.
    numbered = rest.withColumn("__own", own).withColumn("__part", F.spark_partition_id())
    at = F.col("__start") + F.col("__own").bitwiseAND(F.lit((1 << 33) - 1))
    return (numbered.join(F.broadcast(starts), "__part").withColumn(column, at.cast("string"))
            .select(column, *rest.columns))


def rename_reserved(df: DataFrame) -> DataFrame:
    """first/last/long -> cust_first/cust_last/home_lon (absent: no-op)."""
    present = {k: v for k, v in RESERVED_RENAMES.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def normalise_raw(df: DataFrame) -> DataFrame:
    """S2-S4 in the order that avoids duplicate names: lower, index, renames."""
    return rename_reserved(normalise_index(lower_columns(df)))


def sample_hash(seed: int = SAMPLE_SEED, key: str = "trans_num") -> Column:
    """Repeatable pseudo-random order: md5 of the key and the seed (NULL for
    a NULL key; such rows sort last)."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))


def sample_n(df: DataFrame, n: int, seed: int = SAMPLE_SEED, key: str = "trans_num",
             tie: str = "trans_index") -> DataFrame:
    """Exactly ``min(n, rows)`` rows, no replacement, repeatable.

    The rows with the ``n`` smallest ``md5(key || seed)`` (NULL last; ties:
    ``tie`` ascending, NULL last; then a digest of the whole row, which only
    makes the choice among equal (hash, tie) rows repeatable).

    While ``n`` times the partitions is at most ``ONE_SCAN_ROWS`` this is one
    scan: each task keeps its ``n`` least rows in a heap, and the heaps meet.
    Beyond that an exact distributed cut, by a small number of jobs however
    many copies there are: rows per hash prefix (at most 65,537 histogram
    rows; a running total finds the prefix with the n-th row), then the order
    key of the last row taken (:func:`_last_key`) among that prefix's rows.
    Only when rows tie on that key and not all are taken, the same search runs
    on the digests of those.  The sample is then one filter on the order key;
    rows equal in the whole order are identical, so a cut among them adds
    copies of one row.
    """
    if n <= 0:
        return df.limit(0)
    order = [sample_hash(seed, key)]
    if tie in df.columns:
        order.append(F.col(f"`{tie}`").cast("string"))
    digest = F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))
    if n * _partitions(df) <= ONE_SCAN_ROWS:
        # The digest is computed only where rows tie on what precedes it.
        keyed = df.withColumn("__hash", order[0])
        least = [F.col("__hash").asc_nulls_last(), *(c.asc_nulls_last() for c in order[1:]), digest.asc()]
        return keyed.orderBy(*least).limit(n).drop("__hash")
    prefix = F.substring(order[0], 1, 4)
    hist = df.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("c")).withColumn("z", F.col("p").isNull())
    upto = Window.orderBy("z", "p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit = (hist.withColumn("cum", F.sum("c").over(upto)).filter(F.col("cum") >= n)
           .orderBy("z", "p").limit(1).collect())
    if not hit:  # n >= rows: everything
        return df
    left = n - (hit[0]["cum"] - hit[0]["c"])
    at, taken, ties = _last_key(df.filter(prefix.eqNullSafe(F.lit(hit[0]["p"]))), order, left)
    below, same = _less(order, at), _equal(order, at)
    if taken == ties:
        return df.filter(below | same)
    tied = df.filter(same)
    last, taken, copies = _last_key(tied, [digest], taken)
    below = below | (same & _less([digest], last))
    if taken == copies:
        return df.filter(below | (same & _equal([digest], last)))
    one = tied.filter(_equal([digest], last)).limit(1)
    return df.filter(below).unionByName(
        one.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.lit(taken)))).drop("__copy"))


def _partitions(df: DataFrame) -> int:
    """The partitions ``df`` is planned with.  An adaptive plan tells them only
    by running every shuffle below; a plain one of the same rows tells them at
    once."""
    conf, key = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(key)
    conf.set(key, "false")
    try:
        return df.select("*").rdd.getNumPartitions()
    finally:
        conf.set(key, before)


def _last_key(rows: DataFrame, order: Sequence[Column], n: int) -> tuple[list[str | None], int, int]:
    """The order key of the n-th row (NULL last), how many of the first n rows
    have it and how many there are.

    The distinct keys with their counts are range partitioned and written;
    totals per partition lead to the one that holds the cut, and a running
    total inside it to the key.
    """
    names = [f"k{i}" for i in range(len(order))]
    nulls_last = [x for k in names for x in (F.col(k).isNull(), F.col(k))]
    path = scratch_dir(rows.sparkSession, "sample-keys")
    write_table(rows.groupBy(*(c.alias(k) for c, k in zip(order, names, strict=True)))
                .agg(F.count(F.lit(1)).alias("c"))
                .repartitionByRange(_key_partitions(rows.sparkSession), *nulls_last)
                .withColumn("part", F.spark_partition_id()), path)
    keys = scan_table(rows.sparkSession, path)
    seen = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = (keys.groupBy("part").agg(F.sum("c").alias("c")).withColumn("cum", F.sum("c").over(seen))
            .filter(F.col("cum") >= n).orderBy("part").limit(1).first())
    running = Window.orderBy(*nulls_last).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (keys.filter(F.col("part") == part["part"])
            .withColumn("cum", F.sum("c").over(running) + (part["cum"] - part["c"]))
            .filter(F.col("cum") >= n).orderBy("cum").limit(1).first())
    return [last[k] for k in names], n - (last["cum"] - last["c"]), last["c"]


def _equal(order: Sequence[Column], at: Sequence[str | None]) -> Column:
    out = order[0].eqNullSafe(F.lit(at[0]))
    return out if len(order) == 1 else out & _equal(order[1:], at[1:])


def _key_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _less(order: Sequence[Column], at: Sequence[str | None]) -> Column:
    """Whether a row sorts before the key ``at`` (NULL last): later parts of
    the key are evaluated only for rows equal in the earlier ones."""
    c, v = order[0], F.lit(at[0])
    first = c.isNotNull() if at[0] is None else F.coalesce(c < v, F.lit(False))
    if len(order) == 1:
        return first
    return first | (c.eqNullSafe(v) & _less(order[1:], at[1:]))


def ingest_csv(spark: SparkSession, path: str, sample: int | None = None,
               na_values: Sequence[str] | None = None, multi_line: bool | str = False,
               consecutive: bool = False) -> DataFrame:
    """Read the CSV, normalise names, optionally sample ``sample`` rows.
    ``consecutive`` numbers the rows of files without an index column 0..n-1."""
    read = lower_columns(read_csv(spark, path, na_values, multi_line))
    if consecutive and not {INDEX_COLUMN, *INDEX_ALIASES} & set(read.columns):
        read = consecutive_index(read)
    df = normalise_raw(read)
    return sample_n(df, sample) if sample is not None else df
