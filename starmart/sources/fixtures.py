"""RAW transactions derived from the driver's TPC-H-like tables.

One RAW row per lineitem (see FIXTURES.md §3): every column is text, as it
would arrive from the transactions CSV.  Timestamps are formatted without
the session time zone (same text as the mapping under UTC, whatever zone
the caller's session uses).  The derivation is a tree of
inner equi-joins; Spark picks the strategies (nation is tiny and broadcast;
the large sides shuffle on their keys, AQE re-plans from measured sizes).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collections.abc import Sequence

from starmart.schemas import RAW_COLUMNS
from starmart.session import scratch_dir
from starmart.sizing import checked_rows, fits_broadcast
from starmart.sources.tables import scan_table, write_table

TABLES = ("lineitem", "orders", "customer", "part", "supplier", "nation")
#: Columns of the joined rows that parts of RAW are made of: an amount, a
#: merchant, a timestamp, a card, a transaction's id, a person.
AMOUNT_OF = ("l_extendedprice",)
MERCHANT_OF = ("s_name", "p_brand")
TIME_OF = ("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
CARD_OF = ("c_custkey",)
ID_OF = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
PERSON_OF = ("c_custkey", "c_name", "c_mktsegment", "n_nationkey", "n_name")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over the cluster when its scan yields fewer
    partitions than the default parallelism (a single large row group is read
    by one task).  Inputs of many files/row groups already split and are left
    alone: no extra shuffle at scale."""
    try:
        slots = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except Exception:  # Spark Connect: partition counts are not visible
        return df
    return df.repartition(slots) if parts < slots else df


def joined_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem with what RAW is made of.

    The joins are ordered by what they move: a lineitem meets part and
    supplier while it is six numbers, and the customer's text comes with the
    orders (a quarter of the rows), so that no exchange carries it by lineitem.
    Suppliers that were measured (a job) and are within the broadcast bound are
    joined last, where no exchange carries their names.
    """
    t = {n: read_table(spark, sf_dir, n) for n in TABLES}
    li = spread(t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                     "l_extendedprice", "l_shipdate"))
    orders = t["orders"].select("o_orderkey", "o_custkey")
    cust = t["customer"].select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    part = t["part"].select("p_partkey", "p_brand")
    supp = t["supplier"].select("s_suppkey", "s_name")
    nation = t["nation"].select("n_nationkey", "n_name")

    ordered = (orders.join(cust, F.col("o_custkey") == cust.c_custkey)
               .join(nation, F.col("c_nationkey") == nation.n_nationkey)
               .drop("o_custkey", "c_nationkey"))
    items = li.join(part, li.l_partkey == part.p_partkey).drop("p_partkey")

    def supplied(df: DataFrame, supp: DataFrame) -> DataFrame:
        return df.join(supp, F.col("l_suppkey") == supp.s_suppkey).drop("s_suppkey")

    small = fits_broadcast(checked_rows(supp))
    if not small:
        items = supplied(items, supp)
    met = items.join(ordered, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    return supplied(met, F.broadcast(supp)) if small else met


def raw_transactions(spark: SparkSession, sf_dir: str, keep: bool | Sequence[str] = False) -> DataFrame:
    """RAW transactions (23 text columns, normalised names) for ``sf_dir``.

    ``keep`` writes the joined rows to the shared scratch folder first (this
    runs a job): several readers then share one run of the joins, and each
    reads only the columns it needs.  Readers that need few name the joined
    columns (``AMOUNT_OF``, ...), and only these are shuffled and written;
    reading a RAW column made of others is then an error.
    """
    j = joined_tables(spark, sf_dir)
    if keep:
        path = scratch_dir(spark, "joined")
        kept = j.columns if keep is True else list(dict.fromkeys(keep))
        write_table(j.select(*kept), path)
        scan = scan_table(spark, path)
        j = scan.select(*(c if c in kept else F.raise_error(F.lit(f"{c} was not kept")).cast(t).alias(c)
                          for c, t in j.dtypes))

    e = F.expr
    x = j.select(
        "*",
        e("timestampadd(SECOND, cast((l_orderkey * 7919 + l_linenumber * 104729"
          " + l_partkey * 31) % 86400 as int), l_shipdate)").alias("ts"),
        e("cast(cast(l_extendedprice as decimal(12,2)) as string)").alias("amt"),
        e("(case c_custkey % 5 when 0 then '3' when 1 then '4' when 2 then '5'"
          " when 3 then '6' else '9' end) || lpad(cast(c_custkey as string), 15, '0')"
          ).alias("cc_num"),
        e("'fraud_' || s_name").alias("merchant"),
        F.col("p_brand").alias("category"),
        e("substr(c_name, 1, 8)").alias("cust_first"),
        e("case when c_custkey % 50 = 0 then null else substr(c_name, 10) end").alias("cust_last"),
        e("case when c_custkey % 2 = 0 then 'M' else 'F' end").alias("gender"),
        e("cast(c_custkey % 9999 as string) || ' ' || c_mktsegment || ' St'").alias("street"),
        e("'City ' || cast(n_nationkey as string)").alias("city"),
        F.col("n_name").alias("state"),
        e("lpad(cast(n_nationkey * 137 as string), 5, '0')").alias("zip"),
        e("cast(n_nationkey + 25 as string) || '.5'").alias("lat"),
        e("'-' || cast(n_nationkey + 70 as string) || '.25'").alias("home_lon"),
        e("cast(n_nationkey * 1000 + 500 as string)").alias("city_pop"),
        F.col("c_mktsegment").alias("job"),
        e("cast(n_nationkey + 25 as string) || '.75'").alias("merch_lat"),
        e("'-' || cast(n_nationkey + 70 as string) || '.125'").alias("merch_long"),
        e("case when l_orderkey % 200 = 0 then '1' else '0' end").alias("is_fraud"),
    )
    out = x.select(
        e("cast(l_orderkey * 10 + l_linenumber as string)").alias("trans_index"),
        e("md5(concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string),"
          " cast(l_partkey as string), cast(l_suppkey as string), amt))").alias("trans_num"),
        # zone-free: an NTZ value cast to text is its wall-clock 'yyyy-MM-dd HH:mm:ss'
        e("cast(ts as string)").alias("trans_date_trans_time"),
        "cc_num", "merchant", "category", "amt", "cust_first", "cust_last", "gender",
        "street", "city", "state", "zip", "lat", "home_lon", "city_pop", "job",
        e("cast(date_add(date'1950-01-01', cast(c_custkey * 37 % 18000 as int)) as string)"
          ).alias("dob"),
        # zone-free seconds since 1970-01-01 00:00:00 of the NTZ wall clock
        e("cast(cast(unix_date(to_date(ts)) as bigint) * 86400 + hour(ts) * 3600"
          " + minute(ts) * 60 + second(ts) as string)").alias("unix_time"),
        "merch_lat", "merch_long", "is_fraud",
    )
    return out.select(*RAW_COLUMNS)
