"""Declarative data-quality tests (Q1-Q4).

A test returns its failing rows and passes on zero.  ``quality_report``
runs a whole suite and returns one row per test.

Scale notes: all not-null tests of one model share a single aggregation
pass, and so do its relationship tests whose parents have a checked size
within the broadcast bound (each parent's distinct keys are joined map-side
with a marker).  The other relationship tests of a model share one more pass
that counts rows per (test, key): a key holding a third of the rows collapses
map-side, and only distinct keys meet the parents.  A uniqueness test is one
scan and one aggregation by value.
"""
from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.keys import packed
from starmart.session import scratch_dir
from starmart.sizing import checked_rows, fits_broadcast
from starmart.sources.tables import scan_table, write_table


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str  # not_null | unique | relationships
    to_model: str | None = None
    to_column: str | None = None


def _nn(model: str, column: str) -> Check:
    return Check(model, column, "not_null")


def _un(model: str, column: str) -> Check:
    return Check(model, column, "unique")


def _rel(model: str, column: str, to_model: str, to_column: str) -> Check:
    return Check(model, column, "relationships", to_model, to_column)


F_T = "fact_transactions"
#: The 23 declared tests, in declaration order.
SUITE: tuple[Check, ...] = (
    _nn("stg_transactions", "transaction_id"), _un("stg_transactions", "transaction_id"),
    _nn("stg_transactions", "amount"), _nn("stg_transactions", "transaction_ts"),
    _nn("dim_customer", "customer_key"), _un("dim_customer", "customer_key"),
    _nn("dim_account", "account_key"), _un("dim_account", "account_key"),
    _nn("dim_merchant", "merchant_key"), _un("dim_merchant", "merchant_key"),
    _nn("dim_date", "date_key"), _un("dim_date", "date_key"),
    _nn(F_T, "transaction_id"), _un(F_T, "transaction_id"), _nn(F_T, "amount"),
    _nn(F_T, "customer_key"), _rel(F_T, "customer_key", "dim_customer", "customer_key"),
    _nn(F_T, "account_key"), _rel(F_T, "account_key", "dim_account", "account_key"),
    _nn(F_T, "merchant_key"), _rel(F_T, "merchant_key", "dim_merchant", "merchant_key"),
    _nn(F_T, "date_key"), _rel(F_T, "date_key", "dim_date", "date_key"),
)


# --- Q1-Q3: failing rows -------------------------------------------------------

def not_null(df: DataFrame, column: str) -> DataFrame:
    """Q1: rows whose ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Q2: one row per non-NULL value held by more than one row (one scan,
    one shuffle; copies of a value collapse map-side)."""
    return (df.select(column).filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def relationships(child: DataFrame, column: str, parent: DataFrame,
                  to_column: str, parent_rows: int | None = None) -> DataFrame:
    """Q3: child rows whose non-NULL ``column`` has no ``to_column`` in parent.

    ``parent_rows`` is the parent's checked row count (``None``: unknown).
    A parent within the broadcast bound is broadcast and anti-joined
    map-side (no shuffle).  Otherwise the orphan *keys* are found first --
    the child's distinct keys (reduced map-side, so a hot key costs one row
    per task) anti-joined to the parent's -- and written to the shared folder
    (this runs a job).  None: the result is empty; few: they are broadcast to
    select the child's rows, which are never shuffled; many: a semi join by
    hash, which Spark splits where a key is skewed.
    """
    keys = parent.select(F.col(to_column).alias(column))
    rows = child.filter(F.col(column).isNotNull())
    if fits_broadcast(parent_rows):
        return rows.join(F.broadcast(keys), column, "left_anti")
    path = scratch_dir(child.sparkSession, "orphans")
    write_table(rows.select(column).distinct().join(keys, column, "left_anti"), path)
    orphans = scan_table(child.sparkSession, path)
    n = checked_rows(orphans)
    if n == 0:
        return rows.filter(F.lit(False))
    return rows.join(F.broadcast(orphans) if fits_broadcast(n) else orphans, column, "left_semi")


# --- Q4: the suite ------------------------------------------------------------

def _row(test_id: int, c: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(test_id).alias("test_id"), F.lit(c.model).alias("model"),
        F.lit(c.column).alias("column_name"), F.lit(c.test).alias("test"),
        failures.cast("long").alias("failures"),
    )


def _rows(df: DataFrame, structs: Sequence[Column]) -> DataFrame:
    return df.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _orphans(tables: Mapping[str, DataFrame], model: str,
             checks: Sequence[tuple[int, Check]]) -> DataFrame:
    """One row per relationship test of a model with parents of unknown size:
    one pass over the model for all of them."""
    def pair(i: int, key: Column) -> Column:
        return F.struct(F.lit(i).alias("t"), packed(key.cast("string")).alias("k"))

    per_key = (tables[model].select(F.explode(F.array(*(pair(i, F.col(c.column)) for i, c in checks))).alias("p"))
               .select("p.t", "p.k").filter("k is not null").groupBy("t", "k")
               .agg(F.count(F.lit(1)).alias("n")))
    parents = [tables[c.to_model].select(pair(i, F.col(c.to_column)).alias("p")).select("p.t", "p.k")
               for i, c in checks]
    known = parents[0]
    for p in parents[1:]:
        known = known.unionByName(p)
    got = per_key.join(known, ["t", "k"], "left_anti").agg(
        *[F.coalesce(F.sum(F.when(F.col("t") == i, F.col("n"))), F.lit(0)).alias(f"f{i}") for i, _ in checks])
    return _rows(got, [_row(i, c, F.col(f"f{i}")) for i, c in checks])


def _orphans_kept(keys: DataFrame, parent: DataFrame, i: int, c: Check) -> DataFrame:
    """One row for a relationship test whose child's rows per key were kept:
    no pass over the child, and no exchange where both are in like buckets."""
    known = parent.select(F.col(c.to_column).alias(c.column))
    got = (keys.filter(F.col(c.column).isNotNull()).join(known, c.column, "left_anti")
           .agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("f")))
    return _rows(got, [_row(i, c, F.col("f"))])


def _one_pass(tables: Mapping[str, DataFrame], model: str, nulls: Sequence[tuple[int, Check]],
              small: Sequence[tuple[int, Check]]) -> DataFrame:
    """One row per not-null test and per relationship test with a small
    parent, all from one pass over the model."""
    df = tables[model].select(*dict.fromkeys(c.column for _, c in [*nulls, *small]))
    for i, c in small:
        keys = tables[c.to_model].select(F.col(c.to_column).alias(f"_k{i}")).distinct().withColumn(
            f"_m{i}", F.lit(True))
        df = df.join(F.broadcast(keys), F.col(c.column) == F.col(f"_k{i}"), "left")
    counts = df.agg(
        *[F.count_if(F.col(c.column).isNull()).alias(f"f{i}") for i, c in nulls],
        *[F.count_if(F.col(c.column).isNotNull() & F.col(f"_m{i}").isNull()).alias(f"f{i}") for i, c in small])
    return _rows(counts, [_row(i, c, F.col(f"f{i}")) for i, c in [*nulls, *small]])


def quality_report(tables: Mapping[str, DataFrame],
                   suite: Sequence[Check] = SUITE,
                   rows: Mapping[str, int] | None = None,
                   ids: Collection[int] | None = None,
                   kept: Mapping[tuple[str, str], DataFrame] | None = None) -> DataFrame:
    """Run ``suite`` over ``tables`` (name -> DataFrame), or the tests of it
    whose 1-based numbers are in ``ids``.

    Columns: test_id (1-based, suite order), model, column_name, test,
    failures, passed.  One row per test, lazily: the caller's action runs it.
    ``rows`` holds checked row counts of parent tables (see ``Star.rows``),
    ``kept`` the rows per key of some (model, column), which stand for the
    model in its relationship test with a parent of unknown size.
    """
    rows, kept = rows or {}, kept or {}
    parts: list[DataFrame] = []
    by_model: dict[str, dict[str, list[tuple[int, Check]]]] = {}
    for i, c in enumerate(suite, start=1):
        if ids is not None and i not in ids:
            continue
        kinds = by_model.setdefault(c.model, {"null": [], "small": [], "large": []})
        if c.test == "not_null":
            kinds["null"].append((i, c))
        elif c.test == "relationships" and (c.model, c.column) in kept and not fits_broadcast(rows.get(c.to_model)):
            parts.append(_orphans_kept(kept[c.model, c.column], tables[c.to_model], i, c))
        elif c.test == "relationships":
            kinds["small" if fits_broadcast(rows.get(c.to_model)) else "large"].append((i, c))
        elif c.test == "unique":
            # Only their number is asked for, so values are counted as bytes.
            values = tables[c.model].select(packed(F.col(c.column).cast("string")).alias(c.column))
            dup = unique(values, c.column).agg(F.count(F.lit(1)).alias("f"))
            parts.append(_rows(dup, [_row(i, c, F.col("f"))]))
        else:
            raise ValueError(f"unknown test {c.test!r}")
    for model, kinds in by_model.items():
        if kinds["null"] or kinds["small"]:
            parts.append(_one_pass(tables, model, kinds["null"], kinds["small"]))
        if kinds["large"]:
            parts.append(_orphans(tables, model, kinds["large"]))
    # pairwise, so each union analyses small plans (Spark flattens the tree)
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return (parts[0].withColumn("passed", F.col("failures") == 0)
            .orderBy("test_id"))
