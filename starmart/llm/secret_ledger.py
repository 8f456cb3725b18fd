"""Secret scans: an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text.  The
ledger holds one row for each (blob, rule, rule version) ever scanned, with
the spans found (often none).  A run computes which pairs the ledger lacks,
sends each such blob once to one task, runs only the missing rules on it,
appends the new rows and joins findings back to all paths of a blob.  A new
rule version, or a new text, costs just its own pairs.

Plan: addresses move first, and narrow.  In a first run they are counted: a
text whose address occurs once is scanned where it is, only those that may
have copies (by a bit filter of bounded size) move.  With a ledger, all
addresses meet it, and only texts that may lack a scan move.  Copies collapse
in the task, and each such blob goes once to the task that scans it.  The
join back to paths moves addresses and the few findings, no texts;
``redacted`` moves only the texts that may have findings, the others pass
where they are.

Defined results: a null text is the empty blob and has no findings; repeated
rows are paths of the same blob and get the same findings, one output row
for each input row; null ids stay; an empty table gives an empty result;
other columns are ignored or (``redacted``) kept.  Very long texts are
scanned whole.  A private key without an END line ends with its base64 lines.
"""
from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import map_batches, written
from starmart.operators.bloom import bit_filter

BLOB, SPANS, MAY = "__llm_blob", "__llm_spans", "__llm_may"
LEDGER_SCHEMA = ("__llm_blob binary, rule string, version int, "
                 "spans array<struct<start:int,end:int>>")


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has at
    least ``least`` characters.  ``needs``: lower-case strings one of which
    is in the lower-cased text of any match (a plain test before the scan)."""

    kind: str
    version: int
    pattern: str
    least: int = 0
    group: int = 0
    flags: int = re.ASCII
    needs: tuple[str, ...] = ()

    def finder(self) -> Callable[[str, str], list[dict]]:
        find, least, group, needs = (re.compile(self.pattern, self.flags).finditer,
                                     self.least, self.group, self.needs)

        def spans(text: str, lowered: str) -> list[dict]:
            if needs and not any(x in lowered for x in needs):
                return []
            return [{"start": m.start(), "end": m.end()} for m in find(text)
                    if m.end(group) - m.start(group) >= least]

        return spans


BASE_KINDS = ("assign", "access", "hex")
#: The base kinds, in their order, then the spans the method adds.
RULES = (
    Rule("assign", 1,
         r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         least=8, group=2, flags=re.ASCII | re.IGNORECASE,
         needs=("passw", "secret", "token", "api")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=16, needs=("akia",)),
    # A run is never longer than its greedy match, so the bound may stand in
    # the pattern: shorter runs are passed over without a match object.
    Rule("hex", 1, r"[0-9a-f]{32,}", least=32),
    # Version 2 takes the whole block: to its END line, else its headers and
    # base64 lines (or long base64 words, where line breaks are escaped).
    Rule("private_key", 2,
         r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----(?:(?:(?!-----BEGIN )[\s\S])*?-----END \1PRIVATE KEY-----"
         r"|(?:(?:\s|\\[nr])*+(?:[A-Za-z0-9+/=]{16,}+|(?<=\n)[A-Za-z-]+:[^\n]*+|(?<=\n)[A-Za-z0-9+/=]+(?=\r?\n|\Z)))*+)",
         needs=("private key",)),
    Rule("forge_token", 1, r"gh[pousr]_[A-Za-z0-9]+", least=40, needs=("gh",)),
)


def with_blob(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the content address of its text in a column."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.withColumn(BLOB, F.unhex(F.sha2(text, 256)))


def lacking(addresses: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(address, missing) of the addresses some current rule version has not
    scanned, each once, with the kinds that are missing."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    current = " or ".join(f"(rule = '{r.kind}' and version = {r.version})" for r in rules)
    done = ledger.filter(current).groupBy(BLOB).agg(F.collect_set("rule").alias("done"))
    missing = F.array_except(kinds, F.coalesce("done", F.array().cast("array<string>")))
    return (addresses.select(BLOB).distinct().join(done, BLOB, "left").withColumn("missing", missing)
            .filter(F.size("missing") > 0).select(BLOB, "missing"))


def may_have(docs: DataFrame, addresses: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with their addresses and whether that may be one of
    ``addresses`` (false: surely not)."""
    return bit_filter(addresses, BLOB).passed(with_blob(docs, text_col), F.col(BLOB), MAY)


def split_copies(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(address, text) of the rows whose blob surely occurs once, and of the
    others: all copies, and a few more the bit filter can't tell apart."""
    addressed = with_blob(docs.select(text_col), text_col)
    often = written(addressed.groupBy(BLOB).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(BLOB), "copied")
    marked = may_have(docs.select(text_col), often, text_col)
    return (marked.filter(~F.col(MAY)).select(BLOB, text_col),
            marked.filter(MAY).select(BLOB, text_col))


def unseen(docs: DataFrame, ledger: DataFrame | None, text_col: str = "text",
           rules: Sequence[Rule] = RULES) -> DataFrame:
    """(address, text, missing): the blobs some current rule version has not
    scanned, each once, with the kinds that are missing."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    if ledger is None:
        alone, copies = split_copies(docs, text_col)
        blobs = copies.groupBy(BLOB).agg(F.first(text).alias("text")).unionByName(alone.select(BLOB, text.alias("text")))
        return blobs.withColumn("missing", F.array(*(F.lit(r.kind) for r in rules)))
    todo = written(lacking(with_blob(docs.select(text_col), text_col), ledger, rules), "lacking")
    moved = may_have(docs.select(text_col), todo, text_col).filter(MAY)
    return moved.groupBy(BLOB).agg(F.first(text).alias("text")).join(todo, BLOB)


def scanned(blobs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Ledger rows of the blobs of :func:`unseen`: a row for each pair."""
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    versions = {r.kind: r.version for r in rules}
    find: dict[str, Callable] = {}

    def scan(batch: pa.RecordBatch) -> dict:
        find.update({} if find else {r.kind: r.finder() for r in rules})
        ids, kinds, spans = [], [], []
        for blob, text, missing in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            lowered = text.lower()
            for kind in missing:
                ids.append(blob)
                kinds.append(kind)
                spans.append(find[kind](text, lowered))
        return {BLOB: pa.array(ids, pa.binary()), "rule": pa.array(kinds, pa.string()),
                "version": pa.array([versions[k] for k in kinds], pa.int32()),
                "spans": pa.array(spans, spans_type)}

    return map_batches(blobs.select(BLOB, "text", "missing"), scan, LEDGER_SCHEMA)


def update_ledger(docs: DataFrame, ledger: DataFrame | None = None, text_col: str = "text",
                  rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ledger after scanning what it lacks of ``docs``: the old rows and
    the new ones, which are written to the shared folder."""
    new = written(scanned(unseen(docs, ledger, text_col, rules), rules), "ledger")
    return new if ledger is None else ledger.select(*new.columns).unionByName(new)


def scan_into(spark: SparkSession, docs: DataFrame, path: str, text_col: str = "text",
              rules: Sequence[Rule] = RULES) -> DataFrame:
    """The durable ledger at ``path`` after scanning what it lacks of ``docs``.

    New rows are appended by Spark's commit protocol when the scan is whole,
    so a failed run leaves the ledger as it was; a first run makes it.
    """
    try:
        ledger = spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException:
        ledger = None
    scanned(unseen(docs, ledger, text_col, rules), rules).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def findings(ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(address, spans): for blobs with findings of current rule
    versions, all spans by start, then kind in the rules' order."""
    order = {r.kind: i for i, r in enumerate(rules)}
    current = " or ".join(f"(rule = '{r.kind}' and version = {r.version})" for r in rules)
    rank = F.create_map(*(F.lit(x) for kv in order.items() for x in kv))[F.col("rule")]
    span = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), F.col("rank"), s["end"].alias("end"), F.col("rule").alias("kind")))
    return (ledger.filter(current).filter(F.size("spans") > 0)
            .withColumn("rank", rank).select(BLOB, span.alias("s"))
            .groupBy(BLOB).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("s"))))
                               .alias(SPANS)))


def secret_report(docs: DataFrame, ledger: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row for each path (input row): counts and spans of its blob."""
    paths = with_blob(docs.select(id_col, text_col), text_col).select(id_col, BLOB)
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    found = (paths.join(findings(ledger, rules), BLOB, "left")
             .withColumn(SPANS, F.coalesce(SPANS, none)))

    def count(kind: str):
        return F.size(F.filter(SPANS, lambda s: s["kind"] == kind)).cast("long")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter(SPANS, lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(id_col, *(count(k).alias(f"n_{k}") for k in BASE_KINDS),
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col(SPANS)).alias("spans"))


def redacted(docs: DataFrame, ledger: DataFrame, text_col: str = "text",
             mark: str = "[REDACTED]", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark`` (spans that
    overlap by one mark); other rows and all other columns unchanged.

    The findings are written first; a bit filter of their addresses parts the
    rows, and only those that may be hit are joined, the rest isn't moved.
    """
    text = F.col(text_col)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def cut(acc, span):
        fresh = span["start"] >= acc["at"]
        piece = F.substring(text, acc["at"] + 1, F.greatest(span["start"] - acc["at"], F.lit(0)))
        return F.struct(F.greatest(acc["at"], span["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], piece, F.lit(mark)))
                        .otherwise(acc["out"]).alias("out"))

    def close(acc):
        return F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))

    hits = written(findings(ledger, rules), "hits")
    parted = may_have(docs, hits, text_col)
    clean = F.when(F.col(SPANS).isNull(), text).otherwise(F.aggregate(SPANS, start, cut, close))
    cleaned = parted.filter(MAY).join(hits, BLOB, "left").withColumn(text_col, clean).select(*docs.columns)
    return parted.filter(~F.col(MAY)).select(*docs.columns).unionByName(cleaned)
