"""The registered queries, their SQL, and the pipeline."""
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from starmart.llm import jaccard_join, quality_rules, secret_ledger
from starmart.llm.common import read_table
from starmart.llm.queries import QUERIES
from starmart.llm.spellings import DEFAULT as SPELLING
from tests.llm.test_decontaminate import brute as contamination
from tests.llm.test_jaccard_join import brute as components
from tests.llm.test_maxent_lm import plain as language_model
from tests.llm.test_quality_rules import brute as quality
from tests.llm.test_secret_ledger import brute as secrets
from tests.llm.test_spellings import plain as spellings
from tools.oracle_check import duck, rows

SQL = sorted(set(entry.oracle_sql()) & set(QUERIES))


def test_one_query_for_each_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]
    assert entry.queries()["pipeline"] is corpus_pipeline.run and len(SQL) == 6


@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, sf_dir, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    want = duck(sf_dir).execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


CONTRACT = {
    "op2": ["doc_id", "held_out", "lang_pred", "score"],
    "op4": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op5": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op10": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op11": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op12": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op13": ["word", "form", "root", "n", "n_near", "form_n"]}


@pytest.mark.parametrize("n", CONTRACT)
def test_contract_columns(spark, sf_dir, n):
    name = next(k for k in QUERIES if k.startswith(n + "_"))
    assert QUERIES[name](spark, sf_dir).columns == CONTRACT[n]


def test_language_model_counts_against_plain_counting(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in read_table(spark, sf_dir, "documents").collect()]
    want = dict(zip((i for i, _ in docs), language_model(docs), strict=True))
    got = QUERIES["op11_lm_scoring"](spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        held, tokens, known, total, base = want[r["doc_id"]]
        assert tuple(r)[1:5] == (held, tokens, known, total) and abs(r["base_score"] - base) < 1e-6
    unseen = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_spelling_variants_against_all_pairs(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in read_table(spark, sf_dir, "documents").collect()]
    got = sorted(tuple(r) for r in QUERIES["op13_spelling_variants"](spark, sf_dir).collect())
    assert got == spellings(docs, SPELLING) and len(got) > 1000


def test_pipeline_stages_against_brute_force(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    stage = dict(corpus_pipeline.STAGES)
    local = {r["doc_id"]: r for r in docs.collect()}

    kept = stage["quality_rules"](spark, docs, sf_dir)
    assert kept.columns == docs.columns
    one = {r["doc_id"] for r in kept.collect()}
    assert one <= {i for i, r in local.items() if not quality(r["text"])[5]}
    scores = {r["doc_id"]: r["kept"] for r in quality_rules.repetition_scores(docs).collect()}
    assert one == {i for i, k in scores.items() if k}

    single = stage["jaccard_join"](spark, kept, sf_dir)
    assert single.columns == docs.columns
    of = components([(i, local[i]["text"]) for i in one])
    two = {r["doc_id"] for r in single.collect()}
    assert two == {i for i in one if of[i][1] == i}

    bench = [tuple(r) for r in read_table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    clean = stage["decontamination"](spark, single, sf_dir)
    order = sorted(two)
    bad = {i for i, r in zip(order, contamination([local[i]["text"] for i in order], bench), strict=True) if r[4]}
    three = {r["doc_id"] for r in clean.collect()}
    assert bad and three == two - bad

    safe = stage["secret_scans"](spark, clean, sf_dir)
    assert safe.columns == docs.columns
    for r in safe.collect():
        before = local[r["doc_id"]]["text"]
        spans = secrets(before)
        assert (r["text"] == before) == (not spans) and r["n_chars"] == len(r["text"])
        assert not any(before[a:b] in r["text"] for a, _, b, _ in spans)

    total = sum(r["length"] for r in stage["packing"](spark, safe, sf_dir).collect())
    ran = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in ran} == three and sum(r["length"] for r in ran) == total


def test_docstrings_state_the_awkward_cases():
    for module in (quality_rules, jaccard_join, secret_ledger):
        assert "Defined results" in module.__doc__
