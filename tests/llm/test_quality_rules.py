"""Quality rules against brute force."""
import re
from collections import Counter

import pytest

from starmart.llm.common import read_table
from starmart.llm.quality_rules import keep_unrepetitive, repetition_scores
from tests.llm.data import ODD, frame, prose

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    count = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if count[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), again, len(inside), failed)


def texts():
    line = prose(12, 3)
    return [*ODD, prose(40), prose(40), f"{line}\n{line}\n{prose(30, 4)}", "\n".join([line] * 9), "of " * 30,
            prose(9, 5) + " " + prose(9, 5) + " " + prose(60, 6), prose(30000, 7), "# * $ % & | < > " * 4 + prose(50, 8)]


def test_counts_match_brute_force(spark):
    rows = texts()
    got = {r["doc_id"]: r for r in repetition_scores(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, x in enumerate(rows):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                r["base_failed"]) == brute(x), i
        assert not (r["kept"] and r["base_failed"])


def test_table_matches_brute_force(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    want = {r["doc_id"]: brute(r["text"]) for r in docs.collect()}
    for r in repetition_scores(docs).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                r["base_failed"]) == want[r["doc_id"]]


def test_method_rejects_what_eight_word_windows_miss(spark):
    sevens = " ".join(w for w in ["alpha", "beta", "gamma", "delta", "rho", "tau", "chi", "psi"] for _ in range(7))
    r = repetition_scores(frame(spark, [sevens, prose(80)])).orderBy("doc_id").collect()
    assert (r[0]["base_failed"], r[0]["kept"]) == (False, False) and r[1]["kept"]


def test_filter_keeps_rows_whole_and_repeated(spark):
    good = prose(60, 9)
    docs = frame(spark, [good, good, "short", None], ids=[4, 4, 5, None])
    kept = keep_unrepetitive(docs)
    assert kept.schema == docs.schema
    assert [r["doc_id"] for r in kept.collect()] == [4, 4]
    assert sorted(kept.collect(), key=str) == sorted(docs.filter("doc_id = 4").collect(), key=str)


@pytest.mark.parametrize("fn", [repetition_scores, keep_unrepetitive])
def test_empty_table(spark, fn):
    assert fn(frame(spark, [])).collect() == []
