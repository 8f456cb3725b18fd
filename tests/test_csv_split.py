"""Quoted line breaks read in many tasks equal Spark's one-task reader."""
import os
import random

import pytest

import __spark_entry__ as entry
from starmart.sources.csv_ingest import consecutive_index, ingest_csv, read_csv
from starmart.sources.csv_split import lines


def text_of(n, seed, breaks="\n", end="\n"):
    rng = random.Random(seed)
    out = ["id,name,note"]
    for i in range(n):
        note = rng.choice(["plain", "", '"a ""q"" b"', f'"two{breaks}lines"', f'"{breaks}{breaks}"', '"x, y"',
                           '"' + (breaks + "long ") * rng.randrange(1, 60) + '"', '""'])
        out.append(f"{i},n{i},{note}")
    return end.join(out) + (end if seed % 2 else "")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("breaks,end", [("\n", "\n"), ("\r\n", "\r\n"), ("\n", "\r\n")])
def test_one_large_file_in_many_tasks_equals_multi_line(spark, tmp_path, small_splits, breaks, end):
    d = tmp_path / "csv"
    d.mkdir()
    for seed in range(3):
        (d / f"f{seed}.csv").write_bytes(text_of(150, seed, breaks, end).encode())
    splits = lines(spark, str(d)).select("file", "split").distinct().count()
    assert splits > 20
    want = rows(read_csv(spark, str(d), multi_line=True))
    got = read_csv(spark, str(d), multi_line="split")
    assert len(want) == 450 and rows(got) == want
    assert got.columns == ["id", "name", "note"] and got.count() == 450


def test_a_record_longer_than_a_split(spark, tmp_path, small_splits):
    p = tmp_path / "long.csv"
    body = "\n".join(f"line {i}" for i in range(900))
    p.write_text(f'id,note\n1,"{body}"\n2,"{body}"\n3,x\n')
    assert rows(read_csv(spark, str(p), multi_line="split")) == [("1", body), ("2", body), ("3", "x")]


@pytest.mark.parametrize("text,why", [("a,b\n1,2,3\n", "not 2 fields"), ("a,b\n1\n", "not 2 fields")])
def test_records_of_other_lengths_raise(spark, tmp_path, text, why):
    p = tmp_path / "bad.csv"
    p.write_text(text)
    with pytest.raises(Exception, match=why):
        read_csv(spark, str(p), multi_line="split").collect()


def test_headers_are_compared(spark, tmp_path):
    d = tmp_path / "two"
    d.mkdir()
    (d / "a.csv").write_text("a,b\n1,2\n")
    (d / "b.csv").write_text("A,B\n3,4\n")
    assert rows(read_csv(spark, str(d), multi_line="split")) == [("1", "2"), ("3", "4")]
    (d / "c.csv").write_text("b,a\n5,6\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(d), multi_line="split").collect()


def test_consecutive_index(spark, tmp_path, small_splits):
    d = tmp_path / "idx"
    d.mkdir()
    (d / "a.csv").write_text("name,amt\n" + "".join(f"n{i},{i}\n" for i in range(500)))
    got = ingest_csv(spark, str(d), consecutive=True)
    assert got.columns[0] == "trans_index" and got.rdd.getNumPartitions() > 3
    assert sorted(int(r.trans_index) for r in got.collect()) == list(range(500))
    by = {int(r.trans_index): int(r.amt) for r in got.collect()}
    assert all(by[i] == i for i in range(500))  # one file: in its order
    empty = consecutive_index(spark.range(0).selectExpr("id as x"))
    assert empty.columns == ["trans_index", "x"] and empty.collect() == []
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def _raw(spark, n):
    return spark.createDataFrame([(f"{i % (n - 50)}" if i % 7 else None, f'two\n"lines", {i}', None if i % 5 else "x")
                                  for i in range(n)], "trans_index string, job string, state string")


def _folders(spark, name):
    top = spark.conf.get("spark.checkpoint.dir")
    return {x for x in os.listdir(top) if x.startswith(f"{name}-")} if os.path.isdir(top) else set()


@pytest.mark.parametrize("parts", [1, 4])
def test_quoted_csv_by_parts_keeps_one_part_on_disk(spark, parts):
    raw, before = _raw(spark, 400).repartition(3).localCheckpoint(), _folders(spark, "quoted")
    got = entry.quoted_csv(raw, parts)
    assert got.columns == raw.columns and rows(got) == rows(raw)  # null and repeated keys too
    assert len(_folders(spark, "quoted") - before) == 1


def test_ingest_csv_quoted_of_a_large_table_never_holds_the_whole_csv(spark, sf_dir, monkeypatch):
    def run():
        before = _folders(spark, "quoted")
        got = rows(entry.q_ingest_csv_quoted(spark, sf_dir))
        top = spark.conf.get("spark.checkpoint.dir")
        return got, sum(os.path.getsize(f"{top}/{d}/{x}") for d in _folders(spark, "quoted") - before
                        for x in os.listdir(f"{top}/{d}") if x.endswith(".csv"))

    want, whole = run()
    monkeypatch.setattr(entry, "PART_ROWS", 1000, raising=False)
    got, left = run()
    assert got == want and 0 < left < whole / 2
