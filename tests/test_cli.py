"""Command line end to end on a small CSV written from the driver tables."""
from starmart.__main__ import main
from starmart.session import scratch_dir
from starmart.sources.fixtures import raw_transactions


def test_cli_build_report_sql(spark, sf_dir, capsys):
    csv = scratch_dir(spark, "cli-csv")
    raw_transactions(spark, sf_dir).write.option("header", True).option("escape", '"').csv(csv)
    root = scratch_dir(spark, "cli-wh")
    assert main(["load", "--csv", csv, "--warehouse", root, "--sample", "100"]) == 0
    assert "100 rows loaded, 100 in" in capsys.readouterr().out
    assert main(["build", "--csv", csv, "--warehouse", root]) == 0
    out = capsys.readouterr().out
    assert out.count("PASS") == 23
    assert main(["report", "top5_states_spend", "--warehouse", root]) == 0
    assert "total_spend" in capsys.readouterr().out
    assert main(["sql", "select count(*) as n from fact_transactions", "--warehouse", root]) == 0
    assert "6000" in capsys.readouterr().out
    assert main(["build", "--csv", csv, "--warehouse", root, "--staging-table", "--lenient", "--as-of", "2025-06-30",
                 "--na-values", "NA"]) == 0
    capsys.readouterr()
    assert main(["sql", "drop table fact_transactions", "--warehouse", root]) == 1
