"""The command line jobs chained as a user runs them."""

from __future__ import annotations

import pytest

from netledger.__main__ import main
from tests.test_ingest import FEE, normal_line, put


def test_files_to_export(spark, tmp_path, capsys):
    dims, run, inbox, out = (str(tmp_path / n) for n in ("dims", "run", "in", "out"))
    main(["load", "--target", dims, "--fees", put(tmp_path / "f.txt", FEE),
          "--codes", put(tmp_path / "c.txt", "0200|00|00|T01|d|B001|0|-1|G|0|20140819141406|loader|||"),
          "--groups", put(tmp_path / "g.txt", "1|1|A|02|M1|1|9|0|t|u|||"),
          "--mappings", put(tmp_path / "m.txt", "1|1|1|1|M1,T1|R1|1|9|0|t|u|||")])
    line = dict(MSG_TYPE="0200", PROC_CODE="00", SER_CONCODE="00", TXN_AMT="100", TRAN_STATUS="1", RESP_CODE="00",
                MID="M1", RSV4="")
    flow = put(tmp_path / "n.txt", normal_line(ID="1", TID="T1", **line), normal_line(ID="2", TID="T2", **line))
    main(["ingest", "--flow", "normal", "--files", flow, "--target", inbox])
    main(["settle", "--flow", "normal", "--dimensions", dims, "--run", run, "--messages", inbox])
    main(["export", "--run", run, "--target", out])
    expected = ["M1, 99.4", "R1, 99.4"]
    assert sorted(r.value for r in spark.read.text(out).collect()) == expected

    streamed = str(tmp_path / "streamed")
    main(["stream", "--flow", "normal", "--dimensions", dims, "--run", streamed, "--messages", inbox, "--once"])
    main(["export", "--run", streamed, "--target", out])
    assert sorted(r.value for r in spark.read.text(out).collect()) == expected

    result = str(tmp_path / "result")
    main(["query", "--flow", "normal", "--run", streamed, "--show", "5", "--target", result,
          "SELECT merNo, n FROM normal_specifics CROSS JOIN (SELECT explode(sequence(1, 300)) AS n) ORDER BY n"])
    assert "R1" in capsys.readouterr().out
    assert spark.read.parquet(result).count() == 600
    with pytest.raises(SystemExit):
        main(["query", "--flow", "normal", "--run", streamed, "SELECT 1"])


def test_ingest_keeps_unusable_lines(spark, tmp_path):
    flow, target = put(tmp_path / "n.txt", normal_line(ID="1"), "too|short"), str(tmp_path / "in")
    main(["ingest", "--flow", "normal", "--files", flow, "--target", target])
    bad = spark.read.parquet(f"{target}_rejects").first()
    assert (bad.line, bad.problem, spark.read.text(target).count()) == ("too|short", "too few columns", 1)
