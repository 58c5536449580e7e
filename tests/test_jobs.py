import json

from jobs.run_medallion import main


def test_cli_generate_run_dashboard_corrupt(spark, lake, capsys):
    base = ["--root", lake.root, "--date", "2026-04-19"]
    assert main(base + ["generate", "clean", "--customers", "40", "--sales", "400"]) == 0
    assert main(base + ["run"]) == 0
    steps = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert [s["status"] for s in steps] == ["success"] * 5
    assert main(base + ["dashboard"]) == 0
    kpis = json.loads(capsys.readouterr().out.splitlines()[0])
    assert kpis["total_orders"] == 400
    assert main(base + ["ingest"]) == 0
    capsys.readouterr()
    assert main(base + ["report"]) == 0
    report = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert len(report) == 7 and all(r["success"] for r in report)
    assert main(base + ["corrupt", "landing"]) == 0
    assert main(base + ["run", "--steps", "stg_sales_bronze"]) == 2
    failed = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert failed["status"] == "target_fail" and "reason=target_fail_stg_sales_bronze" in failed["quarantine_path"]


def test_cli_exports_suites(tmp_path, capsys):
    from strata.plans import medallion

    assert main(["--root", str(tmp_path), "--date", "2026-04-19", "suites", "--out", str(tmp_path / "s")]) == 0
    assert len(capsys.readouterr().out.splitlines()) == 6
    assert medallion.load_suites(str(tmp_path / "s")) == medallion.suites()
