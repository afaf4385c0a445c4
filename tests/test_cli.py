"""The command line on derived inputs."""

import os

from conftest import SF001
from emberwall import cli
from emberwall.fixtures import fw_raw, log_lines
from emberwall.session import shared_dir
from emberwall.sinks.files import dedup_folders
from emberwall.sources.csv import scan_csv


def test_classify_and_curate(spark, capsys):
    src = shared_dir(spark, "t-cli-csv")
    fw_raw(spark, SF001).coalesce(2).write.option("header", True).option("escape", '"').csv(src)
    out = shared_dir(spark, "t-cli-out")
    assert cli.main(["classify", f"{src}/*.csv", out]) == 0
    stats = capsys.readouterr().out
    assert '"attacks"' in stats
    assert scan_csv(spark, out).count() == fw_raw(spark, SF001).count()
    base = shared_dir(spark, "t-cli-cur")
    assert cli.main(["curate", f"{src}/*.csv", base]) == 0
    for t in ("firewall_logs", "firewall_stats_hourly", "firewall_top_ports", "firewall_suspicious_ips"):
        assert spark.read.parquet(f"{base}/{t}").count() > 0


def test_land_and_upsert(spark):
    src = shared_dir(spark, "t-cli-lines")
    log_lines(spark, SF001).write.text(src)
    land = shared_dir(spark, "t-cli-land")
    assert cli.main(["land", src, land]) == 0
    assert cli.main(["land", src, shared_dir(spark, "t-cli-land2"), "--stream"]) == 0
    table = shared_dir(spark, "t-cli-dedup")
    assert cli.main(["upsert", src, table]) == 0
    assert spark.read.parquet(table).count() > 0
    assert cli.main(["upsert", src, table, "--stream", "--max-records-per-trigger", "700"]) == 0
    assert cli.main(["compact", table]) == 0
    assert all(len(batches) == 1 for batches in dedup_folders(spark, table).values())
