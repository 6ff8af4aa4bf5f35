"""The command line drives the same lanes."""

from __future__ import annotations

import json
import uuid

import pytest

from starmart import contract
from starmart.__main__ import main
from starmart.config import MartConfig
from starmart.plans.mart import GoldTables, write_table
from tests.conftest import rows, sale


def test_table_list():
    assert contract.table_list(" uom_uom, crm_team ,,uom_uom") == ["crm_team", "uom_uom"]
    with pytest.raises(ValueError, match="nope"):
        contract.table_list("uom_uom,nope")


def test_load_build_and_changes(spark, bronze, tmp_path, capsys):
    tag = uuid.uuid4().hex[:8]
    erp, lake = f"erp_{tag}", f"lake_{tag}"
    spark.sql(f"CREATE SCHEMA {erp}")
    o, ln = sale(1, 10)
    tables = dict(bronze(sale_order=[o], sale_order_line=[ln]))
    last = tables.pop("uom_uom")
    for name, df in tables.items():
        write_table(df, f"{erp}.{name}")
    landed = str(tmp_path / "landed")

    assert main(["check", "--source-schema", erp]) == 1
    assert "uom_uom" in capsys.readouterr().out
    with pytest.raises(contract.MissingTables):
        main(["land", "--source-schema", erp, "--folder", landed])

    write_table(last, f"{erp}.uom_uom")
    assert main(["check", "--source-schema", erp]) == 0
    assert "17/17" in capsys.readouterr().out
    assert main(["load", "--source-schema", erp, "--folder", landed, "--bronze-schema", lake]) == 0
    assert main(["build", "--bronze-schema", lake]) == 0
    assert "status_is_known" in capsys.readouterr().out
    gold = GoldTables(spark, MartConfig.for_target("dev"))
    assert rows(gold.fact_sales.select("order_id", "order_status")) == [(1, "sale")]

    (tmp_path / "feed").mkdir()
    gone = {"table": "sale_order_line", "op": "D", "lsn": 5, "id": "1"}
    (tmp_path / "feed" / "1.json").write_text(json.dumps(gone) + "\n")
    lane = str(tmp_path / "lane")
    assert main(["ingest", "--lane", lane, "--feed", str(tmp_path / "feed")]) == 0
    assert main(["apply", "--lane", lane, "--folder", landed, "--bronze-schema", lake]) == 0
    assert spark.table(f"{lake}.sale_order_line").count() == 0
    assert spark.table(f"{lake}.sale_order").count() == 1

    later = str(tmp_path / "later")
    advance = ["advance", "--lane", lane, "--folder", landed, "--new-folder", later, "--position"]
    assert main([*advance, "5"]) == 0
    again = ["apply", "--lane", lane, "--folder", later, "--bronze-schema", lake]
    assert main([*again, "--snapshot-lsn", "5"]) == 0
    assert spark.table(f"{lake}.sale_order_line").count() == 0
    assert spark.table(f"{lake}.sale_order").count() == 1
