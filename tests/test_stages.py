import pytest

from ledgercast.session import shared_folder, stage_path
from ledgercast.sources.ledger import scan_ledger
from ledgercast.sources.stages import score_sink, stage_read, stage_write, staged


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert stage_path(spark, "x") != stage_path(spark, "x")


def test_a_stage_is_written_once(spark):
    path = stage_write(spark.range(5), stage_path(spark, "five"))
    assert stage_read(spark, path).count() == 5
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        stage_write(spark.range(5), path)


def test_staged_cuts_the_lineage_and_keeps_the_columns(spark):
    source = spark.range(10).selectExpr("id % 2 AS `k_-1`", "id AS v", "date'2020-06-30' AS report_dt")
    out = staged(source, stage_path(spark, "parts"), "report_dt")
    assert out.columns == source.columns and out.schema["report_dt"].dataType == source.schema["report_dt"].dataType
    assert "Range" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.exceptAll(source).isEmpty()


def test_score_sink(spark):
    path = score_sink(spark.range(3), stage_path(spark, "project"), "scores")
    assert path.endswith("/scores") and spark.read.parquet(path).count() == 3


def test_ledger_from_path_and_table(spark, tmp_path):
    rows = spark.sql(
        "SELECT 1L AS client_id, date'2020-06-30' AS report_date, 1 AS product_cd, 2 AS pl_item, 1.25D AS pl_val, 'x' AS other"
    )
    rows.write.parquet(str(tmp_path / "l"))
    rows.createOrReplaceTempView("some_ledger")
    for source in (str(tmp_path / "l"), "some_ledger", rows):
        ledger = scan_ledger(spark, source)
        assert ledger.columns == ["epk_id", "report_dt", "product_cd", "pl_item", "pl_val"]
        assert dict(ledger.dtypes)["pl_val"] == "decimal(18,4)"
