import json

from ledgercast.operators.models import SearchSettings
from ledgercast.plans import fixtures as fx, run
from ledgercast.session import stage_path

CFG = """
[DEFAULT]
hdfs_project_path = {project}
pnl_detail_table = {ledger}
mega_table = {profile}
pnl_products_info_path = {folder}/products.json
pnl_items_info_path = {folder}/items.json
mega_features_postfix_groups_path = {folder}/groups.json
scores_directory_name = scores_new
sample_clients_hdfs_path = no_path
sample_features_from_mega_path = {folder}/features.json
count_history_months = 3
count_predict_months = 6
report_dt_test_left_border = 1999-09-30
report_dt_test_count = 1
report_dt_train_left_border = 1999-06-30
report_dt_train_count = 1
number_of_epk_bins = 30
epk_left_bin_border_train = 0
epk_bins_count_train = 20
epk_left_bin_border_test = 20
epk_bins_count_test = 10

[ScoringEpkDateConfigGenerating]
report_dt_scoring_left_border = 2001-06-30
report_dt_scoring_count = 1
number_of_epk_bins_scoring = 1
epk_left_bin_border_scoring = 0
epk_bins_count_scoring = 1
"""


def test_train_then_score_from_a_settings_file(spark, sf, tmp_path):
    paths = {name: stage_path(spark, name) for name in ("project", "ledger", "profile")}
    fx.raw_ledger(spark, sf).write.parquet(paths["ledger"])
    months = ["1999-06-30", "1999-09-30", "2001-06-30"]
    import datetime as dt

    fx.raw_profile(spark, sf, [dt.date.fromisoformat(m) for m in months]).write.parquet(paths["profile"])
    (tmp_path / "products.json").write_text(json.dumps({"Card": ["t", list(range(1, 13))], "Loan": ["t", list(range(13, 26))]}))
    (tmp_path / "items.json").write_text(json.dumps({"Fee": [1, 2, 3], "Cost": [4, 5, 6]}))
    (tmp_path / "groups.json").write_text(json.dumps({"categorical": ["cd", "segm", "group"], "numeric": ["amt", "qty"], "date": ["dt"]}))
    (tmp_path / "features.json").write_text(json.dumps(["acctbal_amt", "mkt_segm", "last_order_dt", "empty_rate"]))
    (tmp_path / "run.cfg").write_text(CFG.format(folder=tmp_path, **paths))

    settings = run.RunSettings.read(str(tmp_path / "run.cfg"))
    assert settings.training.history == 3 and settings.scoring.predict == 0 and settings.sample is None
    search = SearchSettings(
        forest_trees=3, forest_depth=2, forest_rows=1.0, depths=(2,), steps=(0.1,), iterations=(2,),
        cutoff_features=10, keep_features=20,
    )
    report = run.run_training(spark, settings, search)
    assert {"test", "all_features", "selected_features"} == {r[0] for r in report.select("scope").distinct().collect()}
    scores = run.run_scoring(spark, settings)
    assert scores.count() == fx.table(spark, sf, "customer").count()
    assert "total_pl_predict" in scores.columns and "Card_sales_pl_predict_probability_calibrated" in scores.columns
    importances = spark.read.parquet(f"{paths['project']}/feature_importances")
    assert importances.select("model").distinct().count() == 7


def test_a_job_section_overrides_the_shared_sample(tmp_path):
    (tmp_path / "products.json").write_text(json.dumps({"Card": ["t", [1]]}))
    (tmp_path / "items.json").write_text(json.dumps({"Fee": [1]}))
    (tmp_path / "groups.json").write_text(json.dumps({"categorical": ["cd"], "numeric": ["amt"], "date": ["dt"]}))
    (tmp_path / "features.json").write_text("[]")
    off = "".join(f"\n[{s}]\nsample_clients_hdfs_path = no_path\n" for s in run.TRAINING_READERS)
    text = CFG.replace("sample_clients_hdfs_path = no_path", "sample_clients_hdfs_path = /clients") + off
    (tmp_path / "run.cfg").write_text(text.format(folder=tmp_path, project="p", ledger="l", profile="m"))
    settings = run.RunSettings.read(str(tmp_path / "run.cfg"))
    assert settings.sample is None and settings.scoring_sample == "/clients"
