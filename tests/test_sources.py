import pytest

from riskframe.plans import etl
from riskframe.sources import canonical, tables


def test_csv_round_trip(spark, sf, tmp_path):
    tx = canonical.transactions(spark, sf).select(*tables.ECOMMERCE_SCHEMA.names)
    tables.save(tx, str(tmp_path / "raw" / "Fraud_Data.csv"), "csv", timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS")
    back = tables.load_transactions(spark, str(tmp_path))
    assert back.dtypes == tx.dtypes and back.exceptAll(tx).count() == 0


def test_plain_csv(spark, tmp_path):
    path = tmp_path / "IpAddress_to_Country.csv"
    path.write_text("lower_bound_ip_address,upper_bound_ip_address,country\n16777216.0,16777471,Australia\n")
    r = tables.load_ip_ranges(spark, str(tmp_path), subdirectory=".").first()
    assert (r[0], r[1], r[2]) == (16777216, 16777471, "Australia")
    bank = tmp_path / "creditcard.csv"
    bank.write_text('"Time","V1","Amount","Class"\n0,-1.3,149.62,"0"\n')
    assert tables.load_bank(spark, str(tmp_path), subdirectory=".").first()["Class"] == 0


def test_load_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.load_csv(spark, str(tmp_path / "nothing.csv"))
    header = tmp_path / "header.csv"
    header.write_text("a,b\n")
    with pytest.raises(ValueError, match="empty"):
        tables.load_csv(spark, str(header))
    full = tmp_path / "full.csv"
    full.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="Missing required"):
        tables.load_csv(spark, str(full), required=["a", "c"])
    blank = tmp_path / "blank.csv"
    blank.write_text("")
    with pytest.raises(ValueError, match="empty"):
        tables.load_csv(spark, str(blank))


def test_save_refuses_nothing(spark, tmp_path):
    with pytest.raises(ValueError, match="None"):
        tables.save(None, str(tmp_path / "x"))
    with pytest.raises(ValueError, match="empty"):
        tables.save(spark.range(0), str(tmp_path / "x"))


def test_checks(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (2, None), (3, 2)], "a int, class int")
    assert tables.check_table(df, 2, ["a"], True).first()["duplicate_count"] == 1
    with pytest.raises(ValueError, match="minimum required"):
        tables.check_table(df, 9)
    with pytest.raises(ValueError, match="Missing"):
        tables.check_table(df, required=["z"])
    with pytest.raises(ValueError, match="empty"):
        tables.check_table(df.limit(0))
    r = tables.check_target(df, "class").first()
    assert (r["n_rows"], r["null_targets"], r["distinct_labels"], r["is_binary"]) == (4, 1, 2, True)
    with pytest.raises(ValueError, match="not found"):
        tables.check_target(df, "label")
    assert tables.check_inputs(df, "class", ["a"]).count() == 2
    with pytest.raises(ValueError, match="Missing"):
        tables.check_inputs(df, "class", ["b"])


def test_stages(spark, sf, tmp_path):
    paths = etl.run_stages(canonical.transactions(spark, sf), canonical.ip_ranges(spark, sf), ["event_id"], str(tmp_path))
    sizes = {r["stage"]: r["n_rows"] for r in etl.stage_sizes(spark, paths).collect()}
    n = canonical.transactions(spark, sf).count()
    assert sizes["cleaned"] == sizes["with_country"] == sizes["feature_engineered"] == sizes["transformed"] == n
    train = spark.read.parquet(paths["train_resampled"])
    assert train.where("copy = 0").count() + sizes["test"] == n if "copy" in train.columns else True
