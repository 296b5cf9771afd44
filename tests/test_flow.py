"""End-to-end cleaning → profiling → classification flow on a small headered CSV."""

import pytest
from pyspark.sql import functions as F

from basalt.operators import clean, profile, tree
from basalt.sources import files, tables

SCHEMA = (
    "blockGroup STRING, marketCategory STRING, vacantLots STRING, ownerOccupied STRING, "
    "medianSalesPrice STRING, unitsPerSquareMile DOUBLE, sales INT"
)


@pytest.fixture()
def housing(spark, tmp_path):
    lines = ["blockGroup,marketCategory,vacantLots,ownerOccupied,medianSalesPrice,unitsPerSquareMile,sales"]
    for i in range(120):
        cat = "Stable" if i % 3 == 0 else ("Middle" if i % 3 == 1 else "Rare")
        if i % 40 == 0:
            cat = "Tiny"
        price = 50000 + (i % 3) * 100000 + i
        units = 0.0 if i % 25 == 7 else float(100 + i)
        lines.append(f"b{i},{cat},{i % 7}%,{50 + i % 9}%,${price},{units},{i % 11}")
    p = tmp_path / "housing.csv"
    p.write_text("\n".join(lines) + "\n")
    return files.read_csv_table(spark, str(p), SCHEMA)


def test_housing_flow(spark, housing):
    assert profile.key_uniqueness(housing, ["blockGroup"]).first()["is_unique"]
    df = housing.drop("blockGroup")
    df = clean.parse_number(df, ["vacantLots", "ownerOccupied"], strip="%")
    df = clean.parse_number(df, ["medianSalesPrice"], strip="$")
    assert clean.parse_failures(housing, ["vacantLots"], "%").first()["n_bad"] == 0
    assert dict(df.dtypes)["medianSalesPrice"] == "double"
    zero = clean.rows_equal(df, "unitsPerSquareMile", 0.0).count()
    df = clean.drop_value(df, "unitsPerSquareMile", 0.0)
    assert zero == 5 and df.count() == 115
    assert all(r["n_null"] == 0 for r in profile.null_counts(df).collect())
    assert all(r["n_negative"] == 0 for r in profile.negative_counts(df).collect())
    vc = [tuple(r) for r in profile.value_counts(df, "marketCategory").collect()]
    assert vc[-1][0] == "Tiny"
    merged = clean.merge_tail(df, "marketCategory", min_count=5)
    assert "Tiny" not in {r[0] for r in merged.select("marketCategory").distinct().collect()}
    codes = [tuple(r) for r in clean.label_codes(merged, "marketCategory").orderBy("code").collect()]
    assert codes == [("Middle", 0), ("Other", 1), ("Rare", 2), ("Stable", 3)]
    feats = ["vacantLots", "ownerOccupied", "medianSalesPrice", "unitsPerSquareMile", "sales"]
    model = tree.fit_tree(merged, feats, "marketCategory", max_depth=10, max_bins=128)
    pred = model.transform(merged)
    cm = tree.confusion_matrix(pred, "marketCategory", "predicted_label")
    assert cm.count() == 16
    acc = pred.agg(F.avg((F.col("marketCategory") == F.col("predicted_label")).cast("double"))).first()[0]
    assert acc > 0.9
    imp = {r["feature"]: r["importance"] for r in tree.importances(model, feats).collect()}
    assert max(imp, key=imp.get) == "medianSalesPrice"
    assert profile.majority_accuracy(merged, "marketCategory").first()["majority_pct"] == pytest.approx(
        round(max(r["count"] for r in profile.value_counts(merged, "marketCategory").collect()) / 115 * 100, 2)
    )
    desc = {r["column"]: r for r in profile.describe_numeric(df, ["sales"]).collect()}
    assert desc["sales"]["min"] == 0 and desc["sales"]["max"] == 10
    rep = {r["column"]: r["type"] for r in profile.schema_report(df).collect()}
    assert rep["vacantLots"] == "double"
    # A column built from units plus noise correlates with units (0.4 < r < 1); the exact
    # copy (r = 1) is excluded by the strict upper bound.
    df2 = df.withColumn("u2", F.col("unitsPerSquareMile") * 2 + F.col("sales") * 10).withColumn("u3", F.col("unitsPerSquareMile"))
    pairs = profile.correlation_pairs(df2, ["unitsPerSquareMile", "u2", "u3", "sales"])
    strong = {(r["col_a"], r["col_b"]) for r in profile.strong_correlations(pairs).collect()}
    assert ("unitsPerSquareMile", "u2") in strong and ("unitsPerSquareMile", "u3") not in strong


def test_catalog_helpers(spark, tmp_path):
    d = tmp_path / "t"
    d.mkdir()
    spark.range(4).write.parquet(str(d / "alpha.parquet"))
    spark.range(2).write.parquet(str(d / "beta.parquet"))
    tabs = tables.register_tables(spark, str(d), ["alpha", "beta"])
    assert sorted(tabs) == ["alpha", "beta"]
    got = {r["table_name"]: r["row_count"] for r in tables.catalog_row_counts(spark).collect()}
    assert got["alpha"] == 4 and got["beta"] == 2
