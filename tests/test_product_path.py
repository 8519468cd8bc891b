"""CSV and zip in, features and reports out, on the full column layout."""

import csv
import datetime as dt
import io
import zipfile

import pytest

from shelfwise.config import PreprocessingConfig, ProjectConfig
from shelfwise.operators.quality import quality_report
from shelfwise.plans import pipeline as P
from shelfwise.sources.files import read_sales, read_sales_zips, read_stock, stock_from_frame

HEADER = ["Date", "Store ID", "Product ID", "Category", "Region", "Inventory Level", "Units Sold", "Units Ordered",
          "Demand Forecast", "Price", "Discount", "Weather Condition", "Holiday", "Promotion", "Competitor Pricing", "Seasonality"]
CFG = ProjectConfig(preprocessing=PreprocessingConfig(min_history_days=20), forecast_revenue=True)


def sales_rows(days=40):
    rows = []
    for i in range(days):
        d = dt.date(2022, 1, 1) + dt.timedelta(days=i)
        text = d.strftime("%m/%d/%Y") if i % 7 == 0 else d.isoformat()
        for s in ("S001", "S002"):
            for p, c in (("P0001", "Groceries"), ("P0002", "Toys")):
                # one odd category on some days: repaired to the modal one, key and stock alike
                cat = "Furniture" if p == "P0002" and i % 9 == 4 else c
                units = "n/a" if i == 11 and s == "S001" else str(20 + i % 5 + (5 if p == "P0002" else 0))
                rows.append([text, s, p, cat, "North", str(100 + i), units, str(40 + i % 3), "30.5", "9.99", "5",
                             "Sunny" if i % 3 else "Rainy", str(int(i % 10 == 0)), str(i % 2), "10.5", "Winter"])
    rows += [rows[0], ["not a date", *rows[1][1:]], [rows[2][0], "S001", "", "Toys", *rows[2][4:]]]
    return rows


def text_of(rows, header=HEADER):
    out = io.StringIO()
    csv.writer(out).writerows([header, *rows])
    return out.getvalue()


@pytest.fixture(scope="module")
def csv_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("sales") / "sales.csv"
    path.write_text(text_of(sales_rows()))
    return str(path)


def test_preprocess_takes_stock_from_its_column(spark, csv_path):
    labelled, stock = P.preprocess(read_sales(spark, csv_path), CFG)
    got = {r["product_key"]: (r["current_stock"], r["stock_source"]) for r in stock.collect()}
    assert got == {"P0001_Groceries": (139.0, "dataset column: inventory_level"),
                   "P0002_Toys": (139.0, "dataset column: inventory_level")}
    assert labelled.count() == 2 * 2 * 40  # repaired categories meet in one series
    row = labelled.where("product_id = 'P0001' and date = '2022-01-08' and store_id = 'S001'").first()
    assert (row["is_holiday"], row["is_promotion"], row["units_ordered"], row["discount"], row["competitor_pricing"]) == (
        0, 1, 41.0, 5.0, 10.5)
    assert labelled.where("is_train").count() == int(160 * 0.8)


def test_run_writes_every_report(spark, csv_path, tmp_path):
    out = P.run(read_sales(spark, csv_path), CFG, models=("linear_regression",), out_dir=str(tmp_path))
    assert {r["product_key"] for r in out["recommendations"].collect()} == {"P0001_Groceries", "P0002_Toys"}
    for name in out:
        assert (tmp_path / name / "_SUCCESS").exists(), name
    assert (tmp_path / "models" / "linear_regression" / "metadata").exists()


def test_zip_equals_csv(spark, csv_path, tmp_path):
    rows = sales_rows()
    for i, part in enumerate((rows[:70], rows[70:])):
        with zipfile.ZipFile(tmp_path / f"a{i}.zip", "w") as z:
            z.writestr("deep/other.csv", "x,y\n1,2\n")
            z.writestr("sales.csv", text_of(part))
    zipped = read_sales_zips(spark, f"{tmp_path}/*.zip")
    plain = read_sales(spark, csv_path)
    assert set(zipped.columns) == set(plain.columns)
    order = sorted(plain.columns)
    assert sorted(map(str, zipped.select(order).collect())) == sorted(map(str, plain.select(order).collect()))
    report = {r["metric"]: r["value"] for r in quality_report(zipped).collect()}
    assert (report["input_rows"], report["bad_dates"], report["missing_product_id"], report["duplicates_removed"],
            report["units_sold_converted"], report["inconsistent_products"]) == (163, 1, 1, 1, 2, 1)
    labelled, _ = P.preprocess(zipped, CFG)
    assert labelled.count() == 160


def test_zip_columns_are_united_and_checked(spark, tmp_path):
    rows = sales_rows(3)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("s.csv", text_of(rows))
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("s.csv", text_of([[*r, "x"] for r in rows], [*HEADER, "Extra Note"]))
    got = read_sales_zips(spark, f"{tmp_path}/*.zip")
    assert "extra_note" in got.columns and got.where("extra_note is null").count() == got.count() / 2
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("s.csv", text_of([r[1:] for r in rows], HEADER[1:]))
    with pytest.raises(ValueError, match="missing required columns"):
        read_sales_zips(spark, f"{tmp_path}/*.zip")


def test_no_parseable_date_is_the_error_reported(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(text_of([["??", *r[1:]] for r in sales_rows(3)]))
    with pytest.raises(ValueError, match="Failed to parse"):
        P.preprocess(read_sales(spark, str(path)), CFG)
    path = tmp_path / "short.csv"
    path.write_text(text_of(sales_rows(3)))
    with pytest.raises(ValueError, match="20 days of history"):
        P.preprocess(read_sales(spark, str(path)), CFG)


def test_stock_file_keeps_the_last_row_of_a_product(spark, tmp_path):
    path = tmp_path / "stock.csv"
    path.write_text("Product ID,Category,current_stock\nP1,Food,5\nP2,Toys,n/a\nP1,Food,3\nP3,Food,-4\nP2,Toys,\n")
    got = {r["product_key"]: r["current_stock"] for r in read_stock(spark, str(path)).collect()}
    assert got == {"P1_Food": 3.0, "P2_Toys": 0.0, "P3_Food": 0.0}
    df = spark.createDataFrame([("P1", "Food", 1.0), ("P1", "Food", 4.0)], "product_id string, category string, current_stock double")
    assert stock_from_frame(df).collect()[0]["current_stock"] == 4.0
