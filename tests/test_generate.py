from pyspark.sql import functions as F

from strata.operators import generate
from strata.sources.io import read_batch
from strata.sources.schemas import LANDING_CUSTOMERS, LANDING_SALES


def test_customers_generator(spark):
    df = generate.generate_customers(spark, 10)
    rows = df.orderBy("id").collect()
    assert len(rows) == 10 and rows[0]["id"] == 1001 and rows[-1]["id"] == 1010
    assert rows[0]["name"] == "Customer_1" and rows[0]["email"] == "customer_1@example.com"
    assert all(r["city"] in generate.CITIES and r["state"] in generate.STATES for r in rows)


def test_sales_generator_ranges_and_determinism(spark):
    df = generate.generate_sales(spark, 2000, 5, (10, 100), "2024-03-29")
    stats = df.agg(F.min("price"), F.max("price"), F.min("customer_id"), F.max("customer_id"),
                   F.countDistinct("product"), F.count_distinct("date")).collect()[0]
    assert stats[0] >= 10 and stats[1] < 100
    assert stats[2] >= 1001 and stats[3] <= 1005
    assert stats[4] == 5 and stats[5] == 1
    again = generate.generate_sales(spark, 2000, 5, (10, 100), "2024-03-29", partitions=7)
    assert df.exceptAll(again).count() == 0  # same rows whatever the partitioning
    other_seed = generate.generate_sales(spark, 2000, 5, (10, 100), "2024-03-29", seed=7)
    assert df.exceptAll(other_seed).count() > 0


def test_customer_id_offset_reaches_unknown_customers(spark):
    df = generate.generate_sales(spark, 3000, 5, (10, 100), "2024-01-01", customer_id_offset=5)
    assert df.where("customer_id > 1005").count() > 0


def test_dirty_batch(spark, lake):
    generate.dirty_batch(spark, lake, "2024-01-01")
    paths = lake.paths("2024-01-01")
    sales = read_batch(spark, paths["sales_landing"], "csv", LANDING_SALES)
    customers = read_batch(spark, paths["customers_landing"], "json", LANDING_CUSTOMERS)
    assert sales.count() == 5000 and sales.where("id IS NULL").count() == 51
    assert sales.where("CAST(price AS DOUBLE) < 0").count() > 0
    assert customers.count() == 1000 and customers.where("id IS NULL").count() == 11
    assert customers.where("created_at = '2024-01-01'").count() == 1000


def test_corrupt_batches(spark, lake):
    generate.corrupt_landing(spark, lake, "2024-01-01")
    paths = lake.paths("2024-01-01")
    sales = read_batch(spark, paths["sales_landing"], "csv", LANDING_SALES)
    assert sales.count() == 100 and sales.where("id IS NULL").count() == 10
    assert sales.where("price = '-100.0'").count() == 6
    customers = read_batch(spark, paths["customers_landing"], "json", LANDING_CUSTOMERS)
    assert customers.where("email LIKE 'invalid-email-%'").count() == 50
    generate.corrupt_bronze(spark, lake, "2024-01-01")
    bs = spark.read.parquet(paths["sales_bronze"])
    assert bs.count() == 50 and bs.where("product IS NULL").count() == 10 and bs.where("price = -10.5").count() == 50
    bc = spark.read.parquet(paths["customers_bronze"])
    assert bc.where("customer_id IS NULL").count() == 17


def test_generators_run_on_table_keys(spark):
    from strata.sources.testdata import SF_SMALL, table
    keys = table(spark, SF_SMALL, "orders").select((F.col("o_orderkey") + 1).alias("i"))
    s = generate.sales_from_index(keys, 100, (10.0, 20.0), "2024-01-01")
    assert s.count() == keys.count()
