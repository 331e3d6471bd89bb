import pytest
from pyspark.sql import functions as F

from terrace.sources import landing


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_csv_scan_keeps_text_partition_and_source_file(spark, tmp_path):
    _write(tmp_path / "orders/batch_date=2024-01-02/a.csv",
           "order_id,customer_id,product_id,ordered_at,quantity,unit_price,discount_pct,channel,status,currency\n"
           "O1,C1,P1,2024-01-02T10:00:00+00:00,2,10.50,0.1,WEB,COMPLETED,USD\n"
           "O2,C1,P1,bad,abc,,0.1,WEB,COMPLETED,USD\n"
           "O3,C1\n")
    df = landing.scan(spark, str(tmp_path), "orders")
    rows = {r.order_id: r for r in df.collect()}
    assert str(rows["O1"].batch_date) == "2024-01-02" and (rows["O1"].quantity, rows["O1"].unit_price) == ("2", "10.50")
    assert rows["O2"].quantity == "abc" and rows["O2"].unit_price is None  # bad values keep their text
    assert rows["O3"].product_id is None and rows["O3"]._corrupt_record == "O3,C1"  # short row padded with NULLs
    assert rows["O1"]._corrupt_record is None and rows["O2"]._corrupt_record is None
    assert rows["O1"]._source_file.endswith("a.csv")
    assert landing.scan(spark, str(tmp_path), "orders", since="2024-01-03").count() == 0


def test_csv_scan_rejects_swapped_header(spark, tmp_path):
    _write(tmp_path / "customers/batch_date=2024-01-01/a.csv",
           "full_name,customer_id,email,city,country,segment,signup_date,updated_at\n"
           "Ann,C1,a@b.c,X,Y,Z,2024-01-01,2024-01-01\n")
    with pytest.raises(Exception):
        landing.scan(spark, str(tmp_path), "customers").collect()


def test_json_scan_keeps_digits_and_broken_lines(spark, tmp_path):
    _write(tmp_path / "products/batch_date=2024-01-01/a.json",
           '{"product_id":"P1","unit_cost":1.50100000000000000000001,"list_price":2,"active":true}\n{broken\n'
           '{"product_id":"P2","unit_cost":"x"}\n')
    rows = landing.scan(spark, str(tmp_path), "products").orderBy(F.col("product_id").asc_nulls_first()).collect()
    assert [r.product_id for r in rows] == [None, "P1", "P2"]
    assert [r._corrupt_record for r in rows] == ["{broken", None, None]
    assert [(r.unit_cost, r.list_price, r.active) for r in rows[1:]] == [("1.50100000000000000000001", "2", "true"), ("x", None, None)]


def test_delivery_round_trip_is_lossless(spark, tmp_path):
    df = spark.createDataFrame(
        [(" c1", "Name ", None, "City", "Co", "Seg", "not-a-date", "x", "2024-01-01")],
        "customer_id string, full_name string, email string, city string, country string, segment string, "
        "signup_date string, updated_at string, batch_date string",
    ).withColumn("batch_date", F.col("batch_date").cast("date"))
    landing.write_delivery(df, str(tmp_path), "customers")
    back = landing.scan(spark, str(tmp_path), "customers", with_source_file=False)
    assert [tuple(r) for r in back.drop("_corrupt_record").collect()] == [tuple(r) for r in df.collect()]


def test_bronze_from_landing_prunes_target_partitions(spark, tmp_path):
    import datetime as dt

    from terrace.plans import bronze as B
    from terrace.plans import lakehouse as L

    root = tmp_path / "landing"
    for day, ids in (("2024-01-01", ["O1", "O2"]), ("2024-01-02", ["O3"])):
        lines = "".join(f"{i},C1,P1,{day} 10:00:00,1,2.00,0.0,WEB,COMPLETED,USD\n" for i in ids)
        _write(root / f"orders/batch_date={day}/part.csv",
               "order_id,customer_id,product_id,ordered_at,quantity,unit_price,discount_pct,channel,status,currency\n"
               + lines)
    lake = L.Lakehouse(str(tmp_path / "lake"))
    at = dt.datetime(2024, 1, 3)
    first = L.run_bronze(spark, lake, {"orders": B.stamped_delivery(spark, str(root), "orders", "b1", at)},
                         {"orders": ["batch_date"]})
    assert first[0]["rows_inserted"] == 3
    # replay only the second delivery: the merge reads only that Bronze partition
    replay = B.stamped_delivery(spark, str(root), "orders", "b2", at, since="2024-01-02")
    target = spark.read.parquet(lake.path("bronze", "orders"))
    new = B.new_records(target, replay)
    assert new.count() == 0
    plan = new._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert "PartitionFilters: [isnotnull(batch_date" in plan and "2024-01-02" in plan


HEADER = "order_id,customer_id,product_id,ordered_at,quantity,unit_price,discount_pct,channel,status,currency\n"


def test_prices_that_differ_in_a_tenth_of_a_cent_are_different_records_with_exact_amounts(spark, tmp_path):
    import datetime as dt
    from decimal import Decimal

    from terrace.plans import bronze as B
    from terrace.plans import silver as S

    lines = ["O1,C1,P1,2024-01-02 10:00:00,3,10.501,0.1,WEB,COMPLETED,USD", "O1,C1,P1,2024-01-02 10:00:00,3,10.502,0.1,WEB,COMPLETED,USD",
             "O2,C1,P1,2024-01-02 10:00:00,two,10.5,0.1,WEB,COMPLETED,USD", "O3,C1,P1,2024-01-02 10:00:00,2.5,10.5,0.1,WEB,COMPLETED,USD",
             "O4,C1,P1,2024-01-02 10:00:00,2.0,10.50001,0.1,WEB,COMPLETED,USD", "O5,C1,P1,2024-01-02 10:00:00,,10.5,0.1,WEB,COMPLETED,USD", "O6,C1",
             "O7,C1,P1,2024-01-02 10:00:00,3,10.5015,0.1,WEB,COMPLETED,USD", "O8,C9,P1,2024-01-02 10:00:00,two,10.5,x,WEB,COMPLETED,USD"]
    _write(tmp_path / "orders/batch_date=2024-01-02/a.csv", HEADER + "\n".join(lines) + "\n")
    bronze = B.stamped_delivery(spark, str(tmp_path), "orders", "b1", dt.datetime(2024, 1, 3))
    assert bronze.select("_record_hash").distinct().count() == len(lines)
    customers = spark.createDataFrame([("C1", True)], "customer_id string, is_current boolean")
    products = spark.createDataFrame([("P1",)], "product_id string")
    classified = S.orders_classified(S.orders_checked(bronze, customers, products))
    reasons = {r.order_id: r._quarantine_reason for r in classified.collect()}
    assert reasons == {"O1": None, "O2": "UNREADABLE_VALUE", "O3": "UNREADABLE_VALUE", "O4": "UNREADABLE_VALUE", "O5": "MISSING_MEASURE",
                       "O6": "CORRUPT_RECORD", "O7": None, "O8": "UNKNOWN_CUSTOMER"}
    o7 = classified.filter("order_id = 'O7'").first()
    assert (o7.unit_price, o7.gross_amount, o7.net_amount) == (Decimal("10.5015"), Decimal("31.50"), Decimal("28.35"))
    payloads = {r._quarantine_reason: r._payload for r in S.orders_quarantine(classified, dt.date(2024, 1, 3)).collect()}
    assert '\\"_corrupt_record\\":\\"O6,C1\\"' in payloads["CORRUPT_RECORD"]


def test_quarantined_customer_and_product_keep_their_source_values(spark, tmp_path):
    import datetime as dt
    import json

    from terrace.plans import bronze as B
    from terrace.plans import silver as S

    _write(tmp_path / "customers/batch_date=2024-01-01/a.csv",
           "customer_id,full_name,email,city,country,segment,signup_date,updated_at\n c1 ,Ann,nobody,X,Y,Z,the 5th of May,2024-01-01\n")
    _write(tmp_path / "products/batch_date=2024-01-01/a.json",
           '{"product_id":"P1","unit_cost":1.00001,"list_price":2,"active":true}\n{"product_id":"P2","unit_cost":1\n'
           '{"product_id":"P3","unit_cost":-1,"list_price":2,"active":true}\n{"product_id":"p4","unit_cost":1e1,"list_price":2.5,"active":"perhaps"}\n'
           '{"product_id":"p5","unit_cost":1e1,"list_price":2.5,"active":false}\n')
    at, day = dt.datetime(2024, 1, 3), dt.date(2024, 1, 3)
    customers = S.customers_classified(B.stamped_delivery(spark, str(tmp_path), "customers", "b1", at))
    payload = json.loads(S.customers_quarantine(customers, day).first()._payload)
    assert "signup_date" not in payload and json.loads(payload["_raw"])["signup_date"] == "the 5th of May"
    assert payload["customer_id"] == "C1" and json.loads(payload["_raw"])["customer_id"] == " c1 "
    products = S.products_classified(B.stamped_delivery(spark, str(tmp_path), "products", "b1", at))
    assert [(r.product_id, str(r.unit_cost), r.active) for r in S.products_valid(products).collect()] == [("P5", "10.0000", False)]
    raw = {json.loads(r._payload).get("product_id"): (r._quarantine_reason, json.loads(json.loads(r._payload)["_raw"])) for r in S.products_quarantine(products, day).collect()}
    assert {k: v[0] for k, v in raw.items()} == {"P1": "UNREADABLE_VALUE", None: "CORRUPT_RECORD", "P3": "INVALID_PRODUCT", "P4": "UNREADABLE_VALUE"}
    assert raw["P1"][1]["unit_cost"] == "1.00001" and raw[None][1] == {"_corrupt_record": '{"product_id":"P2","unit_cost":1'} and raw["P4"][1]["active"] == "perhaps"


def test_all_feeds_of_a_landing_zone_go_to_bronze_in_one_call(spark, tmp_path):
    from terrace.plans import bronze as B
    from terrace.plans import lakehouse as L

    root = tmp_path / "landing"
    for day in ("2024-01-01", "2024-01-02"):
        _write(root / f"orders/batch_date={day}/a.csv", HEADER + f"O{day},C1,P1,{day} 10:00:00,1,2.00,0.0,WEB,COMPLETED,USD\n")
        _write(root / f"products/batch_date={day}/a.json", '{"product_id":"P1","unit_cost":1.5,"list_price":2,"active":true}\n{broken\n')
        _write(root / f"customers/batch_date={day}/a.csv",
               "customer_id,full_name,email,city,country,segment,signup_date,updated_at\nc1,Ann,a@b.c,X,Y,Z,2024-01-01,2024-01-01\n")
    lake = L.Lakehouse(str(tmp_path / "lake"))
    sc = spark.sparkContext
    sc.setJobGroup("dates", "dates")
    assert B.delivery_dates(spark, str(root), "orders") == ["2024-01-01", "2024-01-02"]
    assert B.delivery_dates(spark, str(root), "orders", "2024-01-02") == ["2024-01-02"]
    assert list(sc.statusTracker().getJobIdsForGroup("dates")) == []
    sc.setJobGroup("rest", "rest")
    out = L.ingest_landing(spark, lake, str(root))
    assert [(r["entity"], r["rows_seen"], r["rows_inserted"]) for r in out] == [("customers", 2, 2), ("products", 4, 4), ("orders", 2, 2)]
    again = L.ingest_landing(spark, lake, str(root), since="2024-01-02")
    assert [(r["rows_seen"], r["rows_inserted"]) for r in again] == [(1, 0), (2, 0), (1, 0)]
    products = spark.read.parquet(lake.path("bronze", "products"))
    assert sorted(r._corrupt_record or "" for r in products.collect()) == ["", "", "{broken", "{broken"]
    assert (tmp_path / "lake/bronze/orders/batch_date=2024-01-01").is_dir()
    import re

    assert {bool(re.fullmatch(r"\d{8}T\d{6}Z", r._batch_id)) for r in products.collect()} == {True}
