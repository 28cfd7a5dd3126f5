"""Properties that must hold for any size and skew of the data."""

from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import dims, facts, keys, lookups, quality, staging_xml
from ledgerloom.operators.facts import FIRST_SEEN
from ledgerloom.plans import reports
from ledgerloom.plans.store import TableStore
from ledgerloom.session import fresh_path
from ledgerloom.sources import csv_files, documents, files, formats

AS_OF = "2025-01-15 10:00:00"
BATCH = "BATCH_1"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_are_dropped_before_the_shuffle(spark):
    hot = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
    kept = keys.keep_first(hot, ["k"], ["id"])
    text = plan(kept)
    partial, exchange = text.index("Partial"), text.index("Exchange hashpartitioning")
    assert exchange < partial, "the limit runs below the exchange"
    assert kept.count() == 20001
    assert kept.filter("k = -1").first()["id"] == 0


def test_missing_keys_are_spread_and_match_nothing(spark):
    rows = spark.range(9000).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("K"), (F.col("id") % 7).cast("string"))).alias("customer_id"))
    spread = rows.select(lookups.spread_missing_keys("customer_id", ["id"]).alias("k")).filter(F.col("k").startswith("\x00"))
    assert spread.select("k").distinct().count() > 500
    dim = spark.createDataFrame([(1, "K1", True), (-1, "UNKNOWN", True), (9, "K1", False)], "customer_sk bigint, customer_id string, is_current boolean")
    joined = lookups.join_dim_customer_current(rows, dim, ["id"])
    assert joined.count() == 9000
    assert joined.filter("customer_id IS NULL AND customer_sk != -1").count() == 0
    assert joined.filter("customer_id = 'K1' AND customer_sk != 1").count() == 0


@pytest.mark.parametrize("n, files", [(10, 1), (1000, 1), (1001, 2), (30_000, 30)])
def test_surrogate_key_files_follow_the_rows(spark, monkeypatch, n, files):
    """Files of like size for any number of rows, under one setting."""
    monkeypatch.setattr(keys, "ROWS_PER_FILE", 1000)
    rows = keys.assign_surrogate_keys(spark.range(n).select(F.col("id").cast("string").alias("k")), "sk", ["k"])
    assert rows.select("sk").distinct().count() == n == rows.agg(F.max("sk")).first()[0]
    per_file = [pq.ParquetFile(f.removeprefix("file://")).metadata.num_rows for f in rows.inputFiles()]
    assert len(per_file) == files and max(per_file) < 1300


@pytest.mark.parametrize("rows_per_file", [100_000, 1700, 300])
@pytest.mark.parametrize("partitions", ["1", "16"])
def test_surrogate_keys_do_not_depend_on_partitioning(spark, monkeypatch, partitions, rows_per_file):
    monkeypatch.setattr(keys, "ROWS_PER_FILE", rows_per_file)
    rows = spark.range(5000).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("k"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    expected = {r["k"]: i + 11 for i, r in enumerate(rows.orderBy(F.md5("k"), "k").collect())}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r["k"]: r["sk"] for r in keys.assign_surrogate_keys(rows.repartition(7), "sk", ["k"], 10).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == expected


def test_bounded_surrogate_keys_are_written_once_without_their_digest(spark, monkeypatch):
    monkeypatch.setattr(keys, "ROWS_PER_FILE", 300)
    rows = spark.range(1000).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("k"))
    numbered = keys.assign_surrogate_keys(rows, "sk", ["k"], 10, at_most=1500)
    expected = {r["k"]: i + 11 for i, r in enumerate(rows.orderBy(F.md5("k"), "k").collect())}
    assert {r["k"]: r["sk"] for r in numbered.collect()} == expected
    files = [Path(f.removeprefix("file://")) for f in numbered.inputFiles()]
    assert len(files) == 5 and not (files[0].parent.parent / "rows").exists()
    assert "_digest" not in pq.read_schema(files[0]).names


def test_an_empty_fact_needs_no_tasks(spark):
    rows = spark.range(10).select(F.col("id").cast("string").alias("order_id"))
    left = lookups.anti_join_existing(rows, facts.empty_fact(spark, facts.FACT_ORDER), ["order_id"])
    assert "Join" not in plan(left) and left.count() == 10


def test_lines_go_through_one_exchange_for_header_and_first_line(spark, tmp_path, monkeypatch):
    """The first line per key wins, also where a line comes twice and headers are many."""
    line = {**{n: None for n in staged_item_columns()}, "quantity": 1, "quantity_abs": 1}
    seen = [("T1", 1, 2, "late"), ("T1", 1, 1, "first"), ("T1", 2, 1, "x"), ("T9", 1, 1, "no header"), ("", 1, 1, "none"), (None, 1, 1, "none")]
    flags = {n: False for n in line if n.startswith("is_")}
    items = [{**line, **flags, "transaction_id": t, "line_number": n, "raw_record_id": r, "description": d, "source_file_name": "f", "batch_id": "B"} for t, n, r, d in seen]
    items_a = spark.createDataFrame([[i[n] for n in staged_item_columns()] for i in items], ", ".join(f"{n} {t}" for n, t in staged_item_columns().items()))
    items_c = items_a.filter("false").withColumn("item_metadata_json", F.lit(None).cast("string"))
    headers = spark.createDataFrame([("T1", "ClientA", 7, 20250101)], "transaction_id string, source_client string, transaction_sk bigint, order_date_sk bigint")
    products = dims.new_dimension(spark, dims.PRODUCT, AS_OF)
    before = {}
    monkeypatch.setattr(facts, "assign_surrogate_keys", lambda rows, *a: before.setdefault("rows", rows).withColumn("transaction_item_sk", F.lit(1).cast("bigint")))
    got = facts.load_fact_transaction_item(items_a, items_c, headers.hint("merge"), products, facts.empty_fact(spark, facts.FACT_ITEM), AS_OF)
    assert sorted((r["transaction_sk"], r["line_number"], r["description"]) for r in got.collect()) == [(7, 1, "first"), (7, 2, "x")]
    by_line = [e for e in plan(before["rows"]).splitlines() if "Exchange hashpartitioning" in e and "line_number" in e]
    assert by_line == [], "no exchange for the first line alone"


def test_what_follows_from_other_columns_is_not_shuffled_with_keys(spark, monkeypatch):
    columns = staged_item_columns()
    line = {**{n: False if n.startswith("is_") else None for n in columns}, "transaction_id": "T1", "line_number": 1, "quantity": -2, "quantity_abs": 2,
            "unit_price": Decimal("1.5"), "unit_price_abs": Decimal("1.5"), "raw_record_id": 1, "is_negative_quantity": True}
    items_a = spark.createDataFrame([[line[n] for n in columns]], ", ".join(f"{n} {t}" for n, t in columns.items()))
    items_c = items_a.filter("false").withColumn("item_metadata_json", F.lit(None).cast("string"))
    headers = spark.createDataFrame([("T1", "ClientA", 7, 20250101)], "transaction_id string, source_client string, transaction_sk bigint, order_date_sk bigint")
    shuffled = []
    monkeypatch.setattr(facts, "assign_surrogate_keys", lambda rows, sk, *a: (shuffled.extend(rows.columns), keys.assign_surrogate_keys(rows, sk, *a))[1])
    got = facts.load_fact_transaction_item(
        items_a, items_c, headers, dims.new_dimension(spark, dims.PRODUCT, AS_OF), facts.empty_fact(spark, facts.FACT_ITEM), AS_OF
    )
    assert got.columns == facts.FACT_ITEM
    row = got.first()
    assert (row["line_total_abs"], row["dq_status"], row["has_negative_quantity"], row["has_negative_price"]) == (Decimal("3"), "INVALID" if row["is_missing_sku"] else "WARNING", True, False)
    assert not {"line_total_abs", "dq_status", "has_negative_quantity", "has_negative_price", "created_at"} & set(shuffled)


def staged_item_columns() -> dict[str, str]:
    texts = ["transaction_id", "sku", "currency", "description", "source_file_name", "batch_id", "attributes_extra", "warranty_extra", "gift_options_extra"]
    return {
        **{n: "string" for n in texts}, **{n: "bigint" for n in ("line_number", "quantity", "quantity_abs", "raw_record_id", "transaction_index")},
        **{n: "decimal(18,4)" for n in ("unit_price", "unit_price_abs", "line_total")}, "ingestion_timestamp": "timestamp",
        **{n: "boolean" for n in ("is_negative_quantity", "is_negative_unit_price", "is_missing_sku", "is_missing_description")},
    }


def test_surrogate_keys_of_nothing(spark):
    none = spark.createDataFrame([], "k string")
    assert keys.assign_surrogate_keys(none, "sk", ["k"]).count() == 0


@pytest.fixture()
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def test_file_row_numbers_over_many_splits(spark, tmp_path, small_splits):
    header = "order_id,customer_id,order_date,status,total_amount,currency\n"
    for name, n in (("Orders.csv", 1500), ("Order.CSV", 3), ("other.csv", 5)):
        (tmp_path / name).write_text(header + "".join(f"{i + 1},c,,,," + "\n" for i in range(n)))
    rows = csv_files.read_csv_orders(spark, str(tmp_path), BATCH, AS_OF, pattern=formats.ORDERS.pattern)
    assert rows.rdd.getNumPartitions() > 3
    assert rows.count() == 1503
    assert rows.filter("cast(order_id_raw AS bigint) != file_row_number").count() == 0
    assert rows.select("raw_record_id").distinct().count() == 1503


def test_large_xml_file_is_read_record_by_record(spark, tmp_path, small_splits):
    body = "".join(
        f"<!-- <Transaction> no {i} --><Transaction><TransactionID>t{i}</TransactionID><Items><Item><SKU>s</SKU></Item></Items></Transaction>\n"
        for i in range(400)
    )
    (tmp_path / "ClientA_big.xml").write_text(f'<?xml version="1.0"?><SalesData client="ClientA">{body}</SalesData>')
    whole = documents.read_xml_documents(spark, str(tmp_path), BATCH, AS_OF)
    sources = whole.select(*[c for c in staging_xml.LINEAGE if c != "file_hash"], F.col("record_hash").alias("file_hash"), F.col("raw_xml_content").alias("xml_doc"))
    records = documents.read_xml_records(spark, str(tmp_path), BATCH, AS_OF)
    assert records.rdd.getNumPartitions() > 3

    def staged(flat):
        out = staging_xml.stage_flat_client_a(flat)
        return sorted((r["transaction_index"], r["transaction_id"], len(r["items"])) for r in out.collect())

    assert staged(staging_xml.parse_xml_records(records)) == staged(staging_xml.flatten_xml_transactions(sources))
    assert len(staged(staging_xml.parse_xml_records(records))) == 400


def test_comment_over_a_record_end_is_reported(spark, tmp_path):
    (tmp_path / "a.txt").write_text("<Transaction><TransactionID>1</TransactionID><!-- x</Transaction> --></Transaction>")
    records = documents.read_xml_records(spark, str(tmp_path), BATCH, AS_OF)
    assert records.filter("crosses_comment").count() == 1


def test_duplicate_groups_count_every_copy(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("transaction_id"),
        F.concat(F.lit("f"), (F.col("id") % 5).cast("string")).alias("source_file_name"),
    )
    found = quality.detect_duplicate_keys(rows, "transaction_id", "TRANSACTION_ID", "KEEP_FIRST", "ClientA").collect()
    assert [(r["duplicate_key"], r["occurrence_count"], r["all_occurrence_files"]) for r in found] == [("HOT", 10000, ["f0", "f1", "f2", "f3", "f4"])]


def test_quarantine_holds_all_but_one_copy(spark):
    rows = spark.range(3000).select(
        F.lit("ClientA").alias("source_client"), F.lit("XML").alias("source_format"), F.col("id").alias("raw_record_id"),
        F.lit(0).alias("transaction_index"), F.lit("f").alias("source_file_name"), F.lit(AS_OF).cast("timestamp").alias("ingestion_timestamp"),
        F.when(F.col("id") < 1000, "HOT").otherwise(F.col("id").cast("string")).alias("transaction_id"),
        F.lit("o").alias("order_id"), F.lit("c").alias("customer_id"), F.lit("p").alias("raw_payload"), F.lit(False).alias("is_missing_transaction_id"),
    )
    assert FIRST_SEEN == ["ingestion_timestamp", "source_file_name", "raw_record_id"]
    assert quality.quarantine_rejects(rows, BATCH, AS_OF).count() == 999


def test_payloads_of_first_rows_are_not_shuffled(spark, tmp_path):
    """Copies are found by position; a row without a position is a reject of its own."""
    n = F.col("id")
    spark.range(30000).select(
        F.lit("ClientA").alias("source_client"), F.lit("XML").alias("source_format"), F.when(n != 9, n).alias("raw_record_id"),
        F.lit(0).alias("transaction_index"), F.concat(F.lit("f"), n).alias("source_file_name"), F.lit(AS_OF).cast("timestamp").alias("ingestion_timestamp"),
        F.when(n.isin(5, 6, 7), "HOT").otherwise(n.cast("string")).alias("transaction_id"), F.lit("o").alias("order_id"),
        F.lit("c").alias("customer_id"), F.sha2(n.cast("string"), 256).alias("raw_payload"), F.lit(False).alias("is_missing_transaction_id"),
    ).write.parquet(f"{tmp_path}/unified")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        rejects = quality.quarantine_rejects(spark.read.parquet(f"{tmp_path}/unified"), BATCH, AS_OF)
        assert "SortMergeJoin" not in plan(rejects)
        assert sorted(r["source_file_name"] for r in rejects.collect()) == ["f6", "f7", "f9"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "items")
    spark.range(100).select(
        F.col("id").alias("transaction_sk"), (F.col("id") % 2 == 0).alias("has_negative_quantity"), F.lit(False).alias("has_negative_price"),
        F.lit(False).alias("is_missing_sku"), F.lit("x").alias("description"),
    ).write.parquet(path)
    text = reports.item_issue_counts(spark.read.parquet(path))._jdf.queryExecution().toString()
    assert "description" not in text.split("ReadSchema")[1]
    assert "PushedFilters: [Or(" in text


def test_scd2_keeps_one_current_version(spark):
    def source(*rows):
        return spark.createDataFrame(rows, "customer_id string, email string, record_hash string, n bigint").select(
            "customer_id", "email", "record_hash", F.lit(0).alias("_priority"), F.lit(AS_OF).cast("timestamp").alias("_seen"),
            F.col("n").alias("_record"), F.lit(0).alias("_position"), F.lit("f").alias("source_file_name"),
            *[F.lit(None).cast(t).alias(c) for c, t in dims.CUSTOMER.attributes if c not in ("email", "source_file_name")],
        )

    start = dims.new_dimension(spark, dims.CUSTOMER, AS_OF)
    one = dims.scd2_apply(start, source(("A", "a1", "h1", 1), ("B", "b1", "h1", 2), ("A", "late", "h9", 3)), dims.CUSTOMER, AS_OF)
    two = dims.scd2_apply(one, source(("A", "a2", "h2", 1), ("C", "c1", "h1", 2)), dims.CUSTOMER, "2025-01-16 10:00:00")
    again = dims.scd2_apply(two, source(("A", "a2", "h2", 1), ("C", "c1", "h1", 2)), dims.CUSTOMER, "2025-01-17 10:00:00")
    got = sorted((r["customer_id"], r["version_number"], r["email"], r["is_current"]) for r in again.filter("customer_sk > 0").collect())
    assert got == [("A", 1, "a1", False), ("A", 2, "a2", True), ("B", 1, "b1", True), ("C", 1, "c1", True)]
    assert again.select("customer_sk").distinct().count() == again.count()
    versions = {r["version_number"]: r for r in again.filter("customer_id = 'A'").collect()}
    assert versions[1]["effective_to"] == versions[2]["effective_from"]


def test_store_replaces_only_named_batches(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "v bigint, batch_id string")
    assert store.append("x.t", rows) == 3
    store.replace_batches("x.t", store.read("x.t", rows).filter("v = 2"), ["A"], reads_itself=True)
    assert sorted(r["v"] for r in store.read("x.t").collect()) == [2, 3]
    store.replace_batches("x.t", rows.filter("v > 9"), ["B"])
    assert sorted(r["v"] for r in store.read("x.t").collect()) == [2]
    assert store.append("x.t", rows.filter("v > 9")) == 0
    assert store.overwrite("x.v", rows).count() == 3 and store.overwrite("x.v", rows.limit(1)).count() == 1


def test_ids_stay_unique_over_loads(spark, tmp_path):
    Path(tmp_path / "a.txt").write_text("x\ny\n")
    lines = files.with_file_metadata(spark.read.text(str(tmp_path)))
    first = files.with_record_ids(lines)
    last = first.agg(F.max("raw_record_id")).first()[0]
    second = files.with_record_ids(lines, last)
    assert second.agg(F.min("raw_record_id")).first()[0] > last


def test_work_folder_comes_from_the_session():
    class Conf(dict):
        pass

    class Session:
        conf = Conf({"spark.checkpoint.dir": "s3a://shared/tmp/"})

    assert fresh_path(Session, "x").startswith("s3a://shared/tmp/x-")
