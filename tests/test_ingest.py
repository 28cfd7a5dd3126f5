"""What is read: every row once, whatever the splits, sizes, dates, failures and corrections."""

import os

import pytest
from golden import write_inbox
from pyspark.sql import functions as F

from ledgerloom.operators import dims, facts, quality
from ledgerloom.plans import loading, operations
from ledgerloom.plans.loading import DIM_CUSTOMER, FACT_COLUMNS, FACT_ITEM, FACT_ORDER, FACT_TRANSACTION, read_fact
from ledgerloom.plans.pipeline import LEDGER, LEDGER_SCHEMA, Pipeline
from ledgerloom.plans.store import TableStore
from ledgerloom.session import materialize
from ledgerloom.sources import csv_files, documents, files, formats

AS_OF = "2025-01-15 10:00:00"
HEADER = "order_id,customer_id,order_date,status,total_amount,currency\n"


def order_file(path, ids):
    path.write_text(HEADER + "".join(f"{i},c,2024-01-02,shipped,1.50,USD\n" for i in ids))
    return path


@pytest.mark.parametrize("later", ["3", "64"])
def test_row_numbers_survive_other_splits(spark, tmp_path, later):
    """Executors may come or go after the first job; the second one plans other splits."""
    order_file(tmp_path / "Orders.csv", range(1, 60001))
    names = ["spark.sql.leafNodeDefaultParallelism", "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n, v in zip(names, ("8", "200000", "0")):
            spark.conf.set(n, v)
        rows = csv_files.read_csv_orders(spark, str(tmp_path), "B", AS_OF, pattern=formats.ORDERS.pattern)
        spark.conf.set(names[0], later)
        spark.conf.set(names[1], "77777")
        assert rows.count() == 60000
        assert rows.filter("cast(order_id_raw AS bigint) != file_row_number").count() == 0
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_too_many_scan_tasks_fail_instead_of_colliding(spark, monkeypatch):
    monkeypatch.setattr(files, "_TASK_SLOTS", 2)
    with pytest.raises(Exception, match="more scan tasks"):
        files.with_record_ids(spark.range(100).repartition(5)).agg(F.max("raw_record_id")).collect()


def test_size_changes_nothing(spark, tmp_path):
    """A long document with comments over several records reads like a short one, and a long JSON file is read."""
    record = "<Transaction><TransactionID>T{}</TransactionID></Transaction>"
    filler = "".join(record.format(f"x{i}") for i in range(300_000))
    for name, middle in (("ClientA_short.xml", ""), ("ClientA_long.xml", filler)):
        hidden = f"<!-- {record.format(2)} {record.format(3)} -->"
        (tmp_path / name).write_text(f'<SalesData client="ClientA">{record.format(1)}{hidden}{middle}{record.format(5)}</SalesData>')
    assert os.path.getsize(tmp_path / "ClientA_long.xml") > 16 << 20
    docs = documents.read_xml_documents(spark, str(tmp_path), "B", AS_OF, pattern=None)
    from ledgerloom.operators import staging_xml

    flat = staging_xml.flatten_xml_transactions(docs.select(
        *[F.col(c) for c in staging_xml.LINEAGE if c != "file_hash"], F.col("record_hash").alias("file_hash"), F.col("raw_xml_content").alias("xml_doc")
    ))
    ids = flat.select("source_file_name", F.col("transaction.TransactionID").alias("id")).filter("id NOT LIKE 'Tx%'")
    assert sorted(map(tuple, ids.collect())) == [(f"ClientA_{n}.xml", t) for n in ("long", "short") for t in ("T1", "T5")]
    (tmp_path / "big.json").write_text("[" + ",".join('{"transaction": {"id": "' + "y" * 1000 + '"}}' for _ in range(18_000)) + "]")
    found = documents.read_json_documents(spark, str(tmp_path), "B", AS_OF, pattern=None).filter("source_file_name = 'big.json'")
    assert documents.read_json_array(found).count() == 18_000


@pytest.fixture()
def pipeline(spark, tmp_path):
    inbox = tmp_path / "inbox [1]"  # a name that a reader could take for a pattern
    inbox.mkdir()
    order_file(inbox / "Orders.csv", ["ORD-1", "ORD-2"])
    return Pipeline(spark, TableStore(spark, str(tmp_path / "store")), str(inbox).replace("[", "\\[").replace("]", "\\]")), inbox


def orders(pipeline):
    rows = pipeline.raw_tables()["orders"].select("source_file_name", "order_id_raw", "batch_id").collect()
    return sorted((r[0], r[1], r[2]) for r in rows)


def test_late_corrected_and_reprocessed_files(pipeline):
    pipe, inbox = pipeline
    pipe.ingest("B1", AS_OF)
    late = order_file(inbox / "Order_late.csv", ["ORD-9"])
    late.rename(inbox / "Order.CSV")
    os.utime(inbox / "Order.CSV", (1_600_000_000, 1_600_000_000))  # years older than the newest file
    pipe.ingest("B2", AS_OF)
    assert [r for r in orders(pipe) if r[2] == "B2"] == [("Order.CSV", "ORD-9", "B2")]
    pipe.ingest("B3", AS_OF)
    assert not [r for r in orders(pipe) if r[2] == "B3"]
    order_file(inbox / "Orders.csv", ["ORD-1", "ORD-2", "ORD-3"])  # corrected, same name
    pipe.ingest("B4", AS_OF)
    assert [r[1] for r in orders(pipe) if r[2] == "B4"] == ["ORD-1", "ORD-2", "ORD-3"]
    pipe.reprocess("Order.CSV")
    assert not [r for r in orders(pipe) if r[0] == "Order.CSV"]
    pipe.ingest("B5", AS_OF)
    assert [r for r in orders(pipe) if r[0] == "Order.CSV"] == [("Order.CSV", "ORD-9", "B5")]
    assert pipe.raw(LEDGER, LEDGER_SCHEMA).count() == 3


class Broken(Exception):
    pass


def break_write(monkeypatch, spark, number):
    """The ``number``-th write of files or of the commit log from now on fails, the log's after half of its text."""
    writer, left = type(spark.range(1).write), [number]
    parquet, record = writer.parquet, TableStore._write_record

    def count():
        left[0] -= 1
        return left[0] == 0

    def files(self, *a, **k):
        if count():
            raise Broken
        return parquet(self, *a, **k)

    def log(self, state):
        if count():
            name = f"{self.root}/_log/{len(self._records()) + 1:012d}.json"
            where, fs = self._fs(name)
            out = fs.create(where, False)
            out.write(bytearray(b'{"raw'))
            out.close()
            raise Broken
        return record(self, state)

    monkeypatch.setattr(writer, "parquet", files)
    monkeypatch.setattr(TableStore, "_write_record", log)
    return left


def test_ingest_that_fails_at_any_write_counts_wholly_or_not(pipeline, spark, monkeypatch):
    pipe, _ = pipeline
    for n in range(1, 50):
        with monkeypatch.context() as m:
            left = break_write(m, spark, n)
            try:
                pipe.ingest(f"B{n}", AS_OF)
            except Broken:
                pass
        found = [r[1] for r in orders(pipe)]
        assert found in ([], ["ORD-1", "ORD-2"]) and pipe.raw(LEDGER, LEDGER_SCHEMA).count() == len(found) // 2
        if left[0] > 0:
            break
    assert n > 3 and found == ["ORD-1", "ORD-2"]


def test_reprocess_that_fails_at_any_write_loses_nothing(pipeline, spark, monkeypatch):
    pipe, inbox = pipeline
    order_file(inbox / "Order.CSV", ["ORD-9"])
    pipe.ingest("B1", AS_OF)
    old = orders(pipe)
    for n in range(1, 50):
        with monkeypatch.context() as m:
            left = break_write(m, spark, n)
            try:
                pipe.reprocess("Order.CSV")
            except Broken:
                assert orders(pipe) == old and pipe.raw(LEDGER, LEDGER_SCHEMA).count() == 2
        if left[0] > 0:
            break
    assert n == 4  # rows, ledger entries, the record, and none
    assert [r[1] for r in orders(pipe)] == ["ORD-1", "ORD-2"]
    pipe.ingest("B2", AS_OF)
    assert sorted(r[1] for r in orders(pipe)) == ["ORD-1", "ORD-2", "ORD-9"]
    pipe.store.vacuum()
    assert sorted(r[1] for r in orders(pipe)) == ["ORD-1", "ORD-2", "ORD-9"]


def test_replay_that_fails_at_any_write_leaves_the_old_state(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "store"))
    names = {n: facts.empty_fact(spark, FACT_COLUMNS[n]) for n in (FACT_TRANSACTION, FACT_ITEM)}

    def add(name, rows, columns):
        df = spark.createDataFrame(rows, columns)
        store.append(name, df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in names[name].schema]))

    add(FACT_TRANSACTION, [(1, "A"), (2, "B")], "transaction_sk long, batch_id string")
    add(FACT_ITEM, [(10, 1, "A"), (11, 1, "B"), (12, 2, "B")], "transaction_item_sk long, transaction_sk long, batch_id string")

    def load():
        add(FACT_TRANSACTION, [(3, "A")], "transaction_sk long, batch_id string")
        add(FACT_ITEM, [(13, 3, "A")], "transaction_item_sk long, transaction_sk long, batch_id string")

    keys = lambda: (sorted(r[0] for r in read_fact(store, FACT_TRANSACTION).select("transaction_sk").collect()),
                    sorted(r[0] for r in read_fact(store, FACT_ITEM).select("transaction_item_sk").collect()))
    old, new = ([1, 2], [10, 11, 12]), ([2, 3], [12, 13])
    for n in range(1, 20):
        with monkeypatch.context() as m:
            left = break_write(m, spark, n)
            try:
                operations.replay_batch(store, load, "A")
            except Broken:
                assert keys() == old
        if left[0] > 0:
            break
    assert keys() == new and n == 5


def test_figures_of_headers_grow_with_new_lines_only(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "store"))
    shape = {n: facts.empty_fact(spark, FACT_COLUMNS[n]) for n in (FACT_TRANSACTION, FACT_ITEM)}
    fit = lambda name, df: df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in shape[name].schema])
    figures = ["item_count", "total_line_amount", "total_line_amount_abs", "amount_variance", "has_amount_variance"]
    for i, batch in enumerate("ABC"):
        heads = spark.range(i * 100, i * 100 + 100).select(F.col("id").alias("transaction_sk"), F.lit(batch).alias("batch_id"), F.when(F.col("id") % 7 > 0, F.col("id") * 1.5).alias("payment_amount_abs"))
        store.append(FACT_TRANSACTION, fit(FACT_TRANSACTION, heads))
        # lines of this batch's headers, and late ones of the batch before
        lines = spark.range(300).select(F.greatest(F.lit(0), F.col("id") % 130 + i * 100 - 30).alias("transaction_sk"), F.lit(batch).alias("batch_id"),
                                        F.when(F.col("id") % 5 > 0, F.col("id") - 40).alias("line_total"), F.when(F.col("id") % 5 > 0, F.abs(F.col("id") - 40)).alias("line_total_abs"))
        new = fit(FACT_ITEM, lines)
        opened = []
        before = store._versions(FACT_TRANSACTION)
        with store.transaction():
            store.append(FACT_ITEM, new)
            with monkeypatch.context() as m:
                real = store.read
                m.setattr(store, "read", lambda name, *a, **k: opened.append(name) or real(name, *a, **k))
                loading.refresh_transaction_aggregates(store, new)
        assert FACT_ITEM not in opened and (i < 2 or before[0] in store._versions(FACT_TRANSACTION))
        now = read_fact(store, FACT_TRANSACTION)
        plain = now.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name in figures else F.col(f.name) for f in now.schema])
        again = facts.update_transaction_aggregates(plain, read_fact(store, FACT_ITEM))
        key = lambda df: sorted(tuple(r) for r in df.select("transaction_sk", *[F.col(x).cast("string") for x in figures]).fillna("-").collect())
        assert key(now) == key(again)


def test_dimension_changes_are_written_as_segments(spark, tmp_path):
    """Bytes follow the changed members; after any number of loads the table is that of whole rewrites."""
    store = TableStore(spark, str(tmp_path / "store"))

    def source(rows):
        return spark.createDataFrame(rows, "customer_id string, email string, record_hash string, n bigint").select(
            "customer_id", "email", "record_hash", F.lit(0).alias("_priority"), F.lit(AS_OF).cast("timestamp").alias("_seen"),
            F.col("n").alias("_record"), F.lit(0).alias("_position"), F.lit("f").alias("source_file_name"),
            *[F.lit(None).cast(t).alias(c) for c, t in dims.CUSTOMER.attributes if c not in ("email", "source_file_name")],
        )

    plain = store.overwrite(DIM_CUSTOMER, dims.new_dimension(spark, dims.CUSTOMER, AS_OF))
    plain = spark.createDataFrame(plain.collect(), plain.schema)
    written = []
    for day in range(12):
        rows = [(f"C{i}", f"e{day}", f"h{day}" if i % 50 == day else f"h{i % 50 > day and -1 or i % 50}", i) for i in range(3000 if day == 0 else 500)]
        at = f"2025-02-{day + 1:02d} 00:00:00"
        changes = dims.changed_members(store.read(DIM_CUSTOMER), dims.one_per_key(source(rows), dims.CUSTOMER), dims.CUSTOMER)
        changes = materialize(changes, "changes")
        store.upsert(DIM_CUSTOMER, dims.change_segment(store.read(DIM_CUSTOMER), changes, dims.CUSTOMER, at), dims.CUSTOMER.sk)
        folders = store._versions(DIM_CUSTOMER)
        if len(folders) > 1:  # else the segments were written into the table
            written.append((spark.read.parquet(folders[-1]).count(), changes.count()))
        plain = dims.scd2_apply(plain, source(rows), dims.CUSTOMER, at)
        plain = spark.createDataFrame(plain.collect(), plain.schema)
    assert sorted(map(tuple, store.read(DIM_CUSTOMER).fillna("").collect())) == sorted(map(tuple, plain.fillna("").collect()))
    assert len(written) == 11 and all(rows <= 2 * changed for rows, changed in written) and written[-1][1] < 100


def test_a_failed_run_is_taken_up_by_the_next(spark, tmp_path, monkeypatch):
    inbox = write_inbox(tmp_path / "inbox")
    pipe = Pipeline(spark, TableStore(spark, str(tmp_path / "store")), str(inbox))
    from ledgerloom.plans import pipeline as module

    real = module.materialize_staging
    monkeypatch.setattr(module, "materialize_staging", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        pipe.run("BATCH_1", AS_OF)
    monkeypatch.setattr(module, "materialize_staging", real)
    assert pipe.unfinished() == ["BATCH_1"]
    pipe.run("BATCH_2", AS_OF)
    assert pipe.unfinished() == [] and read_fact(pipe.store, FACT_ORDER).count() == 2
    assert {r[0] for r in read_fact(pipe.store, FACT_ORDER).select("batch_id").distinct().collect()} == {"BATCH_1"}


def test_blank_keys_are_no_duplicates(spark):
    rows = spark.createDataFrame([("", "f1"), ("", "f2"), (" ", "f3"), (None, "f1"), (None, "f2"), ("K", "f1"), ("K", "f2")], "k string, source_file_name string")
    found = quality.detect_duplicate_keys(rows, "k", "TRANSACTION_ID", "KEEP_FIRST", "ClientA").collect()
    assert [(r["duplicate_key"], r["occurrence_count"]) for r in found] == [("K", 2)]


def test_erasing_one_customer_leaves_the_others(spark):
    make = spark.createDataFrame
    tables = {
        "dim_customer": make([(1, "P", "a", "x.org"), (2, "P", "b", "x.org"), (3, "Q", "c", "y.org"), (-1, "P", "u", None)], "customer_sk long, customer_id string, email string, email_domain string"),
        # T1 is held by both clients; P's last transaction has the unknown member's key
        "fact_transaction": make([(1, "ClientA", "T1", "O1", 1, "P"), (2, "ClientC", "T1", "O2", 3, "Q"), (3, "ClientA", "T2", "O3", -1, "P"), (4, "ClientA", "T4", "O4", -1, None)],
                                 "transaction_sk long, source_client string, transaction_id string, order_id string, customer_sk long, customer_id string"),
        "fact_order": make([("O1", 2, "P"), ("O2", 3, "Q"), ("O4", -1, None)], "order_id string, customer_sk long, customer_id string"),
        "fact_transaction_item": make([(1, 1), (2, 2), (3, 3)], "transaction_item_sk long, transaction_sk long"),
        "fact_payment": make([("P1", "O1", "T1"), ("P2", "O2", "T1"), ("P3", "O3", "T9"), ("P4", None, "T2"), ("P5", None, "T1"), ("P6", "O4", "T4")], "payment_id string, order_id string, transaction_id string"),
        "issues": make([("T2", "P"), ("T2-LINE_1", None), ("T4", "Q"), (None, None)], "record_identifier string, customer_id string"),
        "rejects": make([("<C>P</C>",), ("<C>P-7</C>",), (None,)], "raw_record string"),
    }
    left = operations.erase_customer(tables, "P")
    ids = lambda name, column: sorted(r[0] for r in left[name].select(column).collect() if r[0] is not None)
    assert ids("dim_customer", "customer_id") == ["Q"]
    assert ids("fact_transaction", "transaction_sk") == [2, 4] and ids("fact_order", "order_id") == ["O2", "O4"]
    assert ids("fact_transaction_item", "transaction_item_sk") == [2]
    # P2 is another customer's; P5 does not tell whose it is
    assert ids("fact_payment", "payment_id") == ["P2", "P5", "P6"]
    assert ids("issues", "record_identifier") == ["T4"] and left["issues"].count() == 2
    assert ids("rejects", "raw_record") == ["<C>P-7</C>"] and left["rejects"].count() == 2
    masked = operations.erase_customer(tables, "P", mask=True)["dim_customer"]
    assert {(r["email"], r["email_domain"]) for r in masked.filter("customer_id = 'P'").collect()} == {("***", "***")}
