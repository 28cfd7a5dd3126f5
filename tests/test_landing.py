"""Building the landing data: work that is done once, with the rows of the statements."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom.session import configure, materialize
from ledgerloom.sources.documents import parse_txt_xml
from workloads import landing, truth
from workloads.landing import Landing


def _lineitem(spark, path):
    """Lines that agree in part or all of the order's columns, nulls among them."""
    n = F.col("id")
    rows = spark.range(3000).select(
        (n % 50).alias("l_orderkey"), F.when(n % 7 > 0, n % 3).alias("l_partkey"), (n % 2).alias("l_suppkey"),
        (n % 4).cast("int").alias("l_linenumber"), F.when(n % 11 > 0, (n % 5).cast("double")).alias("l_quantity"),
        (n % 6 + 0.25).alias("l_extendedprice"), (n % 13 / 100).alias("l_discount"), (n % 9 / 100).alias("l_tax"),
        F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), F.lit("1996-01-01").cast("timestamp").alias("l_shipdate"),
    )
    rows.write.parquet(f"{path}/lineitem.parquet")
    return rows


def test_lines_are_numbered_once_as_the_statement_says(spark, tmp_path):
    rows = _lineitem(spark, tmp_path)
    landing = Landing(spark, str(tmp_path))
    expected = spark.sql(truth.LINES, lineitem=rows)
    assert landing.lines.schema.simpleString() == expected.schema.simpleString()
    assert landing.lines.exceptAll(expected).isEmpty() and expected.exceptAll(landing.lines).isEmpty()
    for sql in (truth.ITEM_TEXT, truth.LINE_SUMS):
        got = landing.rows(sql)
        assert sorted(map(str, got.collect())) == sorted(map(str, spark.sql(sql, lineitem=rows).collect()))
        assert "lineitem.parquet" not in " ".join(got.inputFiles()), "read from the numbered lines"


def test_tables_at_rest_are_compressed_with_zstd(spark):
    file = materialize(spark.range(10), "codec").inputFiles()[0].removeprefix("file://")
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


@pytest.mark.parametrize("setting, dealt", [("2", 200), ("300", 300)])
def test_exchanges_are_dealt_finely_under_any_setting(spark, setting, dealt):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", setting)
    try:
        configure(spark)
        counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        assert len(counted.collect()) == 7
        plan = counted._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        configure(spark)
    assert f", {dealt})" in plan and "coalesced" in plan


def test_documents_are_read_a_few_at_a_time(spark):
    """A batch of rows is in memory at once; 300 documents are no single batch."""
    docs = materialize(spark.range(300).select("id", F.repeat(F.lit("x"), 1000).alias("content")).coalesce(1), "documents-few")
    assert len(docs.collect()) == 300
    to_rows = docs._jdf.queryExecution().executedPlan().child()
    assert to_rows.metrics().apply("numInputBatches").value() >= 5


def _emitted_rows(spark, path):
    """Orders and their lines: copies, keys beyond those of documents of copies, negative ones, orders without lines."""
    n = F.col("id")
    keys = [f"SELECT {sign} id + {first} AS o FROM range({count})" for sign, first, count in (("", 0, 3000), ("", 512 * 10**9, 700), ("-", -1, 700))]
    orders = spark.sql(" UNION ALL ".join(keys)).select(
        F.col("o").alias("o_orderkey"), (F.col("o") % 70).alias("o_custkey"), F.lit("F").alias("o_orderstatus"), (F.col("o") % 900 + 0.5).alias("o_totalprice"),
        F.lit("1996-01-02").cast("timestamp").alias("o_orderdate"), F.concat((F.abs("o") % 5 + 1).cast("string"), F.lit("-URGENT")).alias("o_orderpriority"),
    )
    lines = orders.filter("o_orderkey % 11 != 0").select(F.col("o_orderkey").alias("l_orderkey"), F.explode(F.sequence(F.lit(1), F.abs("o_orderkey") % 4 + 1)).alias("id")).select(
        "l_orderkey", (n * 7 % 3).alias("l_partkey"), (n % 2).alias("l_suppkey"), n.cast("int").alias("l_linenumber"), F.when(n % 4 > 0, n.cast("double")).alias("l_quantity"),
        (n + 0.25).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"), F.lit(0.1).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.lit("1996-01-01").cast("timestamp").alias("l_shipdate"),
    )
    orders.write.parquet(f"{path}/orders.parquet")
    lines.write.parquet(f"{path}/lineitem.parquet")
    return {"orders": spark.read.parquet(f"{path}/orders.parquet"), "lineitem": spark.read.parquet(f"{path}/lineitem.parquet")}


@pytest.mark.parametrize("parity, headers_sql, items_sql, value", [(0, truth.HEADERS_A, truth.ITEM_TEXT, "sku_text"), (1, truth.HEADERS_C, truth.ITEMS_C, "price_alt_raw")])
def test_headers_and_baskets_are_those_of_the_statements(spark, tmp_path, parity, headers_sql, items_sql, value):
    tables = _emitted_rows(spark, tmp_path)
    landing = Landing(spark, str(tmp_path))
    got = [landing._headers(headers_sql, items_sql, parity, F.col(value), near) for near in (True, False)]
    got = materialize(got[0].unionByName(got[1]), "headers")
    expected = materialize(spark.sql(headers_sql, orders=tables["orders"], lineitem=tables["lineitem"]), "expected")
    plain = got.drop("basket").select(*expected.columns)
    assert expected.filter("doc >= 1000000000 AND copy = 0").count() > 300 and expected.filter("copy = 1").count() > 15
    assert plain.exceptAll(expected).isEmpty() and expected.exceptAll(plain).isEmpty()
    items = spark.sql(items_sql, lineitem=tables["lineitem"]).orderBy("o", "line").collect()
    baskets = {}
    for r in items:
        baskets.setdefault(r["o"], []).append(r[value])
    assert {(r["o"], tuple(r["basket"] or ())) for r in got.collect()} == {(r["o"], tuple(baskets.get(r["o"], ()))) for r in expected.collect()}


def test_document_texts_are_not_shuffled(spark, tmp_path):
    """Orders and lines are dealt by document; nothing made of them goes through an exchange."""
    _emitted_rows(spark, tmp_path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for docs in ("documents_a", "documents_c"):
            landing, plans = Landing(spark, str(tmp_path)), []
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr("workloads.landing.materialize", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or materialize(df, label))
                assert getattr(landing, docs).count() == getattr(landing, docs).select("doc").distinct().count() >= 8
            exchanges = [line for line in plans[0].splitlines() if "Exchange" in line]
            assert len(exchanges) == 4 and all("hashpartitioning(doc" in line and "REPARTITION_BY_COL" in line for line in exchanges), exchanges
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_text_files_are_made_without_the_other_documents(spark, tmp_path):
    _emitted_rows(spark, tmp_path)
    made = Landing(spark, str(tmp_path))
    written = spark.read.text(made.txt_files(), wholetext=True)
    assert "documents_a" not in made.__dict__
    expected = made.documents_a.filter("is_txt = 1").select(F.concat("content", F.lit("\n")))
    assert 0 < written.count() < made.documents_a.count()
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, expected.collect()))


def test_texts_are_parsed_once_for_their_verdict(spark):
    texts = spark.range(20).select(F.concat(F.lit("x <Transaction><A>"), "id", F.when(F.col("id") % 5 > 0, "</A></Transaction>").otherwise("")).alias("raw_text_content"), F.lit(None).cast("timestamp").alias("ingestion_timestamp"))
    good = parse_txt_xml(texts).filter("xml_parse_success").select("raw_xml_content")
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 1 and plan.count("regexp_replace") == 3
    assert good.count() == 16 and parse_txt_xml(texts).filter("raw_xml_content IS NULL AND xml_parse_error IS NOT NULL").count() == 4
    missing = parse_txt_xml(texts.limit(1).withColumn("raw_text_content", F.lit(None).cast("string"))).collect()
    assert len(missing) == 1 and missing[0]["raw_xml_content"] is None


def test_raw_csv_rows_are_written_without_an_exchange(spark, tmp_path, monkeypatch):
    n = F.col("id")
    spark.range(1, 3001).coalesce(1).select(
        n.alias("o_orderkey"), (n % 40).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), (n % 90 + 0.5).alias("o_totalprice"),
        F.lit("1996-01-01").cast("timestamp").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    ).write.parquet(f"{tmp_path}/orders.parquet")
    written = []
    monkeypatch.setattr(landing, "materialize", lambda df, *a: (written.append(df), materialize(df, *a))[1])
    monkeypatch.setattr(landing, "RAW_ROWS_PER_FILE", 1000)
    made = Landing(spark, str(tmp_path))
    assert made.orders.count() == made.rows(truth.ORDERS).count() and len(made.orders.inputFiles()) >= 3
    assert "Exchange" not in written[0]._jdf.queryExecution().executedPlan().toString()
