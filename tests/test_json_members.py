"""Client-C documents read in one cast give the values and texts that reading them path by path gives."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from ledgerloom.operators import staging_json

NAMES = {
    "customer": ["customer_id", "id", "first_name", "last_name", "name", "email", "loyalty_tier", "tier"],
    "payment": ["method", "payment_method", "amount", "total", "currency"],
    "item": ["sku", "product_id", "description", "name", "quantity", "qty", "unit_price", "price", "currency"],
}


def some_value(rng: random.Random, odd: float):
    if rng.random() < odd:
        return rng.choice([None, 1, 1.50, True, {}, [], {"k": "v"}, ["x", None], 10**30, 1e300])
    return rng.choice(["x", "1", "", " é ", "null", 'a\u0001\u001f/\x7f  \U0001f600 " \\ \n\u000b'])


def some_object(rng: random.Random, names: list[str], odd: float) -> dict:
    found = {n: some_value(rng, odd) for n in names if rng.random() < 0.7}
    if rng.random() < odd:
        found[rng.choice(["zz", "a b", "", "sku: STRING, x", "A"])] = some_value(rng, odd)
    return found


def some_transaction(rng: random.Random):
    odd = rng.choice([0, 0, 0.02, 0.2])
    kept = lambda value: some_value(rng, 1) if rng.random() < odd else value
    found = some_object(rng, ["transaction_id", "txn_id"], odd)
    order = some_object(rng, ["order_id", "order_date", "status"], odd)
    order["customer"] = kept(some_object(rng, NAMES["customer"], odd))
    parts = {"order": order, "payment": some_object(rng, NAMES["payment"], odd), "items": [kept(some_object(rng, NAMES["item"], odd)) for _ in range(rng.randint(0, 4))]}
    found.update({n: kept(v) for n, v in parts.items() if rng.random() < 0.9})
    members = list(found.items())
    rng.shuffle(members)
    return kept(dict(members))


def documents(spark, contents: list):
    rows = [(i, f"f{i}.json", "ClientC", "JSON", "B", "h", json.dumps(x, ensure_ascii=i % 2 == 0)) for i, x in enumerate(contents)]
    docs = spark.createDataFrame(rows, "raw_record_id bigint, source_file_name string, source_client string, source_format string, batch_id string, record_hash string, raw_json_content string")
    return docs.withColumn("ingestion_timestamp", F.lit("2025-01-01").cast("timestamp"))


def _path(document: str, path: str, kind: str = "string"):
    return F.try_variant_get(document, path, kind)


def test_values_and_texts_are_those_of_the_paths(spark):
    rng = random.Random(7)
    wide = {"transaction_id": "wide", "payment": {f"k{i}": "v" for i in range(20_000)}, "items": [{f"k{i}": "v" for i in range(5_000)}]}
    docs = documents(spark, [[some_transaction(rng) for _ in range(6)] for _ in range(150)] + [[wide]])
    key = ["raw_record_id", "transaction_index"]
    flat = staging_json.flatten_json_transactions(docs)
    texts = {
        "customer_json": F.to_json(_path("transaction", "$.order.customer", "variant")), "payment_json": F.to_json(_path("transaction", "$.payment", "variant")),
        "raw_transaction_json": F.to_json("transaction"),
    }
    paths = {name: _path("transaction", path) for name, path in staging_json.TRANSACTION_PATHS.items()}
    expected = flat.select(*key, *[v.alias(n) for n, v in {**paths, **texts}.items()])
    staged = staging_json.stage_client_c_transactions(docs)
    assert sorted(map(repr, staged.select(*expected.columns).collect())) == sorted(map(repr, expected.collect()))
    plain = {r[0] for r in staging_json._extracted(flat).select("_plain").distinct().collect()}
    assert plain == {True, False}

    items = staged.select(*key, F.posexplode("items").alias("p", "item")).filter(F.col("item").isNotNull() & ~F.is_variant_null("item"))
    paths = {name: _path("item", path) for name, path in staging_json.ITEM_PATHS.items()}
    expected = items.select(*key, (F.col("p") + 1).alias("line_number"), *[v.alias(n) for n, v in paths.items()], F.to_json("item").alias("item_metadata_json"))
    found = staging_json.stage_client_c_items(staged).select(*expected.columns)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))


def test_members_are_not_looked_up_one_by_one(spark):
    staged = staging_json.stage_client_c_transactions(documents(spark, [[{"transaction_id": "1"}]]))
    for df, most in ((staged, 9), (staging_json.stage_client_c_items(spark.createDataFrame([], staged.schema)), 1)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert 0 < plan.count("try_variant_get") <= most
