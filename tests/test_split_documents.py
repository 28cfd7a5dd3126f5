"""Documents split among tasks against the same documents read whole, at several split sizes."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import staging_json, staging_xml
from ledgerloom.sources import documents, nested_records

AS_OF = "2025-01-15 10:00:00"


@pytest.fixture(params=["900", "4000", "100000000"])
def split_bytes(spark, request):
    names = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield int(request.param)
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def xml_text(rng: random.Random, n: int, number: int, section: str = "<![CDATA[</Transaction><!--]]>") -> str:
    """Siblings below a root: records and all that can hide or imitate them."""
    made = iter(range(10**6))

    def record() -> str:
        extra = rng.choice(["", "<!-- a </Transaction> b -->", section, '<Note a="x > y" b=\'"\'/>', "<Items><Item><SKU>s</SKU></Item></Items>", "é漢 "])
        return f"<Transaction><TransactionID>T{number}-{next(made)}</TransactionID>{extra}</Transaction>"

    kinds = [
        record, record, record, lambda: "\n", lambda: f"<!-- {record()} {record()} -->", lambda: "<!-- <Transaction> -->", lambda: "<?keep </Transaction> ?>",
        lambda: "<Transaction/>", lambda: f"<Other>{record()}<x/></Other>", lambda: record().replace("</Transaction>", "</Transaction >"),
        lambda: f"<Transaction><TransactionID>outer{next(made)}</TransactionID>{record()}</Transaction>", lambda: "<Header><a>1</a></Header>",
    ]
    return "".join(rng.choice(kinds)() for _ in range(n))


def flat_whole(spark, path):
    return staging_xml.read_xml_transactions(spark, path, "B", AS_OF)


def xml_rows(flat):
    told = flat.select("source_file_name", "transaction_index", F.col("transaction.TransactionID").alias("id"), F.size("transaction.Items.Item").alias("n"))
    return sorted((r[0], r[1], r[2] or "", r[3]) for r in told.collect())


def test_xml_documents(spark, tmp_path, split_bytes):
    rng = random.Random(11)
    for i in range(8):
        root = rng.choice(["SalesData", 'SalesData client="ClientA"'])
        head = rng.choice(["", '<?xml version="1.0" encoding="UTF-8"?>\n', "<!-- <Transaction> -->\n"])
        text = f"{head}<{root}>{xml_text(rng, 40, i)}</SalesData>" + rng.choice(["", "\n", "<!-- end -->"])
        if i == 3:
            text = text.replace("</TransactionID>", "", 1)
        if i == 4:
            text = text[: len(text) // 2]
        if i == 5:
            text = text.removesuffix("</SalesData>") + "<open>"
        (tmp_path / f"ClientA_{i}.xml").write_text(text)
    (tmp_path / "ClientA_none.xml").write_text("<SalesData></SalesData>")
    (tmp_path / "ClientA_one.xml").write_text("<SalesData><Transaction><TransactionID>T</TransactionID></Transaction></SalesData>")
    rows, docs = documents.split_xml_documents(spark, str(tmp_path), "B", AS_OF)
    assert xml_rows(staging_xml.parse_xml_records(rows)) == xml_rows(flat_whole(spark, str(tmp_path)))
    whole = documents.read_xml_documents(spark, str(tmp_path), "B", AS_OF).withColumn("xml_doc", F.col("raw_xml_content"))
    bad = {r.source_file_name for r in staging_xml.malformed_xml(whole).collect()}
    assert {r.source_file_name for r in docs.filter("NOT well_formed").collect()} == bad >= {"ClientA_4.xml"} and docs.count() == 10


def test_text_fragments(spark, tmp_path, split_bytes):
    rng = random.Random(5)
    for i in range(6):
        # the whole read takes comments out by their marks, also those inside a CDATA section
        text = rng.choice(["Export of the day\n", "", "<!-- lines > 0 -->\n"]) + xml_text(rng, 30, i, "<![CDATA[</Transaction>]]>") + rng.choice(["", "\n"])
        (tmp_path / f"ClientA_{i}.txt").write_text(text + ("<Transaction><Order>" if i == 2 else ""))
    rows, docs = documents.split_xml_documents(spark, str(tmp_path), "B", AS_OF, pattern=None, fragments=True)
    assert xml_rows(staging_xml.parse_xml_records(rows)) == xml_rows(flat_whole(spark, str(tmp_path)))
    parsed = documents.parse_txt_xml(documents.read_txt_documents(spark, str(tmp_path), "B", AS_OF))
    assert {(r.source_file_name, r.well_formed) for r in docs.collect()} == {(r.source_file_name, r.xml_parse_success) for r in parsed.collect()}


def json_element(rng: random.Random, number: int):
    text = "".join(rng.choice(['"', "\\", "{", "}", "[", "]", "é", "a", ","]) for _ in range(rng.randrange(12)))
    kinds = [lambda: {"id": number, "t": text, "n": [{"x": {"y": [text]}}, []]}, lambda: {"id": number, text: {}}, lambda: {"id": number}]
    return rng.choice(kinds)()


def json_text(rng: random.Random, n: int) -> str:
    items = [rng.choice([json_element(rng, i)] * 12 + [None, i, [json_element(rng, i)], "}{", []]) for i in range(n)]
    parts = [json.dumps(x, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, None, 1])) for x in items]
    body = "[" + rng.choice([",", ", ", "\n,\n"]).join(parts) + "]"
    if rng.random() < 0.5:
        return rng.choice(["", " "]) + body + rng.choice(["", "\n"])
    other = json.dumps([json_element(rng, 0), json_element(rng, 1)])
    return '{"meta":{"a":{"b":1}},"before":' + other + ',"transactions":' + body + rng.choice(["", ',"after":' + other]) + "}" + rng.choice(["", "\n"])


def json_rows(flat):
    return sorted((r[0], r[1], r[2]) for r in flat.select("source_file_name", "transaction_index", F.to_json("transaction")).collect())


def test_json_documents(spark, tmp_path, split_bytes):
    rng = random.Random(7)
    for i in range(10):
        text = json_text(rng, rng.choice([0, 1, 2, 40]))
        if i == 6:
            text = json_text(rng, 40).replace('"id"', '"id', 1)
        if i == 7:
            text = text[:-3] + "}"
        if i == 8:
            text = "[{} {}]"
        (tmp_path / f"c_{i}.json").write_text(text)
    rows, docs = documents.split_json_documents(spark, str(tmp_path), "B", AS_OF)
    whole = documents.read_json_documents(spark, str(tmp_path), "B", AS_OF)
    found = rows.filter(~F.is_variant_null("transaction"))
    assert json_rows(found) == json_rows(staging_json.flatten_json_transactions(whole))
    bad = {r.source_file_name for r in staging_json.malformed_json(whole).collect()}
    assert {r.source_file_name for r in docs.filter("NOT well_formed").collect()} == bad >= {"c_6.json", "c_8.json"}


def test_a_document_that_never_ends(spark, tmp_path, monkeypatch, split_bytes):
    """What is too long to be put together makes the document unreadable and is held by no task."""
    monkeypatch.setattr(nested_records, "LONGEST_RECORD", 500)
    record = "<Transaction><TransactionID>1</TransactionID></Transaction>"
    (tmp_path / "ClientA_a.xml").write_text(f"<SalesData>{record}<!-- {record * 50} </SalesData>")
    (tmp_path / "ClientA_b.xml").write_text(f"<SalesData>{record * 50}</SalesData>")
    rows, docs = documents.split_xml_documents(spark, str(tmp_path), "B", AS_OF)
    assert {(r.source_file_name, r.well_formed) for r in docs.collect()} == {("ClientA_a.xml", False), ("ClientA_b.xml", True)}
    assert sorted(r.transaction_index for r in rows.collect()) == list(range(50))


def test_rows_per_piece_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Tables with a row per piece or run are small at rest and large in memory, whatever their size here."""
    plans = {}

    def planned(df, label, *args):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return materialize(df, label, *args)

    materialize = nested_records.materialize
    monkeypatch.setattr(nested_records, "materialize", planned)
    (tmp_path / "c.json").write_text(json.dumps([{"a": {"b": i}} for i in range(20)]))
    rows, _ = documents.split_json_documents(spark, str(tmp_path), "B", "2025-01-01")
    assert rows.count() == 20
    for label, key in (("runs", "_run"), ("joined-pieces", "_line")):
        assert not re.search(rf"BroadcastHashJoin \[[^\]]*{key}", plans[label])
