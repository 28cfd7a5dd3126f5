"""CSV records with line feeds, quotes and escapes in their values, read in splits of any size."""

import gzip
import random

import pytest

from ledgerloom.sources import csv_files, csv_records, formats

AS_OF = "2025-01-15 10:00:00"
NAMES = formats.CUSTOMERS.raw_columns + formats.CUSTOMERS.spare_columns


def plain_records(text: str, sep: str) -> list[list[str]] | None:
    """All records of a text, character by character; None if a quote never closes."""
    records, fields, value, at = [], [], [], 0
    began = True  # of a value, but for blanks
    quoted = closed = False
    blank, n = True, len(text)

    def end_value():
        nonlocal value, began, quoted, closed
        whole = "".join(c for c, _ in value)
        if closed:
            head = value[: closed]
            tail = "".join(c for c, e in _stripped(value[closed:]))
            whole = "".join(c for c, _ in head) + tail
        else:
            whole = "".join(c for c, _ in _stripped(value))
        fields.append(whole)
        value, began, quoted, closed = [], True, False, False

    def end_record():
        nonlocal fields, blank
        end_value()
        if not blank:
            records.append(fields)
        fields, blank = [], True

    while at < n:
        c = text[at]
        if quoted:
            if c == '"' and text[at + 1 : at + 2] == '"':
                value.append(('"', True))
                at += 1
            elif c == '"':
                value.append(("", True))
                quoted, closed = False, len(value)
            else:
                value.append((c, True))
        elif c == "\n":
            if value and value[-1] == ("\r", False):
                value.pop()
            end_record()
        elif c == sep:
            blank = False
            end_value()
        elif c == "\\" and at + 1 < n:
            at += 1
            value.append((text[at], True))
            began, blank = False, False
        elif c == '"' and began:
            value, quoted, began, blank = [], True, False, False
        else:
            began = began and c in " \t"
            blank = blank and c in csv_records.BLANKS
            value.append((c, False))
        at += 1
    if quoted:
        return None
    if value or fields or not blank:
        if value and value[-1] == ("\r", False):
            value.pop()
        end_record()
    return records


def _stripped(value):
    """Without blanks at both ends; escaped ones stay."""
    a, b = 0, len(value)
    while a < b and not value[a][1] and value[a][0] in csv_records.BLANKS:
        a += 1
    while b > a and not value[b - 1][1] and value[b - 1][0] in csv_records.BLANKS:
        b -= 1
    return value[a:b]


def some_text(rng: random.Random, sep: str, n: int) -> str:
    """Records of every awkward kind, all of whose quotes close."""
    word = lambda: "".join(rng.choice("abc é漢") for _ in range(rng.randrange(5))).strip()

    def value():
        kind = rng.randrange(10)
        if kind < 4:
            return word()
        if kind < 7:
            inner = "".join(rng.choice(["a", "\n", sep, '""', "\r\n", "\\", " "]) for _ in range(rng.randrange(8)))
            return rng.choice(["", " "]) + f'"{inner}"' + rng.choice(["", " ", "tail"])
        if kind < 9:
            return "x" + "".join(rng.choice(["\\" + sep, "\\\\", '\\"', "\\\n", '"', "z"]) for _ in range(rng.randrange(4))) + "y"
        return "  " + word() + " "

    lines = []
    for i in range(n):
        lines.append(sep.join([f"k{i}", *[value() for _ in range(rng.randrange(9))]]) + rng.choice(["\n", "\n", "\r\n", "\n\n"]))
    return "".join(lines)


@pytest.mark.parametrize("sep", [",", "|"])
def test_lexer_agrees_with_reading_by_character(sep):
    rng, lexer = random.Random(4), csv_records.Lexer(sep)
    for _ in range(300):
        text = some_text(rng, sep, 6)
        state, records, now = 0, [], []
        for line in text.removesuffix("\n").split("\n"):
            now.append(line)
            state = lexer.after(line.removesuffix("\r"), state)
            if state == 0:
                records.append("\n".join(now).removesuffix("\r"))
                now = []
        got = [lexer.fields(r) for r in records if r.strip()]
        assert got == plain_records(text, sep)


@pytest.fixture(params=["300", "5000", "100000000"])
def split_bytes(spark, request):
    names = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield int(request.param)
    for n, v in before.items():
        spark.conf.set(n, v)


def test_records_do_not_depend_on_splits(spark, tmp_path, split_bytes):
    rng = random.Random(9)
    header = "\n" + ",".join(formats.CUSTOMERS.columns) + "\n"
    expected = {}
    for name in ("Customers.csv", "more_customers_2.csv"):
        text = some_text(rng, ",", 300)
        (tmp_path / name).write_bytes((header + text).encode())
        tokens = set(formats.CSV_NULL_TOKENS)
        for i, values in enumerate(plain_records(text, ","), 1):
            cut = [None if v in tokens else v for v in (values + [None] * 10)[:10]]
            expected[name, i] = (cut, len(values) > 10)
    rows = csv_files.read_csv_customers(spark, str(tmp_path), "B", AS_OF, pattern=formats.CUSTOMERS.pattern)
    got = rows.collect()
    assert {(r.source_file_name, r.file_row_number): ([r[n] for n in NAMES], r[formats.CORRUPT] is not None) for r in got} == expected
    assert len(got) == len(expected) == len({r.raw_record_id for r in got})


def test_a_long_value_over_many_splits(spark, tmp_path, split_bytes):
    """One value of 40 KB of lines, then a file whose quote never closes."""
    long = "\n".join(f'line {i}, ""said""' for i in range(2000))
    (tmp_path / "Customers.csv").write_text(f'h\n1,"{long}",x\n2,b\n')
    (tmp_path / "broken_customers.csv").write_text('h\n1,a\n2,"open\n3,c\n4,d\n')
    rows = csv_files.read_csv_customers(spark, str(tmp_path), "B", AS_OF).collect()
    whole = sorted((r for r in rows if r.source_file_name == "Customers.csv"), key=lambda r: r.file_row_number)
    assert [(r.customer_id_raw, r.first_name_raw, r.last_name_raw) for r in whole] == [("1", long.replace('""', '"'), "x"), ("2", "b", None)]
    broken = [r for r in rows if r.source_file_name != "Customers.csv"]
    assert [r.customer_id_raw for r in broken if r[formats.CORRUPT] is None] == ["1"]
    assert sorted(r[formats.CORRUPT] for r in broken if r[formats.CORRUPT]) == ["2,\"open", "3,c", "4,d"]


def test_a_record_of_too_many_bytes_is_kept_line_by_line(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_records, "LONGEST_RECORD", 20)
    (tmp_path / "Customers.csv").write_text('h\n1,"a\nb"\n2,"cccccccccc\ndddddddddd"\n3,e\n')
    rows = csv_files.read_csv_customers(spark, str(tmp_path), "B", AS_OF).collect()
    assert sorted((r.customer_id_raw, r.first_name_raw) for r in rows if r[formats.CORRUPT] is None) == [("1", "a\nb"), ("3", "e")]
    assert sorted(r[formats.CORRUPT] for r in rows if r[formats.CORRUPT]) == ['2,"cccccccccc', 'dddddddddd"']
    assert csv_files.csv_overflow(csv_files.read_csv_customers(spark, str(tmp_path), "B", AS_OF)).count() == 2


def test_other_formats_and_bad_bytes(spark, tmp_path):
    (tmp_path / "Customers.csv").write_bytes(b"1,N/A,null,a\xffb\n")
    rows = csv_files.read_csv_customers(spark, str(tmp_path), "B", AS_OF, fmt=formats.CSV_NO_HEADER).collect()
    assert [(r.customer_id_raw, r.first_name_raw, r.last_name_raw, r.email_raw, r.file_row_number) for r in rows] == [("1", "N/A", None, "a�b", 1)]
    (tmp_path / "Customers.csv").unlink()
    with gzip.open(tmp_path / "Customers.csv.gz", "wt") as out:
        out.write('id|first\n1|"a|\nb"|c\\|d, e\n')
    rows = csv_files.read_csv_customers(spark, str(tmp_path), "B", AS_OF, fmt=formats.CSV_PIPE).collect()
    assert [(r.customer_id_raw, r.first_name_raw, r.last_name_raw) for r in rows] == [("1", "a|\nb", "c|d, e")]


def test_no_files_rows_or_lines(spark, tmp_path):
    (tmp_path / "Customers.csv").write_text("")
    (tmp_path / "b_customers.csv").write_text("only,a,header\n\n \n")
    assert csv_files.read_csv_customers(spark, str(tmp_path), "B", AS_OF).count() == 0
