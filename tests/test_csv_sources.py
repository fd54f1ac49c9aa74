"""Dialect detection, CSV read in splits, and type inference."""

import csv
import random

import pytest
from pyspark.sql import types as T

from orderloom.schemas import RAW_ORDERS
from orderloom.sources.csv_splits import read_csv_splits, records
from orderloom.sources.dialect import Dialect, detect, sniff
from orderloom.sources.files import read_orders_csv
from orderloom.sources.infer import infer_types, read_csv_inferred

HEADER = RAW_ORDERS.fieldNames()


def _orders(n=40):
    odd = ["plain", "with, comma", "semi;colon", "tab\there", "pi|pe", 'quo"ted', "two\nlines", "", " spaced ", "'single'"]
    return [[f"L{i}", f"O{i // 2}", "2024-01-01", f"C{i}", odd[i % len(odd)], *(f"v{i}.{k}" for k in range(11))] for i in range(n)]


def _write(path, rows, delimiter=",", quote='"', backslash=False, newline="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, delimiter=delimiter, quotechar=quote, doublequote=not backslash, escapechar="\\" if backslash else None, lineterminator=newline,
                       quoting=csv.QUOTE_ALL if backslash else csv.QUOTE_MINIMAL)
        w.writerows(rows)


@pytest.mark.parametrize("delimiter", [",", ";", "\t", "|"])
@pytest.mark.parametrize("quote,backslash", [('"', False), ("'", False), ('"', True)])
def test_each_dialect_gives_the_same_rows(spark, tmp_path, delimiter, quote, backslash):
    rows = _orders()
    _write(tmp_path / "orders.csv", [HEADER, *rows], delimiter, quote, backslash)
    got = sorted(tuple(r) for r in read_orders_csv(spark, str(tmp_path)).collect())
    assert detect(spark, str(tmp_path)).delimiter == delimiter
    assert [tuple(x or "" for x in r) for r in got] == sorted(tuple(r) for r in rows)      # an empty field is NULL


def test_undecidable_lines_raise_and_no_lines_do_not(spark, tmp_path):
    (tmp_path / "a.csv").write_text("just\nwords\nin lines\n")
    with pytest.raises(ValueError):
        read_orders_csv(spark, str(tmp_path))
    with pytest.raises(ValueError):
        sniff(["a,b", "c;d;e", "f|g", "h"])
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "b.csv").write_text("")
    assert read_orders_csv(spark, str(empty)).count() == 0


def test_sample_cut_inside_a_record():
    lines = ["a;b;c", *["1;2;3"] * 20, '4;"open']
    assert sniff(lines, cut_off=True) == Dialect(";", '"', '"')


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "text", "more")])


def _rows(seed, n):
    draw = random.Random(seed)
    texts = ["x", "", 'say "hi"', "line\nbreak", "\n", "a\n\nb\n", "cr\r\nlf", "l" * 400, "nested\n" * 60, ",", '"', '""\n""', "é😀\n中", " lead", "trail "]
    return [[f"{i}", draw.choice(texts), draw.choice(texts)] for i in range(n)]


@pytest.mark.parametrize("dialect,newline", [(Dialect(), "\n"), (Dialect(), "\r\n"), (Dialect(";", "'", "'"), "\n"), (Dialect("|", '"', "\\"), "\n")])
def test_splits_equal_the_multiline_reader(spark, tmp_path, small_splits, dialect, newline):
    backslash = dialect.escape != dialect.quote
    for file in range(3):
        _write(tmp_path / f"{file}.csv", [SCHEMA.fieldNames(), *_rows(file, 120)], dialect.delimiter, dialect.quote, backslash, newline)
    (tmp_path / "header.csv").write_text(dialect.delimiter.join(SCHEMA.fieldNames()) + newline)
    (tmp_path / "short.csv").write_text(newline.join([dialect.delimiter.join(SCHEMA.fieldNames()), "only one", dialect.delimiter.join("abc"), "", ""]))
    found = read_csv_splits(spark, str(tmp_path), SCHEMA, dialect)
    assert records(spark, str(tmp_path), dialect).rdd.getNumPartitions() > 30
    whole = (spark.read.schema(T.StructType([*SCHEMA.fields, T.StructField("_corrupt_record", T.StringType())])).options(**dialect.options())
             .options(header=True, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record").csv(str(tmp_path)))
    expected = whole.where("_corrupt_record IS NULL AND coalesce(length(more), 0) >= 0").select(*SCHEMA.fieldNames())
    key = lambda r: tuple(x or "" for x in r)
    assert sorted(map(key, found.collect())) == sorted(map(key, expected.collect()))
    assert found.count() == 361


def test_large_files_are_split_by_default(spark, tmp_path, small_splits):
    _write(tmp_path / "orders.csv", [HEADER, *_orders(60)])
    df = read_orders_csv(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() > 4
    assert sorted(r.line_id for r in df.collect()) == sorted(f"L{i}" for i in range(60))


def test_types_of_mixed_columns(spark, duck, tmp_path):
    columns = {"i": ["1", "-2", "03", ""], "plus": ["1", "+2", "3", "4"], "big": ["9223372036854775807", "1", "2", "3"], "d": ["1", "2.5", "1e3", "-.5"],
               "too_big": ["9223372036854775808", "1", "2", "3"], "day": ["2024-01-01", "2024-02-29", "", "1999-12-31"],
               "moment": ["2024-01-01 10:00:00", "2024-01-02", "2024-01-03T11:12:13.5", ""],
               "no_day": ["2024-02-30", "2024-01-01", "2024-01-02", "2024-01-03"], "yes": ["true", "FALSE", "True", ""], "text": ["a", "1", "2024-01-01", "true"],
               "nothing": ["", "", "", ""]}
    path = tmp_path / "mixed.csv"
    _write(path, [list(columns), *zip(*columns.values())])
    got = dict(read_csv_inferred(spark, str(path)).dtypes)
    names = {"bigint": "BIGINT", "decimal(38,0)": "HUGEINT", "double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "string": "VARCHAR"}
    expected = {r[0]: r[1] for r in duck.execute(f"DESCRIBE SELECT * FROM read_csv_auto('{path}', header = true)").fetchall()}
    assert {c: names[t] for c, t in got.items()} == expected
    assert [r.d for r in read_csv_inferred(spark, str(path)).collect()] == [1.0, 2.5, 1000.0, -0.5]


def test_inference_sees_every_row(spark):
    df = spark.range(5000).selectExpr("CASE WHEN id = 4321 THEN 'x' ELSE string(id) END AS a", "string(id) AS b", "CAST(NULL AS string) AS c")
    assert infer_types(df) == {"a": "string", "b": "bigint", "c": "string"}
