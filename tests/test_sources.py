import os

import pytest

from conftest import ROWS, write_sources
from jobs import build_features as job
from parceltide import contracts as C
from parceltide.functions import parsing as P
from parceltide.operators.validate import ContractViolation
from parceltide.plans.ingest import ingest
from parceltide.session import size_shuffles
from parceltide.sources import csv_files, tables
from pyspark.sql import functions as F


def test_schemas_are_text_and_reviews_are_not_an_input():
    for name in C.SOURCE_FILES:
        assert all(f.dataType.simpleString() == "string" for f in C.csv_schema(name))
    assert len(C.SOURCE_FILES) == 8
    assert not any("review" in text for pair in C.SOURCE_FILES.items() for text in pair)


def test_feature_contract_shape():
    assert len(C.FEATURE_ROW) == 33 and len(C.MODEL_FEATURES) == 30
    assert C.FEATURE_ROW[:2] == C.METADATA and C.FEATURE_ROW[-1] == C.TARGET
    assert not set(C.MODEL_FEATURES) & C.FORBIDDEN_FEATURES
    assert len(C.NOT_NULL_FEATURES) == 10


def test_uri_join():
    assert csv_files.uri_join("data/raw", "x.csv") == "data/raw/x.csv"
    assert csv_files.uri_join("s3://bucket/a/", "x.csv") == "s3://bucket/a/x.csv"


def test_job_arguments():
    args = job.parse_args(["--source-root", "a", "--output", "b", "--JOB_NAME", "x", "--TempDir", "t"])
    assert (args.source_root, args.output) == ("a", "b")
    for partial in (["--source-root", "a"], ["--output", "b"]):
        with pytest.raises(SystemExit):
            job.parse_args(partial)


def test_ingest_keeps_leading_zeros_and_types(spark, csv_root):
    sources = ingest(spark, csv_root)
    assert sources["customers"].where("customer_id = 'c1'").first()["customer_zip_code_prefix"] == "00011"
    kinds = dict(sources["payments"].dtypes)
    assert kinds["payment_value"] == "double" and kinds["payment_sequential"] == "bigint"
    assert dict(sources["orders"].dtypes)["order_purchase_timestamp"] == "timestamp_ntz"
    assert sources["products"].where("product_category_name IS NULL").count() == 1


def test_reordered_header_fails(spark, tmp_path):
    header = ("seller_zip_code_prefix", "seller_id", "seller_city", "seller_state")
    root = write_sources(tmp_path / "raw", headers={"sellers": header})
    with pytest.raises(ValueError, match="header"):
        csv_files.check_headers(spark, root)
    with pytest.raises(Exception):
        csv_files.read_raw(spark, root)["sellers"].collect()


@pytest.mark.parametrize("line", ["pX,livros,,,,100", "pX,livros,,,,100,10,2,5,6,7"])
def test_rows_with_another_field_count_fail(spark, csv_root, line):
    with open(f"{csv_root}/{C.SOURCE_FILES['products']}", "a") as handle:
        handle.write(line + "\n")
    with pytest.raises(Exception, match="MALFORMED|[Mm]alformed"):
        ingest(spark, csv_root)


def test_the_bad_file_is_named_before_the_scan(spark, tmp_path):
    root = write_sources(tmp_path / "raw")
    sellers = tmp_path / "raw" / C.SOURCE_FILES["sellers"]
    rows = sellers.read_text()
    sellers.unlink()
    sellers.mkdir()
    (sellers / "part-0.csv").write_text(rows)
    (sellers / "part-1.csv").write_text(rows.replace("seller_city", "seller_town"))
    (sellers / "part-2.csv").write_bytes(b'"seller_id","seller_zip_code_prefix"\r\nx,1\r\n')
    (tmp_path / "raw" / C.SOURCE_FILES["translations"]).write_bytes(b"")
    paths = {n: csv_files.uri_join(root, f) for n, f in C.SOURCE_FILES.items()}
    got = {(r.source, r.path and r.path[-10:], r.position, r.expected, r.found) for r in csv_files.header_differences(spark, paths).collect()}
    assert got == {
        ("sellers", "part-1.csv", 3, "seller_city", "seller_town"), ("sellers", "part-2.csv", 3, "seller_city", None),
        ("translations", None, 1, "product_category_name", None),
    }
    with pytest.raises(ValueError, match="part-1.csv: column 3 is 'seller_town', not 'seller_city'"):
        csv_files.check_headers(spark, root)


def test_every_file_of_a_source_needs_the_header(spark, tmp_path):
    root = write_sources(tmp_path / "raw")
    path = tmp_path / "raw" / C.SOURCE_FILES["sellers"]
    text = path.read_text()
    path.unlink()
    path.mkdir()
    (path / "a.csv").write_text(text)
    (path / "b.csv").write_text(text.replace("seller_city", "seller_town"))
    with pytest.raises(Exception, match="header|Header"):
        csv_files.read_raw(spark, root)["sellers"].collect()


def test_prices_with_more_decimals_are_taken(spark, changed):
    sources = ingest(spark, changed(items=[*ROWS["items"], ("o4", "2", "pA", "sX", "", "1.005", "1.00")]))
    assert sources["items"].where("price = 1.005").count() == 1


@pytest.mark.parametrize(
    "table, row, message",
    [
        ("items", ("o4", "2", "pA", "sX", "", "bad", "1.00"), "items.price: numeric"),
        ("items", ("o4", "1.5", "pA", "sX", "", "1.00", "1.00"), "items.order_item_id: integer"),
        ("items", ("o4", "2", "pA", "sX", "", "-1.00", "1.00"), "items.price: nonnegative"),
        ("items", ("o4", "2", "pA", "sX", "", "  ", "1.00"), "items.price: numeric"),
        ("orders", ("o5", "c5", "created", "2018-01-01", "", "", "", "2018-01-01 00:00:00"), "order_purchase_timestamp: timestamp"),
        ("orders", ("o5", "c5", "created", "2018-01-01 00:00:00", "", "", "", ""), "order_estimated_delivery_date: nonmissing"),
        ("geolocation", ("1", "91", "0", "", ""), "geolocation_lat: world_bounds"),
        ("geolocation", ("1", "", "0", "", ""), "geolocation_lat: nonmissing"),
    ],
)
def test_bad_rows_are_reported(spark, changed, table, row, message):
    with pytest.raises(ContractViolation, match=message):
        ingest(spark, changed(**{table: [*ROWS[table], row]}))


def test_missing_tokens_and_numbers(spark):
    texts = ["1", "2.0", " 3 ", "2.5", "1d", "abc", "", "NA", "nan", "1e3", "9007199254740993", "inf",
             "1234567890123456789", "9100000000000000001", "9300000000000000000", "1e30"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    clean = P.text_or_null(F.col("t"))
    rows = frame.select(
        "t", clean.alias("c"), P.double_or_null(clean).alias("d"), P.long_or_null(clean).alias("n")
    ).orderBy("i").collect()
    got = {r["t"]: (r["d"], r["n"]) for r in rows}
    assert got["1"] == (1.0, 1) and got["2.0"] == (2.0, 2) and got[" 3 "] == (3.0, 3)
    assert got["2.5"] == (2.5, None) and got["1e3"] == (1000.0, 1000)
    assert got["1d"] == got["abc"] == (None, None)
    assert got["9007199254740993"][1] == 9007199254740993
    assert got["inf"] == (float("inf"), None)
    assert got["1234567890123456789"][1] == 1234567890123456789 and got["9100000000000000001"][1] == 9100000000000000001
    assert got["9300000000000000000"][1] is None and got["1e30"][1] is None
    assert all(r["c"] is None for r in rows if r["t"] in ("", "NA", "nan"))


def test_parse_rules_of_text_sources(spark):
    from conftest import ROWS
    from parceltide.operators.validate import parse_violations

    rows = {**ROWS, "payments": [("o1", "x", "voucher", "1.5", "abc")]}
    raw = {n: spark.createDataFrame(r, C.csv_schema(n)).select(*C.USED_COLUMNS[n]) for n, r in rows.items()}
    clean = csv_files.normalise_missing(raw)
    found = {(r["column"], r["rule"]) for r in parse_violations(clean).collect() if r["violations"]}
    assert found == {("payment_value", "numeric"), ("payment_sequential", "integer"), ("payment_installments", "integer")}


def test_shuffles_follow_the_input_size(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    (tmp_path / "x.bin").write_bytes(b"0" * 4000)
    try:
        assert size_shuffles(spark, str(tmp_path), bytes_each=100) == 40
        assert size_shuffles(spark, str(tmp_path), bytes_each=1) == 4000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_timestamps_do_not_depend_on_the_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        text = spark.createDataFrame([("2018-03-11 02:30:00",), ("2018-03-11 02:30",)], "t string")
        stamps = text.select(P.timestamp_or_null(F.col("t")).cast("string").alias("s")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r["s"] for r in stamps] == ["2018-03-11 02:30:00", None]


def test_job_end_to_end(spark, csv_root, tmp_path):
    output = str(tmp_path / "features")
    expected = {"rows": 3, "unique_order_id": 3, "late": 1, "on_time": 2, "eligible_orders_without_payment": 1}
    assert job.run(spark, csv_root, output, expected).first().asDict() == expected
    stored = tables.read_external(spark, output)
    assert tuple(stored.columns) == C.FEATURE_ROW
    assert dict(stored.dtypes) == C.FEATURE_TYPES
    with pytest.raises(Exception):
        job.run(spark, csv_root, output)
    with pytest.raises(ContractViolation, match="differs"):
        job.run(spark, csv_root, str(tmp_path / "again"), {**expected, "late": 2})
    assert not (tmp_path / "again").exists()  # nothing is published before it is checked
    report = spark.read.json(f"{output}_quality").first()
    assert len(report["missing_values"]) == 33


def test_manifest_detects_changes(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "a.csv").write_text("1\n")
    (folder / "b.csv").write_text("2\n")
    before = spark.createDataFrame(
        tables.build_manifest(spark, str(folder)).collect()
    )
    assert {r["status"] for r in tables.verify_manifest(before, tables.build_manifest(spark, str(folder))).collect()} == {"ok"}
    (folder / "b.csv").write_text("3\n")
    (folder / "c.csv").write_text("4\n")
    status = {
        r["filename"]: r["status"]
        for r in tables.verify_manifest(before, tables.build_manifest(spark, str(folder))).collect()
    }
    assert status == {"a.csv": "ok", "b.csv": "checksum", "c.csv": "unexpected"}
    assert tables.list_files(spark, str(folder)).count() == 3


def test_manifest_tells_folders_apart(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0.csv").write_text(name)
    before = spark.createDataFrame(tables.build_manifest(spark, str(tmp_path)).collect())
    (tmp_path / "y" / "part-0.csv").unlink()
    found = {r["filename"]: r["status"] for r in tables.verify_manifest(before, tables.build_manifest(spark, str(tmp_path))).collect()}
    assert found == {"x/part-0.csv": "ok", "y/part-0.csv": "missing"}


def test_files_are_read_as_streams_of_blocks(spark, tmp_path):
    import hashlib

    from parceltide.sources import digests

    (tmp_path / "sub").mkdir()
    rows = {"empty": b"", "one block": bytes(100), "sub/many": os.urandom(1 << 20) + b"\n\r\x00", "sub/a b%20c=é": os.urandom(4097)}
    for name, data in rows.items():
        (tmp_path / name).write_bytes(data)
    found = {r.filename: r for r in tables.build_manifest(spark, str(tmp_path), block_bytes=4096).collect()}
    assert set(found) == set(rows) - {"empty"}  # Spark's file sources pass over files without bytes
    for name, data in rows.items():
        if not data:
            continue
        assert (found[name].size_bytes, found[name].sha256_hex) == (len(data), hashlib.sha256(data).hexdigest())

    class Counted:
        """A stream that remembers how much was asked for at once."""

        def __init__(self, data):
            self.data, self.asked = data, []

        def read(self, n):
            self.asked.append(n)
            out, self.data = self.data[:n], self.data[n:]
            return out

    stream = Counted(bytes(10_000))
    assert digests.digest_of(stream, 512)[1] == 10_000 and set(stream.asked) == {512} and len(stream.asked) == 21
    contents = spark.createDataFrame([("x", bytearray(b"abc"))], "filename string, content binary")
    whole = digests.whole_file_digests(contents).first()
    assert (whole.size_bytes, whole.sha256_hex) == (3, hashlib.sha256(b"abc").hexdigest())


def test_entries_of_a_name_must_agree(spark):
    layout = "filename string, size_bytes long, sha256_hex string, sha256_base64 string"
    make = lambda *rows: spark.createDataFrame(rows, layout)
    listed = make(("twice", 1, "a", "a"), ("twice", 1, "a", "a"), ("odd", 1, "a", "a"), ("odd", 1, "b", "a"), ("gap", 1, None, "a"))
    there = make(("twice", 1, "a", "a"), ("odd", 1, "a", "a"), ("gap", 1, "a", "a"))
    got = {r.filename: r.status for r in tables.verify_manifest(listed, there).collect()}
    assert got == {"twice": "ok", "odd": "checksum", "gap": "checksum"}
    assert tables.verify_manifest(make(), make()).count() == 0


def test_a_table_stored_as_a_folder_is_one_entry(spark, tmp_path):
    from registry.quality_queries import _STATUS

    for name in _STATUS:
        if name.startswith("gone/"):
            continue
        if name in ("documents.parquet", "region.parquet", "nation.parquet"):
            (tmp_path / name).mkdir()
            for k in range(3):
                (tmp_path / name / f"part-{k}.parquet").write_text(f"{name} {k}")
        else:
            (tmp_path / name).write_text(name)
    import __spark_entry__ as entry

    found = {r.filename: r.status for r in entry.queries()["manifest_verify"](spark, str(tmp_path)).collect()}
    assert found == _STATUS
    verified = spark.createDataFrame(
        [("a.parquet/x", "ok"), ("a.parquet/y", "checksum"), ("b.parquet/x", "unexpected"), ("b.parquet/y", "missing"), ("c.csv", "ok"), (None, "size")],
        "filename string, status string",
    )
    assert {tuple(r) for r in tables.table_status(verified).collect()} == {
        ("a.parquet", "checksum"), ("b.parquet", "missing"), ("c.csv", "ok"), (None, "size")
    }
