import json

import pytest

from parceltide.operators import findings as N

TRACKER = "https://security-tracker.debian.org/tracker/"


def document(*found, status="COMPLETE"):
    return json.dumps({
        "imageScanStatus": {"status": status},
        "imageScanFindings": {"findings": [
            {"name": cve, "severity": severity, "uri": "", "attributes": [{"key": k, "value": v} for k, v in attributes]}
            for cve, severity, attributes in found
        ]},
    })


def package(name="zlib", version="1.0"):
    return [("package_name", name), ("package_version", version)]


def flat(spark, *documents):
    frame = spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "image int, document string")
    return N.flatten_findings(N.parse_scans(frame))


def allow(spark, *rows):
    layout = "cve string, severity string, package string, version string, rationale string, source string, review_by string"
    return spark.createDataFrame(rows, layout)


def entry(cve, severity="HIGH", name="zlib", version="1.0", rationale="waiting", source=None, review="2030-01-01"):
    return (cve, severity, name, version, rationale, source or TRACKER + cve, review)


def broken(violations):
    return {(r["rule"], r["column"]): r["violations"] for r in violations.collect() if r["violations"]}


def test_flatten_and_partition(spark):
    rows = flat(spark, document(("CVE-2020-0001", "HIGH", package()), ("CVE-2020-0002", "LOW", package("a", "2"))))
    assert N.gated(rows).count() == 1
    low = N.report_only(rows).first()
    assert (low["cve"], low["package"], low["version"]) == ("CVE-2020-0002", "a", "2")
    assert broken(N.finding_violations(rows)) == {}


@pytest.mark.parametrize("documents, rule", [
    ((document(("CVE-20-1", "HIGH", package())),), ("cve_format", "cve")),
    ((document(("CVE-2020-0001", "ODD", package())),), ("known_severity", "severity")),
    ((document(("CVE-2020-0001", "HIGH", package() + package())),), ("duplicate_attribute", "attributes")),
    ((document(("CVE-2020-0001", "HIGH", package(" zlib"))),), ("tidy_text", "package")),
    ((document(("CVE-2020-0001", "HIGH", [])),), ("tidy_text", "version")),
    ((document(("CVE-2020-0001", "HIGH", package())),) * 2, ("duplicate_key", "cve")),
])
def test_finding_rules(spark, documents, rule):
    assert rule in broken(N.finding_violations(flat(spark, *documents)))


@pytest.mark.parametrize("row, rule", [
    (entry("CVE-1"), ("cve_format", "cve")),
    (entry("CVE-2020-0001", severity="LOW"), ("gated_severity", "severity")),
    (entry("CVE-2020-0001", rationale="x" * 1001), ("length", "rationale")),
    (entry("CVE-2020-0001", rationale=""), ("tidy_text", "rationale")),
    (entry("CVE-2020-0001", source=TRACKER + "CVE-2020-0002"), ("tracker_url", "source")),
    (entry("CVE-2020-0001", review="soon"), ("date", "review_by")),
    (entry("CVE-2020-0001", review="2030"), ("date", "review_by")),
    (entry("CVE-2020-0001", review="2030-1-5"), ("date", "review_by")),
    (entry("CVE-2020-0001", review="2023-12-31"), ("expired", "review_by")),
])
def test_allowlist_rules(spark, row, rule):
    assert rule in broken(N.allowlist_violations(allow(spark, row), "2024-01-01"))


def test_allowlist_count_and_duplicates(spark):
    rows = allow(spark, entry("CVE-2020-0001"), entry("CVE-2020-0001"))
    got = broken(N.allowlist_violations(rows, "2024-01-01", expected_entries=1))
    assert got == {("duplicate_key", "cve"): 2, ("entry_count", "*"): 1}
    assert broken(N.allowlist_violations(allow(spark, entry("CVE-2020-0001")), "2030-01-01", 1)) == {}


def test_reconcile(spark):
    rows = flat(spark, document(
        ("CVE-2020-0001", "HIGH", package()), ("CVE-2020-0002", "CRITICAL", package()),
        ("CVE-2020-0003", "HIGH", package()), ("CVE-2020-0009", "LOW", package()),
    ))
    listed = allow(spark, entry("CVE-2020-0001"), entry("CVE-2020-0002"), entry("CVE-2020-0004"))
    outcome = {r["cve"]: r["outcome"] for r in N.reconcile_findings(rows, listed).collect()}
    assert outcome == {
        "CVE-2020-0001": "approved", "CVE-2020-0002": "mismatch",
        "CVE-2020-0003": "unexpected", "CVE-2020-0004": "stale",
    }


def scans(spark, *documents):
    return spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "image int, document string")


def test_document_rules(spark):
    good = document(("CVE-2020-0001", "LOW", package()))
    frame = scans(spark, good, document(), document(status="FAILED"), "{broken", None, '{"imageScanStatus": {"status": "COMPLETE"}}')
    assert broken(N.scan_violations(N.parse_scans(frame))) == {
        ("readable", "document"): 2, ("complete", "status"): 1, ("nonmissing", "findings"): 1
    }
    assert flat(spark, document()).count() == 0  # a clean scan has no findings, and that is fine


def test_gate(spark):
    high, low = ("CVE-2020-0001", "HIGH", package()), ("CVE-2020-0002", "LOW", package("a", "2"))
    allowed = allow(spark, entry("CVE-2020-0001"))
    rows = N.gate(scans(spark, document(high, low), document()), allowed, "2024-01-01", 1).collect()
    assert [r["cve"] for r in rows] == ["CVE-2020-0002"]
    for found, listed, day, message in (
        ([document(high)], allow(spark, entry("CVE-2020-0001", version="2")), "2024-01-01", "mismatch"),
        ([document(high, ("CVE-2020-0003", "HIGH", package()))], allowed, "2024-01-01", "unexpected"),
        ([document()], allowed, "2024-01-01", "stale"),
        ([document(high)], allowed, "2031-01-01", "expired"),
        (["{broken"], allowed, "2024-01-01", "readable"),
    ):
        with pytest.raises(N.ContractViolation, match=message):
            N.gate(scans(spark, *found), listed, day)


def test_gate_job(spark, tmp_path):
    import json

    from jobs import scan_gate

    high, low = ("CVE-2020-0001", "HIGH", package()), ("CVE-2020-0002", "LOW", package("a", "2"))
    (tmp_path / "scans").mkdir()
    for name in ("x", "y"):  # the same findings in two images
        (tmp_path / "scans" / f"{name}.json").write_text(json.dumps(json.loads(document(high, low)), indent=1))
    listed = [r.asDict() for r in allow(spark, entry("CVE-2020-0001")).collect()]
    (tmp_path / "allow.json").write_text(json.dumps(listed))
    places = (str(tmp_path / "scans"), str(tmp_path / "allow.json"), str(tmp_path / "out"))
    assert [tuple(r) for r in scan_gate.run(spark, *places, "2024-01-01", 1).collect()] == [("LOW", 2)]
    (tmp_path / "allow.json").write_text("[]")
    with pytest.raises(N.ContractViolation, match="unexpected"):
        scan_gate.run(spark, places[0], places[1], str(tmp_path / "again"), "2024-01-01")
    assert not (tmp_path / "again").exists()
    args = scan_gate.parse_args(["--scans", "s", "--allowlist", "a", "--output", "o", "--as-of", "2024-01-01", "--odd"])
    assert (args.scans, args.as_of, args.expected_entries) == ("s", "2024-01-01", None)


def test_ids_of_seven_digit_parts_follow_the_check(spark, tmp_path):
    from registry import finding_queries as Q

    parts = [(k, "zlib", "Brand#3", "LARGE", 7, 1500.0) for k in (1234579, 42, 100059)]
    spark.createDataFrame(parts, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(
        str(tmp_path / "part.parquet")
    )
    found = {r.cve for r in Q._findings(spark, str(tmp_path)).where("cve LIKE 'CVE-2020%'").collect()}
    listed = {r.cve for r in Q.allowlist(spark, str(tmp_path)).collect()}
    assert found == {"CVE-2020-123457", "CVE-2020-100059"} and found <= listed
