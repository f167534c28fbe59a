"""Reconciles scan findings with an allowlist, over many scan documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parceltide.operators.validate import ContractViolation, count_violations, enforce, key_violations, union_all
from parceltide.session import stage

# Severities, patterns and layouts.
GATED = ("CRITICAL", "HIGH")
REPORT_ONLY = ("MEDIUM", "LOW")
CVE = "^CVE-[0-9]{4}-[0-9]{4,}\\z"
TRACKER = "^https://security-tracker\\.debian\\.org/tracker/CVE-[0-9]{4}-[0-9]{4,}\\z"
FULL_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}\\z"
RATIONALE_LIMIT = 1000
SCAN_SCHEMA = (
    "unreadable string, imageScanStatus struct<status: string>, imageScanFindings struct<findings: array<struct<"
    "name: string, severity: string, uri: string, attributes: array<struct<key: string, value: string>>>>>"
)


def parse_scans(documents: DataFrame, text: str = "document") -> DataFrame:
    """Scan documents as structs; the other columns stay. Text that is no JSON is kept in ``scan.unreadable``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "unreadable"}
    return documents.withColumn("scan", F.from_json(text, SCAN_SCHEMA, options)).drop(text)


def scan_violations(scans: DataFrame) -> DataFrame:
    """Rules of whole documents: readable, complete, and with a list of findings, which may be empty."""
    broken = F.col("scan").isNull() | F.col("scan.unreadable").isNotNull()
    return count_violations("scans", scans, [
        ("readable", "document", broken),
        ("complete", "status", ~broken & ~F.col("scan.imageScanStatus.status").eqNullSafe("COMPLETE")),
        ("nonmissing", "findings", ~broken & F.col("scan.imageScanFindings.findings").isNull()),
    ])


def flatten_findings(scans: DataFrame) -> DataFrame:
    """One row per finding; a scan without findings has none. ``package`` and ``version`` come from the attributes.

    A repeated attribute key would make map building fail, so it is flagged and
    the map is built from the remaining rows only.
    """
    other = [c for c in scans.columns if c != "scan"]
    found = scans.select(
        *other, F.col("scan.imageScanStatus.status").alias("status"),
        F.inline("scan.imageScanFindings.findings"),
    )
    keys = F.transform("attributes", lambda a: a["key"])
    repeated = F.size(F.array_distinct(keys)) < F.size(keys)
    lookup = F.map_from_entries(F.when(~repeated, F.col("attributes")))
    return found.select(
        *other, "status", F.col("name").alias("cve"), "severity",
        lookup["package_name"].alias("package"), lookup["package_version"].alias("version"),
        F.coalesce(repeated, F.lit(False)).alias("duplicate_attribute"),
    )


def gated(findings: DataFrame) -> DataFrame:
    return findings.where(F.col("severity").isin(*GATED))


def report_only(findings: DataFrame) -> DataFrame:
    return findings.where(F.col("severity").isin(*REPORT_ONLY))


def _untidy(c: Column) -> Column:
    return c.isNull() | (c == "") | c.rlike(r"^\s|\s$") | c.rlike("[\\n\\r\\x00]")


def finding_violations(findings: DataFrame, key: tuple[str, ...] = ("cve",)) -> DataFrame:
    """Field rules and duplicate findings of the flattened scans."""
    severity = F.col("severity")
    rules = [
        ("cve_format", "cve", F.coalesce(~F.col("cve").rlike(CVE), F.lit(True))),
        ("known_severity", "severity", severity.isNull() | ~severity.isin(*GATED, *REPORT_ONLY)),
        ("duplicate_attribute", "attributes", F.col("duplicate_attribute")),
        ("tidy_text", "package", _untidy(F.col("package"))),
        ("tidy_text", "version", _untidy(F.col("version"))),
    ]
    return count_violations("findings", findings, rules).unionByName(
        key_violations(findings, key, "findings")
    )


def allowlist_violations(
    allowlist: DataFrame, today: str, expected_entries: int | None = None, key: tuple[str, ...] = ("cve",)
) -> DataFrame:
    """Field rules, expiry on ``today``, duplicates and, optionally, the entry count."""
    cve, source, rationale = F.col("cve"), F.col("source"), F.col("rationale")
    review = F.when(F.col("review_by").rlike(FULL_DATE), F.col("review_by")).try_cast("date")
    rules = [
        ("cve_format", "cve", F.coalesce(~cve.rlike(CVE), F.lit(True))),
        ("gated_severity", "severity", F.coalesce(~F.col("severity").isin(*GATED), F.lit(True))),
        ("tidy_text", "package", _untidy(F.col("package"))),
        ("tidy_text", "version", _untidy(F.col("version"))),
        ("tidy_text", "rationale", _untidy(rationale)),
        ("length", "rationale", F.length(rationale) > RATIONALE_LIMIT),
        ("tracker_url", "source", F.coalesce(
            ~source.rlike(TRACKER) | (F.substring_index(source, "/", -1) != cve), F.lit(True))),
        ("date", "review_by", review.isNull()),
        ("expired", "review_by", F.coalesce(review < F.lit(today).cast("date"), F.lit(False))),
    ]
    parts = [count_violations("allowlist", allowlist, rules), key_violations(allowlist, key, "allowlist")]
    if expected_entries is not None:
        parts.append(allowlist.agg(F.count("*").alias("n")).select(
            F.lit("allowlist").alias("table"), F.lit("entry_count").alias("rule"),
            F.lit("*").alias("column"), F.abs(F.col("n") - expected_entries).alias("violations"),
        ))
    return union_all(parts)


def reconcile_findings(findings: DataFrame, allowlist: DataFrame) -> DataFrame:
    """Gated findings against the allowlist: approved, mismatch, unexpected or stale.

    A CVE found in very many scans is a hot key. A left join can be split on the
    finding side, which a full outer join cannot; stale entries are therefore a
    separate anti-join against the distinct CVEs found.
    """
    record = lambda side: [F.col(f"{side}.{c}") for c in ("severity", "package", "version")]
    found = stage(gated(findings), "gated")  # read twice below; the documents are parsed once
    f, a = found.alias("f"), allowlist.alias("a")
    same = [x.eqNullSafe(y) for x, y in zip(record("f"), record("a"))]
    outcome = (
        F.when(F.col("a.cve").isNull(), "unexpected")
        .when(same[0] & same[1] & same[2], "approved")
        .otherwise("mismatch")
    )
    matched = f.join(a, F.col("f.cve") == F.col("a.cve"), "left").select(
        F.col("f.cve").alias("cve"), outcome.alias("outcome"),
        F.col("f.version").alias("found_version"), F.col("a.version").alias("allowed_version"),
    )
    stale = allowlist.join(found.select("cve").distinct(), "cve", "left_anti").select(
        "cve", F.lit("stale").alias("outcome"),
        F.lit(None).cast("string").alias("found_version"), F.col("version").alias("allowed_version"),
    )
    return matched.unionByName(stale)


def gate(
    documents: DataFrame, allowlist: DataFrame, today: str, expected_entries: int | None = None,
    key: tuple[str, ...] = ("cve",),
) -> DataFrame:
    """Raise unless every rule holds and every gated finding is allowed; returns the report-only findings.

    Mismatched, unexpected and stale entries fail as well as expired ones.
    """
    scans = stage(parse_scans(documents), "scans")
    findings = flatten_findings(scans)
    enforce(union_all([
        scan_violations(scans), finding_violations(findings, key),
        allowlist_violations(allowlist, today, expected_entries),
    ]))
    outcomes = reconcile_findings(findings, allowlist).where("outcome <> 'approved'")
    counts = {r["outcome"]: r["n"] for r in outcomes.groupBy("outcome").agg(F.count("*").alias("n")).collect()}
    if counts:
        raise ContractViolation(f"findings and allowlist differ: {dict(sorted(counts.items()))}")
    return report_only(findings)
