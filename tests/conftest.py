import csv
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parceltide import contracts as C  # noqa: E402
from parceltide.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="parceltide-tests")
    yield session
    session.stop()


ROWS = {
    "orders": [
        ("o1", "c1", "delivered", "2018-01-01 10:00:00", "2018-01-01 11:30:00", "", "2018-01-10 23:59:59", "2018-01-10 00:00:00"),
        ("o2", "c2", "delivered", "2018-01-06 23:10:00", "2018-01-06 23:10:00", "", "2018-01-21 00:00:01", "2018-01-20 23:59:59"),
        ("o3", "c3", "delivered", "2018-02-04 00:00:00", "", "", "2018-02-10 08:00:00", "2018-02-20 00:00:00"),
        ("o4", "c4", "canceled", "2018-02-05 00:00:00", "", "", "", "2018-02-20 00:00:00"),
    ],
    "customers": [
        ("c1", "u1", "00011", "a", "SP"), ("c2", "u2", "00022", "b", "RJ"),
        ("c3", "u3", "99999", "c", "MG"), ("c4", "u1", "00011", "a", "SP"),
    ],
    "items": [
        ("o1", "1", "pA", "sY", "", "10.00", "2.50"), ("o1", "2", "pB", "sX", "", "10.00", "2.50"),
        ("o2", "1", "pA", "sX", "", "7.50", "0.00"), ("o3", "1", "pC", "sX", "", "3.10", "1.00"),
        ("o4", "1", "pA", "sX", "", "5.00", "1.00"),
    ],
    "products": [
        ("pA", "livros", "", "", "", "100", "10", "2", "5"),
        ("pB", "arte", "", "", "", "50", "4", "4", "4"),
        ("pC", "", "", "", "", "", "", "", ""),
    ],
    "sellers": [("sX", "00011", "a", "SP"), ("sY", "00022", "b", "RJ")],
    "payments": [
        ("o1", "1", "voucher", "1", "12.50"), ("o1", "2", "boleto", "2", "12.50"),
        ("o2", "1", "credit_card", "3", "7.50"), ("o4", "1", "credit_card", "1", "6.00"),
    ],
    "geolocation": [
        ("00011", "-23", "-46", "a", "SP"), ("00011", "-21", "-44", "a", "SP"), ("00011", "-23", "-46", "a", "SP"),
        ("00022", "-10", "-50", "b", "RJ"), ("00033", "42.184003", "-8.723762", "x", "XX"),
    ],
    "translations": [("livros", "books"), ("arte", "art")],
}


def write_sources(folder, rows=ROWS, headers=None):
    folder.mkdir(parents=True, exist_ok=True)
    for name, filename in C.SOURCE_FILES.items():
        with open(folder / filename, "w", newline="") as handle:
            out = csv.writer(handle)
            out.writerow((headers or {}).get(name, C.SOURCE_HEADERS[name]))
            out.writerows(rows[name])
    return str(folder)


@pytest.fixture
def csv_root(tmp_path):
    return write_sources(tmp_path / "raw")


@pytest.fixture
def changed(tmp_path):
    """Write the mini sources with some tables replaced."""

    def build(**tables):
        return write_sources(tmp_path / "changed", {**ROWS, **tables})

    return build


@pytest.fixture(scope="session")
def mini(spark):
    """Typed mini sources, straight from the rows."""
    from parceltide.sources.csv_files import normalise_missing, type_sources

    raw = {
        name: spark.createDataFrame(rows, C.csv_schema(name)).select(*C.USED_COLUMNS[name])
        for name, rows in ROWS.items()
    }
    return type_sources(normalise_missing(raw))
