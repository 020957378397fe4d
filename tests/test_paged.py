import datetime
import json

from tessera.sources.paged import PagedRecords, ranges

D = datetime.date


def service(url, parameters):
    """Two pages a range: the second repeats its cursor."""
    a, b = parameters["f.datum.start"], parameters["f.datum.end"]
    page = 2 if parameters.get("cursor") else 1
    return 200, json.dumps({"documents": [{"id": f"{a}#{page}", "to": b}], "cursor": "c"}).encode()


def test_ranges():
    assert ranges(D(2025, 1, 1), D(2025, 1, 5), 2) == [(D(2025, 1, 1), D(2025, 1, 2)), (D(2025, 1, 3), D(2025, 1, 4)), (D(2025, 1, 5), D(2025, 1, 5))]
    assert ranges(D(2025, 1, 2), D(2025, 1, 1), 2) == []


def test_source(spark):
    spark.dataSource.register(PagedRecords)
    df = spark.read.format("paged_records").options(url="u", transport="tests.test_paged:service", start="2025-01-01", end="2025-01-20", days="14", pause="0").load()
    got = sorted((r["id"], json.loads(r["record"])["to"], r["range_end"]) for r in df.collect())
    assert got == [("2025-01-01#1", "2025-01-14", "2025-01-14"), ("2025-01-01#2", "2025-01-14", "2025-01-14"), ("2025-01-15#1", "2025-01-20", "2025-01-20"), ("2025-01-15#2", "2025-01-20", "2025-01-20")]
