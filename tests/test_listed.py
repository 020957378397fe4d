"""Streams over services that list and serve, against a fake that writes down each request."""

import json
import urllib.parse
from collections import Counter
from pathlib import Path

import pytest

from tessera.sources import fetch
from tessera.sources.listed import ListedRecords, Numbered, Offsets


def service(url, parameters):
    """The list and the files of a folder; requests are written down there. A file named ``x.broken`` makes x fail."""
    at = urllib.parse.urlparse(url)
    folder, name = Path(at.path).parent, Path(at.path).name
    with open(folder / "requests.log", "a") as log:
        log.write(f"{name} {parameters.get('offset', '')}\n")
    if name == "list":
        every = json.loads((folder / "list.json").read_text())
        page = every[parameters["offset"] : parameters["offset"] + 3]
        return 200, json.dumps({"ids": [i for i, _ in page], "days": [d for _, d in page]}).encode()
    if (folder / f"{name}.broken").exists():
        raise ConnectionError(name)
    return (200, b"text of " + name.encode()) if (folder / name).exists() else (404, b"")


class Stream:
    def __init__(self, spark, tmp_path, **options):
        spark.dataSource.register(ListedRecords)
        self.spark, self.at = spark, tmp_path
        self.options = {"connector": "tessera.sources.listed:Offsets", "transport": "tests.test_listed:service", "folder": str(tmp_path / "kept"), "url": f"http://x{tmp_path}/{{id}}", "list_url": f"http://x{tmp_path}/list", "pause": "0", "tries": "1", "size": "2"} | options

    def offer(self, *ids, there=True):
        (self.at / "list.json").write_text(json.dumps(ids))
        for i, _ in ids:
            if there:
                (self.at / i).touch()

    def run(self):
        df = self.spark.readStream.format("listed_records").options(**self.options).load()
        q = df.writeStream.format("parquet").option("path", str(self.at / "out")).option("checkpointLocation", str(self.at / "check")).trigger(availableNow=True).start()
        try:
            q.awaitTermination(120)
        finally:
            q.stop()

    def rows(self):
        return sorted((r["id"], bytes(r["content"])) for r in self.spark.read.parquet(str(self.at / "out")).collect())

    def requests(self):
        return Counter((self.at / "requests.log").read_text().splitlines())


def ids(*numbers, day="2025-01-02"):
    return [(f"r{n}", day) for n in numbers]


def test_a_restart_after_a_failure_fetches_nothing_twice(spark, tmp_path):
    s = Stream(spark, tmp_path)
    s.offer(*ids(7, 6, 5, 4, 3, 2, 1))
    (tmp_path / "r6.broken").touch()
    with pytest.raises(Exception, match="r6"):
        s.run()
    (tmp_path / "r6.broken").unlink()
    s.run()
    assert s.rows() == [(f"r{n}", f"text of r{n}".encode()) for n in range(1, 8)]
    files = {k: n for k, n in s.requests().items() if not k.startswith("list")}
    assert files.pop("r6 ") >= 2 and set(files.values()) == {1}


def test_a_listing_stops_at_the_known(spark, tmp_path):
    s = Stream(spark, tmp_path)
    s.offer(*ids(6, 5, 4, 3, 2, 1))
    s.run()
    (tmp_path / "requests.log").unlink()
    s.offer(*ids(8, 7, 6, 5, 4, 3, 2, 1))
    s.run()
    assert [i for i, _ in s.rows()] == [f"r{n}" for n in range(1, 9)]
    assert s.requests() == {"list 0": 1, "list 3": 1, "r7 ": 1, "r8 ": 1}  # the second page brings nothing new


def test_what_is_not_there_yet_is_asked_for_again(spark, tmp_path):
    s = Stream(spark, tmp_path)
    s.offer(*ids(3, 2, 1))
    (tmp_path / "r2").unlink()
    s.run()
    assert [i for i, _ in s.rows()] == ["r1", "r3"]
    (tmp_path / "r2").touch()
    s.run()
    s.run()
    assert [i for i, _ in s.rows()] == ["r1", "r2", "r3"]
    assert {k: n for k, n in s.requests().items() if k.startswith("r")} == {"r1 ": 1, "r3 ": 1, "r2 ": 2}
    missing = fetch.Client(lambda url, parameters: (404, b""), pause=0, tries=3)
    with pytest.raises(fetch.Missing):
        missing.get("u")


def test_lists():
    class Fake:
        def json(self, url, offset):
            return {"ids": ["c", "b", "a"], "days": ["2025-02-01", "", "2024-12-31"]} if offset == 0 else {"ids": []}

    assert list(Offsets({"list_url": "u", "since": "2025-01-01"}).pages(Fake())) == [["c", "b"]]
    assert list(Offsets({"list_url": "u"}).pages(Fake())) == [["c", "b", "a"]]
    n = Numbered({"first": "9", "last": "11", "width": "3", "url": "http://x/21{id}.xml"})
    assert list(n.pages(None)) == [["011", "010", "009"]] and n.url("011") == "http://x/21011.xml"
