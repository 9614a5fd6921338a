import base64
import gzip
import hashlib

from tandemsift.llm import common, files, warc


def run(spark, rows, least=0):
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, key string")
    folder = common.new_folder(spark, "warc")
    got = warc.read(pages, folder, warc.index(warc.write(pages, folder, least), folder))
    return sorted(map(tuple, got.collect()), key=str), folder


def brute(rows, least=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        refers = first.get(h or "") if len(data) >= least else None
        again = refers is not None and refers != i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", refers if again else None))
    return sorted(out, key=str)


ROWS = [(i, f"http://h{i % 7}.example.org:80/a/{i % 50}?q={i}", f"<p>{'é' * (i % 90)}</p>") for i in range(1300)] + [
    (5000, None, None), (5001, "", ""), (5002, "odd url\t\n é", "x" * 300000), (5003, "http://u@A.B/", None), (None, "http://a.b/", "<p></p>"), (5004, "http://h1.example.org/a/1", "y\r\n\r\nz"),
]


def test_round_trip(spark):
    got, folder = run(spark, ROWS)
    assert got == brute(ROWS)
    system, path = files.opened(folder)
    from pyarrow import fs

    name = next(f.path for f in system.get_file_info(fs.FileSelector(path)) if f.path.endswith(".warc.gz"))
    assert gzip.decompress(system.open_input_file(name).read()).startswith(b"WARC/1.1\r\n")


def test_repeats_least_and_empty(spark):
    rows = [(1, "http://a/", "same"), (1, "http://a/", "same"), (2, "http://b/", "same"), (3, "http://c/", "no"), (4, "http://d/", "no")]
    assert run(spark, rows, 3)[0] == brute(rows, 3)
    assert run(spark, [])[0] == []


def test_a_missing_id_is_no_id_of_its_own(spark, monkeypatch):
    rows = [(None, "http://a/", "one"), (-1, "http://a/", "two"), (0, "http://a/", "three"), (None, "http://b/", "two")]
    assert run(spark, rows)[0] == brute(rows)


def test_many_ranges_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "LINES", 100)
    monkeypatch.setattr(warc, "LOOKUPS", 50)
    rows = ROWS[:900] + [(-7, "http://h1.example.org/a/1", "z")]
    assert run(spark, rows)[0] == brute(rows)
