import hashlib
import os

import pytest

from furrow.llm import warc


@pytest.fixture()
def folder(tmp_path):
    return f"file://{tmp_path}/warc"


def pages(spark):
    long_ = "<html>" + "é" * 200 + "</html>"
    rows = [
        (5, "http://a/5", long_, "x"),
        (3, None, long_, "x"),
        (9, "http://a/9\r\nWARC-Type: evil", long_, "x"),
        (1, "u", "short", "x"),
        (2, "u", "short", "x"),
        (4, "ü", None, "x"),
        (6, "u", "", "x"),
        (7, "u", "a" * 99, "x"),
        (8, "u", "a" * 99, "x"),
        (10, "u", "b" * 100, "x"),
        (11, "u", "b" * 100, "x"),
        (11, "u", "b" * 100, "x"),
        (12, "u", "\r\n\r\nWARC/1.1\r\n" * 30000, "x"),
        (None, "u", long_, "x"),
    ]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def expected(rows):
    out = []
    for page_id, _, html, _ in rows:
        raw = (html or "").encode()
        same = [p for p, _, h, _ in rows if (h or "") == (html or "") and p is not None]
        first = min(same, default=None)
        again = len(raw) >= 100 and first is not None and page_id != first
        out.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, folder):
    rows, df = pages(spark)
    manifest = warc.write_warc(df, folder, roll_bytes=300)
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows)
    got = warc.read_warc(spark, folder).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == expected(rows)
    texts = {r.page_id: r.payload for r in got if r.record_type == "response"}
    assert texts[12].decode() == rows[12][2] and texts[4] == b""
    assert not any("temporary" in n for n in os.listdir(folder.removeprefix("file://")))


def test_files_are_the_same_bytes_each_time(spark, tmp_path):
    _, df = pages(spark)
    a, b = (
        {r.name: r.sha256 for r in warc.write_warc(df.repartition(n), f"file://{tmp_path}/w{n}", roll_bytes=300).collect()} for n in (2, 5)
    )
    assert a == b and len(a) > 1


def test_leftover_attempts_are_removed_and_breaks_are_found(spark, folder, tmp_path):
    _, df = pages(spark)
    os.makedirs(f"{tmp_path}/warc")
    open(f"{tmp_path}/warc/_temporary-lost-00000", "w").close()
    name = warc.write_warc(df, folder).first().name
    path = f"{tmp_path}/warc/{name}"
    assert not any("lost" in n for n in os.listdir(f"{tmp_path}/warc"))
    data = open(path, "rb").read()
    one = next(warc.members(open(path, "rb")))
    with pytest.raises(ValueError):
        warc.parse(one.replace(b"HTTP/1.1 200", b"HTTP/1.1 404"))
    open(path, "wb").write(data[:-5])
    with pytest.raises(Exception, match="ends within|records"):
        warc.read_warc(spark, folder).count()


def test_a_call_that_ended_early_is_completed(spark, folder, tmp_path):
    rows, df = pages(spark)
    want = {r.name: r.sha256 for r in warc.write_warc(df, f"file://{tmp_path}/other", roll_bytes=300).collect()}
    os.makedirs(f"{tmp_path}/warc/_manifest.tmp.parquet")
    for name in [min(want), "part-99999-00000.warc.gz"]:
        open(f"{tmp_path}/warc/{name}", "w").close()
    got = {r.name: r.sha256 for r in warc.write_warc(df, folder, roll_bytes=300).collect()}
    assert got == want and warc.read_warc(spark, folder).count() == len(rows)
    with pytest.raises(FileExistsError):
        warc.write_warc(df, folder)
    assert warc.read_warc(spark, folder).count() == len(rows)


def test_renaming_can_run_again(tmp_path):
    import pyarrow as pa

    (tmp_path / "t0").write_bytes(b"abc")
    (tmp_path / "t1").write_bytes(b"defg")
    rows = pa.record_batch({"temp": ["t0", "t1"], "name": ["a", "b"], "bytes": [3, 4]})
    for _ in range(2):
        assert list(warc._renamer(f"file://{tmp_path}")([rows]))[0].column(0).to_pylist() == ["a", "b"]
    assert sorted(os.listdir(tmp_path)) == ["a", "b"]
    (tmp_path / "b").write_bytes(b"d")
    with pytest.raises(FileNotFoundError):
        list(warc._renamer(f"file://{tmp_path}")([rows]))


def test_nothing(spark, folder):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.write_warc(df, folder).count() == 0
    assert warc.read_warc(spark, folder).count() == 0
