"""URL filters and archives."""

import base64
import hashlib
import random

from qalathe.llm import url_filter, warc


def test_names(spark):
    urls = {"http://A.b.co:80/x/y?q#f": ["A.b.co", "b.co", "co", "A.b.co/x", "A.b.co/x/y"], "https://h": ["h"], "": [], "x://u@h./": ["h", "h/"]}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    for r in df.select("url", url_filter.names(df.url).alias("n")).collect():
        assert sorted(r.n) == sorted(n.replace("A", "a") for n in urls[r.url]), r.url


def test_as_of_join_against_replay(spark):
    rng = random.Random(9)
    hosts = ["a.com", "b.a.com", "c.org", "org"]
    entries = [(rng.choice(["l1", "l2"]), rng.choice([*hosts, "a.com/x"]), rng.randint(0, 30), rng.random() < 0.6) for _ in range(120)]
    captures = [(k, f"http://{rng.choice(hosts)}{rng.choice(['', '/x', '/x/y', '/z'])}", rng.randint(0, 35)) for k in range(300)]
    odd = [(900, None, 3), (901, "http://a.com", None), (902, "", 3)]
    out = url_filter.judged(
        spark.createDataFrame(captures + captures[:5] + odd, "page_id long, url string, fetched long").selectExpr("*", "1 AS name", "2 AS hits"),
        spark.createDataFrame(entries + [(None, "org", 1, True), ("l1", None, 1, True), ("l1", "org", None, True)],
                              "list string, name string, changed long, listed boolean")).collect()
    assert len(out) == 308

    def holds(name, which, at):
        past = [(t, not on) for w, n, t, on in entries if (w, n) == (which, name) and t <= at]
        return bool(past) and not max(past)[1]

    for r in out:
        want = []
        if r.url and r.fetched is not None:
            host, _, path = r.url.removeprefix("http://").partition("/")
            labels, steps = host.split("."), path.split("/") if path else []
            names = {".".join(labels[k:]) for k in range(len(labels))} | {
                host + "/" + "/".join(steps[:k]) for k in range(1, len(steps) + 1)}
            want = sorted((w, n) for w in ("l1", "l2") for n in names if holds(n, w, r.fetched))
        assert [tuple(h) for h in r.hits] == want and r.blocked == bool(want)


def test_no_entries(spark):
    pages = spark.createDataFrame([("http://a", 1)], "url string, fetched long")
    none = spark.createDataFrame([], "list string, name string, changed long, listed boolean")
    assert [r.blocked for r in url_filter.judged(pages, none).collect()] == [False]
    assert url_filter.judged(pages.limit(0), none).isEmpty()


def test_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "CAPTURES_PER_TASK", 20)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 7)
    rng = random.Random(3)
    bodies = [None, "", "x", "é\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nabc", "long " * 50_000, "\x00\n"]
    urls = [None, "", "http://b.com/x", "https://a.b.com:8/q?x#f", "http://evil/\r\nX-Page-ID: 9", "http://a.com"]
    rows = [(k, rng.choice(urls), rng.choice(bodies), "extra") for k in range(80)] + [(None, "http://n", "null id", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, time string").repartition(3)
    out = warc.capture_histories(pages, path=str(tmp_path / "w")).collect()
    assert len(out) == 81 and all(r.intact for r in out)
    last = {}
    for k, _, body, _ in rows[:-1]:
        last[(body or "").encode()] = k
    by_id = {r.page_id: r for r in out}
    for k, url, body, _ in rows:
        r, content = by_id[k], (body or "").encode()
        assert r.payload_bytes == len(content)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(content).digest()).decode()
        response = k is None or last[content] == k
        assert (r.record_type, r.refers_to) == (("response", None) if response else ("revisit", last[content]))
        assert r.url == (url and url.replace("\r", "%0D").replace("\n", "%0A"))
    order = [(r.url_key, r.time, r.page_id is not None, r.page_id or 0) for r in out]
    assert order == sorted(order) and len({r.file for r in out}) > 3
    some = next(r for r in out if r.page_id == 40)
    with open(some.file.removeprefix("file:"), "rb") as f:
        f.seek(some.offset)
        assert next(warc.parse_records(f.read(some.length)))[0] == 40


def test_archives_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BYTES_PER_FILE", 400_000, raising=False)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 100)
    rng = random.Random(8)
    sizes = [*[rng.randint(0, 2_000) for _ in range(150)], *[rng.randint(3_000, 130_000) for _ in range(60)], 700_000]
    rows = [(k, f"http://one.host/{k:04}", f"{k} " + "x" * n) for k, n in enumerate(sizes)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(1)
    out = warc.capture_histories(pages, path=str(tmp_path / "w")).collect()
    assert [r.page_id for r in out] == list(range(len(rows))) and all(r.intact for r in out)
    assert [r.payload_bytes for r in out] == [len(html) for _, _, html in rows]
    held = {}
    for r in out:
        held.setdefault(r.file, []).append(r.length + 4)
    assert all(sum(x) <= 400_000 or len(x) == 1 for x in held.values())


def test_payloads_too_small_to_revisit(spark):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    got = {r.page_id: r.record_type for r in warc.capture_histories(pages, min_bytes=4).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    assert warc.capture_histories(pages.limit(0)).isEmpty()


def test_loser_tree():
    rng = random.Random(4)
    for _ in range(300):
        runs = [sorted((rng.randint(0, 9), k) for k in range(rng.randint(0, 6))) for _ in range(rng.randint(0, 7))]
        assert list(warc.LoserTree(runs)) == sorted(x for run in runs for x in run)
