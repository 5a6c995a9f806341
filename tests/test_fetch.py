"""Fetch outcomes with an injected fetcher."""

from ocellus.sources import fetch as FETCH


def test_outcomes(spark):
    rows = [("http://h1/a.png", "x"), ("http://h1/b.txt", "x"), ("http://h2/c.jpg", "404"),
            ("", "x"), ("http://h2/d.JPEG", "boom"), ("http://h2/e.png", "big")]
    df = spark.createDataFrame(rows, "url string, how string")

    def fetcher(row):
        if not row["url"]:
            raise ValueError("empty")
        if row["how"] == "404":
            return 404, None
        if row["how"] == "boom":
            raise OSError("reset")
        if row["how"] == "big":
            raise FETCH.BodyTooLarge("more than 2 bytes")
        return 200, b"abc"

    out = {r.url: r for r in FETCH.fetch_urls(df, fetcher).collect()}
    assert out["http://h1/a.png"].outcome == "saved" and out["http://h1/a.png"].n_bytes == 3
    assert out["http://h1/b.txt"].outcome == "bad_extension"
    assert out["http://h2/c.jpg"].outcome == "http_status" and out["http://h2/c.jpg"].http_status == 404
    assert out[""].outcome == "error" and out["http://h2/d.JPEG"].outcome == "error"
    assert out["http://h2/e.png"].outcome == "too_large" and out["http://h2/e.png"].n_bytes is None
    counts = {r.outcome: r.n for r in FETCH.outcome_counts(FETCH.fetch_urls(df, fetcher)).collect()}
    assert sum(counts.values()) == 6


def test_stored_outcomes_without_python_or_shuffle(spark):
    rows = [("http://h/a.html", "<html></html>\n"), ("http://h/b.txt", "<html></html>"), ("http://h/c.html", "<html>"),
            ("http://h/d.html", ""), ("http://h/e.html", None), ("nowhere", "<html></html>"), (None, "x"),
            ("http://h/f.html", None)]
    df = spark.createDataFrame(rows, "url string, html string")
    got = FETCH.stored_outcomes(df, "url", "html", ("html",))
    assert [r.outcome for r in got.collect()] == [
        "saved", "bad_extension", "error", "http_status", "http_status", "error", "error", "http_status"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan
