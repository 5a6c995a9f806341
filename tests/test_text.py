"""Edge rows for names, extensions, payloads and paths."""

from pyspark.sql import functions as F

from ocellus.functions import text as TX


def test_url_names_and_extensions(spark):
    urls = ["http://x/a/b.JPG", "http://x/noext", "http://x/p.png?size=2", "", "http://x/dir/"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    n = TX.file_name("url")
    rows = df.select(n.alias("n"), TX.extension(n).alias("e"), TX.extension_allowed(n).alias("dl"),
                     TX.extension_allowed(n, TX.UPLOAD_EXTENSIONS, require_dot=True).alias("up")).collect()
    assert [(r.n, r.e, r.dl, r.up) for r in rows] == [
        ("b.JPG", "jpg", True, True), ("noext", "noext", False, False),
        ("p.png?size=2", "png?size=2", False, False), ("", "", False, False), ("", "", False, False)]


def test_payload_decode_edge_rows(spark):
    good = "aGVsbG8gd29ybGQ="
    rows = [(good,), ("data:image/png;base64," + good,), ("aGVsbG8g\r\nd29ybGQ=",), ("@@@",), (None,)]
    df = spark.createDataFrame(rows, "p string")
    out = [r[0] for r in df.select(TX.decode_base64("p").cast("string")).collect()]
    assert out == ["hello world", "hello world", "hello world", None, None]
    twice = df.select(TX.strip_data_uri(TX.strip_data_uri("p")).alias("a"), TX.strip_data_uri("p").alias("b"))
    assert all(r.a == r.b for r in twice.collect())


def test_request_json_and_response_body(spark):
    df = spark.createDataFrame([("ab\r\ncd\n",)], "c string")
    assert df.select(TX.image_request_json("c")).first()[0] == '{"image":"abcd"}'
    raw = spark.createDataFrame([("HTTP/1.1 200 OK\r\nA: b\r\n\r\n{\"x\":1}",)], "r string")
    assert raw.select(TX.response_body("r")).first()[0] == '{"x":1}'


def test_static_path_and_safe_names(spark):
    df = spark.createDataFrame([("/srv/app/static/img/static/x.png", "../../etc/pass wd.png")], "p string, n string")
    r = df.select(TX.static_path("p").alias("s"), TX.safe_file_name("n").alias("f")).first()
    assert r.s == "./static./static/x.png"          # every shortest match replaced, as re.sub does
    assert r.f == "etc_pass_wd.png"


def test_link_manifest_order(spark):
    html = '<a href="/1">a</a><p><a class="x" href="/2">b</a></p><a href="/1">c</a>'
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(TX.link_manifest("h")).first()[0] == "/1\n/2\n/1"
    assert df.select(F.size(TX.href_links("h"))).first()[0] == 3
