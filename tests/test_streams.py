"""File-drop scoring stream and the request table."""

import glob
import os
import shutil

import pytest
from pyspark.errors import PySparkException

from ocellus.functions import text as TX
from ocellus.plans import jobs as J
from ocellus.sources import image_files as IF
from ocellus.streaming import scoring as SS
from pngs import make_tree

BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def _drop_transform(stream):
    """Allowed upload extensions only, then score by file size."""
    ok = stream.where(TX.extension_allowed(TX.file_name("path"), TX.UPLOAD_EXTENSIONS, require_dot=True))
    scored = SS.threshold_scorer("length", scale=100.0, cut=100)(ok)
    return scored.select("path", "length", "prediction_label", "prediction_prob")


def test_stream_file_drop_two_steps_no_duplicates(spark, tmpdir_new):
    src = f"{tmpdir_new}/src"
    make_tree(src)
    drop = f"{tmpdir_new}/drop"
    import os
    os.makedirs(drop)
    for name in ("a1.png", "a2.png"):
        shutil.copy(f"{src}/a/{name}", drop)
    out = SS.run_stream(spark, drop, BINARY_SCHEMA, _drop_transform, f"{tmpdir_new}/sink", f"{tmpdir_new}/ckpt",
                        fmt="binaryFile")
    assert out.count() == 2
    for name in ("junk.png", "notes.txt", "b1.png"):
        shutil.copy(f"{src}/b/{name}", drop)
    out = SS.run_stream(spark, drop, BINARY_SCHEMA, _drop_transform, f"{tmpdir_new}/sink", f"{tmpdir_new}/ckpt",
                        fmt="binaryFile")
    names = sorted(r.path.rsplit("/", 1)[-1] for r in out.collect())
    assert names == ["a1.png", "a2.png", "b1.png", "junk.png"]   # .txt refused, nothing repeated


def _drop_files(spark, numbers):
    return spark.createDataFrame([(f"drop-{i % 3}", f"f{i}.{'png' if i % 4 else 'tmp'}", b"x" * (i * 10)) for i in numbers],
                                 "folder string, name string, content binary")


def test_folder_streams_go_on_and_each_lists_its_own(spark, tmpdir_new):
    base, seen = tmpdir_new, []

    def run():
        return SS.run_folder_streams(spark, f"{base}/in", BINARY_SCHEMA, _drop_transform, f"{base}/sink", f"{base}/ckpt",
                                     fmt="binaryFile", options={"pathGlobFilter": "*.png", "recursiveFileLookup": "true"})

    before = [spark.conf.get(key) for key in (SS.OPEN_COST, SS.LISTED)]
    assert run().count() == 0                            # nothing there yet
    for some in (range(1, 14), range(14, 30), []):       # the last run has nothing new
        IF.write_files(spark, _drop_files(spark, some).repartition(4), f"{base}/in")
        seen += some
        got = [(r.path.rsplit("/", 1)[-1], r.length) for r in run().collect()]
        assert sorted(got) == sorted((f"f{i}.png", i * 10) for i in seen if i % 4)
    assert sorted(os.listdir(f"{base}/ckpt")) == ["drop-0", "drop-1", "drop-2"]
    log = "".join(open(f).read() for f in glob.glob(f"{base}/ckpt/drop-1/sources/0/[0-9]*"))
    assert "/in/drop-1/" in log and "/in/drop-0/" not in log
    assert [spark.conf.get(key) for key in (SS.OPEN_COST, SS.LISTED)] == before


def test_a_folder_without_accepted_files_gives_no_rows(spark, tmpdir_new):
    IF.write_files(spark, _drop_files(spark, [0, 4, 5]), f"{tmpdir_new}/in")
    out = SS.run_folder_streams(spark, f"{tmpdir_new}/in", BINARY_SCHEMA, _drop_transform, f"{tmpdir_new}/sink",
                                f"{tmpdir_new}/ckpt", fmt="binaryFile", options={"pathGlobFilter": "*.png", "recursiveFileLookup": "true"})
    assert [r.length for r in out.collect()] == [50]


def test_file_drop_in_several_folders(spark, tmpdir_new, monkeypatch):
    rows = [(i, "t" * (100 * i), f"src{i % 3}") for i in range(1, 25)] + [(7, "twice", "src1"), (8, None, "src1")]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(f"{tmpdir_new}/documents.parquet")
    monkeypatch.setattr(J, "FILES_A_FOLDER", 5)
    got = J.q_file_drop_score(spark, tmpdir_new)
    assert len({f.rsplit("/", 2)[-2] for f in got.inputFiles()}) > 2
    want = sorted((f"doc{i}.png", len(t)) for i, t, s in rows if t is not None and s != "src0")
    assert sorted((r.file_name, r.length) for r in got.collect()) == want


def test_files_go_into_plain_folders_only(spark, tmpdir_new):
    for bad in ("../x", "a/b", "_a", "", None):
        with pytest.raises(PySparkException):
            IF.write_files(spark, spark.createDataFrame([(bad, "n", b"")], "folder string, name string, content binary"), f"{tmpdir_new}/in")
    IF.write_files(spark, _drop_files(spark, [1, 2, 1]), f"{tmpdir_new}/in")
    IF.write_files(spark, _drop_files(spark, [3]), f"{tmpdir_new}/in", append=False)
    assert [f for _, _, names in os.walk(f"{tmpdir_new}/in") for f in names if not f.endswith(".crc")] == ["f3.png"]


def test_enrich_records_attributes(spark):
    df = spark.createDataFrame([(1, "ab\ncd", 60.0), (2, "x", None)], "id int, c string, v double")
    out = {r.id: r for r in SS.enrich_records(df, "c", SS.threshold_scorer("v")).collect()}
    assert out[1].content == '{"image":"abcd"}'
    assert out[1].attributes == {"prediction_label": "HIGH", "prediction_prob": "0.645656"}
    assert out[2].error == "not scored"


def test_request_table_answers(spark):
    rows = [(1, "POST", '{"image": "NjAuMA=="}'), (2, "GET", None), (3, "POST", '{"image": "@@@"}'),
            (4, "POST", '{"image": "data:image/png;base64,NjAuMA=="}'), (5, "POST", '{"other": 1}'),
            (6, "POST", '{"image": "YWJj"}')]   # valid base64 of "abc": decodes, is not a score input
    req = spark.createDataFrame(rows, "request_id int, method string, body string")
    ans = {r.request_id: r for r in SS.answer_requests(
        req, lambda p: p.cast("string").try_cast("double"), SS.threshold_scorer("_value")).collect()}
    assert ans[1].response == '{"prediction_label":"HIGH","prediction_prob":0.645656}'
    assert ans[4].response == ans[1].response
    assert ans[2].response is None and ans[2].error is None
    assert ans[3].error == "bad request" and ans[5].error == "bad request" and ans[6].error == "bad request"
