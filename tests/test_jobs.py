"""File, stream and image jobs on edge rows."""

import os

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from conftest import SF_CHECK
from ocellus.functions import text as TX
from ocellus.operators import evaluation as E
from ocellus.operators import features as FE
from ocellus.operators import images as IM
from ocellus.operators import resample as R
from ocellus.operators import training as TR
from ocellus.operators.stages import ArgMaxLabel, PooledFeatures
from ocellus.plans import queries as Q
from ocellus.sources import files as FS
from ocellus.sources import image_files as IF
from ocellus.streaming import routes as RT

IMAGE = "image_id int, height int, width int, n_channels int, data array<int>"


# ---------------------------------------------------------------- image files
def test_png_files_of_all_depths(spark, tmpdir_new):
    rng = np.random.default_rng(1)
    rows = [(f"i{c}.png", h, w, c, rng.integers(0, 256, h * w * c, dtype=np.uint8).tobytes())
            for h, w, c in ((3, 5, 1), (4, 2, 3), (1, 7, 4))]
    schema = "name string, height int, width int, n_channels int, data binary"
    IF.write_files(spark, spark.createDataFrame(rows, schema), tmpdir_new)
    got = {r.image.origin.rsplit("/", 1)[-1]: r.image for r in FS.read_images(spark, tmpdir_new).collect()}
    for name, h, w, c, data in rows:
        i = got[name]
        assert (i.height, i.width, i.nChannels) == (h, w, c) and bytes(i.data) == data


def test_files_with_equal_names_and_empty_tables(spark, tmpdir_new):
    df = spark.createDataFrame([("a.txt", b"1"), ("a.txt", b"2"), ("x/b.txt", None), ("c.txt", b"")], "name string, content binary")
    IF.write_files(spark, df.coalesce(1), tmpdir_new)
    IF.write_files(spark, df.limit(0), tmpdir_new)

    def there():
        paths = [f"{d}/{f}" for d, _, names in os.walk(tmpdir_new) for f in names]
        return sorted((p.rsplit("/", 1)[-1], open(p, "rb").read()) for p in paths)

    assert there() == [("a.txt", b"1"), ("a.txt", b"2"), ("b.txt", b""), ("c.txt", b"")]
    assert not os.path.exists(f"{tmpdir_new}/_temporary")
    IF.write_files(spark, df.limit(1), tmpdir_new, append=False)
    assert there() == [("a.txt", b"1")]


def test_a_failed_write_leaves_no_file(spark, tmpdir_new):
    df = spark.createDataFrame([("a.txt", b"1")] * 20 + [(None, b"2")], "name string, content binary").repartition(4)
    with pytest.raises(PySparkException):
        IF.write_files(spark, df, f"{tmpdir_new}/out")
    left = [f for _, _, names in os.walk(f"{tmpdir_new}/out") for f in names]
    assert left == []
    with pytest.raises(PySparkException):
        IF.write_files(spark, df.select("name"), f"{tmpdir_new}/out")


# ------------------------------------------------------------------- resizing
@pytest.mark.parametrize("kind", ["area", "linear", "lanczos"])
@pytest.mark.parametrize("src,dst", [(8, 3), (3, 8), (5, 5), (1, 4), (7, 1)])
def test_filter_weights(kind, src, dst):
    w = R.filter_weights(src, dst, kind)
    assert w.shape == (dst, src) and np.allclose(w.sum(axis=1), 1)
    if src == dst:
        assert np.allclose(w, np.eye(src), atol=1e-12)
    if kind == "area":
        for i in range(dst):
            for j in range(src):
                cover = max(0.0, min((i + 1) * src / dst, j + 1) - max(i * src / dst, j))
                assert abs(w[i, j] - cover * dst / src) < 1e-12


@pytest.mark.parametrize("kind", ["nearest", "area", "linear", "lanczos"])
def test_resize_is_pixel_by_pixel(kind):
    rng = np.random.default_rng(3)
    px = rng.integers(0, 256, (4, 9, 6, 3), dtype=np.uint8)
    got = R.resize(px, 4, 8, kind)
    assert got.dtype == np.uint8 and got.shape == (4, 4, 8, 3)
    if kind == "nearest":
        want = px[:, R.nearest_indices(9, 4)][:, :, R.nearest_indices(6, 8)]
    else:
        rows, cols = R.filter_weights(9, 4, kind), R.filter_weights(6, 8, kind)
        exact = np.einsum("ay,nyxc,bx->nabc", rows, px.astype(float), cols)
        want = np.clip(np.floor(exact + 0.5), 0, 255)
        off = np.abs(exact + 0.5 - np.round(exact + 0.5)) < 1e-9  # halves, where rounding may go either way
        assert (off | (got == want)).all()
        want = got
    assert (got == want).all()
    flat = np.full((1, 5, 4, 1), 201, np.uint8)
    assert (R.resize(flat, 3, 7, kind) == 201).all()


def test_resize_to_bytes_of_odd_rows(spark):
    rows = [(1, 2, 2, 1, [0, 100, 200, 255]), (2, 1, 1, 1, [7]), (3, 2, 2, 1, None), (4, 2, 2, 1, [1, 2, 3]),
            (5, 0, 0, 1, []), (6, None, 1, 1, [1]), (7, 2, 2, 1, [4, 4, 4, 4])]
    df = spark.createDataFrame(rows, IMAGE).withColumn("other", F.col("image_id") * 10).coalesce(1)
    got = {r.image_id: (r.resized, r.other) for r in IM.resize_to_bytes(df, 1, 1, kind="area").collect()}
    values = {k: None if v is None else list(v) for k, (v, _) in got.items()}
    assert values == {1: [139], 2: [7], 3: None, 4: None, 5: [], 6: None, 7: [4]}
    assert all(o == 10 * k for k, (_, o) in got.items())
    with pytest.raises(PySparkException):
        IM.resize_to_bytes(df, 1, 1, kind="odd").count()


@pytest.mark.parametrize("grid", [1, 2, 3, 5])
def test_pool_batch_is_cell_by_cell(grid):
    px = np.random.default_rng(grid).integers(0, 256, (6, 4, 7, 2))
    got = FE.pool_batch(px, grid)
    y, x = np.arange(4) * grid // 4, np.arange(7) * grid // 7
    for n in range(6):
        want = []
        for a in range(grid):
            for b in range(grid):
                block = px[n][y == a][:, x == b].reshape(-1, 2)
                want += list(block.mean(axis=0)) if len(block) else [0.0, 0.0]
        flat = px[n].reshape(-1, 2)
        assert np.allclose(got[n], [*want, *flat.mean(axis=0), *flat.std(axis=0)])


# --------------------------------------------------------------------- stages
def test_own_stages_save_and_load(spark, tmpdir_new):
    rows = [(i, 2, 2, 1, [i * 4 % 256] * 4) for i in range(60)] + [(99, 2, 2, 1, None)]
    df = spark.createDataFrame(rows, IMAGE).withColumn("label", (F.col("image_id") * 4 > 120).cast("int"))
    model = Pipeline(stages=[PooledFeatures(outputCol="features", grid=1), LogisticRegression(regParam=0.01),
                             ArgMaxLabel(names=["low", "high"], outputCol="name")]).fit(df)
    model.write().overwrite().save(f"{tmpdir_new}/model")
    loaded = PipelineModel.load(f"{tmpdir_new}/model")
    assert loaded.stages[0].getOrDefault("grid") == 1 and loaded.stages[2].getOrDefault("names") == ["low", "high"]
    a, b = ({r.image_id: (r.name, r.prediction_prob) for r in m.transform(df).collect()} for m in (model, loaded))
    assert a == b and len(a) == 60 and {n for n, _ in a.values()} == {"LOW", "HIGH"}
    assert all(50.0 <= p <= 100.0 for _, p in a.values())
    one = spark.createDataFrame([(1,)], "k int").select(F.expr("array(0.1D, 0.2D, 0.7D)").alias("p"))
    got = ArgMaxLabel(names=["x"]).transform(TR.with_vector(one, "p", "probability")).first()
    assert got.prediction_label is None and got.prediction_prob == 70.0


def test_rounds_stop_early_and_return_the_best(spark):
    train, test = Q._planted_split(spark, SF_CHECK, Q.SPLIT_PCT)
    model, history = TR.fit_mlp_rounds(train, test, 64, 2, rounds=8, steps=10, patience=1, min_delta=1e-4, hidden=(8,))
    losses = [h[2] for h in history]
    assert [h[0] for h in history] == list(range(1, len(history) + 1)) and len(history) < 8
    assert losses[-1] > min(losses) - 1e-4 and losses[0] > min(losses)
    assert abs(TR.validation_loss(model, test)[1] - min(losses)) < 2e-4


# ----------------------------------------------------------------- links, CSV
def test_embedded_json_links(spark):
    def div(text, css="rg_meta"):
        return f'<div class="{css}">{text}</div>'

    rows = [(1, div('{"ou":"http://a/1.jpg"}') + "<p>" + div('{"ou": "http://b/2.png", "x": [1, {"ou": "no"}]}', "a rg_meta b")),
            (2, div("not json") + div('{"other": 1}') + div('{"ou": null}') + div("[1]") + div('{"ou":"z"}')),
            (3, "<html></html>"), (4, None), (5, div('{"ou":"w"}', "rg_metal") + div('{"ou": 5}') + div(""))]
    df = spark.createDataFrame(rows, "k int, html string")
    got = {r.k: r.ou for r in df.select("k", TX.json_links("html").alias("ou")).collect()}
    assert got == {1: ["http://a/1.jpg", "http://b/2.png"], 2: [None, None, None, None, "z"], 3: [], 4: None, 5: ["5", None]}


def test_checked_csv(spark, tmpdir_new):
    text = ["Label,n,x,ok,when,name,none"]
    text += [f'a{i},{i},{i}.5,{"true" if i % 2 else "FALSE"},2024-01-0{1 + i % 9} 10:00:00,"q, ""{i}""",' for i in range(40)]
    text += ["b,many,1.0,true,2024-01-01,n,", "c,1,2.0", "d,1,2,true,2024-01-01,n,,8,9", "e,,,,,,"]
    os.makedirs(f"{tmpdir_new}/csv")
    with open(f"{tmpdir_new}/csv/a.csv", "w") as f:
        f.write("\n".join(text) + "\n")
    good, bad = FS.read_checked_csv(spark, f"{tmpdir_new}/csv", escape='"')
    assert dict(good.dtypes) == {"Label": "string", "n": "bigint", "x": "double", "ok": "boolean", "when": "timestamp",
                                 "name": "string", "none": "string"}
    assert good.count() == 41 and good.where("Label = 'e'").first().n is None
    assert good.where("n = 3").first().name == 'q, "3"'
    got = {(r.line[0], r.reason) for r in bad.collect()}
    assert got == {("b", "type of n"), ("c", "fields"), ("d", "fields")}
    # a column that is mostly words is text, and nothing of it is bad
    loose, none = FS.read_checked_csv(spark, f"{tmpdir_new}/csv", escape='"', types={"n": "string"} | {c: t for c, t in good.dtypes if c != "n"})
    assert loose.where("n = 'many'").count() == 1 and none.where("reason <> 'fields'").count() == 0


def test_csv_types_are_cast_only_where_they_can_be(spark):
    """A failed cast costs as much as some hundred good ones."""
    words = ["t", "TRUE", " y", "Yes ", "1", "f", "False", "n", "NO", "0\t", "no\x01"]
    others = ["0.05", "17.0", "100", "1e3", "0.0", "N", "none", "Fast", "years", "two", "", " ", "-1", "2024-01-01 10:00:00"]
    df = spark.createDataFrame([(w,) for w in words + others], "v string")
    tried = {r.v for r in df.where(F.col("v").rlike(FS.CSV_TYPES["boolean"])).collect()}
    read = {r.v for r in df.where(F.col("v").try_cast("boolean").isNotNull()).collect()}
    assert tried == read == {*words, "N"}


def test_csv_types_of_all_columns(spark):
    rows = [(str(i), f"0.{i}", "yn"[i % 2], f"2024-01-{10 + i}", "a" if i < 2 else str(i), None) for i in range(10)]
    df = spark.createDataFrame(rows, "`a` string, b string, c string, d string, e string, f string")
    assert FS.infer_csv_types(df, df.columns) == {"a": "bigint", "b": "double", "c": "boolean", "d": "timestamp", "e": "string",
                                                  "f": "string"}
    assert FS.infer_csv_types(df, ["e"], share=0.8) == {"e": "bigint"}
    assert FS.infer_csv_types(df.limit(0), ["a"]) == {"a": "string"} and FS.infer_csv_types(df, []) == {}


# ------------------------------------------------------------------------ ROC
def test_roc_points(spark):
    rng = np.random.default_rng(2)
    rows = [(int(rng.random() < 0.4), float(rng.integers(0, 40))) for _ in range(500)]
    odd = [(None, 1.0), (1, None), (0, float("nan")), (1, -0.0), (0, 0.0)]
    df = spark.createDataFrame(rows + odd, "label int, score double")
    got = sorted(((r.threshold, r.n, r.tp, r.fp, r.tpr, r.fpr) for r in E.roc_points(df, "label", "score").collect()), reverse=True)
    known = rows + odd[3:]
    pos = sum(y for y, _ in known)
    want = []
    for t in sorted({s for _, s in known}, reverse=True):
        tp, fp = (sum(1 for y, s in known if s >= t and y == k) for k in (1, 0))
        want.append((t, sum(1 for _, s in known if s == t), tp, fp, tp / pos, fp / (len(known) - pos)))
    assert got == want
    curve = [(0.0, 0.0)] + [(f, t) for *_, t, f in got]
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(curve, curve[1:]))
    clean = spark.createDataFrame(known, "label int, score double")
    assert area == pytest.approx(E.binary_auc(clean, "label", "score"))
    one = E.roc_points(spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, score double"), "label", "score")
    assert {(r.tp, r.tpr, r.fpr) for r in one.collect()} == {(1, 0.5, None), (2, 1.0, None)}
    assert E.roc_points(df.limit(0), "label", "score").count() == 0


# --------------------------------------------------------------------- routes
def _by_value(df):
    return RT.with_route(df, F.when(F.col("v") < 0, "negative")).select("k", "error", "route")


def _files(spark, path, rows, n=3):
    spark.createDataFrame(rows, "k int, v int").repartition(n, "k").write.mode("append").parquet(path)


def test_a_replayed_batch_lands_once(spark, tmpdir_new):
    rows = [(i, i if i % 3 else -i - 1) for i in range(60)]
    _files(spark, f"{tmpdir_new}/in", rows)
    write, calls = RT.batch_writer(f"{tmpdir_new}/out", _by_value), []

    def fails_after_writing(batch, batch_id):
        write(batch, batch_id)
        calls.append(batch_id)
        if len(calls) == 2:
            raise RuntimeError("lost before the commit")

    def run(writer=None):
        return RT.run_routed(spark, f"{tmpdir_new}/in", "k int, v int", _by_value, f"{tmpdir_new}/out", f"{tmpdir_new}/ckpt",
                             max_files_per_trigger=1, writer=writer)

    with pytest.raises(PySparkException):
        run(fails_after_writing)
    assert calls == [0, 1]
    _files(spark, f"{tmpdir_new}/in", [(100, -1), (101, 1)], 1)  # arrives before the restart
    replayed = []

    def counted(batch, batch_id):
        replayed.append(batch_id)
        write(batch, batch_id)

    out = run(counted)
    assert replayed[0] == 1  # the lost batch came again under its number
    assert sorted(r.k for r in RT.success(out).collect()) == sorted([i for i, v in rows if v >= 0] + [101])
    bad = RT.failure(out).collect()
    assert sorted(r.k for r in bad) == sorted([i for i, v in rows if v < 0] + [100]) and {r.error for r in bad} == {"negative"}
    assert run().count() == 62  # nothing new


def test_routes_without_input(spark, tmpdir_new):
    os.makedirs(f"{tmpdir_new}/in")
    out = RT.run_routed(spark, f"{tmpdir_new}/in", "k int, v int", _by_value, f"{tmpdir_new}/out", f"{tmpdir_new}/ckpt")
    assert out.count() == 0 and {"k", "error", "route", "batch"} <= set(out.columns)


def test_committed_input_is_removed(spark, tmpdir_new):
    for n in range(3):
        _files(spark, f"{tmpdir_new}/in", [(n, n)], 1)
        out = RT.run_routed(spark, f"{tmpdir_new}/in", "k int, v int", _by_value, f"{tmpdir_new}/out", f"{tmpdir_new}/ckpt")
        assert out.count() == n + 1
    left = [f for f in os.listdir(f"{tmpdir_new}/in") if f.endswith(".parquet")]
    assert len(left) < 3  # files of batches before the last one are gone
