"""Image folders, labelled trees, thumbnails, resize and channel order (PNG fixtures)."""

import numpy as np
from pyspark.sql import functions as F

from ocellus.operators import features as FE
from ocellus.operators import images as IM
from ocellus.sources import files as FS
from pngs import make_tree


def test_image_scan_drops_invalid_and_labels(spark, tmpdir_new):
    make_tree(tmpdir_new)
    a = FS.labelled_images(spark, f"{tmpdir_new}/a", 1)
    b = FS.labelled_images(spark, f"{tmpdir_new}/b", 0)
    u = a.unionByName(b)
    rows = {(r["image"]["origin"].rsplit("/", 1)[-1], r["label"]) for r in u.collect()}
    # junk.png is dropped, the .txt is not an image, upper-case .PNG is read
    assert rows == {("a1.png", 1), ("a2.png", 1), ("A3.PNG", 1), ("b1.png", 0), ("b2.png", 0)}
    # keeping invalid files gives height -1, not a null image
    raw = FS.read_images(spark, f"{tmpdir_new}/b", drop_invalid=False)
    assert raw.where(F.col("image.height") < 0).count() >= 1
    assert FS.valid_images(raw).count() == 2


def test_labelled_dir_scan_classes_and_counts(spark, tmpdir_new):
    make_tree(tmpdir_new)
    scan = FS.labelled_dir_scan(spark, tmpdir_new, allowed=("png", "jpg", "jpeg", "gif"))
    got = {r["class"]: r["n_files"] for r in FS.class_file_counts(scan).collect()}
    assert got == {"a": 3, "b": 3}      # junk.png counts as a file; .txt is not allowed


def test_bgr_to_rgb_on_decoded_png(spark, tmpdir_new):
    make_tree(tmpdir_new)
    imgs = FS.valid_images(FS.read_images(spark, f"{tmpdir_new}/a"))
    t = IM.decode_image_struct(imgs).withColumn("rgb", IM.bgr_to_rgb("data", "n_channels"))
    for r in t.collect():
        if r["path"].endswith("a1.png"):
            assert list(r["data"][:3]) == [0, 0, 255]     # stored BGR
            assert list(r["rgb"][:3]) == [255, 0, 0]      # model order RGB
            px = t.where(F.col("path") == r["path"]).select(IM.rescale("rgb").alias("f")).first()["f"]
            assert px[0] == 1.0 and px[1] == 0.0


def test_resize_nearest_matches_formula(spark):
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, size=6 * 4 * 3).tolist()
    df = spark.createDataFrame([(1, 6, 4, 3, data)], "image_id int, height int, width int, n_channels int, data array<int>")
    out = IM.resize_images(df, 5, 7).first()["resized"]
    src = np.asarray(data).reshape(6, 4, 3)
    exp = np.zeros((5, 7, 3), dtype=int)
    for y in range(5):
        for x in range(7):
            exp[y, x] = src[int((y + 0.5) * 6 / 5), int((x + 0.5) * 4 / 7)]
    assert list(out) == exp.ravel().tolist()


def test_thumbnail_job(spark, tmpdir_new):
    make_tree(tmpdir_new)
    imgs = FS.read_images(spark, tmpdir_new, drop_invalid=True)
    th = IM.thumbnail_job(imgs, box=(200, 200)).collect()
    names = {r["name"]: (r["width"], r["height"]) for r in th}
    assert names["thumbnaila2.png"] == (200, 100)         # 300x150 fits the box, aspect kept
    assert names["thumbnaila1.png"] == (4, 3)             # never enlarged
    assert all(len(r["bytes"]) == r["width"] * r["height"] * r["n_channels"] for r in th)
    assert "thumbnailnotes.txt" not in names


def test_thumbnail_size_rules(spark):
    df = spark.createDataFrame([(300, 150), (100, 400), (50, 50), (1000, 1)], "w int, h int")
    tw, th = IM.thumbnail_size("w", "h", 200, 100)
    got = [(r[0], r[1]) for r in df.select(tw, th).collect()]
    assert got == [(200, 100), (25, 100), (50, 50), (200, 1)]


def test_pooled_features_numpy(spark):
    data = list(range(16))
    df = spark.createDataFrame([(1, 4, 4, 1, data)], "image_id int, height int, width int, n_channels int, data array<int>")
    f = FE.featurize(df, "pool", grid=2).first()["features"]
    assert f[:4] == [2.5, 4.5, 10.5, 12.5]
    assert f[4] == 7.5 and abs(f[5] - np.std(np.arange(16))) < 1e-12


def test_onnx_featurizer_runs_a_user_model(spark, tmpdir_new):
    from onnx_min import relu_model
    path = f"{tmpdir_new}/relu.onnx"
    with open(path, "wb") as f:
        f.write(relu_model(6))
    rows = [(i, [float(v) for v in range(-3 + i, 3 + i)]) for i in range(5)]
    df = spark.createDataFrame(rows, "image_id int, x array<double>")
    out = FE.featurize(df, "onnx", input_col="x", model_path=path, input_shape=(6,))
    got = {r.image_id: list(r.features) for r in out.collect()}
    assert got == {i: [max(v, 0.0) for v in x] for i, x in rows}


def test_categorical_labels_and_thumbnail_sink(spark, tmpdir_new):
    make_tree(f"{tmpdir_new}/tree")
    scan = FS.labelled_dir_scan(spark, f"{tmpdir_new}/tree", allowed=("png",))
    lab = {r.path.rsplit("/", 1)[-1]: (r["class"], r.class_index, list(r.label))
           for r in FS.with_class_labels(scan).collect()}
    assert lab["a1.png"] == ("a", 0, [1.0, 0.0]) and lab["b1.png"] == ("b", 1, [0.0, 1.0])
    assert FS.with_class_labels(scan, None).columns == scan.columns
    th = IM.thumbnail_job(FS.read_images(spark, f"{tmpdir_new}/tree"))
    IM.write_thumbnails(th, f"{tmpdir_new}/thumbs")
    back = spark.read.parquet(f"{tmpdir_new}/thumbs")
    assert back.count() == th.count() == 5


def test_resize_of_mixed_shapes_null_and_empty_images(spark):
    rows = [(1, 1, 1, 1, [7]), (2, 2, 2, 1, [1, 2, 3, 4]), (3, 2, 2, 1, None), (4, None, 2, 1, [1, 2]),
            (5, 1, 1, 3, [1, 2, 3]), (6, 1, 1, 1, [9])]
    df = spark.createDataFrame(rows, "k int, height int, width int, n_channels int, data array<int>").coalesce(1)
    got = {r.k: r.resized for r in IM.resize_images(df, 2, 2).collect()}
    assert got == {1: [7] * 4, 2: [1, 2, 3, 4], 3: None, 4: None, 5: [1, 2, 3] * 4, 6: [9] * 4}


def test_image_from_vector_uses_the_whole_vector(spark):
    df = spark.createDataFrame([(1, [-1.0] * 7), (2, [1.0])], "k int, v array<double>")
    got = {r.image_id: (r.height, r.data) for r in IM.image_from_vector(df, "k", "v", 2, 3).collect()}
    assert got == {1: (2, [0] * 12), 2: (1, [255, 0, 0, 0, 0, 0])}
