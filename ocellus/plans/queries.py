"""Registered queries: each reads the given tables under ``sf_dir`` and runs
one operator (or a few small steps sharing a key) over the whole tables.

Every callable has the signature ``(spark, sf_dir) -> DataFrame``; computed
columns carry the same names as in ``ocellus.plans.oracles``.  Doubles are
rounded to 6 places at the very end so both engines hash the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ocellus.functions import arrays as A
from ocellus.functions import text as TX
from ocellus.operators import evaluation as E
from ocellus.operators import features as FE
from ocellus.operators import images as IM
from ocellus.operators import sampling as S
from ocellus.operators import scoring as SC
from ocellus.operators import training as TR
from ocellus.session import read_table
from ocellus.sources import fetch as FETCH
from ocellus.sources import files as FS
from ocellus.sources import store as ST
from ocellus.streaming import scoring as SS

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# fixed parameters of the registered queries
SPLIT_PCT = 60          # 60/40 train/test, key-hash split
STRATIFIED_PCT = 30     # 30/70 per class
SHUFFLE_SEED = "42"
PICK_SEED = "7"
TOP_K = 5
SEARCH_TERM = "ou"
FIRST_N = 10


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def r6(col):
    return F.round(col, 6)


def _embeddings(spark, sf_dir):
    return read_table(spark, sf_dir, "embeddings")


def _logits(spark, sf_dir):
    """The whole vector acts as the class logits (classes 0 to its size - 1)."""
    e = _embeddings(spark, sf_dir)
    return e.select("vec_id", "label", A.as_doubles("embedding").alias("logits"))


def _class_table(df: DataFrame) -> DataFrame:
    """index -> name lookup for as many classes as the longest vector has."""
    n = df.agg(F.max(F.size("logits")).alias("n")).where("n > 0")
    index = n.select(F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    return SC.class_names_table(index.select("i", F.concat(F.lit("class_"), F.col("i").cast("string")).alias("name")),
                                "i", "name")


# ---------------------------------------------------------------- evaluation
@register("accuracy")
def q_accuracy(spark, sf_dir):
    """Nearest class mean fitted on the train split, scored on the test
    split; accuracy per true label."""
    e = S.hash_split(_embeddings(spark, sf_dir), "vec_id", SPLIT_PCT)
    train = e.where(F.col("split") == "train")
    test = e.where(F.col("split") == "test")
    cents = E.class_centroids(train, "embedding", "label")
    pred = E.nearest_centroid_predict(test, "embedding", cents)
    return E.accuracy(pred, "label", "prediction", by="label").select(
        "label", "n", "n_correct", r6(F.col("accuracy")).alias("accuracy"))


@register("log_loss")
def q_log_loss(spark, sf_dir):
    p = SC.class_probabilities(_logits(spark, sf_dir), "logits")
    return E.log_loss(p, "label", "probability").select(
        "n", r6(F.col("loss")).alias("loss"), r6(F.col("accuracy")).alias("accuracy"))


@register("confusion_counts")
def q_confusion_counts(spark, sf_dir):
    p = _logits(spark, sf_dir).withColumn("prediction", A.argmax("logits"))
    return E.confusion_counts(p, "label", "prediction")


def _conversation_flags(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations")
    words = c.select("conv_id", "turn",
                     F.concat_ws("/", F.lit("conversations"), F.col("conv_id").cast("string"),
                                 F.col("turn").cast("string")).alias("file_path"),
                     F.split(F.col("text"), r"\s+").alias("predicted_labels"))
    return SC.keyword_flag(words, "predicted_labels", SEARCH_TERM)


@register("search_term_flag")
def q_search_term_flag(spark, sf_dir):
    return _conversation_flags(spark, sf_dir).select("conv_id", "turn", "search_term")


@register("flag_rate")
def q_flag_rate(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels").select(F.col("toxic").alias("search_term"))
    return E.flag_rate(lab).select("search_term", "count", r6(F.col("pct")).alias("pct"))


@register("miss_list")
def q_miss_list(spark, sf_dir):
    return E.miss_list(_conversation_flags(spark, sf_dir), "search_term", "file_path")


@register("hit_rate")
def q_hit_rate(spark, sf_dir):
    h = E.hit_rate(_conversation_flags(spark, sf_dir))
    return h.select("n_rows", "n_hits", r6(F.col("hit_rate")).alias("hit_rate"))


# ------------------------------------------------------------------- scoring
@register("class_probabilities")
def q_class_probabilities(spark, sf_dir):
    l = _logits(spark, sf_dir)
    p = (SC.class_probabilities(l, "logits", "p_softmax", "softmax")
         .transform(lambda d: SC.class_probabilities(d, "logits", "p_sigmoid", "sigmoid")))
    z = p.select("vec_id", F.arrays_zip("p_softmax", "p_sigmoid").alias("z"))
    return z.select("vec_id", F.posexplode_outer("z").alias("class_index", "p")).select(
        "vec_id", F.col("class_index").cast("int").alias("class_index"),
        r6(F.col("p.p_softmax")).alias("p_softmax"), r6(F.col("p.p_sigmoid")).alias("p_sigmoid"))


@register("argmax_label")
def q_argmax_label(spark, sf_dir):
    l = _logits(spark, sf_dir)
    p = SC.class_probabilities(l, "logits")
    out = SC.argmax_label(p, "probability", _class_table(l))
    return out.select("vec_id", "class_index", "prediction_label",
                      r6(F.col("prediction_prob")).alias("prediction_prob"))


@register("probability_map")
def q_probability_map(spark, sf_dir):
    names = F.transform("probability", lambda x, i: F.concat(F.lit("class_"), i.cast("string")))
    p = SC.probability_map(SC.class_probabilities(_logits(spark, sf_dir), "logits"), "probability", names)
    return p.select("vec_id", F.explode_outer("probabilities").alias("class_name", "prob")).select(
        "vec_id", "class_name", r6(F.col("prob")).alias("prob"))


@register("topk_labels")
def q_topk_labels(spark, sf_dir):
    p = SC.topk_labels(SC.class_probabilities(_logits(spark, sf_dir), "logits"), "probability", TOP_K)
    return p.select("vec_id", F.posexplode_outer("predicted_labels").alias("pos", "t")).select(
        "vec_id", (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("t.idx").alias("class_index"), r6(F.col("t.prob")).alias("prob"))


# ------------------------------------------------------------------ sampling
@register("hash_split")
def q_hash_split(spark, sf_dir):
    return S.hash_split(_embeddings(spark, sf_dir), "vec_id", SPLIT_PCT).select("vec_id", "label", "split")


@register("stratified_split")
def q_stratified_split(spark, sf_dir):
    return S.stratified_split(_embeddings(spark, sf_dir), "vec_id", "label", STRATIFIED_PCT).select(
        "vec_id", "label", "split")


@register("split_counts")
def q_split_counts(spark, sf_dir):
    return S.split_counts(S.hash_split(_embeddings(spark, sf_dir), "vec_id", SPLIT_PCT))


@register("shuffle_rank")
def q_shuffle_rank(spark, sf_dir):
    return S.shuffle_rank(_embeddings(spark, sf_dir).select("vec_id", "label"), "vec_id", SHUFFLE_SEED)


@register("first_n")
def q_first_n(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return S.first_n(d, ["doc_id"], FIRST_N)


@register("batch_plan")
def q_batch_plan(spark, sf_dir):
    e = S.hash_split(_embeddings(spark, sf_dir), "vec_id", SPLIT_PCT, names=("training", "validation"))
    return S.batch_plan(e, "split", "label")


@register("labelled_union")
def q_labelled_union(spark, sf_dir):
    """Two labelled sources (quality 1 / quality 0) with literal labels,
    bag-unioned, then joined once to the documents (read once) with the
    not-null filter on the payload."""
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    u = S.labelled_union((lab.where(F.col("quality") == 1).select("doc_id"), 1),
                         (lab.where(F.col("quality") == 0).select("doc_id"), 0))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", "text")
    return docs.where(F.col("text").isNotNull()).join(u, "doc_id").select("doc_id", "source", "n_chars", "label")


def _nation_items(spark, sf_dir):
    return read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")


@register("rotation_assign")
def q_rotation_assign(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id")
    out = S.rotation_assign(ev, "event_id", _nation_items(spark, sf_dir), "n_nationkey", "n_name")
    return out.select("event_id", "request_no", "item_no", "item")


@register("random_assign")
def q_random_assign(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id")
    out = S.random_assign(ev, "event_id", _nation_items(spark, sf_dir), "n_nationkey", "n_name", PICK_SEED)
    return out.select("event_id", "item_no", "item")


# --------------------------------------------------------------------- clean

# the test pages hold no images: html pages stand in for image files
PAGE_EXTENSIONS = ("html", "htm")
UPLOAD_FOLDER = "./static/uploaded_files"
APP_ROOT = "/srv/app/static/model_images"
RESPONSE_HEAD = "HTTP/1.0 200 OK\r\nContent-Type: application/json\r\nContent-Length: 0\r\n\r\n"


def _pages(spark, sf_dir):
    return read_table(spark, sf_dir, "pages")


@register("url_filename_ext")
def q_url_filename_ext(spark, sf_dir):
    p = _pages(spark, sf_dir).select("page_id", "url")
    name = TX.file_name("url")
    return p.select("page_id", name.alias("file_name"), TX.extension(name).alias("extension"),
                    TX.has_dot(name).alias("has_dot"))


@register("ext_allow_filter")
def q_ext_allow_filter(spark, sf_dir):
    """Downloader rule (extension only) and upload rule (dot required)."""
    p = _pages(spark, sf_dir).select("page_id", TX.file_name("url").alias("file_name"))
    return p.where(TX.extension_allowed("file_name", PAGE_EXTENSIONS, require_dot=True)).select(
        "page_id", "file_name", TX.extension("file_name").alias("extension"))


def _payloads(spark, sf_dir):
    """Score requests made from documents: base64 of the text, some with a
    data-URI prefix, some wrapped with CR/LF, some corrupted."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    b64 = F.base64(F.col("text"))       # Spark wraps long values with CR/LF
    clean = TX.strip_crlf(b64)
    variant = F.col("source")
    payload = (F.when(variant == "src0", F.concat(F.lit("data:image/png;base64,"), clean))
               .when(variant == "src1", b64)
               .when(variant == "src2", F.concat(clean, F.lit("@@")))
               .otherwise(clean))
    return d.withColumn("payload", payload)


@register("payload_decode")
def q_payload_decode(spark, sf_dir):
    p = _payloads(spark, sf_dir)
    raw = TX.decode_base64("payload")
    return p.select("doc_id", "source",
                    raw.isNotNull().alias("decoded_ok"),
                    F.length(raw).cast("bigint").alias("n_bytes"),
                    F.coalesce(F.col("text") == raw.cast("string"), F.lit(False)).alias("matches_text"))


@register("payload_encode")
def q_payload_encode(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    req = TX.image_request_json(F.base64(F.col("text")))
    return d.select("doc_id", F.length(req).cast("bigint").alias("request_len"),
                    F.md5(req).alias("request_md5"))


@register("response_body")
def q_response_body(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    body = F.concat(F.lit('{"prediction_label":"'), F.upper("lang"), F.lit('","prediction_prob":'),
                    F.col("n_chars").cast("string"), F.lit("}"))
    raw = F.concat(F.lit(RESPONSE_HEAD), body)
    b = TX.response_body(raw)
    return d.select("doc_id", b.alias("body"),
                    F.get_json_object(b, "$.prediction_label").alias("prediction_label"),
                    F.get_json_object(b, "$.prediction_prob").try_cast("bigint").alias("prediction_prob"))


@register("path_rewrite")
def q_path_rewrite(spark, sf_dir):
    p = _pages(spark, sf_dir).select("page_id", TX.file_name("url").alias("file_name"))
    path = TX.join_path(APP_ROOT, F.col("file_name"))
    safe = TX.safe_file_name("file_name")
    return p.select("page_id", TX.static_path(path).alias("image_path_html"),
                    safe.alias("safe_name"), TX.join_path(UPLOAD_FOLDER, safe).alias("upload_path"))


@register("html_link_manifest")
def q_html_link_manifest(spark, sf_dir):
    p = _pages(spark, sf_dir).select("page_id", "html")
    return p.select("page_id", F.size(TX.href_links("html")).alias("n_links"),
                    TX.link_manifest("html").alias("manifest"))


@register("fetch_outcomes")
def q_fetch_outcomes(spark, sf_dir):
    pages = _pages(spark, sf_dir).select("url", "html")
    return FETCH.outcome_counts(FETCH.stored_outcomes(pages, "url", "html", PAGE_EXTENSIONS))


# -------------------------------------------------------------------- images
@register("thumbnail_dims")
def q_thumbnail_dims(spark, sf_dir):
    p = read_table(spark, sf_dir, "part").select(
        "p_partkey", (F.col("p_size") * 12).alias("width"),
        (F.floor("p_retailprice") - 850).cast("int").alias("height"))
    dw, dh = IM.thumbnail_size("width", "height", *IM.DOWNLOAD_THUMB_BOX)
    tw, th = IM.thumbnail_size("width", "height", *IM.THUMB_BOX)
    return p.select("p_partkey", "width", "height", dw.alias("download_w"), dh.alias("download_h"),
                    tw.alias("thumb_w"), th.alias("thumb_h"))


def _image_table(spark, sf_dir, w=8, c=1):
    return IM.image_from_vector(_embeddings(spark, sf_dir), "vec_id", "embedding", w, c)


@register("image_resize")
def q_image_resize(spark, sf_dir):
    r = IM.resize_to_bytes(_image_table(spark, sf_dir), *IM.MODEL_SIZE)
    return r.select("image_id", _pixel_checksums("resized").alias("c")).select("image_id", "c.*")


@register("thumbnail_job")
def q_thumbnail_job(spark, sf_dir):
    """Image structs as Spark's image source gives them, made from the
    vectors, through the thumbnail job; written, read back and summed."""
    from ocellus.session import scratch_path
    path = scratch_path(spark, "thumbnails")
    im = _image_table(spark, sf_dir)
    raw = F.unhex(F.array_join(F.transform("data", lambda x: F.lpad(F.hex(x), 2, "0")), ""))
    images = im.select(F.struct(
        F.concat(F.lit("/images/"), F.col("image_id").cast("string"), F.lit(".png")).alias("origin"),
        "height", "width", F.col("n_channels").alias("nChannels"), raw.alias("data")).alias("image"))
    IM.write_thumbnails(IM.thumbnail_job(images, box=SMALL_BOX), path)
    px = IM.bytes_to_ints("bytes")
    return spark.read.parquet(path).withColumn("px", px).select(
        "name", "width", "height", "n_channels",
        F.aggregate("px", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("pixel_sum"))


SMALL_BOX = (5, 4)      # smaller than the 8x8 images of the vectors


@F.pandas_udf(T.StructType([T.StructField("n_values", T.IntegerType()),
                            T.StructField("pixel_sum", T.LongType()),
                            T.StructField("weighted_sum", T.LongType())]))
def _pixel_checksums(px):
    """Size, sum and position-weighted sum of each image's bytes; images of
    equal size together."""
    import numpy as np
    import pandas as pd
    out = pd.DataFrame(0, index=px.index, columns=["n_values", "pixel_sum", "weighted_sum"], dtype="int64")
    for n, same in px.dropna().groupby(px.dropna().map(len)):
        v = np.frombuffer(b"".join(same), np.uint8).reshape(len(same), n)
        # up to 2^22 values the sums stay below 2^53, where doubles are exact
        place = np.arange(1, n + 1, dtype=float if n < 1 << 22 else np.int64)
        weighted = [row.astype(place.dtype) @ place for row in v]
        out.loc[same.index, "n_values"] = n
        out.loc[same.index, "pixel_sum"] = v.sum(axis=1, dtype=np.int64)
        out.loc[same.index, "weighted_sum"] = np.array(weighted).astype(np.int64)
    return out


@register("image_pixels")
def q_image_pixels(spark, sf_dir):
    """A three-channel BGR image, 5 wide, per vector -> RGB -> floats / 255."""
    im = _image_table(spark, sf_dir, 5, 3)
    rgb = IM.rescale(IM.bgr_to_rgb("data", "n_channels"))
    return im.select("image_id", F.posexplode(rgb).alias("idx", "v")).select(
        "image_id", F.col("idx").cast("int").alias("idx"), r6(F.col("v")).alias("value"))


@register("featurize_pool")
def q_featurize_pool(spark, sf_dir):
    im = _image_table(spark, sf_dir)
    f = FE.featurize(im, "pool", grid=2)
    return f.select("image_id", F.posexplode_outer("features").alias("idx", "v")).select(
        "image_id", F.col("idx").cast("int").alias("feature_index"), r6(F.col("v")).alias("value"))


# ------------------------------------------------------------------ features
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("vector_assemble")
def q_vector_assemble(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("Label"), *LINE_FEATURES)
    v = FE.assemble(li, "Label", exclude=["l_orderkey", "l_linenumber"])
    a = vector_to_array(F.col("features"))
    return v.select("l_orderkey", "l_linenumber", "Label", F.size(a).alias("n_features"),
                    *[a[i].alias(f"f{i + 1}") for i in range(len(LINE_FEATURES))])


@register("standard_scale")
def q_standard_scale(spark, sf_dir):
    e = S.hash_split(_embeddings(spark, sf_dir), "vec_id", SPLIT_PCT)
    scaled, _ = FE.standard_scale(e, "embedding", fit_df=e.where(F.col("split") == "train"))
    return scaled.select("vec_id", F.posexplode(vector_to_array("features_normalized")).alias("pos", "v")) \
        .select("vec_id", F.col("pos").cast("int").alias("pos"), r6(F.col("v")).alias("value"))


@register("string_index")
def q_string_index(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    out, _ = FE.string_index(ev, "event_type")
    return out.select("event_id", "event_type", "label_index")


@register("one_hot")
def q_one_hot(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    idx, model = FE.string_index(ev, "event_type")
    oh = FE.one_hot(idx, "label_index", width=len(model.labels))
    return oh.select("event_id", "label_index",
                     (F.array_position("label", F.lit(1.0)) - 1).cast("int").alias("hot_index"),
                     F.size("label").alias("width"),
                     F.aggregate("label", F.lit(0.0), lambda a, x: a + x).alias("hot_sum"))


@register("class_index")
def q_class_index(spark, sf_dir):
    """Alphabetical class index, saved to the shared store, loaded back and
    joined to every event; a null type has no index."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    table = FE.class_index_table(ev, "event_type")
    from ocellus.session import scratch_path
    path = scratch_path(spark, "class_index")
    ST.save_class_index(table, path)
    loaded = ST.load_class_index(spark, path)
    return ev.join(loaded.withColumnRenamed("class", "event_type"), "event_type", "left").select(
        "event_id", "event_type", "class_index")


@register("feature_store_roundtrip")
def q_feature_store_roundtrip(spark, sf_dir):
    e = _embeddings(spark, sf_dir)
    j = ST.feature_store_roundtrip(spark, e.select("vec_id", "embedding"), e.select("vec_id", "label"), "vec_id")
    c = ST.stored_vector_checksum(j, "embedding")
    return c.select("vec_id", "label", "dim", r6(F.col("feature_sum")).alias("feature_sum"))


# ------------------------------------------------------------------ training

TRAIN_PCT = 30          # the transfer-learning script trains on 30 % per class
SHIFT = 0.25            # how far the planted classes are moved apart, per value


def planted(df: DataFrame) -> DataFrame:
    """Planted label: 1 if the whole vector's sum is above 0; each vector is
    moved by ``SHIFT`` per value towards its class, so that a trained model can
    tell every row and a constant or random one cannot."""
    label = (A.array_sum(A.as_doubles("embedding")) > 0).cast("int")
    moved = df.withColumn("label", label)
    return moved.withColumn("embedding", F.transform("embedding", lambda x: x.cast("double") + F.lit(SHIFT) * (
        2 * F.col("label") - 1)))


def _planted_split(spark, sf_dir, pct=TRAIN_PCT):
    """Train and test rows, written once: fits and scoring read narrow tables."""
    from ocellus.session import scratch_path
    path = scratch_path(spark, "planted")
    e = planted(_embeddings(spark, sf_dir).select("vec_id", "embedding"))
    S.stratified_split(e, "vec_id", "label", pct).write.partitionBy("split").parquet(path)
    e = TR.with_vector(spark.read.parquet(path), "embedding")
    return e.where(F.col("split") == "train"), e.where(F.col("split") == "test")


def held_out(scored: DataFrame, key: str) -> DataFrame:
    """The scored held-out rows: label, prediction and whether the predicted
    class has more than half of the probability."""
    p = F.element_at(vector_to_array("probability"), F.col("prediction").cast("int") + 1)
    return scored.select(key, "label", F.col("prediction").cast("int").alias("prediction"), (p > 0.5).alias("confident"))


def _lr_scored(spark, sf_dir):
    train, test = _planted_split(spark, sf_dir)
    return TR.fit_lr_pipeline(train).transform(test)


def _width(train: DataFrame) -> int:
    return train.agg(F.max(F.size("embedding"))).first()[0]


def _mlp_scored(spark, sf_dir):
    """Spark's MLP 64-256-2 (L-BFGS) on the planted label, 60 % of the rows."""
    train, test = _planted_split(spark, sf_dir, SPLIT_PCT)
    return TR.fit_spark_mlp(train, _width(train), 2, hidden=(256,), max_iter=HEAD_EPOCHS).transform(test)


@register("lr_transfer")
def q_lr_transfer(spark, sf_dir):
    return held_out(_lr_scored(spark, sf_dir), "vec_id")


def _text_features(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    words = F.split(F.lower("text"), r"\s+")
    n = F.greatest(F.length("text"), F.lit(1))
    sym = (F.length("text") - F.length(F.regexp_replace("text", r"[^\p{L}\p{N}_ .,]", ""))) / n
    uniq = F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1))
    f = d.join(lab, "doc_id").select("doc_id", "label", F.array(F.col("n_chars").cast("double"), sym, uniq)
                                     .alias("tf"))
    return TR.with_vector(S.hash_split(f, "doc_id", SPLIT_PCT), "tf")


def _gbt_scored(spark, sf_dir):
    """The features are written once: fit and scoring read them, not the texts."""
    from ocellus.session import scratch_path
    path = scratch_path(spark, "text_features")
    _text_features(spark, sf_dir).write.parquet(path)
    f = spark.read.parquet(path)
    return TR.fit_gbt(f.where(F.col("split") == "train")).transform(f.where(F.col("split") == "test"))


@register("gbt_quality")
def q_gbt_quality(spark, sf_dir):
    """Every held-out document with its label and the label's held-out rows;
    whether the run's accuracy is above the share of the most frequent label,
    and whether a row of the label is given it more often than a row of the
    others (a constant guess gives all alike)."""
    from ocellus.session import scratch_path
    path = scratch_path(spark, "gbt_scored")
    _gbt_scored(spark, sf_dir).select("doc_id", "label", F.col("prediction").cast("int").alias("prediction")).write.parquet(path)
    return above_guesses(spark.read.parquet(path), "doc_id")


def above_guesses(scored: DataFrame, key: str) -> DataFrame:
    """The scored rows (given written, they are read twice) as ``key, label,
    n, above_majority, above_chance``."""
    found = E.accuracy(scored, "label", "prediction", by="label").withColumn("wrong", F.col("n") - F.col("n_correct"))
    all_ = Window.partitionBy()  # over one row per label
    majority = F.sum("n_correct").over(all_) > F.max("n").over(all_)
    rate = (F.sum("wrong").over(all_) - F.col("wrong")) / (F.sum("n").over(all_) - F.col("n"))
    flags = found.select(F.col("label").alias("_of"), "n", majority.alias("above_majority"),
                         (F.col("accuracy") > rate).alias("above_chance"))
    return scored.join(F.broadcast(flags), F.col("label").eqNullSafe(F.col("_of"))).select(
        key, "label", "n", "above_majority", "above_chance")


@register("gbt_predictions")
def q_gbt_predictions(spark, sf_dir):
    """Prediction and probability of label 1 of every held-out document (no
    SQL twin: ``gbt_quality`` holds the accuracy)."""
    scored = _gbt_scored(spark, sf_dir)
    return scored.select("doc_id", "label", F.col("prediction").cast("int").alias("prediction"),
                         r6(vector_to_array("probability")[1]).alias("score"))


@register("binary_auc")
def q_binary_auc(spark, sf_dir):
    """Area under ROC of the text length as a score of quality."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", F.length("text").cast("double").alias("score"))
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    scored = d.join(lab, "doc_id").where("score IS NOT NULL AND label IS NOT NULL").select("label", "score")
    auc = E.binary_auc(scored, "label", "score")
    return scored.agg(F.count(F.lit(1)).alias("n")).withColumn("auc", F.round(F.lit(auc), 6))


@register("mlp_head")
def q_mlp_head(spark, sf_dir):
    return held_out(_mlp_scored(spark, sf_dir), "vec_id")


HEAD_EPOCHS = 50


def _trainers(train: DataFrame) -> dict:
    width = _width(train)
    return {"lr": TR.fit_lr_pipeline, "gbt": TR.fit_gbt,
            "mlp": lambda t: TR.fit_spark_mlp(t, width, 2, hidden=(256,), max_iter=HEAD_EPOCHS)}


@register("trainer_report")
def q_trainer_report(spark, sf_dir):
    """Accuracy and time of the trainers on the planted label, one split for
    all; the trees see an axis at a time and are held to nine tenths."""
    train, test = _planted_split(spark, sf_dir, SPLIT_PCT)
    report = TR.compare_trainers(_trainers(train), train, test)
    return report.select("trainer", "n_test", F.when(F.col("trainer") != "gbt", r6(F.col("accuracy"))).alias("accuracy"),
                         (F.col("accuracy") > 0.9).alias("above_90"), (F.col("seconds") > 0).alias("timed"))


@register("mlp_rounds")
def q_mlp_rounds(spark, sf_dir):
    """Validation loss after each round of a warm-started fit: every round's
    is below the first one's."""
    train, test = _planted_split(spark, sf_dir, SPLIT_PCT)
    _, history = TR.fit_mlp_rounds(train, test, _width(train), 2, rounds=6, steps=2, patience=6)
    rows = spark.createDataFrame(history, "round int, n_validation bigint, loss double, accuracy double")
    return rows.select("round", "n_validation", (F.col("loss") < history[0][2]).alias("below_first"))


@register("batch_score")
def q_batch_score(spark, sf_dir):
    """Score the held-out rows with the trained model: whether class and
    probability agree, and the probability vector's sum."""
    s = _lr_scored(spark, sf_dir).withColumn("p", vector_to_array("probability"))
    return s.select("vec_id", "label", (A.argmax("p") == F.col("prediction").cast("int")).alias("class_is_argmax"),
                    F.array_max("p").between(0.5, 1.0).alias("prob_in_range"),
                    F.round(A.array_sum("p"), 6).alias("prob_sum"))


def _bright_images(spark, sf_dir) -> DataFrame:
    """Images with a planted label, whether they are brighter than medium
    grey; each is moved further that way."""
    im = _image_table(spark, sf_dir)
    mean = F.aggregate("data", F.lit(0).cast("bigint"), lambda a, x: a + x) / F.size("data")
    lab = im.withColumn("label", (mean > BRIGHT).cast("int"))
    return lab.withColumn("data", F.transform("data", lambda x: F.greatest(F.least(
        x + BRIGHTEN * (2 * F.col("label") - 1), F.lit(255)), F.lit(0))))


@register("image_program")
def q_image_program(spark, sf_dir):
    """Image table -> pooled features -> LR -> predictions."""
    lab = S.hash_split(_bright_images(spark, sf_dir), "image_id", SPLIT_PCT)
    f = TR.with_vector(FE.featurize(lab, "pool", out_col="pooled"), "pooled")
    model = TR.fit_lr_pipeline(f.where(F.col("split") == "train"))
    return held_out(model.transform(f.where(F.col("split") == "test")), "image_id")


BRIGHT, BRIGHTEN = 127.0, 40


@register("tabular_program")
def q_tabular_program(spark, sf_dir):
    """CSV -> assemble -> scale -> index -> one-hot -> split -> LR ->
    predictions; the label written to the CSV is whether the order is large."""
    from ocellus.session import scratch_path
    path = scratch_path(spark, "program_csv")
    label = F.when(F.col("l_quantity") > LARGE_ORDER, "large").otherwise("small")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    li = read_table(spark, sf_dir, "lineitem").select(key.alias("line"), label.alias("Label"), *LINE_FEATURES)
    li.write.option("header", True).csv(path)
    schema = "line string, Label string, " + ", ".join(f"{c} double" for c in LINE_FEATURES)
    v = FE.assemble(FS.read_feature_csv(spark, path, schema), "Label", exclude=["line"])
    v = S.hash_split(v, "line", SPLIT_PCT)
    scaled, _ = FE.standard_scale(v, "features", fit_df=v.where(F.col("split") == "train"))
    idx, model = FE.string_index(scaled, "Label", "class_index", order="alphabetAsc")
    hot = FE.one_hot(idx, "class_index", width=len(model.labels), out_col="hot")
    d = hot.withColumn("label", (F.array_position("hot", F.lit(1.0)) - 1).cast("int")).drop("features").select(
        "line", "split", F.col("label").alias("_y"), "features_normalized").withColumnRenamed("_y", "label")
    fitted = TR.fit_lr_pipeline(d.where(F.col("split") == "train"), features_col="features_normalized")
    return held_out(fitted.transform(d.where(F.col("split") == "test")), "line")


LARGE_ORDER = 25


@register("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    from ocellus.session import scratch_path
    train, test = _planted_split(spark, sf_dir)
    model = TR.fit_lr_pipeline(train)
    path = scratch_path(spark, "lr_model")
    ST.save_model(model, path)
    loaded = ST.load_pipeline_model(path)
    # one pass, no join: the reloaded model scores the rows the original
    # model just scored
    a = model.transform(test).select("vec_id", "features", F.col("prediction").alias("before"))
    b = loaded.transform(a).select("vec_id", "before", F.col("prediction").alias("after"))
    return b.select("vec_id", (F.col("before") == F.col("after")).alias("same"))


# ------------------------------------------------------- streams and files

STREAM_ROWS_PER_FILE = 1_000_000
STREAM_FILES_PER_BATCH = 64


def _value_payload(col):
    """An event's value as the request payload (base64 of its text)."""
    return TX.base64_text(col.cast("string"))


@register("stream_score")
def q_stream_score(spark, sf_dir):
    """Events replayed as parquet files into a directory, scored by a
    file-source stream into a parquet sink; the sink is read back."""
    from ocellus.session import scratch_path
    base = scratch_path(spark, "stream_score")
    ev = read_table(spark, sf_dir, "events").select("event_id", "value")
    # replayed with the input's own partitions: no shuffle
    ev.write.option("maxRecordsPerFile", STREAM_ROWS_PER_FILE).parquet(f"{base}/in")
    scorer = SS.threshold_scorer("value")

    def transform(stream):
        enriched = SS.enrich_records(stream.withColumn("payload", _value_payload(F.col("value"))), "payload", scorer)
        return enriched.select("event_id", "content", "prediction_label", "prediction_prob", "attributes", "error")

    out = SS.run_stream(spark, f"{base}/in", "event_id bigint, value double", transform,
                        f"{base}/out", f"{base}/checkpoint",
                        max_files_per_trigger=STREAM_FILES_PER_BATCH)
    return out.select("event_id", "content", "prediction_label", "prediction_prob",
                      F.col("attributes")["prediction_prob"].alias("prob_attr"))


@register("score_requests")
def q_score_requests(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    payload = _value_payload(F.col("value"))
    payload = F.when(F.col("event_type") == "click", F.concat(F.lit("data:image/png;base64,"), payload)) \
        .otherwise(payload)
    body = F.to_json(F.struct(payload.alias("image")))
    method = F.when(F.col("event_type") == "view", F.lit("GET")).otherwise(F.lit("POST"))
    req = SS.request_table(ev.withColumn("method", method).withColumn("body", body), "event_id", "method", "body")
    ans = SS.answer_requests(req, lambda p: p.cast("string").try_cast("double"), SS.threshold_scorer("_value"))
    return ans.select("request_id", "method", "prediction_label", "prediction_prob", "response")


@register("score_json")
def q_score_json(spark, sf_dir):
    """Request JSON built and parsed back, props parsed, attributes as text."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "value", "props")
    req = F.to_json(F.struct(F.col("event_id"), F.col("value")))
    parsed = F.from_json(req, "event_id bigint, value double")
    scored = SS.threshold_scorer("value")(ev.withColumn("req", req))
    return scored.select(
        "event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        parsed["value"].alias("value_roundtrip"), "prediction_label",
        SS.format_attribute(F.col("prediction_prob")).alias("prob_attr"))


@register("url_manifest_read")
def q_url_manifest_read(spark, sf_dir):
    """pages.url written as a newline manifest and read back line by line."""
    from ocellus.session import scratch_path
    path = scratch_path(spark, "manifest")
    FS.write_url_manifest(_pages(spark, sf_dir), "url", path)
    m = FS.read_url_manifest(spark, path)
    name = TX.file_name("url")
    return m.select("url", name.alias("file_name"), TX.extension(name).alias("extension"))


@register("labelled_dir_scan")
def q_labelled_dir_scan(spark, sf_dir):
    """Texts written as one folder per language, scanned as a labelled tree:
    bytes per class."""
    from ocellus.session import scratch_path
    path = scratch_path(spark, "tree")
    read_table(spark, sf_dir, "documents").select("lang", "text").where("text IS NOT NULL") \
        .write.partitionBy("lang").option("lineSep", "\n").text(path)
    return FS.labelled_dir_scan(spark, path, allowed=("txt",)).groupBy("class").agg(
        F.sum("length").alias("n_bytes"))


@register("csv_features")
def q_csv_features(spark, sf_dir):
    """Label + numeric features written as a header CSV, read back with a
    schema, assembled into one vector per row."""
    from ocellus.session import scratch_path
    path = scratch_path(spark, "csv")
    li = read_table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("Label"), *LINE_FEATURES)
    li.write.option("header", True).csv(path)
    schema = "Label string, " + ", ".join(f"{c} double" for c in LINE_FEATURES)
    v = FE.assemble(FS.read_feature_csv(spark, path, schema), "Label")
    a = vector_to_array(F.col("features"))
    # the inputs have two decimals: sum whole cents so the check is exact at
    # any scale (a double sum of ~1e10 has no sixth decimal to compare)
    cents = [F.round(a[i] * 100).cast("bigint") for i in range(len(LINE_FEATURES))]
    return v.groupBy("Label").agg(F.count(F.lit(1)).alias("n"),
                                  *[F.sum(c).alias(f"sum_f{i + 1}_cents") for i, c in enumerate(cents)])


from ocellus.plans import jobs  # noqa: E402,F401  registers the queries of its jobs
