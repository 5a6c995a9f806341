"""Edge rows for scoring and evaluation."""

import math

from pyspark.sql import functions as F

from ocellus.functions import arrays as A
from ocellus.operators import evaluation as E
from ocellus.operators import scoring as SC


def test_keyword_flag_null_array_and_no_hit(spark):
    df = spark.createDataFrame([(1, ["Alligator", "x"]), (2, ["crocodile"]), (3, None)],
                               "id int, labels array<string>")
    out = {r.id: r.search_term for r in SC.keyword_flag(df, "labels", "alligator").collect()}
    assert out == {1: 1, 2: 0, 3: 0}
    none = SC.keyword_flag(df.where(F.col("id") > 1), "labels", "alligator")
    h = E.hit_rate(none).first()
    assert h.n_hits == 0 and h.hit_rate == 0.0
    empty = E.hit_rate(none.where(F.lit(False))).first()
    assert empty.n_rows == 0 and empty.hit_rate == 0.0


def test_flag_rate_is_a_fraction_of_the_real_total(spark):
    df = spark.createDataFrame([(1,), (1,), (0,), (1,)], "search_term int")
    got = {r.search_term: (r["count"], r.pct) for r in E.flag_rate(df).collect()}
    assert got == {1: (3, 0.75), 0: (1, 0.25)}


def test_probabilities_argmax_topk(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, -2.0],)], "z array<double>")
    r = df.select(A.softmax("z").alias("p"), A.sigmoid("z").alias("s"), A.argmax("z").alias("am"),
                  A.topk(F.col("z"), 3).alias("t")).first()
    assert abs(sum(r.p) - 1.0) < 1e-12
    assert abs(r.s[0] - 1 / (1 + math.exp(-1))) < 1e-12 and sum(r.s) > 1   # sigmoid does not sum to 1
    assert r.am == 1                                                        # first maximum wins
    assert [x.idx for x in r.t] == [1, 2, 0]                                # ties to the lower index


def test_argmax_label_formatting(spark):
    df = spark.createDataFrame([(0, [0.1, 0.123456789, 0.05])], "id int, p array<double>")
    classes = spark.createDataFrame([(0, "cat"), (1, "alligator"), (2, "water")], "ci int, name string")
    out = SC.argmax_label(df, "p", SC.class_names_table(classes, "ci", "name")).first()
    assert out.prediction_label == "ALLIGATOR" and out.class_index == 1
    assert abs(out.prediction_prob - 12.345679) < 1e-9                     # round(p, 8) * 100


def test_log_loss_and_confusion(spark):
    df = spark.createDataFrame([(0, [0.9, 0.1]), (1, [0.2, 0.8]), (1, [0.6, 0.4])], "label int, p array<double>")
    r = E.log_loss(df, "label", "p").first()
    assert abs(r.loss - (-(math.log(0.9) + math.log(0.8) + math.log(0.4)) / 3)) < 1e-12
    assert abs(r.accuracy - 2 / 3) < 1e-12
    c = {(x.label, x.prediction): x.n for x in E.confusion_counts(
        df.withColumn("pred", A.argmax("p")), "label", "pred").collect()}
    assert c == {(0, 0): 1, (1, 1): 1, (1, 0): 1}


def test_class_probabilities_keeps_caller_columns(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0], "keep")], "_z int, z array<double>, _e string")
    out = SC.class_probabilities(df, "z")
    assert out.columns == ["_z", "z", "_e", "probability"]
    r = out.first()
    assert r["_z"] == 1 and r["_e"] == "keep" and abs(sum(r.probability) - 1) < 1e-12
