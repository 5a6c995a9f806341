"""Training invariants: above-majority accuracy on the planted label,
probabilities sum to one, saved == reloaded."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK
from ocellus.functions import arrays as A
from ocellus.operators import evaluation as E
from ocellus.operators import training as TR
from ocellus.plans import queries as Q


def _majority(df):
    n = df.count()
    return max(r["count"] for r in df.groupBy("label").count().collect()) / n


def _acc(df):
    return E.accuracy(df, "label", "prediction").first()["accuracy"]


def test_lr_beats_majority_on_planted_label(spark):
    out = Q._lr_scored(spark, SF_CHECK)
    assert _acc(out) > _majority(out) + 0.1


def test_mlp_beats_majority(spark):
    out = Q._mlp_scored(spark, SF_CHECK)
    assert _acc(out) > _majority(out)


def test_held_out_rows_show_a_constant_guess(spark):
    """A model that predicts one class does not pass for a trained one."""
    train, test = Q._planted_split(spark, SF_CHECK)
    one = Q.held_out(TR.fit_lr_pipeline(train.withColumn("label", F.lit(1.0)).limit(20), regParam=1.0).transform(test), "vec_id")
    rows = one.collect()
    assert {r.prediction for r in rows} == {1} and any(r.label != r.prediction for r in rows)


def test_batch_scores_are_probabilities(spark):
    out = Q.q_batch_score(spark, SF_CHECK)
    assert out.where(~F.col("class_is_argmax") | ~F.col("prob_in_range") | (F.col("prob_sum") != 1.0)).count() == 0


def test_model_roundtrip(spark):
    out = Q.q_model_roundtrip(spark, SF_CHECK)
    assert out.count() > 0 and out.where(~F.col("same")).count() == 0


def test_gbt_on_quality(spark):
    out = Q._gbt_scored(spark, SF_CHECK)
    assert _acc(out) >= _majority(out)


def test_gbt_quality_returns_every_held_out_document(spark):
    got = Q.q_gbt_quality(spark, SF_CHECK)
    assert got.columns == ["doc_id", "label", "n", "above_majority", "above_chance"]
    want = {(r.doc_id, r.label) for r in Q._gbt_scored(spark, SF_CHECK).collect()}
    rows = got.collect()
    assert {(r.doc_id, r.label) for r in rows} == want and len(rows) == len(want)
    assert all(r.above_majority and r.above_chance and r.n == sum(x.label == r.label for x in rows) for r in rows)


def test_a_constant_guess_is_not_above_guesses(spark):
    rows = spark.createDataFrame([(i, int(i < 7), 1) for i in range(10)] + [(9, 0, 1)], "doc_id int, label int, prediction int")
    got = Q.above_guesses(rows, "doc_id").collect()
    assert len(got) == 11 and not any(r.above_majority or r.above_chance for r in got)
    assert {(r.label, r.n) for r in got} == {(1, 7), (0, 4)}
    odd = rows.union(spark.createDataFrame([(10, None, 1)], rows.schema))
    assert {(r.label, r.n) for r in Q.above_guesses(odd, "doc_id").collect()} == {(1, 7), (0, 4), (None, 1)}


def test_auc_counts_ties_half(spark):
    rows = spark.createDataFrame([(1, 2.0), (0, 2.0), (1, 3.0), (0, 1.0)], "label int, score double")
    # pairs: 2.0=2.0 a half, all others right
    assert E.binary_auc(rows, "label", "score") == pytest.approx(3.5 / 4)


def test_trainer_report_rows(spark):
    train, test = Q._planted_split(spark, SF_CHECK, Q.SPLIT_PCT)
    rows = {r.trainer: r for r in TR.compare_trainers(Q._trainers(train), train, test).collect()}
    assert set(rows) == {"lr", "gbt", "mlp"} and len({r.n_test for r in rows.values()}) == 1
    assert all(r.seconds > 0 and r.accuracy > 0.9 and r.n_correct == round(r.accuracy * r.n_test) for r in rows.values())
    assert TR.compare_trainers({}, train, test).count() == 0


def test_probability_vector_has_one_value_a_class(spark):
    s = Q._lr_scored(spark, SF_CHECK).withColumn("p", Q.vector_to_array("probability"))
    assert all(abs(r.s - 1.0) < 1e-9 for r in s.select(A.array_sum("p").alias("s")).collect())
