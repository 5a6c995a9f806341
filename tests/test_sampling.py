"""Splits, ranks, batch planning and picks: invariants and partition independence."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ocellus.operators import sampling as S
from ocellus.session import read_table


def _emb(spark):
    return read_table(spark, SF_SMALL, "embeddings").select("vec_id", "label")


def test_hash_split_disjoint_covering_and_partition_independent(spark):
    e = _emb(spark)
    base = {(r.vec_id, r.split) for r in S.hash_split(e, "vec_id", 60).collect()}
    assert len(base) == e.count()
    for n in (1, 3, 7):
        again = {(r.vec_id, r.split) for r in S.hash_split(e.repartition(n), "vec_id", 60).collect()}
        assert again == base
    counts = {r.split: r.n_rows for r in S.split_counts(S.hash_split(e, "vec_id", 60)).collect()}
    assert sum(counts.values()) == e.count() and 0.5 < counts["train"] / e.count() < 0.7


def test_stratified_split_per_class_shares(spark):
    e = _emb(spark)
    s = S.stratified_split(e, "vec_id", "label", {c: (10 if c == 0 else 90) for c in range(10)})
    share = {r.label: r.share for r in s.groupBy("label").agg(
        F.avg((F.col("split") == "train").cast("double")).alias("share")).collect()}
    assert share[0] < 0.3 and all(share[c] > 0.7 for c in range(1, 10))


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_global_row_number_equals_sorted_order(spark, parts):
    e = _emb(spark).repartition(parts)
    got = [r.vec_id for r in S.global_row_number(e, ["vec_id"], "rn", num_buckets=5).orderBy("rn").collect()]
    assert got == sorted(got)
    rn = [r.rn for r in S.global_row_number(e, ["vec_id"], "rn", num_buckets=5).collect()]
    assert sorted(rn) == list(range(1, len(rn) + 1))


def test_shuffle_rank_is_a_permutation_independent_of_partitions(spark):
    e = _emb(spark)
    a = {r.vec_id: r.shuffle_rank for r in S.shuffle_rank(e, "vec_id", "s").collect()}
    b = {r.vec_id: r.shuffle_rank for r in S.shuffle_rank(e.repartition(7), "vec_id", "s", num_buckets=3).collect()}
    assert a == b and sorted(a.values()) == list(range(1, len(a) + 1))


def test_batch_size_rule(spark):
    df = spark.createDataFrame([(100, 7), (99, 20), (13, 5), (10, 0), (12, 10)], "t int, m int")
    got = [r[0] for r in df.select(S.calculate_batch_size(F.col("t"), F.col("m"))).collect()]
    assert got == [5, 9, 1, None, 6]


def test_rotation_wraps_and_random_pick_in_range(spark):
    ev = spark.range(0, 30).withColumnRenamed("id", "event_id")
    items = spark.createDataFrame([(i, f"img{i}") for i in range(8)], "k int, name string")
    rot = {r.event_id: r.item for r in S.rotation_assign(ev, "event_id", items, "k", "name").collect()}
    assert rot[0] == "img0" and rot[7] == "img7" and rot[8] == "img0" and rot[29] == "img5"
    rnd = S.random_assign(ev, "event_id", items, "k", "name", seed="1").collect()
    assert len(rnd) == 30 and all(0 <= r.item_no < 8 for r in rnd)


def test_first_n(spark):
    d = read_table(spark, SF_SMALL, "documents").select("doc_id")
    assert [r.doc_id for r in S.first_n(d, ["doc_id"], 5).collect()] == [0, 1, 2, 3, 4]


def test_row_number_with_hot_first_column(spark):
    """A third of the rows share one value of the first order column: the
    composite key is range-sampled as a whole and numbering stays exact."""
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id"))
    out = S.global_row_number(df, ["k", "id"], "rn", num_buckets=16)
    got = [(r.k, r.id) for r in out.orderBy("rn").collect()]
    assert got == sorted((r.k, r.id) for r in df.collect())
    assert sorted(r.rn for r in out.collect()) == list(range(1, 3001))


def test_clustered_keys_get_dense_numbers(spark):
    """Ids spread exponentially: most rows crowd the low end."""
    df = spark.range(0, 20000).select((F.pow(F.lit(1.001), F.col("id"))).cast("bigint").alias("k"), "id") \
        .select((F.col("k") * 20000 + F.col("id")).alias("key"))
    out = S.global_row_number(df, ["key"], "rn", num_buckets=32)
    assert sorted(r.rn for r in out.collect()) == list(range(1, 20001))


def test_null_keys_keep_their_rows(spark):
    """Numbering and picking return every row, null and repeated keys too."""
    df = spark.createDataFrame([(3,), (None,), (1,), (None,), (1,), (1,)], "e int")
    items = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "k int, v string")
    assert sorted(r.shuffle_rank for r in S.shuffle_rank(df, "e").collect()) == list(range(1, 7))
    rows = S.rotation_assign(df, "e", items, "k", "v").collect()
    assert sorted(r.request_no for r in rows) == list(range(6))
    assert all(r.item == "abc"[r.request_no % 3] == "abc"[r.item_no] for r in rows)
    picked = S.random_assign(df, "e", items, "k", "v").collect()
    assert len(picked) == 6 and all(r.item == "abc"[r.item_no] for r in picked)
    assert [r.item for r in S.rotation_assign(df, "e", items.limit(0), "k", "v").collect()] == [None] * 6


def test_item_list_above_the_old_bound(spark):
    items = spark.range(0, 100_500).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    rows = S.rotation_assign(spark.range(0, 50).withColumnRenamed("id", "e"), "e", items, "k", "v").collect()
    assert {(r.e, r.item) for r in rows} == {(i, str(i)) for i in range(50)}


def test_stratified_split_draws_classes_apart(spark):
    """The same keys in two classes do not fall on the same side together."""
    df = spark.range(0, 2000).select((F.col("id") % 1000).alias("key"), F.floor(F.col("id") / 1000).alias("cls"))
    s = S.stratified_split(df, "key", "cls", 30)
    both = s.where("split = 'train'").groupBy("key").count().where("count = 2").count()
    assert 50 < both < 140      # 0.3 * 0.3 of 1000 keys, not 0.3


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_range_row_number_partition_independent(spark, parts):
    df = spark.range(0, 2000).select((F.col("id") % 5).alias("g"), (F.col("id") * 7919 % 2003).alias("v"))
    out = S.global_row_number(df.repartition(parts), ["g", "v"], "rn", num_buckets=6)
    got = {(r.g, r.v): r.rn for r in out.collect()}
    want = {k: i + 1 for i, k in enumerate(sorted((r.g, r.v) for r in df.collect()))}
    assert got == want


def test_hash_prefix_bucket_preserves_md5_order(spark):
    df = spark.range(0, 5000).select(F.md5(F.col("id").cast("string")).alias("h"))
    rows = df.select("h", S.hash_prefix_bucket("h", 97).alias("b")).collect()
    ordered = sorted(rows, key=lambda r: r.h)
    assert all(a.b <= b.b for a, b in zip(ordered, ordered[1:]))
    assert 0 <= min(r.b for r in rows) and max(r.b for r in rows) < 97


def test_feature_options(spark):
    from ocellus.operators import features as FE
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("b",), ("c",)], "cls string")
    freq, _ = FE.string_index(df, "cls")
    alpha, _ = FE.string_index(df, "cls", order="alphabetAsc")
    assert {r.cls: r.label_index for r in freq.collect()} == {"b": 0, "c": 1, "a": 2}
    assert {r.cls: r.label_index for r in alpha.collect()} == {"a": 0, "b": 1, "c": 2}
    v = spark.createDataFrame([(0, [1.0, 10.0]), (1, [3.0, 10.0]), (2, [5.0, 40.0])], "id int, x array<double>")
    out, model = FE.standard_scale(v, "x", fit_df=v.where("id < 2"))
    from pyspark.ml.functions import vector_to_array
    rows = {r.id: r.z for r in out.select("id", vector_to_array("features_normalized").alias("z")).collect()}
    assert rows[0][0] == pytest.approx(-1 / 2 ** 0.5) and rows[0][1] == 0.0   # zero std -> 0
    assert rows[2][0] == pytest.approx(3 / 2 ** 0.5)                           # fitted on train rows only
