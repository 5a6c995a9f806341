"""The pipeline's stages against plain Python on planted rows: exact and near
copies, repeated rows and ids, null ids and texts, and columns named like those
that the operators use inside."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ocellus.llm import (ann, exact_dedup, language, mixing, ngram_join, packing, pii, postings, quality, secrets, spelling,
                         token_orc, whitening)
from ocellus.session import read_table

DOC = "doc_id long, text string, lang string, source string, n_chars long"
INSIDE = ("h", "key", "row", "sha", "band", "score", "stats", "ids", "task", "rank", "weight", "norm", "fold", "learn", "base", "t",
          "n", "ki", "kt", "key_id", "key_text", "id", "tokens", "label", "root", "keep", "own", "words", "topic", "draw", "text_",
          "part", "prefix", "chars", "rep", "cid", "size", "times", "stays", "kept", "piece", "start", "length", "offset", "z")


def with_inside_names(df):
    """Extra columns with every internal name, with and without ``_``."""
    names = [c for n in INSIDE for c in (n, f"_{n}") if c not in df.columns]
    return df.withColumns({c: F.concat(F.lit(f"{c}:"), F.coalesce(F.col("text").substr(1, 5), F.lit("-"))) for c in names})


def words(rng, n):
    return [rng.choice("aeioulnrst") * rng.randrange(1, 3) + str(rng.randrange(900)) for _ in range(n)]


def planted():
    rng = random.Random(12)
    rows, n = [], 0
    for _ in range(30):
        base = words(rng, rng.choice([30, 120, 400]))
        rows.append((n, " ".join(base)))
        for kind in range(rng.randrange(4)):
            n += 1
            w = list(base)
            if kind == 1:
                w[rng.randrange(len(w))] = "other"
            rows.append((n, ("\n" if kind == 2 else " ").join(w)))
        n += 1
    some = " ".join(words(rng, 150))
    rows += [rows[0], rows[0], (rows[3][0], " ".join(words(rng, 90))), (None, some), (None, some), (7000, some), (7001, some.upper()),
             (None, None), (7002, None), (7003, ""), (7004, "  "), (7005, "a"), (7006, "a"), (7007, " a "), (None, "a")]
    # an id that repeats with a near copy of another document and with a text of its own
    rows += [(8000, " ".join(base)), (8001, " ".join([*base[:-1], "x"])), (8001, " ".join(words(rng, 60)))]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", None][k % 2], "s", len(t or "")) for k, (i, t) in enumerate(planted())]
    return with_inside_names(spark.createDataFrame(rows, DOC))


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def unchanged(before, after):
    """All columns in their order, every row one of the rows before."""
    assert after.columns == before.columns and after.schema == before.schema
    there = Counter(map(tuple, before.collect()))
    left = Counter(map(tuple, after.collect()))
    assert not left - there


def test_exact_copies_leave(spark, docs):
    out = exact_dedup.exact_duplicates_removed(spark, docs)
    unchanged(docs, out)
    groups: dict = {}
    for i, t in pairs(docs):
        groups.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", t or ""), []).append(i)
    want = Counter((min([i for i in g if i is not None], default=None), t) for t, g in groups.items())
    got = Counter((i, re.sub(r"[\x20\x09-\x0d]+", " ", t or "")) for i, t in pairs(out))
    assert got == want


def shingles(text, size):
    w = (text or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})).split()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def near_groups(rows, size, num, den):
    """Groups of row numbers that links join; rows without id or words alone."""
    sets = [shingles(t, size) if i is not None else frozenset() for i, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and den * both >= num * len(sets[a] | sets[b]):
                root[top(a)] = top(b)
    groups: dict = {}
    for k in range(len(rows)):
        groups.setdefault(top(k), []).append(k)
    return list(groups.values())


@pytest.mark.parametrize("large", [256, 2])
def test_near_copies_leave_and_nothing_else(spark, docs, monkeypatch, large):
    monkeypatch.setattr(ngram_join, "LARGE_BUCKET", large)
    out = ngram_join.near_duplicates_removed(spark, docs, size=5, num=4, den=5)
    unchanged(docs, out)
    rows, left = pairs(docs), Counter(pairs(out))
    groups = near_groups(rows, 5, 4, 5)
    assert sum(left.values()) == len(groups)
    for g in groups:
        own = Counter(rows[k] for k in g) & left
        assert own, [rows[k] for k in g]
        if len(g) > 1:
            assert {i for i, _ in own} == {min(rows[k][0] for k in g)}
    assert (8001, rows[-1][1]) in left and rows[-2] not in left


@pytest.mark.parametrize("stars,large", [(0, 1 << 60), (0, 8), (2, 8)])
def test_large_buckets_lose_no_link(spark, monkeypatch, stars, large):
    """Documents made from a few common blocks share many keys but few link."""
    rng = random.Random(4)
    blocks = [words(rng, 25) for _ in range(8)]
    rows = []
    for i in range(160):
        w = sum(rng.sample(blocks, 4), []) + words(rng, 12)
        rows.append((i, " ".join(w)))
        if i % 5 == 0:
            rows.append((1000 + i, " ".join([*w[:-2], "other", w[-1]])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "STARS", stars)
    monkeypatch.setattr(ngram_join, "LARGE_BUCKET", large)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_components(spark, df, size=3, num=4, den=5).collect()}
    for g in near_groups(rows, 3, 4, 5):
        assert {got[rows[k][0]] for k in g} == {min(rows[k][0] for k in g)}


def test_quality_keeps_by_score(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    odd = spark.createDataFrame([(None, "some text", "en", "s", 9), (None, None, None, None, None), (10 ** 9, "", "en", "s", 0)],
                                docs.schema)
    more = with_inside_names(docs.union(odd).union(docs.limit(3)))
    clash = labels.withColumns({"text": F.lit("x"), "label": F.lit("x"), "stats": F.lit(1)})
    out = quality.good_documents(spark, more, clash)
    unchanged(more, out)
    scores = quality.quality_scores(spark, more, labels)
    want = Counter(r["doc_id"] for r in scores.where("predicted = 1").collect())
    assert Counter(i for i, _ in pairs(out)) == want
    marked = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    kept = {i for i, _ in pairs(out)}
    there = {i for i, _ in pairs(docs)}
    assert len(marked & kept & there) >= 0.95 * len(marked & there)


def test_mixing_keeps_rows_whole(spark, docs):
    out = mixing.mixed_sample(spark, docs)
    unchanged(docs, out)
    drawn = mixing.mixed(spark, docs).select("_row.doc_id", "_row.text", "_probability", "_sampled").collect()
    assert len(drawn) == docs.count()
    assert Counter(pairs(out)) == Counter((r["doc_id"], r["text"]) for r in drawn if r["_sampled"])


def test_budget_is_near_the_largest(spark):
    """A value that has a third of the tokens its goal asks for bounds the
    budget to a third; the one found is within a hundredth of it."""
    rows = [(i, " ".join(["w"] * 100), "en", "rare" if i % 10 == 0 else "often", 200) for i in range(400)]
    df = spark.createDataFrame(rows, DOC)
    targets = {"source": spark.createDataFrame([("=rare", 0.3), ("=often", 0.7)], "value string, share double")}
    cells = mixing.mixing_cells(spark, df, targets=targets, budget=0.8, targets_first=True).collect()
    found = {c["budget"] for c in cells}.pop()
    assert 0.99 * 0.97 / 3 <= found <= 1 / 3
    tokens = {c["_source"]: c["t"] * c["probability"] for c in cells}
    assert abs(tokens["=rare"] / sum(tokens.values()) - 0.3) < 0.002


def test_a_rare_value_does_not_hold_back_the_others(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.choice([20, 200, 900])), rng.choice(["en", "en", "de", "fr"]),
             "hot" if i % 3 == 0 else f"s{rng.randrange(6)}", 9) for i in range(900)]
    rows += [(1000, "a | b | c", "en", "s1", 9)]  # the only table
    df = spark.createDataFrame(rows, DOC)
    cells = mixing.mixing_cells(spark, df, targets_first=True, within_reach=True).collect()
    total = sum(c["t"] for c in cells)
    sample = sum(c["t"] * c["probability"] for c in cells)
    assert 0.7 * total < sample <= 0.8 * total
    for dim, power in mixing.TEMPER.items():
        have, got = Counter(), Counter()
        for c in cells:
            have[c[f"_{dim}"]] += c["t"]
            got[c[f"_{dim}"]] += c["t"] * c["probability"]
        low, high = 0.0, 1e9
        for _ in range(100):  # the level at which the capped shares add up to 1
            mid = (low + high) / 2
            shares = {v: min(n / (0.8 * total), mid * n ** power) for v, n in have.items()}
            low, high = (mid, high) if sum(shares.values()) < 1 else (low, mid)
        assert all(abs(got[v] / sample - s) < 0.005 * s for v, s in shares.items())
    plain = mixing.mixing_cells(spark, df, targets_first=True).collect()
    assert sum(c["t"] * c["probability"] for c in plain) < 0.5 * total


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_empty_tables_and_any_columns(spark, docs, name, stage):
    sf = "/root/testdata/sf0.001"
    assert stage(spark, docs.limit(0), sf).count() == 0
    out = stage(spark, docs, sf)
    if name != "packing":
        unchanged(docs, out)
    else:
        assert {r["doc_id"] for r in out.select("doc_id").collect()} <= {i for i, _ in pairs(docs)}


OPERATORS = {
    "ngram_join": lambda s, d: ngram_join.ngram_components(s, d),
    "quality": lambda s, d: quality.quality_scores(s, d, s.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")),
    "secrets": lambda s, d: secrets.secret_spans(d),
    "mixing": lambda s, d: mixing.mixed(s, d),
    "packing": lambda s, d: packing.pack(s, d),
    "pii": lambda s, d: pii.personal_spans(s, d),
    "exact_dedup": lambda s, d: exact_dedup.exact_groups(s, d),
    "language": lambda s, d: language.held_out_identification(s, d),
    "token_orc": lambda s, d: token_orc.token_output(s, d),
    "spelling": lambda s, d: spelling.spelling_variants(s, d),
    "postings": lambda s, d: postings.contaminated(s, d, s.createDataFrame([(1, "a b")], "item_id long, text string")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_take_any_columns(spark, docs, name):
    few = docs.where("doc_id is null or doc_id > 6990 or doc_id < 12")
    plain = few.select("doc_id", "text", "lang", "source", "n_chars")

    def columns(df):
        rows = df.drop("_row").collect()
        return sorted(map(repr, rows)) if name not in ("packing", "token_orc") else len(rows)

    assert columns(OPERATORS[name](spark, few)) == columns(OPERATORS[name](spark, plain))


@pytest.mark.parametrize("search", [
    lambda s, d: ann.nearest(s, d, F.expr("vec_id % 2 = 0"), k=2), lambda s, d: whitening.whitened(s, d)])
def test_vector_operators_take_any_columns(spark, search):
    rows = [(i, [float(i % 5), 1.0, float(i * i % 7)]) for i in range(20)] + [(None, [1.0, 1.0, 2.0]), (30, None)]
    plain = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    more = plain.withColumns({c: F.lit("c") for n in (*INSIDE, "vec", "d", "members", "shard", "x", "v", "query_id", "block", "first")
                              for c in (n, f"_{n}")})

    def rows_of(df):  # sums of doubles may differ in the last place
        return sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in search(spark, df).collect())

    assert rows_of(more) == rows_of(plain)


def test_a_run_leaves_only_its_result(spark):
    import os

    from ocellus.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).removeprefix("file:").rstrip("/") + "/ocellus"
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0
    assert [n.rsplit("-", 1)[0] for n in set(os.listdir(base)) - before] == ["stage-packing"]
