"""Guess cost against every segmentation, and what the scan makes of it."""

import random
import time
from collections import Counter
from functools import cache

from ocellus.llm import secrets


def cheapest(value, ranks):
    """The cheapest of all segmentations, tried one by one."""
    cost = {}
    for a, b, digits in secrets.pieces(value, ranks):
        cost[a, b] = min(digits, cost.get((a, b), 99))

    @cache
    def every(at):
        if at == len(value):
            return [0.0]
        return [digits + rest for (a, b), digits in cost.items() if a == at for rest in every(b)]

    return min(every(0))


def test_cost_is_that_of_the_cheapest_segmentation():
    rng = random.Random(1)
    ranks = {**secrets.BASE_RANK, "cat": 900, "category": 40, "gory": 7000}
    values = ["".join(rng.choice("ab1p@sSwcq") for _ in range(rng.randrange(1, 11))) for _ in range(150)]
    values += ["password1", "P@ssw0rd!", "category", "catgory", "aaaabbbb", "qwertz12", "abcabcab", "19991231", "31.12.1999", "pass1999"]
    for v in values:
        assert abs(secrets.guess_digits(v, ranks) - cheapest(v, ranks)) < 1e-9, v


def test_pieces_of_each_kind():
    ranks = {"river": 10}

    def least(value):
        return {(a, b): d for a, b, d in sorted(secrets.pieces(value, ranks), key=lambda x: -x[2])}

    assert least("xriver9")[1, 6] < 1.1 < least("xR1ver9")[1, 6] < 2  # a capital and a digit for a letter
    assert least("1998-07-21")[0, 10] == 4.6 and least("1998")[0, 4] == 2.0
    assert (0, 5) in least("zzzzz") and (0, 6) in least("qwerty") and (0, 4) in least("defg")
    assert least("x7k-x7k-")[4, 8] == 0.5


def test_words_of_the_corpus_are_no_secrets(spark):
    rng = random.Random(2)
    corpus = [f"w{rng.randrange(10)} notwendig information bedienungsanleitung documentation necessary" for _ in range(20)]
    found = ["password is necessary", "login: documentation", "pin: Bedienungsanleitung", "secret is Information",
             "pin: x8#kQ2!vT9", "pwd = zuGqWx7R#p", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(corpus + found)], "doc_id long, text string")
    got = {r["doc_id"] - len(corpus): [x["kind"] for x in r["spans"]] for r in secrets.secret_spans(df).collect()}
    assert [i for i in range(8) if got[i] == ["guess"]] == [4, 5] and not any(got[i] for i in (0, 1, 2, 3, 6, 7))


def test_words_are_ranked_by_count(spark):
    texts = ["one two three"] * 9 + ["Two two three"] * 6 + ["rare rare", "ab " * 50, "x" * 30, None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    ranks = secrets.ranked_words(spark, df)
    want = [w for w, _ in sorted(Counter(" ".join(t or "" for t in texts).lower().split()).items(), key=lambda x: (-x[1], x[0]))
            if w in ("one", "two", "three")]
    assert sorted(want, key=ranks.get) == want and ranks["two"] == 1
    assert "rare" not in ranks and "ab" not in ranks and "x" * 30 not in ranks and ranks["password"] == 1
    few = secrets.ranked_words(spark, df, most=2)
    assert "two" in few and "three" in few and "one" not in few
    assert secrets.ranked_words(spark, df.limit(0)) == secrets.BASE_RANK


def test_very_many_matches_in_one_text():
    n = 40_000
    text = " ".join(f"token=abc{i:06d}x pwd: Zq{i}#vX!w8" for i in range(n))
    start = time.time()
    kinds = Counter(k for _, _, k in secrets.find_secrets(text))
    assert kinds["assign"] == n and kinds["guess"] > 0.9 * n and time.time() - start < 60
    assert secrets.guess_digits("x" * 20_000) < 8
