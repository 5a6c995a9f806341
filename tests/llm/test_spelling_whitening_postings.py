"""Spelling variants, whitening and the postings index against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ocellus.llm import postings, spelling, whitening

DOC = "doc_id long, text string"
CLASH = ("row", "word", "words", "n", "sig", "parts", "size", "x", "v", "run", "code", "cut", "id", "items", "hits", "near",
         "terms", "_row", "_n", "_id", "component", "letters", "dims", "best", "root", "part")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in CLASH if c not in df.columns})


# --- spelling variants ---------------------------------------------------

def spelled(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        a, b = sorted((a, b), key=len)
        return any(a[:i] + b[i:i + 1] + a[i + (len(a) == len(b)):] == b for i in range(len(b)))

    by, form = {w: [x for x in n if near(w, x)] for w in n}, {}
    for w, others in by.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 5 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(by[w]), n.get(form.get(w))))
    return out


def texts_with_variants(rng):
    letters = "abcdeéÀßz"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 12))) for _ in range(30)]
    pool = []
    for w in base:
        pool += [w] * rng.choice([8, 40, 200])
        for _ in range(6):
            i = rng.randrange(len(w))
            v = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])
            pool += [v] * rng.choice([1, 5, 7, 9])
    # anagrams, repeated letters, chains of forms and ties
    pool += ["listen"] * 9 + ["silent"] * 9 + ["aaaaaa"] * 6 + ["aaaaaaa"] * 6 + ["aaaaab"] * 30 + ["Aaaaac"] * 30
    pool += ["chains"] * 5 + ["chaine"] * 45 + ["choine"] * 450 + ["short"] * 50 + ["öffnen×"] * 6
    rng.shuffle(pool)
    return pool


def test_spelling_variants_equal_brute_force(spark):
    rng = random.Random(3)
    pool = texts_with_variants(rng)
    rows = [(i, " ".join(pool[i * 20:i * 20 + 20])) for i in range(len(pool) // 20)]
    rows += [(9001, None), (9002, ""), (None, " ".join(pool[:50])), (9003, " ".join(pool)), rows[0], rows[0],
             (9004, "x" * 200_000 + " " + ",".join(pool[:300]))]
    got = spelling.spelling_variants(spark, clashing(spark.createDataFrame(rows, DOC)))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = [tuple(r) for r in got.collect()]
    want = spelled(rows)
    assert len(found) == len(set(found)) and set(found) == want
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] and r[2] != r[1] for r in want)


def test_spelling_variants_of_nothing(spark):
    assert spelling.spelling_variants(spark, spark.createDataFrame([], DOC)).count() == 0
    assert spelling.spelling_variants(spark, spark.createDataFrame([(1, None), (2, "a b")], DOC)).count() == 0


def test_signatures_are_exact(spark):
    """Every pair at distance one shares a signature, whatever its letters."""
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(6, 9))) for _ in range(400)})
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    got = {(r["word"], r["other"]) for r in spelling.near_words(spark, df).collect()}
    near = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            near[i, w[:i] + w[i + 1:]].add(w)
    want = {(a, b) for g in near.values() for a in g for b in g if a != b}
    for w in words:
        for v in {w[:i] + w[i + 1:] for i in range(len(w))} & set(words):
            want |= {(v, w), (w, v)}
    assert got == want


# --- whitening ------------------------------------------------------------

@pytest.mark.parametrize("name, x", [
    ("plain", lambda r: r.normal(size=(400, 24))),
    ("falling", lambda r: r.normal(size=(400, 24)) * np.logspace(0, -6, 24)),
    ("few directions", lambda r: r.normal(size=(300, 3)) @ r.normal(size=(3, 20))),
    ("few rows", lambda r: r.normal(size=(5, 20))),
    ("equal values", lambda r: np.vstack([np.eye(12), -np.eye(12)])),
    ("groups of equal values", lambda r: np.vstack([np.diag([1.0] * 6 + [2.0] * 6), -np.diag([1.0] * 6 + [2.0] * 6)])),
    ("nearly equal values", lambda r: np.linalg.qr(np.c_[np.ones(90), r.normal(size=(90, 20))])[0][:, 1:] * (1 + 1e-9 * np.arange(20))),
    ("constant", lambda r: np.ones((9, 4))),
    ("one dimension", lambda r: r.normal(size=(9, 1))),
])
def test_solver(name, x):
    x = x(np.random.default_rng(1))
    x = x - x.mean(0)
    values, vectors = whitening.directions(np.linalg.qr(x, mode="r"), 24)
    exact = np.linalg.svd(x, compute_uv=False) ** 2
    exact = np.r_[exact, np.zeros(max(0, len(values) - len(exact)))][:len(values)]
    top = max(exact[0], 1e-30)
    assert np.abs(values - exact).max() <= 1e-13 * top
    big = exact > 1e-20 * top  # small values are accurate too, relative to themselves
    assert np.allclose(values[big], exact[big], rtol=1e-6 if name == "falling" else 1e-10, atol=1e-25)
    assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() < 1e-10
    assert max(np.linalg.norm(x.T @ (x @ v) - e * v) for e, v in zip(values, vectors)) <= 1e-12 * top


def vectors_table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def whitened_by_numpy(vectors):
    x = np.floor(64 * np.array(vectors)).astype(np.int64) + 1000000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = (n * fit - s) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1][:16], v[:, ::-1][:, :16]
    return n, ((n * x - s) ** 2).sum(1), (n * x - s) / n @ v / np.sqrt(e), e / np.trace(c.T @ c / n)


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(4)
    wide, flat = rng.normal(size=(700, 20)) * np.linspace(3, 0.5, 20), rng.normal(size=(50, 3)) + 100
    rows = [(i, v.tolist()) for i, v in enumerate(wide)] + [(2000 + i, v.tolist()) for i, v in enumerate(flat)]
    rows += [rows[5], (9000, rows[7][1]), (None, rows[8][1])]  # copies count once in the fit list
    bad = [(1, None), (2, []), (3, [1.0, None] + [0.0] * 18), (4, [float("nan")] * 20), (5, [float("inf")] * 3), (6, [1e300] * 3)]
    df = clashing(vectors_table(spark, rows + bad).repartition(7))
    got = whitening.whitened(spark, df).toPandas()
    assert len(got) == 16 * 703 + 3 * 50
    for low, high, vectors, k in ((0, 700, wide, 16), (2000, 2050, flat, 3)):
        n, deviation, w, explained = whitened_by_numpy(vectors)
        part = got[(got.vec_id >= low) & (got.vec_id < high)].drop_duplicates(["vec_id", "component"]).sort_values(["vec_id", "component"])
        g = part.whitened.to_numpy().reshape(-1, k)
        assert np.abs(g * np.sign((g * w).sum(0)) - w).max() < 1e-9
        assert set(part.n) == {n} and (part.deviation.to_numpy().reshape(-1, k) == deviation[:, None]).all()
        assert np.allclose(part.explained.to_numpy().reshape(-1, k), explained, rtol=1e-10)
        assert part.identity_error.nunique() == 1 and part.identity_error.max() < 1e-10
    same = got[got.vec_id == 9000].sort_values("component").whitened.to_numpy()
    assert (same == got[got.vec_id == 7].sort_values("component").whitened.to_numpy()).all()
    assert got.vec_id.isna().sum() == 16


def test_whitening_without_variance(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [0.0] * 5), (4, [1.0, 0.0, 0.0, 0.0, 0.0])]
    got = whitening.whitened(spark, vectors_table(spark, rows)).toPandas().sort_values(["vec_id", "component"])
    one = got[got.vec_id < 3]
    assert one.whitened.isna().all() and set(one.explained) == {0.0} and set(one.deviation) == {0}
    two = got[got.vec_id > 2]
    assert two.whitened.notna().sum() == 2 and set(two.whitened.dropna().abs().round(12)) == {1.0}
    assert (two[two.component == 1].explained.round(12) == 1.0).all() and set(two.deviation) == {64 * 64}
    assert whitening.whitened(spark, vectors_table(spark, [])).count() == 0
    far = whitening.whitened(spark, vectors_table(spark, [(1, [1e15]), (2, [-1e15])])).toPandas()
    assert far.deviation.isna().all() and np.allclose(far.whitened.abs(), 1.0)


# --- postings ---------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def scan(docs, bench, width, span):
    wins = defaultdict(set)
    for item, text in bench:
        w = split(text)
        for i in range(max(1, len(w) - width + 1)) if w else ():
            wins[tuple(w[i:i + width])].add(item)
    out = []
    for doc_id, text in docs:
        w, hit, items, near = split(text), set(), set(), set()
        for win, ids in wins.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    items |= ids
            if span and any(set(win) <= set(w[i:i + span]) for i in range(len(w))):
                near |= ids
        out.append((doc_id, len(w), sorted(hit), sorted(str(i) for i in items if i is not None),
                    sorted(str(i) for i in near if i is not None)))
    return sorted(out, key=repr)


def items_and_docs():
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(60)] + ["ümlaut", "中文", "Ab9", "x"]

    def passage(n):
        return [rng.choice(vocab) for _ in range(n)]

    items = [(i, passage(rng.choice([1, 3, 9, 10, 11, 30]))) for i in range(25)]
    items += [(25, items[3][1]), (26, items[20][1][:5] + items[21][1]), (None, passage(12)), (3, passage(12))]
    docs = []
    for i in range(120):
        w = passage(rng.randrange(0, 80))
        for _ in range(rng.randrange(3)):
            p = list(rng.choice(items)[1])
            if rng.random() < 0.4:
                rng.shuffle(p)
            at = rng.randrange(len(w) + 1)
            w[at:at] = p[rng.randrange(len(p)):] if rng.random() < 0.2 else p
        docs.append((i, rng.choice([" ", ", ", "\n", " - "]).join(w)))
    half = items[5][1]
    docs += [(900, None), (901, ""), (902, " ".join(half[:5])), (903, " ".join(half[5:])), (None, " ".join(half)), docs[3],
             (904, " ".join(passage(40_000))), (905, "z" * 3_000_000 + " " + " ".join(half).upper()), (906, "x " * 500)]
    bench = [(i, " ".join(w).upper() if j % 2 else ";".join(w)) for j, (i, w) in enumerate(items)]
    return docs, bench + [(30, None), (31, " .. "), bench[2]]


def ran(spark, docs, bench, **how):
    d = clashing(spark.createDataFrame(docs, DOC).repartition(3))
    b = clashing(spark.createDataFrame(bench, "item_id long, text string"))
    out = []
    for r in postings.contaminated(spark, d, b, **how).collect():
        runs = [(x["start"], x["stop"]) for x in r["hits"]]
        assert all(a < b for a, b in runs) and all(x[1] < y[0] for x, y in zip(runs, runs[1:]))
        out.append((r["doc_id"], r["n_words"], [p for a, b in runs for p in range(a, b)], r["items"], r["near"]))
    return sorted(out, key=repr)


def test_postings_equal_brute_force(spark, monkeypatch):
    docs, bench = items_and_docs()
    want = scan(docs, bench, 10, 15)
    assert ran(spark, docs, bench, width=10, span=15) == want
    assert any(set(r[4]) - set(r[3]) for r in want) and all(set(r[3]) <= set(r[4]) for r in want)
    # small shards, few candidates at a time, all terms, several blocks of windows
    monkeypatch.setattr(postings, "MOST_TERMS", 0)
    monkeypatch.setattr(postings, "BLOCK_BYTES", 40_000)
    want = [r[:4] + ([],) for r in want]
    assert ran(spark, docs, bench, width=10) == want


def test_shards_and_candidates_of_any_size():
    docs, bench = items_and_docs()
    import pyarrow as pa

    texts = [(t or "").encode() for _, t in docs]
    codes, counts = postings.text_codes(texts)
    assert counts.tolist() == [len(split(t)) for _, t in docs]
    words = [w for _, t in docs for w in split(t)]
    assert len(set(codes.tolist())) == len(set(words)) == len(set(zip(words, codes.tolist())))
    for size in (1, 50, 4096):
        old = postings.SHARD_WORDS, postings.CANDIDATES
        postings.SHARD_WORDS, postings.CANDIDATES = size, size
        try:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(range(len(docs)), pa.int64()), pa.array([d for d, _ in docs], pa.int64()),
                 pa.array([t for _, t in docs])], names=["row", "doc_id", "text"])
            shards = [b.to_pylist()[0] for b in postings._index(None)([batch.slice(0, 50), batch.slice(50)])]
        finally:
            postings.SHARD_WORDS, postings.CANDIDATES = old
        assert [r for s in shards for r in s["rows"]] == list(range(len(docs)))
        assert all(sum(s["sizes"]) <= size or len(s["rows"]) == 1 or sum(s["sizes"][:-1]) <= size for s in shards)
        assert sum(sum(s["counts"]) for s in shards) == len(words)


def test_postings_of_empty_tables(spark):
    docs, bench = items_and_docs()
    assert ran(spark, [], bench, width=10) == []
    got = ran(spark, docs[:5], [], width=10)
    assert len(got) == 5 and all(r[2:] == ([], [], []) for r in got)
