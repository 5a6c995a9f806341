"""Language identification by character language models.

Per language an interpolated Kneser-Ney model of character trigrams, kept as
sorted arrays of n-gram codes with their weights.  A text goes to the language
of lowest cross-entropy per character.  A fold of the training rows, left out
of a first model, calibrates the score (the share of right answers at that
margin and length) and, per language, the cross-entropy beyond which an answer
is rejected.

Codes have 7 bits a character, so a model has at most 2^21 trigrams, 2^14
bigrams and 2^7 characters per language: a fixed bound, however large the
corpus.  Models go to the tasks in blocks of languages of bounded size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ocellus.llm.common import fold_of, materialise, row_key

BITS = 7
SIZE = 1 << (3 * BITS)
MARGIN_BINS, LENGTH_BINS = 40, 8
UNKNOWN = "und"


def _alphabet() -> np.ndarray:
    """Character codes: 0 for what is no letter, a-z apart, other letters
    spread over the rest of the 7 bits."""
    table = np.zeros(0x110000, np.int32)
    for i in range(0x110000):
        if 0xD800 <= i < 0xE000 or not chr(i).isalpha():
            continue
        table[i] = i - 96 if 97 <= i <= 122 else 27 + (i * 2654435761 >> 7) % 101
    return table


_TABLE: list[np.ndarray] = []


def trigrams(text: str) -> np.ndarray:
    """Trigram codes of the text: lower case, other characters as single
    blanks, one blank before and after.  Empty without letters."""
    if not _TABLE:
        _TABLE.append(_alphabet())
    raw = text.lower().encode("utf-32-le", "surrogatepass")
    codes = _TABLE[0][np.frombuffer(raw, np.uint32)]
    codes = codes[(codes != 0) | np.r_[True, codes[:-1] != 0]] if len(codes) else codes
    if not codes.any():
        return np.empty(0, np.int64)
    codes = np.r_[0, codes[int(codes[0] == 0):], 0].astype(np.int64)
    codes = codes[:-1] if codes[-2] == 0 else codes
    return (codes[:-2] << 2 * BITS) | (codes[1:-1] << BITS) | codes[2:]


#: Trigrams that a counting task holds before it adds equal ones up.
HELD = 2_000_000


def _count(batches):
    held: dict[tuple[str, int], list] = {}
    size = 0

    def added_up():
        nonlocal size
        size = 0
        for key, parts in held.items():
            code, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
            held[key] = [(code, np.bincount(at, np.concatenate([n for _, n in parts]), len(code)).astype(np.int64))]

    def flushed():
        added_up()
        for (lang, fold), ((code, n),) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(code), pa.string()), pa.array(np.full(len(code), fold, np.int32)),
                 pa.array(code.astype(np.int64)), pa.array(n)], names=["lang", "fold", "code", "n"])
        held.clear()

    for batch in batches:
        for text, lang, fold in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "fold"))):
            code, n = np.unique(trigrams(text), return_counts=True)
            held.setdefault((lang, fold), []).append((code, n))
            size += len(code)
            if size > HELD:
                added_up()
                if sum(len(c) for parts in held.values() for c, _ in parts) > HELD:  # very many languages
                    yield from flushed()
    yield from flushed()


@dataclass
class Model:
    """Sorted n-gram codes of one language with their discounted share and,
    per context, the weight that goes to the next shorter n-gram."""
    grams: list[np.ndarray]
    shares: list[np.ndarray]
    contexts: list[np.ndarray]
    rests: list[np.ndarray]

    @staticmethod
    def _find(keys, values, wanted, missing):
        if not len(keys):
            return np.full(len(wanted), missing)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], missing)

    def probability(self, codes: np.ndarray) -> np.ndarray:
        """P(third character | first two), interpolated down to uniform."""
        p = np.full(len(codes), 1.0 / (1 << BITS))
        for order in (1, 2, 3):
            own = codes & ((1 << order * BITS) - 1)
            share = self._find(self.grams[order - 1], self.shares[order - 1], own, 0.0)
            rest = self._find(self.contexts[order - 1], self.rests[order - 1], own >> BITS, 1.0)
            p = share + rest * p
        return p


def kneser_ney(code: np.ndarray, n: np.ndarray) -> Model:
    """Model from trigram counts.  Shorter n-grams count the different
    characters before them; the discount of an order is n1 / (n1 + 2 n2)."""
    tables = [(code, n.astype(float))]
    for order in (2, 1):
        kept = tables[0][0] & ((1 << order * BITS) - 1)
        kinds, times = np.unique(kept, return_counts=True)
        tables.insert(0, (kinds, times.astype(float)))
    model = Model([], [], [], [])
    for grams, counts in tables:
        ones, twos = (counts == 1).sum(), (counts == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        context, at = np.unique(grams >> BITS, return_inverse=True)
        total = np.bincount(at, counts, len(context))
        kinds = np.bincount(at, minlength=len(context))
        model.grams.append(grams)
        model.shares.append(np.maximum(counts - discount, 0) / total[at])
        model.contexts.append(context)
        model.rests.append(np.minimum(1.0, discount * kinds / total))
    return model


#: Trigrams of the models that are sent to tasks at once (about 50 bytes each);
#: more languages are scored in several passes.
MOST_GRAMS = 2_000_000


def _blocks(counts: DataFrame) -> list[list[str]]:
    """Languages whose models go together (one language, up to 2^21 trigrams,
    at least)."""
    sizes = counts.groupBy("lang").agg(F.countDistinct("code").alias("n")).orderBy("lang").collect()
    blocks, room = [], 0
    for lang, n in sizes:
        if not blocks or n > room:
            blocks.append([])
            room = MOST_GRAMS
        blocks[-1].append(lang)
        room -= n
    return blocks or [[]]


def _models(counts: DataFrame, langs: list[str]) -> dict[str, Model]:
    table = counts.where(F.col("lang").isin(langs)).groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas()
    return {lang: kneser_ney(*(part.sort_values("code")[c].to_numpy(np.int64) for c in ("code", "n")))
            for lang, part in sorted(table.groupby("lang"))}


def _entropies(models, texts):
    """Bits per character, texts by languages (no letters: nan), and the
    number of characters.  Each distinct trigram is looked up once."""
    codes = [trigrams(t or "") for t in texts]
    sizes = np.array([len(c) for c in codes], np.int64)
    out = np.full((len(texts), len(models)), np.nan)
    if not sizes.sum() or not models:
        return out, sizes
    flat = np.concatenate(codes)
    seen = np.zeros(SIZE, bool)
    seen[flat] = True
    kinds = np.flatnonzero(seen)
    dense = np.empty(SIZE)
    some = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[some]
    for j, model in enumerate(models.values()):
        dense[kinds] = -np.log2(model.probability(kinds))
        out[some, j] = np.add.reduceat(dense[flat], starts) / sizes[some]
    return out, sizes


def _two_best(models: dict[str, Model]):
    """The two languages of lowest cross-entropy (ties by name) and the number
    of characters; none without letters."""
    langs = list(models)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            best, chars = [], []
            for a in range(0, len(texts), 2000):
                bits, sizes = _entropies(models, texts[a:a + 2000])
                order = np.argsort(bits, axis=1, kind="stable")[:, :2] if langs else np.empty((len(sizes), 0), int)
                for row, own, n in zip(bits, order, sizes):
                    best.append([{"bits": float(row[j]), "lang": langs[j]} for j in own] if n else [])
                chars += sizes.tolist()
            kind = pa.list_(pa.struct([("bits", pa.float64()), ("lang", pa.string())]))
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(chars, pa.int64()), pa.array(best, kind)],
                                             names=[*kept, "chars", "best"])
    return run


def _ranked(spark: SparkSession, rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` (``doc_id, text`` and more) without text, with ``chars`` and
    ``best``, the two best of all languages of ``counts``."""
    blocks = _blocks(counts)
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join([*kept, "chars long", "best array<struct<bits:double,lang:string>>"])
    if len(blocks) == 1:
        return rows.mapInArrow(_two_best(_models(counts, blocks[0])), schema)
    # rows of one id and text have one answer: each block's is kept once, and the blocks' meet by that key
    keyed = rows.withColumns(dict(zip(("ki", "kt"), row_key())))
    narrow = "ki string, kt long, chars long, best array<struct<bits:double,lang:string>>"
    found = None
    for n, langs in enumerate(blocks):
        one = keyed.select("ki", "kt", "text").mapInArrow(_two_best(_models(counts, langs)), narrow).groupBy("ki", "kt").agg(
            F.first("chars").alias("chars"), F.first("best").alias("best"))
        one = materialise(spark, one, "language-block")
        found = one if found is None else found.union(one)
    met = materialise(spark, found.groupBy("ki", "kt").agg(F.first("chars").alias("chars"), F.slice(F.array_sort(
        F.flatten(F.collect_list("best"))), 1, 2).alias("best")), "language-met")
    return keyed.drop("text").join(met, ["ki", "kt"]).drop("ki", "kt")


def _bin(languages: int) -> Column:
    """The calibration bin: how far the second language is, and the length."""
    margin = F.when(F.size("best") > 1, F.col("best")[1]["bits"] - F.col("best")[0]["bits"]).otherwise(
        F.lit(9.0 if languages < 2 else 0.0))
    length = F.least(F.greatest(F.floor(F.log2(F.greatest("chars", F.lit(1)).cast("double"))) - 1, F.lit(0)), F.lit(LENGTH_BINS - 1))
    near = F.least(F.greatest(F.floor(margin * 20), F.lit(0)), F.lit(MARGIN_BINS - 1))
    return (length * MARGIN_BINS + near).cast("int")


def _calibrate(tally: dict[int, tuple[int, int]]) -> np.ndarray:
    """Share of right answers per bin, pooled within its length class so that
    it never falls as the margin grows."""
    out = np.zeros(MARGIN_BINS * LENGTH_BINS)
    for length in range(LENGTH_BINS):
        blocks: list[list[float]] = []
        for i in range(MARGIN_BINS):
            n, right = tally.get(length * MARGIN_BINS + i, (0, 0))
            blocks.append([right + 0.5 + 0.5 * i / MARGIN_BINS, n + 1, 1])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                a = blocks.pop()
                blocks[-1] = [x + y for x, y in zip(blocks[-1], a)]
        out[length * MARGIN_BINS:(length + 1) * MARGIN_BINS] = np.concatenate(
            [np.full(int(w), r / n) for r, n, w in blocks])
    return np.clip(out, 0.0, 1.0)


def identify(spark: SparkSession, docs: DataFrame, learn: Column, calibrate: Column,
             reject: float = 0.999) -> DataFrame:
    """``doc_id, lang_pred, bits, score, accepted``, one row per row of
    ``docs``.  ``learn`` marks the rows to learn from (with text and lang;
    others of them are passed over), ``calibrate`` the part of these that
    calibrates.  ``bits`` is the cross-entropy per character, ``score`` the
    calibrated chance to be right, ``accepted`` whether ``bits`` is within
    what ``reject`` of the language's calibration rows have.  Null texts and
    texts without letters are ``und`` with score 0; so is everything if
    nothing can be learned.  Ties go to the first language by name."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang",
                       F.coalesce(learn, F.lit(False)).alias("learn"),
                       F.coalesce(calibrate, F.lit(False)).cast("int").alias("fold"))
    taught = rows.where("learn and lang is not null and text is not null")
    counts = materialise(spark, taught.select("text", "lang", "fold").mapInArrow(
        _count, "lang string, fold int, code long, n long").groupBy("lang", "fold", "code")
        .agg(F.sum("n").alias("n")), "language-counts")
    first = counts.where("fold = 0")
    checked = materialise(
        spark, _ranked(spark, taught.where("fold = 1").select("doc_id", "text", "lang"), first).where("size(best) > 0").select(
            "lang", F.col("best")[0]["lang"].alias("lang_pred"), F.col("best")[0]["bits"].alias("bits"),
            _bin(sum(map(len, _blocks(first)))).alias("bin")), "language-checked")
    tally = {r["bin"]: (r["n"], r["right"]) for r in checked.groupBy("bin").agg(
        F.count("*").alias("n"), F.sum((F.col("lang") == F.col("lang_pred")).cast("long")).alias("right")).collect()}
    limits = materialise(spark, checked.where("lang = lang_pred").groupBy(F.col("lang").alias("lang_pred")).agg(
        F.percentile_approx("bits", reject, 10000).alias("edge")), "language-limits")
    table = F.array(*[F.lit(float(x)) for x in _calibrate(tally)])
    found = _ranked(spark, rows.select("doc_id", "text"), counts)
    some = F.size("best") > 0
    answer = found.select(
        "doc_id", F.when(some, F.col("best")[0]["lang"]).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(some, F.col("best")[0]["bits"]).alias("bits"),
        F.when(some, F.element_at(table, _bin(sum(map(len, _blocks(counts)))) + 1)).otherwise(F.lit(0.0)).alias("score"))
    return answer.join(limits, "lang_pred", "left").select(
        "doc_id", "lang_pred", "bits", "score",
        F.coalesce(F.col("bits") <= F.coalesce("edge", F.lit(float("inf"))), F.lit(False)).alias("accepted"))


def held_out_identification(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``identify`` that learns from all rows but those with crc32(doc_id) mod
    4 = 2 and calibrates on those with 3; with ``held_out``."""
    fold = fold_of("doc_id", 4)
    found = identify(spark, docs, fold != 2, fold == 3)
    return found.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
                        "lang_pred", "score", "bits", "accepted")
