"""N-gram Jaccard join by parity sketches.

Each document is its set of distinct word shingles, hashed to 64 bits.  A
*parity sketch* flips one bit per shingle, so the XOR of two sketches is the
sketch of their symmetric difference and its bit count never exceeds the
symmetric difference.  Sets with Jaccard similarity of at least ``num/den``
differ in at most ``(|A|+|B|)(den-num)/(den+num)`` shingles.

Per *size band* the shingles are dealt to ``k`` segments; of two similar sets
at least ``k - d`` segments agree, ``d`` being the band's largest allowed
difference.  Each segment's parity is compressed to one 64-bit key (the XOR
of per-shingle codes).  By the prefix principle both sets may leave out
``spare`` keys under any order common to all sets and still share one:
the segments with fewest shingles go at the source, the keys in most
documents after counting.  Sets that share a key are candidates.

Candidates are compared in passes: first one member of each bucket against the
others (linear in the bucket; a few rounds with other members, which join the
large groups), then, only across components that are still apart, the pairs of
a bucket whose sketches are close enough.  All candidates are verified on the
whole sets.  Copies share one node.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ocellus.llm.common import components, discard, materialise, row_key, rows_without

U = np.uint64
BAND_MASK = 4095
#: Rounds of one drawn member against its bucket; they only save work.
STARS = 2
_M1, _M2, _G = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (SplitMix)."""
    x = x + _G
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str | None, size: int, cache: dict) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``size``-word shingles; a shorter
    text is one shingle, a text without words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, U)
    w = np.fromiter(map(cache.__getitem__, words), U, len(words))
    width = min(size, len(w))
    acc = np.full(len(w) - width + 1, width if width < size else 0, U)
    with np.errstate(over="ignore"):
        for i in range(width):
            acc = mix(acc ^ w[i:len(w) - width + 1 + i])
    return np.unique(acc)


def size_bands(num: int, den: int, limit: int = 1 << 31) -> list[tuple[int, int, int]]:
    """``(low, high, d)`` per band.  Sets of similarity ``num/den`` lie in the
    same band or in neighbours; ``d`` bounds their difference when the larger
    one lies in the band."""
    lows = [1, 2]
    while lows[-1] < limit:
        lows.append(max(lows[-1] + 1, (lows[-1] - 1) * den // num + 1))
    return [(a, b - 1, 2 * (b - 1) * (den - num) // (den + num))
            for a, b in zip(lows, lows[1:])]


def spares(d: int) -> int:
    return max(1, (d + 1) // 8)


def segment_keys(h: np.ndarray, band: int, d: int) -> np.ndarray:
    """Keys of the set for one band (signed; the low bits are the band).
    ``h`` is sorted, so the segments, taken from the high bits, are too."""
    k = d + 1 + 2 * spares(d)
    seg = (((h >> U(32)) * U(k)) >> U(32)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
    parity = np.zeros(k, U)
    with np.errstate(over="ignore"):
        parity[seg[first]] = np.bitwise_xor.reduceat(mix(h), first)
        key = mix(parity + mix(np.arange(k, dtype=U) + (U(band) << U(40))))
    key = (key & ~U(BAND_MASK)) | U(band)
    filled = np.bincount(seg, minlength=k)
    return key[np.lexsort((key, filled))[spares(d):]].view(np.int64)


def parity_sketch(h: np.ndarray, high: int) -> np.ndarray:
    """Sketch of ``2 * high`` bits (rounded up to words) as signed longs."""
    bits = 64 * -(-2 * high // 64)
    with np.errstate(over="ignore"):
        pos = ((mix(h ^ _G) >> U(32)) * U(bits)) >> U(32)
    odd = (np.bincount(pos.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def _node(s: np.ndarray) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(s.tobytes()), "big", signed=True)


_SIGNED = "doc_id long, t long, n long, h long, band int, sketches array<array<long>>, keys array<long>"


def _sign(size: int, bands: list[tuple[int, int, int]]):
    lows = np.array([b[0] for b in bands])

    def run(batches):
        cache, seen = _WordHashes(), set()
        for batch in batches:
            out = {c: [] for c in ("n", "h", "band", "sketches", "keys")}
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                s = shingle_set(text.as_py(), size, cache)
                out["n"].append(len(s))
                if not len(s):
                    for c in ("h", "band", "sketches", "keys"):
                        out[c].append(None)
                    continue
                node = _node(s)
                b = int(np.searchsorted(lows, len(s), "right")) - 1
                out["h"].append(node)
                out["band"].append(b)
                out["sketches"].append([parity_sketch(s, bands[j][1]) for j in (b, b + 1)])
                # a copy met before in this task; a row without id links with nothing
                if node in seen or not doc_id.is_valid:
                    out["keys"].append(None)
                    continue
                seen.add(node)
                keys = [segment_keys(s, j, bands[j][2]) for j in (b, b + 1) if bands[j][2]]
                out["keys"].append(np.concatenate(keys) if keys else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("t"), pa.array(out["n"], pa.int64()), pa.array(out["h"], pa.int64()),
                 pa.array(out["band"], pa.int32()), pa.array(out["sketches"], pa.list_(pa.list_(pa.int64()))),
                 pa.array(out["keys"], pa.list_(pa.int64()))],
                names=["doc_id", "t", "n", "h", "band", "sketches", "keys"])
    return run


def _shared(batches):
    """Rows ``(key, h)`` sorted by both within the partition: keep one row of
    each, of keys with several nodes here, or that touch the partition's ends
    (their other rows may lie in the neighbouring partitions)."""
    held, forced = None, None
    for batch in batches:
        key = batch.column("key").to_numpy()
        h = batch.column("h").to_numpy()
        if held is not None:
            key, h = np.concatenate([held[0], key]), np.concatenate([held[1], h])
        if not len(key):
            continue
        new = np.r_[True, (key[1:] != key[:-1]) | (h[1:] != h[:-1])]
        key, h = key[new], h[new]
        # the last key stays open: its rows go on with the next batch
        cut = int(np.searchsorted(key, key[-1]))
        held = key[cut:], h[cut:]
        key, h = key[:cut], h[:cut]
        if len(key):
            same = key[1:] == key[:-1]
            forced = key[0] if forced is None else forced
            keep = np.r_[False, same] | np.r_[same, False] | (key == forced)
            yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(h[keep])], names=["key", "h"])
        if len(held[0]) > 50_000:  # a very frequent key: pass on all but its last row
            yield pa.RecordBatch.from_arrays([pa.array(held[0][:-1]), pa.array(held[1][:-1])], names=["key", "h"])
            held, forced = (held[0][-1:], held[1][-1:]), held[0][-1]
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], names=["key", "h"])


def _sets(size: int):
    """The whole sets as bytes."""
    def run(batches):
        cache = _WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), size, cache).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(sets, pa.binary())], names=["h", "s"])
    return run


def _verify(num: int, den: int):
    def run(batches):
        for batch in batches:
            sa, sb = batch.column("sa"), batch.column("sb")
            keep = []
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(s[i].as_buffer(), U) for s in (sa, sb))
                few, many = (a, b) if len(a) < len(b) else (b, a)
                place = np.minimum(np.searchsorted(many, few), len(many) - 1)
                both = int((many[place] == few).sum())
                keep.append(den * both >= num * (len(a) + len(b) - both) > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _close(num: int, den: int):
    """Sketches of the pair's common band differ by no more than the pair's
    sizes allow: a necessary condition for the similarity."""
    return F.expr(f"""
        abs(band_a - band_b) <= 1
        and aggregate(zip_with(
              element_at(sk_a, greatest(band_a, band_b) - band_a + 1),
              element_at(sk_b, greatest(band_a, band_b) - band_b + 1),
              (x, y) -> bit_count(x ^ y)), 0, (s, v) -> s + v)
            <= floor((n_a + n_b) * {den - num} / {den + num})""")


#: Buckets of more nodes than this are split by a second shared key.
LARGE_BUCKET = 256


#: A node's smallest keys, by which a pair knows where it met before.
LEAD = 16


def _under_two_keys(spark: SparkSession, met: DataFrame, large: DataFrame, shared: DataFrame, counts: DataFrame) -> DataFrame:
    """``met(key, h, root)`` with the ``large`` buckets split by a second key
    where that leaves far fewer pairs.

    Similar sets share at least one key more than may be left out, so besides
    the rarest one they share a second, more crowded one: the bucket's pairs
    meet again under both."""
    order = counts.select("key", "cnt")
    keyed = large.select("key", "h", "root", "size").join(order, "key").withColumn("band", F.col("key").bitwiseAND(BAND_MASK))
    second = shared.join(large.select("h").distinct(), "h").join(order, "key").select(
        "h", F.col("key").alias("key2"), F.col("cnt").alias("cnt2"), F.col("key").bitwiseAND(BAND_MASK).alias("band"))
    both = materialise(
        spark, keyed.join(second, ["h", "band"])
        .where("cnt2 > cnt or cnt2 = cnt and key2 < key").select("key", "key2", "h", "root", "size"), "ngram-both")
    pairs = both.groupBy("key", "key2").agg(F.count("*").cast("double").alias("m"), F.first("size").alias("size")).groupBy("key").agg(
        F.sum(F.col("m") * F.col("m")).alias("pairs"), F.first("size").cast("double").alias("size"))
    # a bucket whose members have no second key has no similar pair
    split = materialise(spark, large.select("key").distinct().join(pairs, "key", "left").where(
        F.coalesce(4 * F.col("pairs") < F.col("size") * F.col("size"), F.lit(True))).select("key"), "ngram-choice")
    return met.join(split, "key", "left_anti").union(
        both.join(split, "key").select(F.xxhash64("key", "key2").alias("key"), "h", "root"))


def _placed(spark: SparkSession, docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """``doc_id, t, n, root, cid``, one row per row of ``docs``: ``t`` is the
    text's hash in ``row_key``, ``n`` the set's size, ``root`` names the
    component (null without id or shingles), ``cid`` is its smallest doc_id."""
    bands = size_bands(num, den)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key()[1].alias("t"), "text")
    wide = materialise(spark, rows.mapInArrow(_sign(size, bands), _SIGNED), "ngram-signed")
    ids = materialise(spark, wide.select("doc_id", "t", "n", "h"), "ngram-ids")
    shared = materialise(
        spark,
        wide.where("doc_id is not null").select(F.explode("keys").alias("key"), "h")
        .repartitionByRange("key", "h").sortWithinPartitions("key", "h")
        .mapInArrow(_shared, "key long, h long").distinct(), "ngram-shared")

    # buckets of two and more, without each node's most crowded keys
    # (what joins back to a large group is written first, so that Spark can split the group)
    counts = materialise(spark, shared.groupBy("key").agg(
        F.count("*").alias("cnt"), F.min("h").alias("c")).where("cnt > 1"), "ngram-counts")
    extra = F.array(*[F.lit(spares(b[2])) for b in bands])
    rank = F.row_number().over(Window.partitionBy("h", "band").orderBy(F.desc("cnt"), "key"))
    ranked = shared.join(counts, "key").withColumn("band", F.col("key").bitwiseAND(BAND_MASK).cast("int")).withColumn("rank", rank)
    buckets = materialise(
        spark, ranked.where(F.col("rank") > F.element_at(extra, F.col("band") + 1)).select("key", "h", "c"), "ngram-buckets")

    known = ids.where("h is not null and doc_id is not null")
    reps = known.groupBy("h").agg(F.min("doc_id").alias("rep"))
    involved = buckets.select("h").union(buckets.select("c")).distinct().join(reps, "h")
    nodes = materialise(
        spark,
        wide.select("doc_id", "t", "h", "n", "band", "sketches").join(
            involved.withColumnRenamed("rep", "doc_id"), ["h", "doc_id"]).dropDuplicates(["h"]), "ngram-nodes")
    discard(spark, wide)
    sets = materialise(
        spark, rows.join(nodes.select("doc_id", "t", "h"), ["doc_id", "t"]).select("h", "text")
        .mapInArrow(_sets(size), "h long, s binary").dropDuplicates(["h"]), "ngram-sets")

    def side(s):
        return nodes.select(F.col("h").alias(s), F.col("n").alias(f"n_{s}"), F.col("band").alias(f"band_{s}"),
                            F.col("sketches").alias(f"sk_{s}"))

    def verified(pairs, name):
        return materialise(
            spark,
            pairs.select("a", "b").join(sets.toDF("b", "sb"), "b").join(sets.toDF("a", "sa"), "a")
            .mapInArrow(_verify(num, den), "a long, b long"), name)

    close = _close(num, den)

    def linked(pairs, name):
        return verified(pairs.join(side("a"), "a").join(side("b"), "b").where(close), name)

    def split_buckets(roots):
        """Rows of the buckets that still hold several components."""
        placed = materialise(spark, buckets.join(roots.withColumnRenamed("node", "h"), "h", "left").select(
            "key", "h", F.coalesce("root", "h").alias("root")), "ngram-placed")
        split = materialise(spark, placed.groupBy("key").agg(
            F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size"))
            .where("lo != hi").select("key", "size"), "ngram-split")
        return materialise(spark, placed.join(split, "key"), "ngram-apart")

    def grown(roots, more):
        """Components once the links ``more`` are added to those of ``roots``."""
        return materialise(spark, components(spark, roots.toDF("a", "b").union(more)), "ngram-roots")

    # each bucket's smallest member against the others, then one drawn anew per bucket and round
    links = linked(buckets.where("h != c").select(F.col("c").alias("a"), F.col("h").alias("b")).distinct(), "ngram-star")
    roots = materialise(spark, components(spark, links), "ngram-roots")
    apart = split_buckets(roots)
    for turn in range(STARS):
        drawn = materialise(spark, apart.groupBy("key").agg(F.min_by(
            F.struct("h", "root"), F.xxhash64("h", "key", F.lit(turn))).alias("c")), "ngram-drawn")
        pairs = apart.join(drawn, "key").where("root != c.root").select(
            F.least("h", "c.h").alias("a"), F.greatest("h", "c.h").alias("b")).distinct()
        more = linked(pairs, "ngram-star")
        if not more.take(1):
            break
        roots = grown(roots, more)
        apart = split_buckets(roots)

    # whatever is left: the pairs of a bucket across components, if their sketches allow
    met, large = apart.select("key", "h", "root"), apart.where(F.col("size") > LARGE_BUCKET)
    if large.limit(1).count():
        met = materialise(spark, _under_two_keys(spark, met, large, shared, counts), "ngram-met")
    lead = met.groupBy("h").agg(F.slice(F.sort_array(F.collect_list("key")), 1, LEAD).alias("lead"))
    rows = materialise(spark, met.join(lead, "h"), "ngram-met")
    left = rows.select("key", F.col("h").alias("a"), F.col("root").alias("ra"), F.col("lead").alias("la")).join(side("a"), "a")
    right = rows.select("key", F.col("h").alias("b"), F.col("root").alias("rb"), F.col("lead").alias("lb")).join(side("b"), "b")
    # a pair that meets under several keys counts where it meets first
    first = F.coalesce(F.array_min(F.array_intersect("la", "lb")) >= left["key"], F.lit(True))
    cross = left.join(right, (left["key"] == right["key"]) & (F.col("ra") < F.col("rb")) & close & first)
    more = verified(cross.select("a", "b").distinct(), "ngram-cross")
    merged = grown(roots, more) if more.take(1) else roots

    named = merged.join(reps, merged["node"] == reps["h"]).select("node", "root", "rep")
    lowest = materialise(spark, named.groupBy("root").agg(F.min("rep").alias("cid")), "ngram-lowest")
    cids = named.join(lowest, "root").select(F.col("node").alias("h"), "cid", "root")
    best = materialise(spark, reps.join(cids, "h", "left").select(
        "h", F.coalesce("root", "h").alias("root"), F.coalesce("cid", "rep").alias("cid")), "ngram-best")
    return ids.join(best, "h", "left").select(
        "doc_id", "t", "n", *[F.when(F.col("doc_id").isNotNull(), F.col(c)).alias(c) for c in ("root", "cid")])


def ngram_components(spark: SparkSession, docs: DataFrame, size: int = 5,
                     num: int = 4, den: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per row of ``docs``.

    Documents link when the Jaccard similarity of their ``size``-word shingle
    sets is at least ``num/den``; ``component_id`` is the smallest doc_id
    reachable.  Words are split at ASCII white space, A-Z lower-cased.  Null
    and blank texts have no shingles and stand alone.  A row with null doc_id
    links with nothing and has a null component.  Repeated rows are copies.
    Other columns of ``docs`` are ignored.  Sets are compared by 64-bit
    hashes of their shingles.
    """
    return _placed(spark, docs, size, num, den).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("cid", "doc_id").alias("component_id"))


def near_duplicates_removed(spark: SparkSession, docs: DataFrame, size: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """``docs``, all its columns unchanged, with one row of each component: one
    with its smallest doc_id (where that repeats with several texts, one of
    them; of repeated rows, one).  Rows with null doc_id and rows without
    words stay.  An empty table gives none."""
    rows = materialise(spark, _placed(spark, docs, size, num, den).where("root is not null").groupBy(
        "root", "doc_id", "t").agg(F.count("*").alias("times")), "ngram-members")
    kept = materialise(spark, rows.groupBy("root").agg(
        F.min(F.struct("doc_id", "t")).alias("keep"), F.sum("times").alias("size")).where("size > 1").drop("size"), "ngram-kept")
    placed = materialise(spark, rows.join(kept, "root").select(
        F.col("doc_id").cast("string").alias("ki"), F.col("t").alias("kt"), "times",
        (F.struct("doc_id", "t") == F.col("keep")).alias("stays")), "ngram-members")
    return rows_without(docs, placed.where("not stays").select("ki", "kt"),
                        placed.where("stays and times > 1").select("ki", "kt"))
