"""Benchmark decontamination by a distributed positional inverted index.

The training texts are cut into shards of whole documents.  A shard stores, for
each term, the sorted positions at which it occurs; positions run through
the shard's documents.  The index is a written table with one row per shard.

A *window* of a test item is ``width`` consecutive words (an item of fewer words
is one window).  In a shard that lacks one of its terms a window can't occur.
Otherwise the positions of its rarest term there, less the term's offset in
the window, are the possible starts; the lists of its other terms, offset in
the same way, are intersected with them from the next rarest on.  What is left
are the exact phrase matches.  Proximity matches hold all terms of a window
within ``span`` words of one document in any order; their lists are met in the
same order, each by its first position not before the span.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ocellus.llm.common import materialise

U = np.uint64
#: Words of a shard, unless one document has more; documents of a shard.
SHARD_WORDS, SHARD_DOCS = 262_144, 20_000
#: Test terms that are sent to the indexing tasks (8 bytes each); with more
#: the index holds all terms.
MOST_TERMS = 4_000_000
#: Bytes of test windows that are sent to the searching tasks at once; with
#: more the index is searched once per block.
BLOCK_BYTES = 32_000_000
#: Possible starts that are held at a time.
CANDIDATES = 1_000_000
#: Bytes of text that are hashed at a time.
TEXT_BYTES = 1 << 20

#: Letters A-Z in lower case; 0 for what no word holds: ASCII but 0-9 and letters.
_FOLD = np.zeros(256, np.uint8)
_FOLD[128:] = np.arange(128, 256)
for _a, _b in ((0x30, 0x39), (0x61, 0x7A)):
    _FOLD[_a:_b + 1] = np.arange(_a, _b + 1)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_ODD, _SPACE = 0x9E3779B97F4A7C15, b" "
_CODE = np.random.default_rng(11).integers(1, 1 << 63, 256).astype(U)


class _Powers:
    """Powers of an odd number modulo 2^64 and of its inverse."""
    def __init__(self):
        self.up = self.down = np.empty(0, U)

    def __call__(self, n: int):
        if len(self.up) < n:
            n = max(n, TEXT_BYTES)
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.full(n, _ODD, U))
                self.down = np.cumprod(np.full(n, pow(_ODD, -1, 1 << 64), U))
        return self.up, self.down


_powers = _Powers()


def word_codes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of UTF-8 text and the byte at which each
    begins.  A word's hash is a polynomial of its bytes, taken from running
    sums, and mixed."""
    folded = _FOLD[np.frombuffer(raw, np.uint8)]
    inside = np.r_[False, folded != 0, False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[::2], edges[1::2]
    if not len(begin):
        return np.empty(0, U), begin
    up, down = _powers(len(folded))
    with np.errstate(over="ignore"):
        run = np.r_[U(0), np.cumsum(_CODE[folded] * up[:len(folded)])]
        code = (run[end] - run[begin]) * down[begin] + (end - begin).astype(U)
        code = (code ^ (code >> U(30))) * U(0xBF58476D1CE4E5B9)
        code = (code ^ (code >> U(27))) * U(0x94D049BB133111EB)
    return code ^ (code >> U(31)), begin


def _blocks(texts: list[bytes]):
    """``(index, bytes)`` in order: the texts, long ones cut between words."""
    for i, t in enumerate(texts):
        a = 0
        while len(t) - a > 2 * TEXT_BYTES:
            b = a + TEXT_BYTES
            while b < len(t) and _FOLD[t[b]]:
                b += 1
            yield i, t[a:b]
            a = b
        yield i, t[a:] if a else t


def text_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts``, in order, and the words per text."""
    codes, counts, held, size = [], np.zeros(len(texts), np.int64), [], 0

    def flush():
        if held:
            code, begin = word_codes(_SPACE.join(t for _, t in held))
            at = np.cumsum([0, *[len(t) + 1 for _, t in held]])
            np.add.at(counts, [i for i, _ in held], np.diff(np.searchsorted(begin, at)))
            codes.append(code)
            held.clear()

    for i, t in _blocks(texts):
        if size + len(t) > TEXT_BYTES:
            flush()
            size = 0
        held.append((i, t))
        size += len(t)
    flush()
    return np.concatenate(codes) if codes else np.empty(0, U), counts


def _bytes(column) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


_INDEX = "rows array<long>, doc_ids array<long>, sizes array<int>, terms array<long>, counts array<int>, positions binary"


def _shard(rows: list, ids: list, sizes: np.ndarray, codes: np.ndarray, known: np.ndarray | None):
    at = np.arange(len(codes), dtype=np.int32)
    if known is not None:
        place = np.minimum(np.searchsorted(known, codes), max(0, len(known) - 1))
        at = at[known[place] == codes] if len(known) else at[:0]
    terms, which, counts = np.unique(codes[at], return_inverse=True, return_counts=True)
    positions = at[np.argsort(which, kind="stable")]

    def one(values, kind):
        return pa.array([values], pa.list_(kind))

    return pa.RecordBatch.from_arrays(
        [one(rows, pa.int64()), one(ids, pa.int64()), one(sizes.astype(np.int32), pa.int32()),
         one(terms.view(np.int64), pa.int64()), one(counts.astype(np.int32), pa.int32()),
         pa.array([positions.tobytes()], pa.binary())],
        names=["rows", "doc_ids", "sizes", "terms", "counts", "positions"])


def _index(known):
    def run(batches):
        rows, ids, sizes, codes, words = [], [], [], [], 0
        keep = known.value if known is not None else None

        def shard():
            return _shard(rows, ids, np.array(sizes, np.int64), np.concatenate(codes) if codes else np.empty(0, U), keep)

        for batch in batches:
            got, counts = text_codes(_bytes(batch.column("text")))
            row, doc = batch.column("row").to_pylist(), batch.column("doc_id").to_pylist()
            ends, a = np.cumsum(counts), 0
            while a < len(row):  # as many documents as the shard takes
                base = ends[a - 1] if a else 0
                b = int(np.searchsorted(ends, base + SHARD_WORDS - words, "right"))
                b = min(max(b, a if rows else a + 1), a + SHARD_DOCS - len(rows), len(row))
                if b > a:
                    rows += row[a:b]
                    ids += doc[a:b]
                    sizes += counts[a:b].tolist()
                    codes.append(got[base:ends[b - 1]])
                    words += int(ends[b - 1] - base)
                    a = b
                if a < len(row):
                    yield shard()
                    rows, ids, sizes, codes, words = [], [], [], [], 0
        if rows:
            yield shard()
    return run


def build_index(spark: SparkSession, docs: DataFrame, terms: np.ndarray | None = None) -> DataFrame:
    """The written index of ``docs(doc_id, text)``: all terms, or only those of
    ``terms`` (sorted hashes)."""
    known = None if terms is None else spark.sparkContext.broadcast(terms)
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialise(spark, numbered.mapInArrow(_index(known), _INDEX), "postings")


def _windows(width: int):
    def run(batches):
        for batch in batches:
            codes, counts = text_codes(_bytes(batch.column("text")))
            ends = np.cumsum(counts)
            lists, items = [], []
            for item, a, b in zip(batch.column("item_id").to_pylist(), ends - counts, ends):
                words = codes[a:b].view(np.int64)
                if len(words):
                    lists += list(np.lib.stride_tricks.sliding_window_view(words, min(width, len(words))))
                    items += [item] * (max(0, len(words) - width) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(lists, pa.list_(pa.int64()))],
                                             names=["item_id", "words"])
    return run


def test_windows(spark: SparkSession, benchmark: DataFrame, width: int) -> DataFrame:
    """``words, items``: the distinct windows, each with the items that hold it
    (those of a very common window in several rows, about 1,000 in each)."""
    rows = materialise(spark, benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(
        _windows(width), "item_id string, words array<long>"), "windows")
    parts = max(1, -(-benchmark.count() // 1000))
    return materialise(spark, rows.groupBy("words", F.pmod(F.xxhash64("item_id"), F.lit(parts)).alias("part")).agg(
        F.collect_set("item_id").alias("items")).select("words", "items"), "windows")


class Block:
    """Windows as arrays: ``words`` (0 beyond a window's ``size``), ``items``."""
    def __init__(self, rows: pa.Table, width: int):
        lists = pc.list_value_length(rows["words"]).to_numpy().astype(np.int64)
        flat = rows["words"].combine_chunks().flatten().to_numpy().view(U) if len(rows) else np.empty(0, U)
        self.size, self.words = lists, np.zeros((len(lists), width), U)
        self.words[np.arange(width) < lists[:, None]] = flat
        self.items = rows["items"].to_pylist()


def _expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``which`` repeats each place ``counts`` times; ``inside`` counts them."""
    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)


class Shard:
    """A row of the index."""
    def __init__(self, row: dict):
        self.rows, self.doc_ids = row["rows"], row["doc_ids"]
        self.sizes = np.asarray(row["sizes"], np.int64)
        self.terms, self.counts = np.asarray(row["terms"], np.int64).view(U), np.asarray(row["counts"], np.int64)
        self.positions = np.frombuffer(row["positions"], np.int32).astype(np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        self.n = int(self.sizes.sum())
        self.ends = np.cumsum(self.sizes)
        #: position -> term, the postings read the other way (-1: no term)
        self.at = np.full(self.n + 1, -1, np.int64)
        self.at[self.positions] = np.repeat(np.arange(len(self.terms)), self.counts)

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, position, "right")

    def present(self, block: Block):
        """Windows whose terms all occur here: their numbers, terms and the
        offsets of the terms from the rarest on (-1: no more)."""
        if not len(self.terms) or not len(block.size):
            return np.empty(0, int), np.empty((0, 0), int), np.empty((0, 0), int)
        place = np.minimum(np.searchsorted(self.terms, block.words), len(self.terms) - 1)
        used = np.arange(block.words.shape[1]) < block.size[:, None]
        which = np.flatnonzero(((self.terms[place] == block.words) | ~used).all(1))
        place, used = place[which], used[which]
        order = np.argsort(np.where(used, self.counts[place], np.iinfo(np.int64).max), axis=1, kind="stable")
        return which, place, np.where(np.take_along_axis(used, order, 1), order, -1)

    def starts(self, place: np.ndarray, order: np.ndarray):
        """Blocks of ``(window's place, start)``: the rarest terms' positions
        less their offsets."""
        rare = place[np.arange(len(place)), order[:, 0]]
        total = np.cumsum(self.counts[rare])
        a = 0
        while a < len(rare):
            base = total[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(total, base + CANDIDATES, "right")))
            which, inside = _expand(self.counts[rare[a:b]])
            which += a
            yield which, self.positions[self.first[rare[which]] + inside] - order[which, 0]
            a = b

    def phrases(self, block: Block):
        """``(window, start)`` of every exact occurrence."""
        windows, place, order = self.present(block)
        found = [(np.empty(0, int), np.empty(0, int))]
        for which, start in self.starts(place, order) if len(windows) else ():
            size = block.size[windows[which]]
            ok = (start >= 0) & (start + size <= self.n)
            which, start = which[ok], start[ok]
            for rank in range(1, order.shape[1]):
                offset = order[which, rank]
                ok = (offset < 0) | (self.at[start + np.maximum(offset, 0)] == place[which, offset])
                which, start = which[ok], start[ok]
            one = self.document(start) == self.document(start + block.size[windows[which]] - 1)
            found.append((windows[which[one]], start[one]))
        return tuple(map(np.concatenate, zip(*found)))

    def near(self, block: Block, span: int):
        """``(window, position of its rarest term)`` where all terms of the
        window lie within ``span`` words of one document."""
        windows, place, order = self.present(block)
        found = [(np.empty(0, int), np.empty(0, int))]
        if not len(windows):
            return found[0]
        keys = (np.repeat(np.arange(len(self.terms)), self.counts) << 32) | self.positions
        keys = np.r_[keys, np.iinfo(np.int64).max]

        def met(term, low, high):
            """The term's list has a position from ``low`` to ``high``."""
            return keys[np.searchsorted(keys, (term << 32) | low)] <= ((term << 32) | high)

        for which, start in self.starts(place, order):
            p = start + order[which, 0]
            doc = self.document(p)
            begin, end = (self.ends - self.sizes)[doc], self.ends[doc] - 1
            low, high = np.maximum(begin, p - span + 1), np.minimum(end, p + span - 1)
            for rank in range(1, order.shape[1]):
                offset = order[which, rank]
                ok = (offset < 0) | met(place[which, offset], low, high)
                which, p, begin, end, low, high = (x[ok] for x in (which, p, begin, end, low, high))
            hit = np.zeros(len(which), bool)
            for back in range(span):
                a = p - back
                ok = ~hit & (a >= begin)
                for rank in range(order.shape[1]):
                    offset = order[which, rank]
                    ok &= (offset < 0) | met(place[which, offset], np.maximum(a, 0), np.minimum(end, a + span - 1))
                hit |= ok
            found.append((windows[which[hit]], p[hit]))
        return tuple(map(np.concatenate, zip(*found)))


_FOUND = ("row long, doc_id long, n_words long, hits array<struct<start:int,stop:int>>, "
          "items array<string>, near array<string>")


def _items(shard: Shard, block: Block, windows: np.ndarray, position: np.ndarray) -> dict[int, set]:
    """Document's place -> items of the windows found in it."""
    out: dict[int, set] = {}
    pairs = np.unique(np.c_[shard.document(position), windows], axis=0) if len(windows) else ()
    for doc, window in pairs:
        out.setdefault(int(doc), set()).update(i for i in block.items[window] if i is not None)
    return out


def _find(sent, span: int | None):
    def run(batches):
        block = sent.value
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard({c: batch.column(c)[i].as_py() if c in ("positions", "doc_ids") else
                               batch.column(c)[i].values.to_numpy() for c in batch.schema.names})
                windows, start = shard.phrases(block)
                edge = np.zeros(shard.n + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + block.size[windows], -1)
                hit = np.cumsum(edge)[:-1] > 0
                begin = shard.ends - shard.sizes
                runs = np.flatnonzero(np.diff(np.r_[False, hit, False]))
                # a run that goes on in the next document is cut at the border
                cuts = np.setdiff1d(begin, runs)
                cuts = cuts[(cuts < shard.n)]
                cuts = cuts[hit[cuts]] if len(cuts) else cuts
                runs = np.sort(np.r_[runs, cuts, cuts])
                hits: dict[int, list] = {}
                for doc, a, b in zip(shard.document(runs[::2]).tolist(), runs[::2].tolist(), runs[1::2].tolist()):
                    hits.setdefault(doc, []).append({"start": a - int(begin[doc]), "stop": b - int(begin[doc])})
                items = _items(shard, block, windows, start)
                near = _items(shard, block, *shard.near(block, span)) if span else {}
                docs = range(len(shard.rows))
                kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.rows, pa.int64()), pa.array(shard.doc_ids, pa.int64()), pa.array(shard.sizes),
                     pa.array([hits.get(d, []) for d in docs], kind),
                     *[pa.array([sorted(x.get(d, ())) for d in docs], pa.list_(pa.string())) for x in (items, near)]],
                    names=["row", "doc_id", "n_words", "hits", "items", "near"])
    return run


#: Runs of hit words of several blocks as disjoint runs in order.
_UNITED = """aggregate(array_sort(flatten(collect_list(hits))), cast(array() as array<struct<start:int,stop:int>>),
    (done, x) -> case when size(done) > 0 and element_at(done, -1).stop >= x.start
      then concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start,
                  'stop', greatest(element_at(done, -1).stop, x.stop))))
      else concat(done, array(x)) end)"""


def search_index(spark: SparkSession, index: DataFrame, windows: DataFrame, width: int,
                 span: int | None = None) -> DataFrame:
    """``row, doc_id, n_words, hits, items, near``, one row per document."""
    size = windows.agg(F.sum(8 * F.size("words") + 64 + F.expr(
        "aggregate(items, 0L, (s, x) -> s + 56 + coalesce(length(x), 0))"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    found = None
    for b in range(blocks):
        part = windows.where(F.pmod(F.xxhash64("words", "items"), F.lit(blocks)) == b) if blocks > 1 else windows
        sent = spark.sparkContext.broadcast(Block(part.toArrow(), width))
        one = index.mapInArrow(_find(sent, span), _FOUND)
        found = one if found is None else found.union(one)
    if blocks == 1:
        return found
    return materialise(spark, found, "matches").groupBy("row", "doc_id", "n_words").agg(
        F.expr(_UNITED).alias("hits"), *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
                                         for c in ("items", "near")])


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, width: int = 10,
                 span: int | None = None) -> DataFrame:
    """``doc_id, n_words, hits, items, near``, one row per row of ``docs``.

    ``hits``: the runs of words (from 0, stop exclusive) inside an occurrence of
    a window; ``items``: the item ids, as sorted strings, whose windows occur;
    ``near``: those of which all words of a window lie within ``span`` words (none
    without ``span``).  Words are runs of 0-9, letters in lower case (A-Z only)
    and all beyond ASCII, and are compared by 64-bit hashes.  Null and blank
    texts have no words and no windows.  Repeated rows are found each;
    repeated items count once; a null item_id names no item though its
    windows count as hits.  Empty tables give no rows, or rows without
    hits.  Texts are taken whole, whatever their length; other columns of
    both tables are ignored."""
    windows = test_windows(spark, benchmark, width)
    vocabulary = materialise(spark, windows.select(F.explode("words").alias("term")).distinct(), "windows-terms")
    terms = None
    if vocabulary.count() <= MOST_TERMS:
        terms = np.sort(vocabulary.toArrow()["term"].to_numpy().view(U))
    index = build_index(spark, docs, terms)
    return search_index(spark, index, windows, width, span).drop("row")
