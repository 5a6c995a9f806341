"""Secret scans: fixed patterns, and password guess cost.

Values that stand in a credential context are scored by dynamic programming:
the cheapest way to cut the value into dictionary words, dates, repeats,
keyboard walks, sequences and brute-force spans, in decimal digits of guesses.
The dictionary is the corpus' own: its words, ranked by their counts.
Values that would take at least ``MIN_DIGITS`` digits of guesses are secrets,
beside what the fixed patterns find.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ocellus.llm.common import materialise

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs, so a shorter run is a failing match
CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_ -]?key|auth(?:orization)?|credentials?|bearer|"
    r"(?:private|access|client|encryption)[_ -]?(?:key|secret)|login|pin)"
    r"""["']?[ \t]*(?::=?|=>?|[ \t]is[ \t]|bearer[ \t])[ \t]*["'`]?([^\s"'`<>,;]{6,})""", re.I | re.A)
MIN_DIGITS = 8.0

#: Frequent password words, most frequent first.
WORDS = """password qwerty admin welcome login monkey dragon master letmein football shadow sunshine princess
superman iloveyou trustno secret freedom whatever michael jordan hunter ranger buster soccer hockey killer george
andrew charlie thomas robert daniel jessica jennifer michelle ashley summer winter spring autumn orange banana
cheese cookie pepper ginger flower silver golden purple yellow access server system manager default change temp
test guest user root pass word love baby angel star computer internet google example company office hello world
this that none null true false value string token key your here insert enter required optional""".split()
BASE_RANK = {w: i + 1 for i, w in enumerate(WORDS)}
#: Words of the corpus that are ranked: how often one occurs at least, its
#: letters, and how many are sent to the tasks at most.
MIN_COUNT, LETTERS, MOST_WORDS = 5, (3, 24), 100_000
ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("@4310$57", "aaeiosst")
_MONTH, _DAY = "(?:1[0-2]|0?[1-9])", r"(?:3[01]|[12]\d|0?[1-9])"
DATE = re.compile(rf"(?:19|20)\d\d[-/.]?{_MONTH}(?:[-/.]?{_DAY})?|{_DAY}[-/.]{_MONTH}[-/.](?:(?:19|20)\d\d|\d\d)|(?:19|20)\d\d")


def _beside() -> set[tuple[str, str]]:
    place = {c: (x, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
    return {(a, b) for a, (x, y) in place.items() for b, (u, v) in place.items()
            if a != b and abs(y - v) <= 1 and abs(x - u) <= 1}


BESIDE = _beside()


def _symbols(c: str) -> int:
    return 10 if c.isdigit() else 26 if c.isalpha() else 33


def pieces(value: str, ranks: dict[str, int]):
    """``(start, end, digits)`` of every piece, by end.  Words and dates are
    short; a run of repeats, neighbours or steps is a piece from its start to
    anywhere in it, so there are few pieces for each end."""
    n, low = len(value), value.lower()
    plain = low.translate(LEET)
    run = {"repeat": 0, "walk": 0, "step": 0}  # where the current run starts
    kinds = {
        "repeat": lambda a, b: a == b,
        "walk": lambda a, b: (a, b) in BESIDE,
        "step": lambda a, b: abs(ord(a) - ord(b)) == 1,
    }
    dates: dict[int, list] = {}
    for i, c in enumerate(value):
        yield i, i + 1, math.log10(_symbols(c)) + (0.3 if c.isupper() else 0.0)
        for start in range(max(0, i + 1 - LETTERS[1]), i - 1):
            rank = min(ranks.get(plain[start:i + 1], 1 << 60), ranks.get(low[start:i + 1], 1 << 60))
            if rank < 1 << 60:
                same = low if low[start:i + 1] in ranks else plain
                changed = sum(a != b for a, b in zip(value[start:i + 1], same[start:i + 1]))
                yield start, i + 1, math.log10(rank + 1) + 0.3 * changed
        m = DATE.match(value, i)
        if m:
            dates.setdefault(m.end(), []).append((i, m.end(), 2.0 if m.end() - i == 4 else 4.6))
        yield from dates.pop(i + 1, ())
        for kind, same in kinds.items():
            if i and not same(low[i - 1], low[i]):
                run[kind] = i
            start = run[kind]
            if i - start >= 2:
                size = i + 1 - start
                yield start, i + 1, math.log10(_symbols(value[start]) * size) + (0.5 * math.log10(size) if kind == "walk" else 0.0)
        # a repeated block: the text so far ends in the same block twice or more
        for width in (2, 3, 4, 5, 6, 8):
            if i + 1 >= 2 * width and value[i + 1 - width:i + 1] == value[i + 1 - 2 * width:i + 1 - width]:
                yield i + 1 - width, i + 1, 0.5


def guess_digits(value: str, ranks: dict[str, int] = BASE_RANK) -> float:
    """Decimal digits of the guesses that the cheapest segmentation needs."""
    best = [0.0] + [math.inf] * len(value)
    for start, end, digits in pieces(value, ranks):
        if best[start] + digits < best[end]:
            best[end] = best[start] + digits
    return best[-1]


def find_secrets(text: str, ranks: dict[str, int] = BASE_RANK) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` in code points, end exclusive, by start and then
    kind as listed.  Base spans are whole matches; a guess span is the value,
    where no base span overlaps it."""
    base = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    base += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    base += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    base.sort(key=lambda x: (x[0], x[2]))
    starts = [a for a, _, _ in base]
    reach = list(accumulate((b for _, b, _ in base), max))  # how far the spans up to here go
    added = []
    for m in CONTEXT.finditer(text):
        start, value = m.start(1), m[1].rstrip(".:!?)]}")
        end = start + len(value)
        before = bisect_left(starts, end)
        if len(value) >= 6 and not (before and reach[before - 1] > start) and guess_digits(value, ranks) >= MIN_DIGITS:
            added.append((start, end, 3))
    return [(a, b, KINDS[k]) for a, b, k in sorted(base + added, key=lambda x: (x[0], x[2]))]


def ranked_words(spark: SparkSession, docs: DataFrame, most: int = MOST_WORDS) -> dict[str, int]:
    """Rank by count of the words that occur in ``docs``, and of the fixed
    ones.  All words of all texts are counted; at most ``most`` go to the
    driver: those of at least the count that leaves so many (counts are
    compared in steps of about one in a hundred)."""
    low, high = LETTERS
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(rf"\p{{L}}{{{low},}}+"), F.lit(0))).alias("word"))
    counts = materialise(spark, words.where(F.length("word") <= high).groupBy("word").agg(
        F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT).withColumn(
        "step", F.floor(F.log2(F.col("n").cast("double")) * 64).cast("int")), "secret-words")
    # a few thousand steps, whatever the counts
    steps = sorted(((r["step"], r["words"]) for r in counts.groupBy("step").agg(F.count("*").alias("words")).collect()), reverse=True)
    least, so_far = None, 0
    for step, n in steps:
        so_far += n
        if so_far > most:
            break
        least = step
    found = counts.where(F.col("step") >= least).select("word", "n").collect() if least is not None else []
    ranks = {w: i + 1 for i, (w, _) in enumerate(sorted(map(tuple, found), key=lambda x: (-x[1], x[0])))}
    return {**ranks, **{w: min(r, ranks.get(w, r)) for w, r in BASE_RANK.items()}}


def _scan(ranks):
    def run(batches):
        for batch in batches:
            spans = []
            for text in batch.column("text"):
                spans.append([{"kind": k, "s": a, "e": b} for a, b, k in find_secrets(text.as_py() or "", ranks.value)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, pa.list_(pa.struct(
                    [("kind", pa.string()), ("s", pa.int32()), ("e", pa.int32())])))], names=["doc_id", "spans"])
    return run


def secret_spans(docs: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """``doc_id, spans``, one row per row of ``docs`` (null text: empty; null
    ids and repeated rows kept as they are); other columns are ignored.  An
    empty table gives no rows."""
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(ranked_words(spark, docs, most_words))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scan(ranks), "doc_id long, spans array<struct<kind:string,s:int,e:int>>")
