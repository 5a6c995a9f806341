"""Personal data by weak supervision, in DataFrame operations only.

Base spans come from four fixed patterns with their checks.  They, their
look-alikes that fail the check, and further candidate spans get votes (for,
against, abstain) from several labelers: shape patterns, check digits,
gazetteers, context words, length and neighbourhood.  Expectation-maximisation
over the vote patterns estimates how reliable each labeler is; its posteriors
train a logistic span classifier on features of the span itself, and
candidates it accepts join the base spans.

One scan of the texts leaves a narrow table of spans; counts by vote and
feature pattern (a fixed number of patterns) are all the driver sees.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ocellus.llm.common import materialise

#: The base patterns.  Runs are possessive and start only where a run starts
#: (or the last match ended), which matches the same spans in linear time.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Candidates beyond the base spans, by kind.
EXTRA = {
    "id": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "tel": r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
    "name": r"(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Sra)\.? \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?",
    "number": r"[0-9](?:[ -]?[0-9]){8,18}",
}
CANDIDATE = (r"(?:\G|(?<![0-9A-Za-z]))(?:" + "|".join(EXTRA.values()) + r")(?![0-9A-Za-z])")
#: Gazetteers: given names, and number prefixes of cards, banks and lines.
NAMES = ("James|John|Robert|Michael|William|David|Mary|Patricia|Linda|Barbara|Elizabeth|Jennifer|Maria|Susan|"
         "Hans|Peter|Karl|Anna|Ursula|Jean|Pierre|Marie|Claire|Jose|Juan|Carmen|Luis|Ana|Pablo|Thomas")
CUES = (r"(?i)(?:e-?mail|phone|telephone|tel|call|mobile|fax|contact|card|visa|ssn|social security|iban|account|"
        r"konto|compte|cuenta|name|patient|customer|address|born|passport)[^A-Za-z0-9]{0,3}(?:is|no|nr|number)?[^A-Za-z0-9]{0,3}$")
AGAINST = r"(?i)(?:version|page|isbn|issn|total|price|order|item|build|chapter|figure|serial|sku)[^A-Za-z0-9]{0,8}$"
CONTEXT, NEAR = 32, 200
LABELERS = ("shape", "check", "gazetteer", "context", "length", "near")
#: How much each is trusted before anything is counted.
TRUST = (1, 3, 1, 1, 1, 1)
FEATURES = ("is_id", "is_tel", "is_iban", "is_name", "is_number", "spaced", "dashed", "many_digits", "after_newline",
            "check_holds", "check_fails", "cue_before", "against_before", "near")
_NEAR = len(LABELERS) - 1  # the labeler and the feature that other spans decide come last

_SPAN = "struct<kind:string,s:int,e:int>"
_FOUND = "array<struct<s:int,e:int,before:string,v:string>>"


def _literal(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _with_spans(rows: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Each column ``m_<name>`` of matches as ``<name>``: ``(s, e, before, v)``
    in code points, end exclusive, with the text before (since the last match,
    ``CONTEXT`` at most).  The lengths of the text between matches are added
    up in blocks of about the root of their number, so that long lists are
    not copied for every match."""
    steps = rows.select("*", *[F.expr(
        f"""zip_with(slice(split(text, '{_literal(p)}', -1), 1, size(m_{k})), m_{k},
                (a, b) -> struct(length(a) as gap, length(b) as len, right(a, {CONTEXT}) as before, b as v))""").alias(f"s_{k}")
        for k, p in patterns.items()])
    blocks = steps.select("*", *[F.expr(
        f"""if(size(s_{k}) = 0, array(), transform(sequence(0, (size(s_{k}) - 1) div greatest(16, int(sqrt(size(s_{k}))))),
              i -> slice(s_{k}, i * greatest(16, int(sqrt(size(s_{k})))) + 1, greatest(16, int(sqrt(size(s_{k})))))))""").alias(f"b_{k}")
        for k in patterns])
    starts = blocks.select("*", *[F.expr(
        f"""aggregate(transform(b_{k}, b -> aggregate(b, 0, (n, x) -> n + x.gap + x.len)), array(0),
              (acc, n) -> concat(acc, array(element_at(acc, -1) + n)))""").alias(f"f_{k}") for k in patterns])
    return starts.select("doc_id", "row", "text", *[F.expr(
        f"""flatten(zip_with(b_{k}, slice(f_{k}, 1, size(b_{k})), (b, first) -> aggregate(b,
              cast(struct(first, array()) as struct<at:int, out:{_FOUND}>),
              (acc, x) -> struct(acc.at + x.gap + x.len as at, concat(acc.out, array(struct(
                  acc.at + x.gap as s, acc.at + x.gap + x.len as e, x.before as before, x.v as v))) as out), acc -> acc.out)))"""
        ).alias(k) for k in patterns])


def _digits(v: str = "x.v") -> str:
    return f"regexp_replace({v}, '[^0-9]', '')"


_VALID = {
    "email": "true",
    "ip": "forall(split(x.v, '[.]'), p -> length(regexp_replace(p, '^0+', '')) < 3"
          " or (length(regexp_replace(p, '^0+', '')) = 3 and regexp_replace(p, '^0+', '') <= '255'))",
    "card": f"length({_digits()}) between 16 and 19 and luhn_check({_digits()})",
    "phone": f"length({_digits()}) between 8 and 15",
}


def _matches(pattern: str, needs: str | None) -> Column:
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    return F.when(F.contains("text", F.lit(needs)), found).otherwise(F.array().cast("array<string>")) if needs else found


def _vote(yes: str, no: str = "false") -> str:
    return f"case when {yes} then 1 when {no} then 2 else 0 end"


#: A bank number's check: its letters as 10 to 35, the first four places last, modulo 97.
_IBAN = """(aggregate(split(concat(substring(regexp_replace(x.v, ' ', ''), 5), substring(x.v, 1, 4)), ''), 0,
    (r, c) -> if(c between '0' and '9', (r * 10 + ascii(c) - 48) % 97,
                 if(c between 'A' and 'Z', (r * 100 + ascii(c) - 55) % 97, r))) = 1)"""
_HOLDS = f"""case x.kind when 'iban' then {_IBAN}
    when 'id' then not x.v rlike '^(?:000|666|9..)-|-00-|-0000$'
    when 'card' then x.n between 16 and 19 and luhn_check(x.d)
    when 'number' then x.n between 13 and 19 and luhn_check(x.d)
    when 'phone' then x.n between 8 and 15 else null end"""
_FAILS = f"""case x.kind when 'iban' then not {_IBAN}
    when 'id' then x.v rlike '^(?:000|666|9..)-|-00-|-0000$'
    when 'card' then not (x.n between 16 and 19 and luhn_check(x.d))
    when 'number' then x.n between 13 and 19 and not luhn_check(x.d)
    when 'phone' then not x.n between 8 and 15 else null end"""


def _votes() -> str:
    """The vote pattern of ``x``, without the last labeler."""
    cue, against = _literal(CUES), _literal(AGAINST)
    votes = (
        _vote("x.kind in ('id', 'tel', 'iban', 'email', 'ip', 'phone')", "x.kind in ('number', 'card') and not x.v rlike '[ -]'"),
        _vote("coalesce(x.holds, false)", "coalesce(x.fails, false)"),
        _vote(f"x.v rlike '(?:{NAMES})' or (x.kind = 'iban' and x.v rlike '^(?:DE|FR|ES|GB|IT|NL|CH|AT)')"
              " or (x.kind in ('number', 'card') and x.d rlike '^(?:4|5[1-5]|34|37|6011)')",
              "x.kind = 'number' and not x.d rlike '^[1-9]'"),
        _vote(f"x.before rlike '{cue}'", f"x.before rlike '{against}'"),
        _vote("x.kind = 'name' or x.n between 9 and 11", "x.n > 19"),
    )
    return " + ".join(f"{3 ** i} * ({v})" for i, v in enumerate(votes))


def _bits() -> str:
    """The feature pattern of ``x``, without the last feature."""
    cue, against = _literal(CUES), _literal(AGAINST)
    flags = ("x.kind = 'id'", "x.kind in ('tel', 'phone')", "x.kind = 'iban'", "x.kind = 'name'", "x.kind in ('number', 'card')",
             "contains(x.v, ' ')", "contains(x.v, '-')", "x.n > 11", "x.before rlike '\\\\n$'", "coalesce(x.holds, false)",
             "coalesce(x.fails, false)", f"x.before rlike '{cue}'", f"x.before rlike '{against}'")
    return " + ".join(f"if({f}, {1 << i}, 0)" for i, f in enumerate(flags))


def _judged(kind: str, spans: str) -> str:
    """``spans`` with their votes and features, and without their text."""
    known = (f"transform({spans}, x -> struct(x.s as s, x.e as e, x.before as before, x.v as v, {kind} as kind, {_digits()} as d,"
             f" length({_digits()}) as n))")
    checked = (f"transform({known}, x -> struct(x.s as s, x.e as e, x.before as before, x.v as v, x.kind as kind, x.d as d, x.n as n,"
               f" {_HOLDS} as holds, {_FAILS} as fails))")
    return f"transform({checked}, x -> struct(x.kind as kind, x.s as s, x.e as e, {_votes()} as votes, {_bits()} as bits))"


def candidate_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, row, base, alike, candidates``: spans with their vote and
    feature patterns and without their text.  ``base`` are the base spans,
    ``alike`` their failing look-alikes, ``candidates`` the matches of the
    further patterns."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       F.coalesce("text", F.lit("")).alias("text"))
    needs = {"email": "@", "ip": ".", "card": None, "phone": "+", "extra": None}
    patterns = {**BASE, "extra": CANDIDATE}
    rows = rows.select("*", *[_matches(p, needs[k]).alias(f"m_{k}") for k, p in patterns.items()])
    rows = _with_spans(rows, patterns)
    rows = rows.select("doc_id", "row", "extra", *[F.expr(f"filter({k}, x -> {_VALID[k]})").alias(k) for k in BASE], *[F.expr(
        f"filter({k}, x -> length(x.v) >= 8 and not ({_VALID[k]}))").alias(f"not_{k}") for k in BASE if k != "email"])
    kind = "case " + " ".join(f"when x.v rlike '^(?:{_literal(p)})$' then '{k}'" for k, p in EXTRA.items()) + " else 'number' end"

    def all_of(prefix: str, kinds) -> Column:
        return F.expr("concat(" + ", ".join(_judged(f"'{k}'", prefix + k) for k in kinds) + ")")

    return rows.select("doc_id", "row", all_of("", BASE).alias("base"), all_of("not_", [k for k in BASE if k != "email"]).alias("alike"),
                       F.expr(_judged(kind, "extra")).alias("candidates"))


def free_candidates(narrow: DataFrame) -> DataFrame:
    """``row, kind, s, e, votes, bits``: candidates that no base span overlaps,
    voted on by the spans near them.  Base spans and candidates of a text meet
    in order of their places."""
    spans = narrow.where("size(candidates) > 0").select("row", F.explode(F.concat(
        F.expr("transform(base, x -> struct(true as own, x as x))"),
        F.expr("transform(candidates, x -> struct(false as own, x as x))"))).alias("z")).select("row", "z.own", "z.x.*")
    # spans of one place are met on both sides; both windows run on, and never start anew for a row
    text, so_far = Window.partitionBy("row"), (Window.unboundedPreceding, Window.currentRow)
    upto = F.max(F.when(F.col("own"), F.col("e"))).over(text.orderBy("s").rangeBetween(*so_far))
    after = F.min(F.when(F.col("own"), F.col("s"))).over(text.orderBy(F.desc("s")).rangeBetween(*so_far))
    met = spans.withColumns({"upto": upto, "after": after}).where("not own").where(
        "not (coalesce(upto > s, false) or coalesce(after < e, false))")
    near = f"coalesce(s - upto <= {NEAR}, false) or coalesce(after - e <= {NEAR}, false)"
    return met.select("row", "kind", "s", "e", F.expr(f"votes + if({near}, {3 ** _NEAR}, 0)").alias("votes"),
                      F.expr(f"bits + if({near}, {1 << len(FEATURES) - 1}, 0)").alias("bits"))


def em(counts: dict[int, float], rounds: int = 50, sure: dict[int, float] | None = None) -> dict[int, float]:
    """Posterior of "personal" per vote pattern.  Labelers vote independently
    given the class; one that abstains says nothing.  ``sure`` counts spans by
    pattern that are personal whatever the votes: they show how reliable
    the labelers are.  The prior stays between a quarter and three, as chance
    finds of a pattern may outnumber all else."""
    sure = sure or {}
    votes = {p: [p // 3 ** i % 3 for i in range(len(LABELERS))] for p in {**counts, **sure}}
    sign = (0.0, 1.0, -1.0)
    post = {p: min(0.95, max(0.05, 0.5 + sum(0.2 * sign[said] * t for said, t in zip(v, TRUST)))) for p, v in votes.items()}
    for _ in range(rounds):
        yes = {p: counts.get(p, 0) * post[p] for p in votes}
        no = {p: counts.get(p, 0) - yes[p] for p in votes}
        prior = min(0.75, max(0.25, (sum(yes.values()) + 1) / (sum(counts.values()) + 2)))
        yes = {p: n + sure.get(p, 0) for p, n in yes.items()}
        rates = []
        for i in range(len(LABELERS)):
            n = [[2 + sum(w[p] for p, v in votes.items() if v[i] == said) for said in (1, 2)] for w in (yes, no)]
            # a labeler is taken to be better than chance, one that computes a check digit by far
            n[0][0], n[1][1] = n[0][0] + 2 * TRUST[i] ** 4, n[1][1] + 2 * TRUST[i] ** 4
            rates.append([[x / sum(row) for x in row] for row in n])
        for p, v in votes.items():
            odds = math.log(prior / (1 - prior)) + sum(
                math.log(r[0][said - 1] / r[1][said - 1]) for r, said in zip(rates, v) if said)
            post[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return post


def _classifier(spark: SparkSession, narrow: DataFrame, free: DataFrame) -> str:
    """SQL that tells whether the candidate of the columns is accepted.  Base
    spans are known to be personal, and their look-alikes are voted on as
    well: both show the labelers what holds and what fails."""
    judged = narrow.select(F.explode("base").alias("x")).select("x.votes", "x.bits", F.lit(True).alias("sure")).union(
        narrow.select(F.explode("alike").alias("x")).select("x.votes", "x.bits", F.lit(False))).union(
        free.select("votes", "bits", F.lit(False)))
    # at most 3^6 * 2^14 patterns, whatever the input; few occur
    tally = judged.groupBy("votes", "bits", "sure").agg(F.count("*").alias("n")).collect()
    if not tally:
        return "false"
    by_votes: dict[bool, dict[int, float]] = {True: {}, False: {}}
    for r in tally:
        mine = by_votes[r["sure"]]
        mine[r["votes"]] = mine.get(r["votes"], 0) + r["n"]
    post = em(by_votes[False], sure=by_votes[True])
    weights: dict[tuple[int, float], float] = {}
    for r in tally:
        yes = 1.0 if r["sure"] else post[r["votes"]]
        for label, share in ((1.0, yes), (0.0, 1 - yes)):
            weights[r["bits"], label] = weights.get((r["bits"], label), 0.0) + r["n"] * share
    rows = [(*[float(bits >> i & 1) for i in range(len(FEATURES))], label, w) for (bits, label), w in sorted(weights.items())]
    table = spark.createDataFrame(rows, [*FEATURES, "label", "weight"]).coalesce(1)
    model = LogisticRegression(weightCol="weight", regParam=0.001, maxIter=50).fit(
        VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(table))
    linear = " + ".join(f"{float(c)!r}D * (shiftright(bits, {i}) & 1)" for i, c in enumerate(model.coefficients))
    return f"({linear} + {float(model.intercept)!r}D) > 0"


def personal_spans(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, base, added``, one row per row of ``docs``: arrays of
    ``(kind, s, e)``, each by kind as listed and start.  A null text counts as
    empty; null ids and repeated rows are kept as they are; a table without
    candidates adds nothing.  Other columns are ignored."""
    narrow = materialise(spark, candidate_spans(docs), "pii-spans")
    free = materialise(spark, free_candidates(narrow), "pii-free")
    accepted = _classifier(spark, narrow, free)
    order = "array_position(array('" + "','".join(EXTRA) + "'), kind)"
    added = free.where(accepted).groupBy("row").agg(F.expr(
        f"transform(array_sort(collect_list(struct({order} as o, s, e, kind))), x -> cast(struct(x.kind, x.s, x.e) as {_SPAN}))"
    ).alias("added"))
    base = F.expr(f"transform(base, x -> cast(struct(x.kind, x.s, x.e) as {_SPAN}))").alias("base")
    return narrow.select("doc_id", "row", base).join(added, "row", "left").select(
        "doc_id", "base", F.coalesce("added", F.array().cast(f"array<{_SPAN}>")).alias("added"))


def joined(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.s, x.e)), ',')")
