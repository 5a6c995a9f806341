"""Added spans of personal data on planted texts, and very many spans in one."""

import random
import string
import time

from ocellus.llm import pii

FIRST = ["James", "Mary", "Otto", "Priya", "Hans", "Carmen", "Ludmila", "Pierre"]
LAST = ["Smith", "Meyer", "Okafor", "Dupont", "Garcia", "Novak"]
FILL = "the of and report was found near old river while others went home again later that day".split()


def luhn_digits(rng, n, good=True):
    d = [rng.choice("45")] + [rng.choice(string.digits) for _ in range(n - 2)]
    total = sum(v - 9 * (v > 9) for v in (int(c) * (2 - i % 2) for i, c in enumerate(reversed(d))))
    last = (10 - total % 10) % 10
    return "".join(d) + str(last if good else (last + rng.randrange(1, 10)) % 10)


def iban(rng, good=True):
    body = "".join(rng.choice(string.digits) for _ in range(18))
    number = int(body + "1314" + "00")  # DE00
    check = 98 - number % 97
    if not good:
        check = (check + rng.randrange(1, 90)) % 97 + 2 if check != 50 else 51
    text = f"DE{check:02d}{body}"
    return " ".join(text[i:i + 4] for i in range(0, len(text), 4))


def digits(rng, n):
    return "".join(rng.choice("23456789") for _ in range(n))


def personal(rng):
    kind = rng.choice(["id", "tel", "iban", "name", "card"])
    value = {
        "id": lambda: f"{rng.randrange(100, 600)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}",
        "tel": lambda: f"({digits(rng, 3)}) {digits(rng, 3)}-{digits(rng, 4)}",
        "iban": lambda: iban(rng),
        "name": lambda: f"{rng.choice(['Mr', 'Dr', 'Frau'])} {rng.choice(FIRST)} {rng.choice(LAST)}",
        "card": lambda: luhn_digits(rng, 15),  # shorter than the base pattern's
    }[kind]()
    cue = {"id": "SSN", "tel": "phone", "iban": "IBAN", "name": "patient", "card": "card number"}[kind]
    return kind, (f"{cue}: " if rng.random() < 0.7 else ""), value


def decoy(rng):
    kind = rng.choice(["order", "isbn", "bad card", "bad iban", "bad id"])
    value = {
        "order": lambda: "1" + digits(rng, 11), "isbn": lambda: "978" + digits(rng, 10), "bad card": lambda: luhn_digits(rng, 16, False),
        "bad iban": lambda: iban(rng, False), "bad id": lambda: f"000-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}"}[kind]()
    cue = {"order": "order ", "isbn": "ISBN ", "bad card": "serial ", "bad iban": "item ", "bad id": "version "}[kind]
    return kind, cue if rng.random() < 0.7 else "", value


def fixture(n, seed=5):
    """Texts, and of each the places of personal values and of decoys."""
    rng = random.Random(seed)
    texts, truth, decoys = [], [], []
    for _ in range(n):
        out, want, bad = "", {}, {}
        for _ in range(rng.randrange(1, 5)):
            out += " ".join(rng.choice(FILL) for _ in range(rng.randrange(4, 12))) + " "
            if rng.random() < 0.2:
                mail = f"{rng.choice(FIRST).lower()}@{rng.choice(LAST).lower()}.org"
                want[len(out), len(out) + len(mail)] = "email"
                out += mail + " "
            kind, cue, value = (personal if rng.random() < 0.6 else decoy)(rng)
            out += cue
            (bad if kind in ("order", "isbn") or kind.startswith("bad") else want)[len(out), len(out) + len(value)] = kind
            out += value + rng.choice([". ", ", ", "; "])
        texts.append(out)
        truth.append(want)
        decoys.append(bad)
    return texts, truth, decoys


# --- tests


def test_added_spans_are_personal(spark):
    texts, truth, _ = fixture(400)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hits = found = wanted = 0
    for r in pii.personal_spans(spark, df).collect():
        base, added = ({(s, e) for _, s, e in map(tuple, r[c])} for c in ("base", "added"))
        want = set(truth[r["doc_id"]]) - base
        hits, found, wanted = hits + len(added & want), found + len(added), wanted + len(want)
    assert hits >= 0.9 * found and hits >= 0.9 * wanted and wanted > 400


def test_very_many_spans_in_one_text(spark):
    n = 80_000
    text = " ".join(f"a{i}@b.org (223) 555-{i % 10000:04d}" for i in range(n))
    start = time.time()
    r = pii.personal_spans(spark, spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(r["base"]) == len(r["added"]) == n and time.time() - start < 60
    places = [(s, e) for _, s, e in map(tuple, r["base"])]
    assert places[0] == (0, 8) and text[slice(*places[-1])] == f"a{n - 1}@b.org"
    assert [text[s:e] for _, s, e in map(tuple, r["added"])][-1] == f"(223) 555-{(n - 1) % 10000:04d}"
