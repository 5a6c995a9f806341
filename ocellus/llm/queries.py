"""The registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ocellus.llm import (ann, exact_dedup, language, mixing, ngram_join, packing, pii, postings, quality, secrets,
                         spelling, token_orc, whitening)
from ocellus.session import read_table


def op1_ngram_jaccard_join(spark, sf_dir):
    """Components of documents that share nine tenths of their 3-word shingles."""
    return ngram_join.ngram_components(spark, read_table(spark, sf_dir, "documents"), size=3, num=9, den=10)


def op2_hnsw_neighbours(spark, sf_dir):
    """Ten nearest vectors of every hundredth one."""
    return ann.nearest(spark, read_table(spark, sf_dir, "embeddings"), F.expr("vec_id % 100 = 0"), k=10)


def op3_quality_classifier(spark, sf_dir):
    """Calibrated quality score of every document."""
    return quality.quality_scores(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_secret_scan(spark, sf_dir):
    """Secrets of every document, with a digest of the base spans."""
    found = secrets.secret_spans(read_table(spark, sf_dir, "documents"))
    text = "array_join(transform({}, x -> concat_ws(':', x.kind, x.s, x.e)), ',')"
    base = "filter(spans, x -> x.kind in ('assign', 'access', 'hex'))"
    return found.select(
        "doc_id", *[F.expr(f"cast(size(filter(spans, x -> x.kind = '{k}')) as long)").alias(f"n_{k}")
                    for k in ("assign", "access", "hex")],
        F.sha2(F.expr(text.format(base)), 256).alias("base_sha256"), F.expr(text.format("spans")).alias("spans"))


def op5_mix_to_targets(spark, sf_dir):
    """Raked weight, inclusion probability and draw of every document."""
    out = mixing.mixed(spark, read_table(spark, sf_dir, "documents"))
    return out.select("_row.doc_id", "_row.source", "_row.lang", F.substring("_topic", 2, 100).alias("topic"),
                      F.col("_tokens").alias("n_tokens"), F.col("_weight").alias("weight"),
                      F.col("_probability").alias("probability"), F.col("_sampled").alias("sampled"))


def op6_pattern_packing(spark, sf_dir):
    """Every document's pieces and their places in sequences of 2048 tokens."""
    out = packing.pack(spark, read_table(spark, sf_dir, "documents"), with_ids=False)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_weak_supervision_pii(spark, sf_dir):
    """Personal data of every document, with a digest of the base spans."""
    found = pii.personal_spans(spark, read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as long)").alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.joined("base"), 256).alias("base_sha256"),
        pii.joined("concat(base, added)").alias("spans"))


def op8_exact_dedup(spark, sf_dir):
    """Group, keeper and digest of every document's normalised text."""
    out = exact_dedup.exact_groups(spark, read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def op9_language_id(spark, sf_dir):
    """Language of every document, learned from three of four."""
    return language.held_out_identification(spark, read_table(spark, sf_dir, "documents"))


def op10_token_orc(spark, sf_dir):
    """Every document's token ids, written to ORC and read back."""
    return token_orc.token_output(spark, read_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark, sf_dir):
    """Form and root of every word that a near word outnumbers."""
    return spelling.spelling_variants(spark, read_table(spark, sf_dir, "documents"))


def op12_whitening(spark, sf_dir):
    """Whitened components of every embedding."""
    return whitening.whitened(spark, read_table(spark, sf_dir, "embeddings"))


def op13_benchmark_index(spark, sf_dir):
    """Words of every document inside ten-word passages of benchmark items."""
    found = postings.contaminated(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                                  width=10)
    n_hit = F.expr("aggregate(hits, 0L, (s, x) -> s + x.stop - x.start)")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


REGISTRY = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_hnsw_neighbours, op3_quality_classifier, op4_secret_scan, op5_mix_to_targets,
    op6_pattern_packing, op7_weak_supervision_pii, op8_exact_dedup, op9_language_id, op10_token_orc,
    op11_spelling_variants, op12_whitening, op13_benchmark_index)}

SPACE = r"[\x20\x09-\x0D]+"

ORACLES = {
    "op8_exact_dedup": rf"""
        WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g')) AS text_sha256
                   FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM n WINDOW g AS (PARTITION BY text_sha256)""",
    "op1_ngram_jaccard_join": rf"""
        WITH RECURSIVE w AS (
          SELECT doc_id, [x FOR x IN string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SPACE}')
            IF x <> ''] AS words FROM documents),
        s AS (
          SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3
            THEN [array_to_string(words, ' ')]
            ELSE [array_to_string(words[i:i + 2], ' ') FOR i IN range(1, len(words) - 1)] END) AS shingles FROM w),
        f AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
        l AS (
          SELECT a, b FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
                            FROM f a JOIN f b USING (shingle) GROUP BY 1, 2)
          JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
          WHERE 100 * c >= 90 * (len(x.shingles) + len(y.shingles) - c)),
        r(node, seen) AS (SELECT a, b FROM l UNION SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a)
        SELECT s.doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles,
               coalesce((SELECT min(seen) FROM r WHERE node = s.doc_id), s.doc_id) AS component_id
        FROM s""",
    # crc32 by its polynomial, a bit at a time, of the table of 256 bytes
    "op11_spelling_variants": r"""
        WITH RECURSIVE bits AS (
          SELECT b, list_reduce(list_prepend(b, range(8)::BIGINT[]),
                   lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS code
          FROM (SELECT unnest(range(256)) AS b)),
        crc AS MATERIALIZED (SELECT list(code ORDER BY b) AS t FROM bits),
        runs AS (
          SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
        kinds AS (SELECT doc_id, run, count(*) AS c FROM runs WHERE length(run) >= 6 GROUP BY ALL),
        coded AS (
          SELECT run, c, xor(4294967295, list_reduce(
                   list_prepend(4294967295::BIGINT, [('0x' || x)::BIGINT FOR x IN regexp_extract_all(
                     hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..')]),
                   lambda s, x: xor(s >> 8, t[(xor(s, x) & 255) + 1]))) AS h
          FROM kinds, crc),
        cut AS (
          SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                 ELSE run END AS word, c FROM coded),
        v AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM cut GROUP BY 1 HAVING length(word) >= 6 AND sum(c) >= 5),
        less AS MATERIALIZED (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
                              FROM (SELECT word, n, unnest(range(length(word)))::INT AS i FROM v)),
        pairs AS MATERIALIZED (
          SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b USING (i, rest) WHERE a.word <> b.word
          UNION SELECT l.word, v.word, v.n FROM less l JOIN v ON v.word = l.rest
          UNION SELECT v.word, l.word, l.n FROM less l JOIN v ON v.word = l.rest),
        best AS (SELECT word, count(*) AS n_near, min((-other_n, other)) AS f FROM pairs GROUP BY 1),
        forms AS MATERIALIZED (
          SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -f[1] >= 5 * v.n THEN f[2] END AS form,
                 CASE WHEN -f[1] >= 5 * v.n THEN (-f[1])::BIGINT END AS form_n
          FROM v LEFT JOIN best USING (word)),
        way(word, place) AS (SELECT word, word FROM forms
                          UNION ALL SELECT way.word, f.form FROM way JOIN forms f ON f.word = way.place WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, w.place AS root, f.n, f.n_near, f.form_n
        FROM forms f JOIN way w USING (word) JOIN forms g ON g.word = w.place WHERE g.form IS NULL""",
    "op13_benchmark_index": r"""
        WITH d AS (
          SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
        b AS (
          SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
        windows AS MATERIALIZED (
          SELECT DISTINCT item_id, least(10, len(words)) AS k,
                 array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS phrase
          FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
        spots AS (
          SELECT r, i, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
          FROM (SELECT r, words, k, unnest(range(1, len(words) - k + 2)) AS i
                FROM d, (SELECT DISTINCT k FROM windows) WHERE len(words) >= k)),
        found AS MATERIALIZED (SELECT r, i, k, item_id FROM spots JOIN windows USING (k, phrase)),
        hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM found) GROUP BY 1),
        items AS (SELECT r, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM found GROUP BY 1)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
               sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)""",
}
