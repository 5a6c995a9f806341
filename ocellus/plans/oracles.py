"""DuckDB SQL twins of the registered queries (same keys, same column names).

The tables ``region nation customer supplier part orders lineitem events
documents embeddings pages benchmark labels conversations`` are views.
DuckDB regex literals take single backslashes; Spark SQL text would need
them doubled.
"""

from __future__ import annotations

# md5-bucket of a key, the twin of ocellus.operators.sampling.hash_bucket
def _bucket(expr: str, modulo: str = "100") -> str:
    return f"((('0x' || substr(md5({expr}), 1, 8))::BIGINT) % {modulo})"


_SPLIT = f"CASE WHEN {_bucket('CAST(vec_id AS VARCHAR)')} < 60 THEN 'train' ELSE 'test' END"

_LOGITS = """
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS z
  FROM embeddings"""

_SOFTMAX = f"""
  SELECT vec_id, label, z,
         list_transform(z, lambda x: exp(x - list_max(z))) AS e
  FROM ({_LOGITS})"""

_PROBS = f"""
  SELECT vec_id, label, list_transform(e, lambda x: x / list_sum(e)) AS p,
         list_transform(z, lambda x: 1.0 / (1.0 + exp(-x))) AS s
  FROM ({_SOFTMAX})"""

_CONV_FLAGS = """
  SELECT conv_id, turn,
         'conversations/' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS file_path,
         CAST(coalesce(list_bool_or(list_transform(regexp_split_to_array(text, '\\s+'),
                                                   lambda w: regexp_matches(lower(w), 'ou'))), false) AS INTEGER)
           AS search_term
  FROM conversations"""

ORACLES: dict[str, str] = {}

ORACLES["accuracy"] = f"""
WITH e AS (SELECT vec_id, label, embedding, {_SPLIT} AS split FROM embeddings),
tr AS (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS pos
       FROM e WHERE split = 'train'),
cent AS (SELECT label AS cls, pos, avg(v) AS c FROM tr GROUP BY label, pos),
te AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS pos
       FROM e WHERE split = 'test'),
d AS (SELECT te.vec_id, te.label, cent.cls, sum((te.v - cent.c) * (te.v - cent.c)) AS dist
      FROM te JOIN cent ON te.pos = cent.pos GROUP BY te.vec_id, te.label, cent.cls),
pred AS (SELECT vec_id, label, cls AS prediction FROM (
           SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cls) AS rn FROM d) WHERE rn = 1)
SELECT label, count(*) AS n, CAST(sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
       round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS accuracy
FROM pred GROUP BY label
"""

ORACLES["log_loss"] = f"""
SELECT count(*) AS n,
       round(avg(-ln(greatest(p[label + 1], 1e-15))), 6) AS loss,
       round(avg(CASE WHEN list_position(p, list_max(p)) - 1 = label THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS accuracy
FROM ({_PROBS})
"""

ORACLES["confusion_counts"] = f"""
SELECT label, CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS prediction, count(*) AS n
FROM ({_LOGITS}) GROUP BY ALL
"""

ORACLES["search_term_flag"] = f"SELECT conv_id, turn, search_term FROM ({_CONV_FLAGS})"

ORACLES["flag_rate"] = """
SELECT toxic AS search_term, count(*) AS "count",
       round(count(*) / sum(count(*)) OVER (), 6) AS pct
FROM labels GROUP BY toxic
"""

ORACLES["miss_list"] = f"SELECT file_path AS misclassified_images FROM ({_CONV_FLAGS}) WHERE search_term = 0"

ORACLES["hit_rate"] = f"""
SELECT count(*) AS n_rows, CAST(coalesce(sum(search_term), 0) AS BIGINT) AS n_hits,
       round(coalesce(avg(CASE WHEN search_term = 1 THEN 1.0 ELSE 0.0 END), 0)::DOUBLE, 6) AS hit_rate
FROM ({_CONV_FLAGS})
"""

ORACLES["class_probabilities"] = f"""
SELECT vec_id, CAST(i - 1 AS INTEGER) AS class_index, round(p[i], 6) AS p_softmax, round(s[i], 6) AS p_sigmoid
FROM (SELECT vec_id, p, s, generate_subscripts(p, 1) AS i FROM ({_PROBS}))
"""

ORACLES["argmax_label"] = f"""
SELECT vec_id, CAST(list_position(p, list_max(p)) - 1 AS INTEGER) AS class_index,
       upper('class_' || CAST(list_position(p, list_max(p)) - 1 AS VARCHAR)) AS prediction_label,
       round(round(list_max(p), 8) * 100.0, 6) AS prediction_prob
FROM ({_PROBS})
"""

ORACLES["probability_map"] = f"""
SELECT vec_id, 'class_' || CAST(i - 1 AS VARCHAR) AS class_name, round(p[i], 6) AS prob
FROM (SELECT vec_id, p, generate_subscripts(p, 1) AS i FROM ({_PROBS}))
"""

ORACLES["topk_labels"] = f"""
SELECT vec_id, CAST(rk AS INTEGER) AS rank, CAST(i - 1 AS INTEGER) AS class_index, round(pi, 6) AS prob FROM (
  SELECT vec_id, i, pi, row_number() OVER (PARTITION BY vec_id ORDER BY pi DESC, i) AS rk FROM (
    SELECT vec_id, p[i] AS pi, i FROM (SELECT vec_id, p, generate_subscripts(p, 1) AS i FROM ({_PROBS}))))
WHERE rk <= 5
"""

ORACLES["hash_split"] = f"SELECT vec_id, label, {_SPLIT} AS split FROM embeddings"

ORACLES["stratified_split"] = f"""
SELECT vec_id, label,
       CASE WHEN {_bucket("concat_ws(':', CAST(label AS VARCHAR), CAST(vec_id AS VARCHAR))")} < 30
            THEN 'train' ELSE 'test' END AS split
FROM embeddings
"""

ORACLES["split_counts"] = f"SELECT {_SPLIT} AS split, count(*) AS n_rows FROM embeddings GROUP BY 1"

ORACLES["shuffle_rank"] = """
SELECT vec_id, label, row_number() OVER (ORDER BY md5('42' || CAST(vec_id AS VARCHAR)), vec_id) AS shuffle_rank
FROM embeddings
"""

ORACLES["first_n"] = "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 10"

ORACLES["batch_plan"] = f"""
WITH c AS (SELECT CASE WHEN {_bucket('CAST(vec_id AS VARCHAR)')} < 60 THEN 'training' ELSE 'validation' END AS split,
                  label, count(*) AS n FROM embeddings GROUP BY 1, 2),
g AS (SELECT split, CAST(sum(n) AS BIGINT) AS n_files, count(*) AS n_classes, min(n) AS min_class_files
      FROM c GROUP BY split),
b AS (SELECT *, CASE WHEN min_class_files > 0 THEN
        CAST(list_max(list_filter(range(1, least(min_class_files, 10) + 1), lambda x: n_files % x = 0)) AS INTEGER)
      END AS batch_size FROM g)
SELECT split, n_files, n_classes, min_class_files, batch_size,
       CAST(ceil(n_files / batch_size) AS BIGINT) AS steps FROM b
"""

ORACLES["labelled_union"] = """
SELECT d.doc_id, d.source, d.n_chars, 1 AS label FROM documents d JOIN labels l USING (doc_id)
WHERE l.quality = 1 AND d.text IS NOT NULL
UNION ALL
SELECT d.doc_id, d.source, d.n_chars, 0 AS label FROM documents d JOIN labels l USING (doc_id)
WHERE l.quality = 0 AND d.text IS NOT NULL
"""

_ITEMS = "SELECT CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS INTEGER) AS item_no, n_name AS item FROM nation"

ORACLES["rotation_assign"] = f"""
WITH r AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS request_no FROM events)
SELECT r.event_id, r.request_no, i.item_no, i.item
FROM r JOIN ({_ITEMS}) i ON CAST(r.request_no % (SELECT count(*) FROM nation) AS INTEGER) = i.item_no
"""

ORACLES["random_assign"] = f"""
SELECT e.event_id, i.item_no, i.item
FROM events e JOIN ({_ITEMS}) i
  ON CAST({_bucket("'7' || CAST(e.event_id AS VARCHAR)", "(SELECT count(*) FROM nation)")} AS INTEGER) = i.item_no
"""

# --------------------------------------------------------------------- clean
_NAME = "regexp_extract(url, '[^/]*$')"
_EXT = f"lower(regexp_extract({_NAME}, '[^.]*$'))"

ORACLES["url_filename_ext"] = f"""
SELECT page_id, {_NAME} AS file_name, {_EXT} AS extension, strpos({_NAME}, '.') > 0 AS has_dot FROM pages
"""

ORACLES["ext_allow_filter"] = f"""
SELECT page_id, {_NAME} AS file_name, {_EXT} AS extension FROM pages
WHERE strpos({_NAME}, '.') > 0 AND {_EXT} IN ('html', 'htm')
"""

ORACLES["payload_decode"] = """
WITH p AS (SELECT doc_id, source, text, to_base64(encode(text)) AS b FROM documents),
q AS (SELECT doc_id, source, text,
             CASE source WHEN 'src0' THEN b WHEN 'src2' THEN b || '@@' ELSE b END AS payload FROM p),
r AS (SELECT doc_id, source, text, try(from_base64(payload)) AS raw FROM q)
SELECT doc_id, source, raw IS NOT NULL AS decoded_ok, CAST(octet_length(raw) AS BIGINT) AS n_bytes,
       coalesce(decode(raw) = text, false) AS matches_text
FROM r
"""

ORACLES["payload_encode"] = """
WITH r AS (SELECT doc_id, '{"image":"' || to_base64(encode(text)) || '"}' AS req FROM documents)
SELECT doc_id, CAST(length(req) AS BIGINT) AS request_len, md5(req) AS request_md5 FROM r
"""

ORACLES["response_body"] = """
SELECT doc_id, '{"prediction_label":"' || upper(lang) || '","prediction_prob":' || CAST(n_chars AS VARCHAR) || '}'
         AS body,
       upper(lang) AS prediction_label, CAST(n_chars AS BIGINT) AS prediction_prob
FROM documents
"""

_SAFE = ("regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(" + _NAME +
         ", '[/\\\\]', ' ', 'g')), '\\s+', '_', 'g'), '[^A-Za-z0-9_.\\-]', '', 'g'), '^[._]+|[._]+$', '', 'g')")

ORACLES["path_rewrite"] = f"""
SELECT page_id,
       regexp_replace('/srv/app/static/model_images/' || {_NAME}, '.*?static', './static', 'g') AS image_path_html,
       {_SAFE} AS safe_name,
       './static/uploaded_files/' || {_SAFE} AS upload_path
FROM pages
"""

ORACLES["html_link_manifest"] = """
SELECT page_id, CAST(len(l) AS INTEGER) AS n_links, array_to_string(l, chr(10)) AS manifest
FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)
"""

ORACLES["fetch_outcomes"] = f"""
SELECT outcome, count(*) AS n FROM (
  SELECT CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN 'error'
              WHEN html IS NULL OR html = '' THEN 'http_status'
              WHEN NOT regexp_matches(html, '</html>\\s*$') THEN 'error'
              WHEN {_EXT} IN ('html', 'htm') THEN 'saved'
              ELSE 'bad_extension' END AS outcome
  FROM pages) GROUP BY outcome
"""

# -------------------------------------------------------------------- images
def _fit(w: str, h: str, bw: int, bh: int) -> tuple[str, str]:
    h1 = f"(CASE WHEN {w} > {bw} THEN greatest(({h} * {bw}) // {w}, 1) ELSE {h} END)"
    w1 = f"(CASE WHEN {w} > {bw} THEN {bw} ELSE {w} END)"
    w2 = f"(CASE WHEN {h1} > {bh} THEN greatest(({w1} * {bh}) // {h1}, 1) ELSE {w1} END)"
    h2 = f"(CASE WHEN {h1} > {bh} THEN {bh} ELSE {h1} END)"
    return f"CAST({w2} AS INTEGER)", f"CAST({h2} AS INTEGER)"


_DW, _DH = _fit("width", "height", 200, 100)
_TW, _TH = _fit("width", "height", 200, 200)

ORACLES["thumbnail_dims"] = f"""
SELECT p_partkey, width, height, {_DW} AS download_w, {_DH} AS download_h, {_TW} AS thumb_w, {_TH} AS thumb_h
FROM (SELECT p_partkey, CAST(p_size * 12 AS INTEGER) AS width,
             CAST(floor(p_retailprice) - 850 AS INTEGER) AS height FROM part)
"""


def _image(width: int) -> str:
    """Whole vector as pixels, the last row of ``width`` values filled with 0."""
    return (f"SELECT vec_id AS image_id, CAST(ceil(len(embedding) / {width}) AS BIGINT) AS h, "
            f"list_resize(list_transform(embedding, lambda x: "
            f"CAST(least(greatest(floor((CAST(x AS DOUBLE) + 1.0) * 127.5), 0), 255) AS INTEGER)), "
            f"CAST(ceil(len(embedding) / {width}) AS BIGINT) * {width}, 0) AS data FROM embeddings")


ORACLES["image_resize"] = f"""
WITH r AS (SELECT image_id, list_transform(range(224 * 224), lambda i:
             data[(((2 * (i // 224) + 1) * h) // 448) * 8 + (((2 * (i % 224) + 1) * 8) // 448) + 1]) AS px
           FROM ({_image(8)}))
SELECT image_id, CAST(len(px) AS INTEGER) AS n_values, CAST(list_sum(px) AS BIGINT) AS pixel_sum,
       CAST(list_sum(list_transform(px, lambda x, i: CAST(x AS BIGINT) * i)) AS BIGINT) AS weighted_sum
FROM r
"""

# 8 x 8 images in a box of 5 x 4: 4 x 4, every second pixel of every second row
ORACLES["thumbnail_job"] = f"""
SELECT 'thumbnail' || CAST(image_id AS VARCHAR) || '.png' AS name, 4 AS width, 4 AS height, 1 AS n_channels,
       CAST(list_sum(list_transform(range(16), lambda i: data[(2 * (i // 4) + 1) * 8 + 2 * (i % 4) + 2])) AS BIGINT)
         AS pixel_sum
FROM ({_image(8)})
"""

ORACLES["image_pixels"] = f"""
WITH r AS (SELECT image_id, list_transform(range(len(data)), lambda i:
             data[CASE i % 3 WHEN 0 THEN i + 2 WHEN 2 THEN i - 2 ELSE i END + 1]) AS px FROM ({_image(15)}))
SELECT image_id, CAST(i - 1 AS INTEGER) AS idx, round(CAST(px[i] AS DOUBLE) / 255.0, 6) AS value
FROM (SELECT image_id, px, generate_subscripts(px, 1) AS i FROM r)
"""

ORACLES["featurize_pool"] = f"""
WITH p AS (SELECT image_id, h, CAST(unnest(data) AS DOUBLE) AS v, generate_subscripts(data, 1) - 1 AS p
           FROM ({_image(8)})),
c AS (SELECT image_id, v, (((p // 8) * 2) // h) * 2 + (((p % 8) * 2) // 8) AS cell,
             avg(v) OVER (PARTITION BY image_id) AS m FROM p)
SELECT image_id, CAST(cell AS INTEGER) AS feature_index, round(avg(v), 6) AS value FROM c GROUP BY image_id, cell
UNION ALL
SELECT image_id, 4 AS feature_index, round(avg(v), 6) AS value FROM c GROUP BY image_id
UNION ALL
SELECT image_id, 5 AS feature_index, round(sqrt(avg((v - m) * (v - m))), 6) AS value FROM c GROUP BY image_id
"""

# ------------------------------------------------------------------ features
ORACLES["vector_assemble"] = """
SELECT l_orderkey, l_linenumber, l_returnflag AS "Label", 4 AS n_features,
       l_quantity AS f1, l_extendedprice AS f2, l_discount AS f3, l_tax AS f4
FROM lineitem
"""

ORACLES["standard_scale"] = f"""
WITH e AS (SELECT vec_id, {_SPLIT} AS split, CAST(unnest(embedding) AS DOUBLE) AS v,
                  generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
s AS (SELECT pos, avg(v) AS m, stddev_samp(v) AS sd FROM e WHERE split = 'train' GROUP BY pos)
SELECT e.vec_id, CAST(e.pos AS INTEGER) AS pos,
       round(CASE WHEN s.sd = 0 THEN 0.0 ELSE (e.v - s.m) / s.sd END, 6) AS value
FROM e JOIN s USING (pos)
"""

ORACLES["string_index"] = """
WITH c AS (SELECT event_type, CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS INTEGER) AS label_index
           FROM events GROUP BY event_type)
SELECT e.event_id, e.event_type, c.label_index FROM events e JOIN c USING (event_type)
"""

ORACLES["one_hot"] = """
WITH c AS (SELECT event_type, CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS INTEGER) AS label_index
           FROM events GROUP BY event_type)
SELECT e.event_id, c.label_index, c.label_index AS hot_index, (SELECT count(*) FROM c)::INTEGER AS width,
       1.0::DOUBLE AS hot_sum
FROM events e JOIN c USING (event_type)
"""

ORACLES["class_index"] = """
WITH c AS (SELECT event_type, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INTEGER) AS class_index
           FROM (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL))
SELECT e.event_id, e.event_type, c.class_index FROM events e LEFT JOIN c USING (event_type)
"""

ORACLES["feature_store_roundtrip"] = """
SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dim,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS feature_sum
FROM embeddings
"""

# ------------------------------------------------------------------ training
# held-out rows; the planted classes lie apart, so a trained model tells every row
def _planted(pct: int) -> str:
    return f"""
  SELECT * FROM (
    SELECT vec_id, CAST(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) > 0 AS INTEGER) AS label
    FROM embeddings)
  WHERE {_bucket("concat_ws(':', CAST(label AS VARCHAR), CAST(vec_id AS VARCHAR))")} >= {pct}"""


ORACLES["lr_transfer"] = f"SELECT vec_id, label, label AS prediction, TRUE AS confident FROM ({_planted(30)})"
ORACLES["mlp_head"] = f"SELECT vec_id, label, label AS prediction, TRUE AS confident FROM ({_planted(60)})"
ORACLES["model_roundtrip"] = f"SELECT vec_id, TRUE AS same FROM ({_planted(30)})"

ORACLES["batch_score"] = f"""
SELECT vec_id, label, TRUE AS class_is_argmax, TRUE AS prob_in_range, 1.0::DOUBLE AS prob_sum FROM ({_planted(30)})
"""

ORACLES["trainer_report"] = f"""
SELECT trainer, n_test, CASE WHEN trainer <> 'gbt' THEN 1.0::DOUBLE END AS accuracy, TRUE AS above_90, TRUE AS timed
FROM (SELECT unnest(['lr', 'gbt', 'mlp']) AS trainer, n_test FROM (SELECT count(*) AS n_test FROM ({_planted(60)})))
"""

ORACLES["mlp_rounds"] = f"""
SELECT CAST(r AS INTEGER) AS round, n_validation, r > 1 AS below_first
FROM (SELECT unnest(range(1, 7)) AS r, n_validation FROM (SELECT count(*) AS n_validation FROM ({_planted(60)})))
"""

ORACLES["gbt_quality"] = f"""
SELECT d.doc_id, l.quality AS label, count(*) OVER (PARTITION BY l.quality) AS n, TRUE AS above_majority, TRUE AS above_chance
FROM documents d JOIN labels l USING (doc_id)
WHERE {_bucket('CAST(d.doc_id AS VARCHAR)')} >= 60
"""

# mean rank of the positives, ties at their middle rank
ORACLES["binary_auc"] = """
WITH s AS (SELECT l.quality AS label, length(d.text) AS score FROM documents d JOIN labels l USING (doc_id)
           WHERE d.text IS NOT NULL AND l.quality IS NOT NULL),
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk FROM s)
SELECT n, round((up - n1 * (n1 + 1) / 2) / (n1 * (n - n1)), 6) AS auc
FROM (SELECT count(*) AS n, CAST(sum(label) AS DOUBLE) AS n1, sum(CASE WHEN label = 1 THEN rk END) AS up FROM r)
"""

ORACLES["image_program"] = f"""
SELECT image_id, label, label AS prediction, TRUE AS confident
FROM (SELECT image_id, CAST(list_avg(data) > 127.0 AS INTEGER) AS label FROM ({_image(8)}))
WHERE {_bucket('CAST(image_id AS VARCHAR)')} >= 60
"""

ORACLES["saved_image_pipeline"] = f"""
SELECT image_id, CASE WHEN list_avg(data) > 127.0 THEN 'BRIGHT' ELSE 'DARK' END AS prediction_label, TRUE AS same_label,
       TRUE AS same_prob
FROM ({_image(8)}) WHERE {_bucket('CAST(image_id AS VARCHAR)')} >= 60
"""

ORACLES["tabular_program"] = f"""
SELECT line, label, label AS prediction, TRUE AS confident FROM (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line,
         CASE WHEN l_quantity > 25 THEN 0 ELSE 1 END AS label FROM lineitem)
WHERE {_bucket('line')} >= 60
"""

# ------------------------------------------------------- streams and files
ORACLES["labelled_dir_scan"] = """
SELECT 'lang=' || lang AS class, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS n_bytes
FROM documents WHERE text IS NOT NULL GROUP BY lang
"""

_PROB = "round(1.0 / (1.0 + exp(-value / 100.0)), 6)"
_LABEL = "CASE WHEN value >= 50 THEN 'HIGH' ELSE 'LOW' END"

ORACLES["stream_score"] = f"""
SELECT event_id, '{{"image":"' || to_base64(encode(CAST(value AS VARCHAR))) || '"}}' AS content,
       {_LABEL} AS prediction_label, {_PROB} AS prediction_prob, printf('%.6f', {_PROB}) AS prob_attr
FROM events
"""

ORACLES["score_requests"] = f"""
SELECT event_id AS request_id, CASE WHEN event_type = 'view' THEN 'GET' ELSE 'POST' END AS method,
       CASE WHEN event_type <> 'view' THEN {_LABEL} END AS prediction_label,
       CASE WHEN event_type <> 'view' THEN {_PROB} END AS prediction_prob,
       CASE WHEN event_type <> 'view' THEN '{{"prediction_label":"' || {_LABEL} || '","prediction_prob":'
         || CAST({_PROB} AS VARCHAR) || '}}' END AS response
FROM events
"""

ORACLES["score_json"] = f"""
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, value AS value_roundtrip,
       {_LABEL} AS prediction_label, printf('%.6f', {_PROB}) AS prob_attr
FROM events
"""

ORACLES["url_manifest_read"] = f"SELECT url, {_NAME} AS file_name, {_EXT} AS extension FROM pages"

ORACLES["csv_features"] = """
SELECT l_returnflag AS "Label", count(*) AS n,
       CAST(sum(CAST(round(l_quantity * 100) AS BIGINT)) AS BIGINT) AS sum_f1_cents,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS sum_f2_cents,
       CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS sum_f3_cents,
       CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS sum_f4_cents
FROM lineitem GROUP BY l_returnflag
"""

# ---------------------------------------------------------------- jobs
ORACLES["image_files_roundtrip"] = f"""
SELECT image_id, CAST(image_id % 2 AS INTEGER) AS label, CAST(h AS INTEGER) AS height, 5 AS width, 3 AS n_channels,
       array_to_string(data, ',') AS pixels
FROM ({_image(15)}) WHERE image_id % 25 <> 0
"""

# a cell covers 8/3 pixels a side: overlaps in thirds of a pixel, 8 of them per side
ORACLES["image_area_resize"] = f"""
WITH px AS (SELECT image_id, h, (i // 8) AS y, (i % 8) AS x, data[i + 1] AS v
            FROM (SELECT image_id, h, data, unnest(range(len(data))) AS i FROM ({_image(8)}))),
cells AS (SELECT image_id, a, b, h, sum(v * greatest(least((a + 1) * h, (y + 1) * 3) - greatest(a * h, y * 3), 0)
                                  * greatest(least((b + 1) * 8, (x + 1) * 3) - greatest(b * 8, x * 3), 0)) AS s
          FROM px, (SELECT unnest(range(3)) AS a), (SELECT unnest(range(3)) AS b) GROUP BY ALL)
SELECT image_id, string_agg(CAST(((2 * s + 8 * h) // (16 * h)) AS INTEGER)::VARCHAR, ',' ORDER BY a, b) AS pixels
FROM cells GROUP BY image_id
"""

ORACLES["featurize_grids"] = f"""
WITH px AS (SELECT image_id, g, ((i // 8) * g) // h AS a, ((i % 8) * g) // 8 AS b, data[i + 1] AS v
            FROM (SELECT image_id, h, data, unnest(range(len(data))) AS i FROM ({_image(8)})), (SELECT unnest([3, 4]) AS g)),
f AS (SELECT image_id, g, a * g + b AS k, avg(v) AS x FROM px GROUP BY ALL
      UNION ALL SELECT image_id, g, g * g, avg(v) FROM px GROUP BY ALL
      UNION ALL SELECT image_id, g, g * g + 1, stddev_pop(v) FROM px GROUP BY ALL)
SELECT image_id, CAST(g AS INTEGER) AS grid, CAST(k AS INTEGER) AS feature_index, round(x, 6) AS value FROM f
"""

ORACLES["json_link_manifest"] = """
WITH l AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM pages)
SELECT page_id, CAST(len(links) AS INTEGER) AS n_objects, CAST((len(links) // 3) AS INTEGER) AS n_without,
       array_to_string(list_filter(links, lambda x, i: i % 3 <> 0), chr(10)) AS manifest FROM l
"""

ORACLES["fetch_pages"] = f"""
WITH o AS (SELECT *, CASE WHEN url IS NULL OR NOT contains(url, '://') THEN 'error'
                          WHEN coalesce(html, '') = '' THEN 'http_status'
                          WHEN NOT regexp_matches(html, '</html>\\s*$') THEN 'error'
                          WHEN {_EXT} IN ('html', 'htm') THEN 'saved' ELSE 'bad_extension' END AS outcome FROM pages)
SELECT coalesce(url, '') AS url, coalesce({_NAME}, '') AS file_name,
       CAST(CASE outcome WHEN 'error' THEN NULL WHEN 'http_status' THEN 404 ELSE 200 END AS INTEGER) AS http_status, outcome,
       CASE WHEN outcome = 'saved' THEN CAST(octet_length(encode(html)) AS BIGINT) END AS n_bytes, outcome = 'error' AS failed
FROM o
"""

ORACLES["csv_checked"] = """
WITH l AS (SELECT l_returnflag AS "Label",
                  CASE WHEN l_orderkey % 101 = 1 THEN 'fields' WHEN l_orderkey % 97 = 1 THEN 'type of l_quantity' ELSE 'good' END AS state,
                  CAST(round(l_quantity * 100) + round(l_extendedprice * 100) + round(l_discount * 100) + round(l_tax * 100) AS BIGINT) AS c
           FROM lineitem)
SELECT "Label", state, count(*) AS n, CASE WHEN state = 'good' THEN CAST(sum(c) AS BIGINT) END AS cents,
       'string,double,double,double,double' AS types
FROM l GROUP BY 1, 2
"""

ORACLES["roc_points"] = """
WITH s AS (SELECT l.quality AS label, CAST(length(d.text) AS DOUBLE) AS threshold FROM documents d JOIN labels l USING (doc_id)
           WHERE d.text IS NOT NULL AND l.quality IS NOT NULL),
g AS (SELECT threshold, count(*) AS n, count(*) FILTER (label = 1) AS p, count(*) FILTER (label <> 1) AS q FROM s GROUP BY 1),
c AS (SELECT threshold, n, sum(p) OVER w AS tp, sum(q) OVER w AS fp, sum(p) OVER () AS np, sum(q) OVER () AS nq
      FROM g WINDOW w AS (ORDER BY threshold DESC))
SELECT threshold, n, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(tp / np, 6) AS tpr, round(fp / nq, 6) AS fpr FROM c
"""

ORACLES["file_drop_score"] = """
SELECT 'doc' || doc_id || '.png' AS file_name, CAST(octet_length(encode(text)) AS BIGINT) AS length,
       CASE WHEN octet_length(encode(text)) >= 1000 THEN 'HIGH' ELSE 'LOW' END AS prediction_label,
       round(1.0 / (1.0 + exp(-octet_length(encode(text)) / 1000.0)), 6) AS prediction_prob
FROM documents WHERE text IS NOT NULL AND source IS DISTINCT FROM 'src0'
"""

ORACLES["stream_routes"] = f"""
WITH e AS (SELECT *, CASE WHEN event_type = 'view' THEN 'payload' WHEN event_id % 10 = 3 THEN 'value' END AS error FROM events)
SELECT event_id, CASE WHEN error IS NULL THEN 'success' ELSE 'failure' END AS route,
       CASE WHEN error IS NULL THEN {_LABEL} END AS prediction_label, CASE WHEN error IS NULL THEN {_PROB} END AS prediction_prob, error
FROM e
"""

ORACLES["request_stream"] = f"""
WITH p AS (SELECT event_id, {_PROB} AS p FROM events),
c AS (SELECT event_id, CASE WHEN p >= 1.0 - p THEN 0 ELSE 1 END AS class_index, round(greatest(p, 1.0 - p), 8) * 100.0 AS prob FROM p)
SELECT event_id, class_index, CASE class_index WHEN 0 THEN 'HIGH' ELSE 'LOW' END AS prediction_label,
       '{{"prediction_label":"' || CASE class_index WHEN 0 THEN 'HIGH' ELSE 'LOW' END || '","prediction_prob":'
         || CAST(prob AS VARCHAR) || '}}' AS reply
FROM c
"""
