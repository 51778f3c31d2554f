"""DuckDB twins of the registered queries, on the same parquet tables."""

from __future__ import annotations

from inkfold.functions.fixed_values import FIELDS, LABEL_TO_FIELD, METRIC_LABELS, MONTHS
from inkfold.plans.fixtures import UNREAD

# Inputs -------------------------------------------------------------------

PIXELS = """
px_cells AS (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i FROM embeddings),
pixels AS (SELECT vec_id AS img_id, CAST((i - 1) // 8 AS INT) AS y, CAST((i - 1) % 8 AS INT) AS x,
  least(255, greatest(0, CAST(floor((CAST(e AS DOUBLE) + CAST(0.6 AS DOUBLE)) * 210) AS INT))) AS v FROM px_cells)"""

MASKS = PIXELS + """,
masks AS (SELECT img_id, y, x, CASE WHEN v > 127 THEN 255 ELSE 0 END AS gt,
  CASE WHEN v > 120 + img_id % 15 THEN 255 ELSE 0 END AS pred,
  CASE WHEN v < 110 THEN 0 WHEN v < 140 THEN 1 ELSE 2 END AS cls_gt,
  CASE WHEN v < 108 THEN 0 WHEN v < 143 THEN 1 ELSE 2 END AS cls_pred FROM pixels)"""

LOGITS = PIXELS + """,
logits AS (SELECT img_id, y, x, CAST(v - 100 AS DOUBLE) / 50 AS l0, CAST(130 - v AS DOUBLE) / 50 AS l1,
  CAST(x - y AS DOUBLE) / 8 AS l2, CASE WHEN v > 127 THEN 1 ELSE 0 END AS target FROM pixels)"""

BOXES = """
boxes AS (SELECT vec_id AS img_id, CAST(d.det_no AS INT) AS det_no, CAST((label + d.det_no % 3) % 5 AS INT) AS cls,
  CAST((vec_id + d.det_no) % 4 AS INT) AS x1, CAST((vec_id * 3 + d.det_no) % 4 AS INT) AS y1,
  CAST((vec_id + d.det_no) % 4 + 3 AS INT) AS x2, CAST((vec_id * 3 + d.det_no) % 4 + 2 AS INT) AS y2
  FROM embeddings CROSS JOIN (VALUES (0), (1), (2), (3)) AS d(det_no))"""

DROPPED = """
dropped AS (SELECT doc_id, text AS gt, regexp_replace(text, '[aeo]', '', 'g') AS et FROM documents)"""

TOKENS = """
tokens AS (SELECT doc_id, CAST(i - 1 AS INT) AS pos, word FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word,
  generate_subscripts(string_split(text, ' '), 1) AS i FROM documents) WHERE word <> '')"""

TOKEN_VECTORS = """
tokvec AS (SELECT CAST(label AS BIGINT) AS doc_id, CAST(vec_id AS INT) AS pos,
  concat('w', CAST(vec_id % 97 AS VARCHAR)) AS word, embedding AS vec FROM embeddings),
close_pairs AS (SELECT a.doc_id, a.word, b.word AS similar_word, list_cosine_similarity(a.vec::DOUBLE[], b.vec::DOUBLE[]) AS cosine
  FROM tokvec a JOIN tokvec b ON a.doc_id = b.doc_id AND a.pos <> b.pos
  WHERE list_cosine_similarity(a.vec::DOUBLE[], b.vec::DOUBLE[]) > 0.3)"""

ORDERS = """
ord AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

CAPTIONS = ORDERS + """,
captions AS (SELECT o_orderkey AS doc_id, concat(n_name, ' ', c_mktsegment, ' ',
  list_extract(['Januar', 'Februar', 'April', 'Mai', 'Juni', 'Oktober', 'Nov.', 'Feber'], CAST(o_orderkey % 8 + 1 AS INT)),
  ' ', CAST(year(o_orderdate) AS VARCHAR), ' Aufn. Lindtaler', CASE WHEN o_orderkey % 5 = 0 THEN ' Ö1' ELSE '' END,
  ' Rollfilm ', CAST(o_orderkey AS VARCHAR), ' ZV', CASE WHEN o_orderkey % 3 = 0 THEN ' Übersicht Nord' ELSE '' END) AS text
  FROM ord)"""

ENTITIES = ORDERS + """,
entities AS (SELECT * FROM (SELECT o_orderkey AS doc_id, k.start, k.label, CASE k.start
   WHEN 0 THEN CASE WHEN o_orderstatus <> 'P' THEN n_name END
   WHEN 1 THEN CASE WHEN c_acctbal > 0 THEN r_name END
   WHEN 2 THEN CASE WHEN o_totalprice > 100000 THEN CAST(year(o_orderdate) AS VARCHAR) END
   WHEN 3 THEN CASE WHEN o_orderpriority <> '5-LOW' THEN c_name END
   WHEN 4 THEN CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(o_orderkey AS VARCHAR) END
   ELSE CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END END AS text
  FROM ord CROSS JOIN (VALUES (0, 'LOC'), (1, 'GPE'), (2, 'DATE'), (3, 'PER'), (4, 'FILM'), (5, 'MISC')) AS k(start, label))
  WHERE text IS NOT NULL)"""

RECORDS = ORDERS + """,
rec_a AS (SELECT o_orderkey AS doc_id, concat(n_name, ' ', r_name) AS "Location",
  concat('order of ', c_mktsegment, ' with priority ', o_orderpriority) AS "Description",
  concat('April ', CAST(year(o_orderdate) AS VARCHAR)) AS "Date", c_name AS "Photographer",
  CASE WHEN o_totalprice > 250000 THEN concat('Film ', CAST(o_orderkey AS VARCHAR)) END AS "Film"
  FROM ord WHERE o_orderstatus <> 'P'),
rec_b AS (SELECT o_orderkey AS doc_id, CASE WHEN r_name = 'ASIA' THEN n_name ELSE concat(n_name, ' ', r_name) END AS "Location",
  concat(c_mktsegment, ' order with priority ', o_orderpriority) AS "Description",
  concat(CASE WHEN o_orderstatus = 'F' THEN 'April ' ELSE 'Mai ' END, CAST(year(o_orderdate) AS VARCHAR)) AS "Date",
  CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS "Photographer",
  CASE WHEN o_totalprice < 50000 THEN '' WHEN o_orderpriority <> '1-URGENT' THEN concat('Film ', CAST(o_orderkey + 1 AS VARCHAR)) END AS "Film"
  FROM ord WHERE c_acctbal >= 0)"""

PAIRS = RECORDS + """,
pairs AS (SELECT a.doc_id, """ + ", ".join(f'a."{f}" AS "{f}_a", b."{f}" AS "{f}_b"' for f in FIELDS) + """
  FROM rec_a a JOIN rec_b b ON a.doc_id = b.doc_id)"""

RAW_JSON = """
answers AS (SELECT event_id, props, event_id % 4 AS kind FROM events)"""

# Expressions --------------------------------------------------------------


def _words(text: str) -> str:
    squeezed = f"regexp_replace({text}, '\\s\\s+', ' ', 'g')"
    return f"list_filter(string_split(trim({squeezed}, ' ' || chr(10) || chr(9)), ' '), lambda w: w <> '')"


def _coded(side: str, vocabulary: str) -> str:
    """A word list as one ASCII character per distinct word (up to 94 of them)."""
    return f"array_to_string(list_transform({side}, lambda w: chr(CAST(list_position({vocabulary}, w) + 32 AS INT))), '')"


def _wer(source: str, columns: str, gt: str = "gt", et: str = "et") -> str:
    """CTE body: ``source`` with its word error rate; words become ASCII characters."""
    return (f"SELECT {columns}, CASE WHEN len(gw) > 0 THEN levenshtein({_coded('gw', 'voc')}, {_coded('ew', 'voc')}) * 1.0 / len(gw) END AS wer "
            f"FROM (SELECT *, list_distinct(list_concat(gw, ew)) AS voc FROM (SELECT *, {_words(gt)} AS gw, {_words(et)} AS ew FROM {source}))")


_LETTERS = "ÊÄñÉßêÈÑäÜèéÍçíÇöüÖóÓ"
_CODES = "||".join(f"chr({i})" for i in [*range(1, 9), *range(14, 27)])


def _strip(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^\\s+', ''), '\\s+$', '')"


def _cer(gt: str, et: str) -> str:
    """levenshtein counts bytes here, so each accented letter is mapped to one unused byte first."""
    one_byte = lambda t: f"translate({_strip(t)}, '{_LETTERS}', {_CODES})"
    return f"levenshtein({one_byte(gt)}, {one_byte(et)}) * 1.0 / length({_strip(gt)})"


def _swept(settings: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS config, doc_id, text AS gt, {edit} AS et FROM captions" for name, edit in settings)


_EDITS = [("drop vowels", "regexp_replace(text, '[aeo]', '', 'g')"), ("lower case", "lower(text)"),
          ("join sentences", "replace(text, ' Rollfilm', 'Rollfilm')")]
SCORED = (CAPTIONS + ", swept AS (" + _swept(_EDITS) + "), scored AS ("
          + _wer("swept", "config, doc_id, " + _cer("gt", "et") + " AS cer") + ")")

_INK = "sum(CASE WHEN pred = 0 AND gt = 0 THEN 2.0 ELSE 0 END)", "(sum(CASE WHEN pred = 0 THEN 1.0 ELSE 0 END) + sum(CASE WHEN gt = 0 THEN 1.0 ELSE 0 END))"
_DICE = f"({_INK[0]} + 1e-6) / ({_INK[1]} + 1e-6)"

_CONFUSION = """
conf AS (SELECT {by} img_id, CAST(count(*) FILTER (gt = 0 AND pred = 0) AS DOUBLE) AS tp, CAST(count(*) FILTER (gt <> 0 AND pred = 0) AS DOUBLE) AS fp,
  CAST(count(*) FILTER (gt = 0 AND pred <> 0) AS DOUBLE) AS fn, CAST(count(*) FILTER (gt <> 0 AND pred <> 0) AS DOUBLE) AS tn FROM {source} GROUP BY ALL),
measured AS (SELECT {by} img_id, 100 * (tp + tn) / (tp + fp + fn + tn) AS accuracy,
  200 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0)) / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0) AS fm,
  (tp * tn - fp * fn) / nullif(sqrt(tp + fp) * sqrt(tp + fn) * sqrt(tn + fp) * sqrt(tn + fn), 0) AS mcc,
  CASE WHEN fp + fn > 0 THEN 10 * log10((tp + fp + fn + tn) / (fp + fn)) END AS psnr,
  (fn / nullif(fn + tp, 0) + fp / nullif(fp + tn, 0)) / 2 AS nrm FROM conf)"""

_DRDM = """
offs AS (SELECT i AS dy, j AS dx, 1 / sqrt(i * i + j * j) AS w FROM range(-2, 3) a(i), range(-2, 3) b(j) WHERE i <> 0 OR j <> 0),
wts AS (SELECT dy, dx, w / (SELECT sum(w) FROM offs) AS w FROM offs),
drd AS (SELECT {k} p.img_id, sum(w) AS d FROM {source} p CROSS JOIN wts JOIN {source} q
  ON p.img_id = q.img_id AND q.y = p.y + dy AND q.x = p.x + dx {same} WHERE p.gt <> p.pred AND q.gt <> p.pred GROUP BY ALL),
blk AS (SELECT {by} img_id, y // 8 AS ay, x // 8 AS ax, CAST(min(gt) <> max(gt) AS INT) AS mixed FROM {source} GROUP BY ALL),
nub AS (SELECT {by} img_id, sum(mixed) AS n FROM blk GROUP BY ALL),
drdms AS (SELECT {nk} nub.img_id, coalesce(d, 0) / nullif(n, 0) AS drdm FROM nub LEFT JOIN drd ON nub.img_id = drd.img_id {nsame})"""

METHODS = (MASKS + """,
methods AS (SELECT 'fine' AS method, img_id, y, x, gt, pred FROM masks UNION ALL
  SELECT 'coarse', img_id, y, x, gt, CASE WHEN cls_pred = 0 THEN 0 ELSE 255 END FROM masks),"""
           + _CONFUSION.format(by="method,", source="methods") + ","
           + _DRDM.format(k="p.method,", by="method,", nk="nub.method,", source="methods",
                          same="AND p.method = q.method", nsame="AND nub.method = drd.method") + """,
vals AS (""" + " UNION ALL ".join(
               [f"SELECT method, img_id, '{m}' AS metric, {m} AS value FROM measured" for m in list(METRIC_LABELS)[:5]]
               + ["SELECT method, img_id, 'drdm', drdm FROM drdms"]) + """),
means AS (SELECT method, metric, round(avg(value), 2) AS value FROM vals GROUP BY ALL)""")


def _label_case(label: str) -> str:
    return "CASE " + " ".join(f"WHEN {label} = '{k}' THEN '{v}'" for k, v in LABEL_TO_FIELD.items()) + " ELSE 'Description' END"


_NEAR = """
near AS (SELECT a.img_id, a.y, a.x, max(b.v) AS hi, min(b.v) AS lo FROM pixels a JOIN pixels b
  ON a.img_id = b.img_id AND b.y BETWEEN a.y - 1 AND a.y + 1 AND b.x BETWEEN a.x - 1 AND a.x + 1 GROUP BY ALL),
contrast AS (SELECT img_id, y, x, least(CAST((hi - lo) / ((hi + lo) % 256 + CAST(0.001 AS DOUBLE)) AS FLOAT), CAST(1 AS FLOAT)) AS c FROM near)"""


def _otsu(source: str) -> str:
    """CTEs ending in ``levels`` (img_id, level) for a table of (img_id, v)."""
    return f"""
hist AS (SELECT img_id, v, count(*) AS n FROM {source} GROUP BY ALL),
run AS (SELECT img_id, v, CAST(sum(n) OVER w AS DOUBLE) AS n1, CAST(sum(n * v) OVER w AS DOUBLE) AS s1,
  CAST(sum(n) OVER (PARTITION BY img_id) AS DOUBLE) AS n, CAST(sum(n * v) OVER (PARTITION BY img_id) AS DOUBLE) AS s
  FROM hist WINDOW w AS (PARTITION BY img_id ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
vars AS (SELECT img_id, v, CASE WHEN n1 < n THEN (n * s1 - n1 * s) * (n * s1 - n1 * s) / (n1 * (n - n1)) ELSE 0 END AS var FROM run),
ranked AS (SELECT img_id, v, var, row_number() OVER (PARTITION BY img_id ORDER BY var DESC, v) AS r FROM vars),
levels AS (SELECT img_id, CASE WHEN var > 0 THEN v ELSE 0 END AS level FROM ranked WHERE r = 1)"""


def _decide(source: str) -> str:
    """CTEs ending in ``decided`` for a table of (img_id, y, x, v, e), window 3, at least 3 neighbours."""
    return f"""
wins AS (SELECT a.img_id, a.y, a.x, any_value(a.v) AS v0, any_value(a.e) AS e0,
  list(b.e ORDER BY b.y, b.x) AS es, list(b.v ORDER BY b.y, b.x) AS vs FROM {source} a JOIN {source} b
  ON a.img_id = b.img_id AND b.y BETWEEN a.y - 1 AND a.y + 1 AND b.x BETWEEN a.x - 1 AND a.x + 1 GROUP BY a.img_id, a.y, a.x),
cut AS (SELECT img_id, y, x, v0, e0,
  list_concat(es[1:list_position(es, e0) - 1], es[list_position(es, e0) + 1:]) AS es,
  list_concat(vs[1:list_position(vs, v0) - 1], vs[list_position(vs, v0) + 1:]) AS vs FROM wins),
cells AS (SELECT img_id, y, x, v0, e0, unnest(es) AS e, unnest(vs) AS v FROM cut),
sums AS (SELECT img_id, y, x, v0, e0, sum(CASE WHEN e = 255 THEN 1 ELSE 0 END) AS n,
  sum(v * CASE WHEN e = 255 THEN 2 ELSE 1 END % 256) AS s,
  sum(CASE WHEN e = 255 THEN 4 ELSE 1 END) AS w, sum(v * CASE WHEN e = 255 THEN 4 ELSE 1 END) AS wv,
  sum(v * v * CASE WHEN e = 255 THEN 4 ELSE 1 END) AS wvv FROM cells GROUP BY ALL),
stat AS (SELECT *, CASE WHEN n > 0 THEN CAST(s AS DOUBLE) / n ELSE 0 END AS m FROM sums),
decided AS (SELECT img_id, y, x, v0 AS v, e0 AS e, CASE WHEN n >= 3 AND v0 <= m + sqrt((wvv - 2 * m * wv + m * m * w) / 2) / 2 THEN 0 ELSE 255 END AS b FROM stat)"""


def _paper_binarize(k: int) -> str:
    """Contrast without wrap, Otsu on its levels, mean and deviation over the high-contrast neighbours."""
    around = f"a.img_id = b.img_id AND b.y BETWEEN a.y - {k} AND a.y + {k} AND b.x BETWEEN a.x - {k} AND a.x + {k}"
    return f"""WITH {PIXELS},
near AS (SELECT a.img_id, a.y, a.x, max(b.v) AS hi, min(b.v) AS lo FROM pixels a JOIN pixels b ON {around} GROUP BY ALL),
cimg AS (SELECT img_id, y, x, CAST(floor(least(CAST((hi - lo) / (hi + lo + CAST(0.001 AS DOUBLE)) AS FLOAT), CAST(1 AS FLOAT)) * CAST(255 AS FLOAT)) AS INT) AS v FROM near),
{_otsu('cimg')},
masked AS (SELECT p.img_id, p.y, p.x, p.v, CASE WHEN c.v > level THEN 255 ELSE 0 END AS e FROM pixels p
  JOIN cimg c ON p.img_id = c.img_id AND p.y = c.y AND p.x = c.x JOIN levels ON p.img_id = levels.img_id),
s AS (SELECT a.img_id, a.y, a.x, any_value(a.v) AS v, CAST(count(*) FILTER (b.e = 255) AS DOUBLE) AS n,
  CAST(coalesce(sum(b.v) FILTER (b.e = 255), 0) AS DOUBLE) AS s, CAST(coalesce(sum(b.v * b.v) FILTER (b.e = 255), 0) AS DOUBLE) AS q
  FROM masked a JOIN masked b ON {around} AND NOT (a.y = b.y AND a.x = b.x) GROUP BY a.img_id, a.y, a.x)
SELECT img_id, y, x, CASE WHEN n >= 3 AND v <= s / n + sqrt((n * q - s * s) / (n * n)) / 2 THEN 0 ELSE 255 END AS b FROM s"""


SPANS = CAPTIONS + """,
capwords AS (SELECT doc_id, string_split(text, ' ') AS ws FROM captions),
ct AS (SELECT doc_id, CAST(i - 1 AS INT) AS pos, word FROM (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM capwords)),
seq AS (SELECT doc_id, pos, word, lead(word) OVER w AS nxt, count(*) OVER (PARTITION BY doc_id) AS n,
  min(CASE WHEN strlen(word) <> length(word) THEN pos END) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS stop
  FROM ct WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
spans AS (
  SELECT doc_id, pos AS start, pos + 2 AS "end", 'DATE' AS label FROM seq WHERE word IN (""" + ", ".join(f"'{m}'" for m in MONTHS) + """) AND regexp_full_match(nxt, '[0-9]{4}')
  UNION ALL SELECT doc_id, pos, pos + 1, 'DATE' FROM seq WHERE regexp_full_match(word, '[0-9]{4}')
  UNION ALL SELECT doc_id, pos, pos + 2, 'PERSON' FROM seq WHERE word = 'Aufn.' AND regexp_full_match(nxt, '[A-Z][a-z]+')
  UNION ALL SELECT doc_id, pos, CAST(coalesce(stop, n) AS INT), 'FILM' FROM seq WHERE lower(word) IN ('film', 'rollfilm') AND strlen(nxt) = length(nxt)),
kept AS (SELECT * FROM spans s WHERE NOT EXISTS (SELECT 1 FROM spans t WHERE t.doc_id = s.doc_id AND t.start <= s.start AND t."end" >= s."end"
  AND t."end" - t.start > s."end" - s.start)),
enttok AS (SELECT ct.doc_id, ct.pos, ct.word, kept.label FROM ct JOIN kept ON ct.doc_id = kept.doc_id AND ct.pos >= kept.start AND ct.pos < kept."end")"""


def _record(source: str) -> str:
    """Five fields per document from (doc_id, start, label, text)."""
    field = _label_case("label")
    return "SELECT doc_id, " + ", ".join(
        f"string_agg(text, ' ' ORDER BY start) FILTER ({field} = '{f}') AS \"{f}\"" for f in FIELDS) + f" FROM {source} GROUP BY doc_id"


_FIELD_WERS = ", ".join(f"w{i} AS (" + _wer(
    f"(SELECT doc_id, \"{f}_a\" AS gt, \"{f}_b\" AS et FROM pairs WHERE \"{f}_a\" <> '' AND \"{f}_b\" <> '')", "doc_id") + ")"
    for i, f in enumerate(FIELDS))
FIELD_WER = (PAIRS + ", " + _FIELD_WERS + ", fw AS (SELECT pairs.doc_id, " + ", ".join(f"w{i}.wer AS \"{f}_wer\"" for i, f in enumerate(FIELDS))
             + " FROM pairs " + " ".join(f"LEFT JOIN w{i} ON pairs.doc_id = w{i}.doc_id" for i in range(5)) + ")")


def _per_field(select: str) -> str:
    return " UNION ALL ".join(select.replace("{f}", f) for f in FIELDS)


_NAMES = """
names AS (SELECT page_id, concat(CASE WHEN contains(url, '?') THEN '.' ELSE '' END, 'img_', regexp_extract(url, '/([0-9]+)[^/]*$', 1),
  CASE WHEN starts_with(url, 'https') THEN '.jpg' ELSE '.png' END) AS name FROM pages)"""

_ANSWER = """SELECT event_id, CASE WHEN {ok} THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END AS k,
  CASE WHEN {ok} THEN NULL ELSE 'Failed to decode response' END AS error FROM answers"""


def sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # Sources and sinks.
    q["text_scan"] = "SELECT doc_id, text FROM documents"
    q["file_filter"] = f"WITH {_NAMES} SELECT * FROM names WHERE ends_with(name, '.jpg') AND NOT starts_with(name, '.')"
    q["file_key"] = f"""WITH {_NAMES} SELECT page_id, TRY_CAST(regexp_extract(name, '([0-9]+)', 1) AS BIGINT) AS key,
      regexp_replace(name, '\\.[^.]*$', '') AS stem FROM names"""
    q["pixel_table"] = q["image_sink"] = f"WITH {PIXELS} SELECT * FROM pixels"
    q["json_sink"] = f"WITH {RECORDS} SELECT * FROM rec_a"
    q["json_source"] = f"WITH {RECORDS} SELECT * FROM rec_b"
    q["similar_words"] = q["csv_sink"] = q["set_union"] = f"""WITH {TOKEN_VECTORS}, d AS (SELECT DISTINCT word, similar_word FROM close_pairs)
      SELECT word, string_agg(similar_word, ', ' ORDER BY similar_word) AS similar_words FROM d GROUP BY word"""
    q["similar_word_pairs"] = f"""WITH {TOKEN_VECTORS} SELECT word, similar_word, round(max(cosine), 5) AS cosine, count(*) AS n_pairs
      FROM close_pairs GROUP BY word, similar_word"""
    q["text_sink"] = "SELECT doc_id, text FROM documents"
    q["overwrite_output"] = "SELECT doc_id, lang, n_chars FROM documents"

    # Projections and filters.
    q["detection_class_filter"] = f"WITH {BOXES} SELECT * FROM boxes WHERE cls = 2"
    q["has_vector_filter"] = f"WITH {TOKEN_VECTORS} SELECT doc_id, pos, word FROM tokvec WHERE vec[1] > 0"
    q["field_get_default"] = f"""WITH {RECORDS} SELECT doc_id, "Film" AS film, coalesce("Film", '') AS film_or_blank,
      coalesce("Photographer", '') AS photographer_or_blank FROM rec_b"""
    q["non_empty_flags"] = f"WITH {PAIRS} SELECT doc_id, " + ", ".join(
        f"coalesce(\"{f}_{s}\" <> '', FALSE) AS \"{f}_{s}_not_empty\"" for f in FIELDS for s in "ab") + " FROM pairs"
    q["field_match"] = f"WITH {PAIRS} SELECT doc_id, " + ", ".join(
        f'"{f}_a" IS NOT DISTINCT FROM "{f}_b" AS "{f}_match"' for f in FIELDS) + " FROM pairs"
    q["label_to_field"] = f"WITH {ENTITIES} SELECT doc_id, start, {_label_case('label')} AS field FROM entities"
    q["pixel_scale"] = f"""WITH {PIXELS} SELECT img_id, y, x, round(CASE WHEN max(v) OVER (PARTITION BY img_id) > 1
      THEN v / CAST(255 AS DOUBLE) ELSE v END, 6) AS value FROM pixels"""
    q["mask_encode"] = f"""WITH {PIXELS} SELECT img_id, y, x, CASE v - v % 32 WHEN 64 THEN 1 WHEN 96 THEN 2 WHEN 128 THEN 3
      WHEN 160 THEN 4 ELSE 0 END AS cls FROM pixels"""
    q["mask_decode"] = f"""WITH {MASKS} SELECT img_id, y, x, CASE WHEN cls_gt = 1 THEN 128 ELSE 0 END AS value, cls_gt = 1 AS flag,
      CASE WHEN cls_gt = 1 THEN '10,20,30' ELSE '0,0,0' END AS rgb FROM masks"""
    q["logits_to_mask"] = f"""WITH {LOGITS} SELECT img_id, y, x, CASE WHEN l0 >= l1 AND l0 >= l2 THEN 0 WHEN l1 >= l2 THEN 1 ELSE 2 END AS cls,
      CASE WHEN 1 / (1 + exp(-l0)) > 0.5 THEN 1 ELSE 0 END AS ink, CASE WHEN 1 / (1 + exp(-l0)) > 0.7 THEN 1 ELSE 0 END AS sure_ink FROM logits"""
    q["mask_checks"] = f"""WITH {MASKS}, m AS (SELECT img_id, CASE WHEN v > 200 THEN 3 ELSE cls_gt END AS cls, v >= 60 AS present
      FROM masks JOIN pixels USING (img_id, y, x)),
      f AS (SELECT img_id, min(cls) FILTER (present) AS low, max(cls) FILTER (present) AS high, count(*) AS image_pixels,
      count(*) FILTER (present) AS mask_pixels, count(*) FILTER (present) AS shared FROM m GROUP BY img_id)
      SELECT *, coalesce(low < 0 OR high >= 3, FALSE) AS bad_range, image_pixels <> shared AS bad_size FROM f
      WHERE coalesce(low < 0 OR high >= 3, FALSE) OR image_pixels <> shared"""
    q["mask_resize_nearest"] = f"""WITH {MASKS}, g AS (SELECT a.i AS y, b.i AS x FROM range(0, 5) a(i), range(0, 5) b(i)), d AS (SELECT DISTINCT img_id FROM masks)
      SELECT d.img_id, CAST(g.y AS INT) AS y, CAST(g.x AS INT) AS x, m.cls_gt AS v FROM d CROSS JOIN g JOIN masks m ON m.img_id = d.img_id
      AND m.y = floor((g.y + 0.5) * 8 / 5) AND m.x = floor((g.x + 0.5) * 8 / 5)"""
    q["pixel_flip"] = f"""WITH {PIXELS} SELECT img_id, CASE WHEN img_id % 4 < 2 AND img_id % 2 = 0 THEN 7 - y ELSE y END AS y,
      CASE WHEN img_id % 4 < 2 AND img_id % 2 = 1 THEN 7 - x ELSE x END AS x, v FROM pixels"""

    # Joins.
    q["truth_join"] = f"""WITH {DROPPED} SELECT doc_id, CAST(length(gt) AS INT) AS gt_chars,
      CAST(CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN length(et) ELSE 0 END AS INT) AS et_chars FROM dropped"""
    q["unpaired_keys"] = "SELECT doc_id, 'result' AS missing FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
    q["image_mask_join"] = f"WITH {MASKS} SELECT img_id, y, x, v, gt FROM pixels JOIN masks USING (img_id, y, x)"
    q["image_mask_files"] = """SELECT concat('img', vec_id) AS key, CAST(1 AS BIGINT) AS n_images, concat('img', vec_id, '.png') AS image,
      CAST(CASE WHEN label IN (3, 5) THEN 0 ELSE 1 END AS BIGINT) AS n_masks, CASE WHEN label NOT IN (3, 5) THEN concat('img', vec_id, '_gt.tif') END AS mask,
      label NOT IN (3, 5) AS valid FROM embeddings"""
    q["record_pair_join"] = f"WITH {PAIRS} SELECT * FROM pairs"
    q["similar_token_join"] = f"""WITH {TOKEN_VECTORS} SELECT doc_id, word, similar_word, round(max(cosine), 5) AS cosine, count(*) AS n_pairs
      FROM close_pairs GROUP BY ALL"""
    q["similar_token_join_by_angle"] = q["similar_token_join"]
    q["vector_lookup"] = f"""WITH {TOKENS}, w AS (SELECT DISTINCT word FROM (SELECT unnest(string_split(text, ' ')) AS word FROM benchmark) WHERE word <> '')
      SELECT doc_id, count(*) AS n, CAST(sum(length(word)) AS DOUBLE) AS chars, CAST(sum(ord(word) * pos) AS DOUBLE) AS weight
      FROM tokens JOIN w USING (word) GROUP BY doc_id"""
    q["crop_boxes"] = f"""WITH {PIXELS}, {BOXES} SELECT img_id, det_no, y - y1 AS y, x - x1 AS x, v FROM pixels JOIN boxes USING (img_id)
      WHERE y >= y1 AND y < y2 AND x >= x1 AND x < x2"""
    wide = {a: f"CAST(floor(({a}1 + {a}2) / 2 {{s}} (({a}2 - {a}1) * 1.02 + 2) / 2) AS INT)" for a in "xy"}
    q["crop_boxes_padded"] = f"""WITH {PIXELS}, {BOXES}, g AS (SELECT img_id, det_no, greatest(0, {wide['x'].format(s='-')}) AS x1,
      greatest(0, {wide['y'].format(s='-')}) AS y1, {wide['x'].format(s='+')} AS x2, {wide['y'].format(s='+')} AS y2 FROM boxes)
      SELECT img_id, det_no, y - y1 AS y, x - x1 AS x, v FROM pixels JOIN g USING (img_id) WHERE y >= y1 AND y < y2 AND x >= x1 AND x < x2"""
    q["pixel_window_join"] = f"""WITH {PIXELS} SELECT a.img_id, a.y, a.x, count(*) AS n, CAST(sum(b.v) AS BIGINT) AS total, CAST(sum(b.y * 8 + b.x) AS BIGINT) AS places
      FROM pixels a JOIN pixels b ON a.img_id = b.img_id AND abs(a.y - b.y) <= 2 AND abs(a.x - b.x) <= 2 GROUP BY ALL"""
    q["cross_scalar"] = "SELECT doc_id, n_chars, (SELECT max(n_chars) FROM documents) AS longest FROM documents"
    q["entity_token_join"] = q["entity_tokens"] = f"WITH {SPANS} SELECT * FROM enttok"

    # Aggregations.
    q["ocr_error_summary"] = f"WITH {SCORED} SELECT config AS source, round(avg(wer), 2) AS wer, round(avg(cer), 2) AS cer FROM scored GROUP BY config"
    rounded = ", ".join(f"round({m}, 6) AS {m}" for m in list(METRIC_LABELS)[:5])
    q["binarization_metrics"] = f"WITH {MASKS}, {_CONFUSION.format(by='', source='masks')} SELECT img_id, {rounded} FROM measured"
    drd = _DRDM.format(k="", by="", nk="", source="masks", same="", nsame="")
    q["drdm"] = f"WITH {MASKS}, {drd} SELECT img_id, round(drdm, 6) AS drdm FROM drdms"
    q["metric_means"] = f"WITH {METHODS} SELECT * FROM means"
    q["metric_first"] = f"WITH {METHODS} SELECT method, metric, round(arg_min(value, img_id), 2) AS value FROM vals GROUP BY ALL"
    q["metric_pivot"] = f"""WITH {METHODS} SELECT metric, max(value) FILTER (method = 'fine') AS fine, max(value) FILTER (method = 'coarse') AS coarse
      FROM means GROUP BY metric"""
    labels = "CASE metric " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in METRIC_LABELS.items()) + " END"
    q["display_names"] = f"WITH {METHODS} SELECT method, {labels} AS metric, value FROM means"
    q["distinct_mask_values"] = f"WITH {PIXELS} SELECT DISTINCT v AS value FROM pixels"
    q["value_sort"] = f"WITH {PIXELS} SELECT DISTINCT v FROM pixels ORDER BY v"
    q["distinct_mask_triples"] = f"WITH {PIXELS} SELECT DISTINCT concat(v // 64, ',', v // 32, ',', v // 16) AS value FROM pixels"
    q["gray_histogram"] = f"WITH {PIXELS} SELECT img_id, v, count(*) AS n FROM pixels GROUP BY ALL"
    q["running_histogram"] = f"""WITH {PIXELS}, h AS (SELECT img_id, v, count(*) AS n FROM pixels GROUP BY ALL)
      SELECT img_id, v, n, CAST(sum(n) OVER w AS BIGINT) AS n_upto, CAST(sum(n * v) OVER w AS BIGINT) AS s_upto FROM h
      WINDOW w AS (PARTITION BY img_id ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    q["otsu_threshold"] = f"""WITH {PIXELS}, {_otsu('pixels')} SELECT img_id, y, x, v, CASE WHEN v > level THEN 255 ELSE 0 END AS e
      FROM pixels JOIN levels USING (img_id)"""
    q["l2_normalized_rates"] = f"""WITH {SCORED} SELECT config, doc_id, round(wer / nullif(sqrt(sum(wer * wer) OVER w), 0), 6) AS wer_norm,
      round(cer / nullif(sqrt(sum(cer * cer) OVER w), 0), 6) AS cer_norm FROM scored WINDOW w AS (PARTITION BY config)"""
    q["entity_record"] = f"WITH {ENTITIES} {_record('entities')}"
    q["vectors_by_label"] = f"WITH {SPANS} SELECT label, count(*) AS n_vectors, count(DISTINCT word) AS n_words FROM enttok WHERE length(word) > 2 GROUP BY label"
    q["match_rates"] = f"WITH {PAIRS} " + _per_field(
        "SELECT '{f}' AS field, round(avg(CASE WHEN \"{f}_a\" IS NOT DISTINCT FROM \"{f}_b\" THEN 1.0 ELSE 0 END) * 100, 6) AS match_rate FROM pairs")
    q["non_empty_rates"] = f"WITH {PAIRS} " + _per_field(
        "SELECT '{f}' AS field, round(avg(CASE WHEN \"{f}_a\" <> '' THEN 1.0 ELSE 0 END) * 100, 6) AS rate_a, "
        "round(avg(CASE WHEN \"{f}_b\" <> '' THEN 1.0 ELSE 0 END) * 100, 6) AS rate_b FROM pairs")
    full = " AND ".join(f'"{f}_wer" IS NOT NULL' for f in FIELDS)
    q["field_wer_means"] = f"WITH {FIELD_WER} " + _per_field(
        "SELECT '{f}' AS field, round(avg(\"{f}_wer\"), 6) AS mean_wer FROM fw WHERE " + full)
    q["dice_per_mask"] = f"WITH {MASKS} SELECT img_id, round({_DICE}, 6) AS dice FROM masks GROUP BY img_id"
    q["dice_batch"] = f"WITH {MASKS} SELECT round({_DICE}, 6) AS dice FROM masks"
    q["dice_loss"] = f"WITH {MASKS} SELECT round(1 - {_DICE}, 6) AS loss FROM masks"
    q["dice_multiclass"] = f"""WITH {MASKS} SELECT img_id, CAST(c.cls AS INT) AS cls, round((sum(CASE WHEN cls_pred = c.cls AND cls_gt = c.cls THEN 2.0 ELSE 0 END) + 1e-6)
      / (sum(CASE WHEN cls_pred = c.cls THEN 1.0 ELSE 0 END) + sum(CASE WHEN cls_gt = c.cls THEN 1.0 ELSE 0 END) + 1e-6), 6) AS dice
      FROM masks CROSS JOIN (VALUES (1), (2)) AS c(cls) GROUP BY ALL"""
    q["dice_loss_multiclass"] = f"""WITH {LOGITS}, p AS (SELECT exp(CASE target WHEN 0 THEN l0 ELSE l1 END) / (exp(l0) + exp(l1) + exp(l2)) AS p FROM logits)
      SELECT round(1 - (2 * sum(p) + 1e-6) / (2 * count(*) + 1e-6), 6) AS loss FROM p"""
    q["dice_bce_loss"] = f"""WITH {LOGITS}, p AS (SELECT l0 AS z, target AS t, 1 / (1 + exp(-l0)) AS p FROM logits)
      SELECT round(0.5 * avg(greatest(z, 0) - z * t + ln(1 + exp(-abs(z)))) + 0.5 * (1 - (2 * sum(p * t) + 1e-6) / (sum(p) + sum(t) + 1e-6)), 6) AS loss FROM p"""
    q["batch_mean_dice"] = f"""WITH {MASKS}, d AS (SELECT img_id, {_DICE} AS dice FROM masks GROUP BY img_id),
      b AS (SELECT dice, (row_number() OVER (ORDER BY img_id) - 1) // 7 AS batch FROM d),
      m AS (SELECT batch, avg(dice) AS dice FROM b GROUP BY batch HAVING count(*) = 7)
      SELECT round(coalesce(avg(dice), 0), 6) AS dice, count(*) AS n_batches FROM m"""
    q["word_frequency"] = f"WITH {TOKENS} SELECT word, count(*) AS n FROM tokens GROUP BY word"
    q["top_words"] = f"WITH {TOKENS} SELECT word, count(*) AS n FROM tokens GROUP BY word ORDER BY n DESC, word LIMIT 200"

    # Windows.
    q["sequence_index"] = """WITH p AS (SELECT page_id, concat(url, '/', page_id) AS path FROM pages), r AS (SELECT *, row_number() OVER (ORDER BY path) AS idx FROM p)
      SELECT page_id, path, idx, concat('img_', idx) AS name FROM r"""
    q["first_detection"] = f"""WITH {BOXES}, r AS (SELECT *, row_number() OVER (PARTITION BY img_id, cls ORDER BY det_no) AS r FROM boxes WHERE cls = 2)
      SELECT img_id, cls, det_no, x1, y1, x2, y2 FROM r WHERE r = 1"""
    q["exact_split"] = """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5(concat(doc_id, '-0')), doc_id) AS r, count(*) OVER () AS n FROM documents)
      SELECT doc_id, CASE WHEN r <= floor(n * CAST(0.1 AS DOUBLE)) THEN 'val' ELSE 'train' END AS split FROM r"""
    q["batching"] = """WITH r AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 7 AS batch, count(*) OVER () AS n FROM documents)
      SELECT doc_id, batch FROM r WHERE (batch + 1) * 7 <= n"""
    q["local_contrast"] = f"WITH {PIXELS}, {_NEAR} SELECT img_id, y, x, round(CAST(c AS DOUBLE), 5) AS c FROM contrast"
    q["token_pattern_match"] = f"WITH {SPANS} SELECT * FROM spans"
    q["token_pattern_list"] = q["token_pattern_match"]
    coded = "string_agg(CASE {cases} ELSE 'x' END, '' ORDER BY pos)"
    place = coded.format(cases="WHEN regexp_full_match(word, '[A-Z]+') THEN 'u' WHEN word IN ('Januar', 'Mai', 'Nov.') THEN 'm' WHEN regexp_full_match(word, '[0-9]+') THEN 'd'")
    roll = coded.format(cases="WHEN lower(word) = 'rollfilm' THEN 'r' WHEN strlen(word) = length(word) THEN 'a'")
    # The kinds of tokens are apart, so the greedy match is the longest.
    q["token_pattern_quantifiers"] = f"""WITH {SPANS}, codes AS (SELECT doc_id, {place} AS p, {roll} AS r FROM ct GROUP BY doc_id),
      starts AS (SELECT doc_id, unnest(range(length(p))) AS i, p, r FROM codes),
      found AS (SELECT doc_id, i, 'PLACE' AS label, length(regexp_extract(substr(p, i + 1), '^u+m?d*')) AS n FROM starts
        UNION ALL SELECT doc_id, i, 'ROLL', length(regexp_extract(substr(r, i + 1), '^r[ra]*x?')) FROM starts)
      SELECT doc_id, CAST(i AS INT) AS start, CAST(i + n AS INT) AS "end", label FROM found WHERE n > 0"""
    q["longest_match_resolve"] = f"WITH {SPANS} SELECT * FROM kept"
    q["film_pattern"] = f"WITH {SPANS} SELECT * FROM spans WHERE label = 'FILM'"
    months = ", ".join(f"'{m}'" for m in MONTHS)
    q["date_pattern"] = f"""WITH {SPANS} SELECT doc_id, pos, word FROM seq
      WHERE (word IN ({months}) AND regexp_full_match(nxt, '[0-9]{{4}}')) OR regexp_full_match(word, '[0-9]{{4}}')"""
    q["person_pattern"] = f"WITH {SPANS} SELECT doc_id, pos, word FROM seq WHERE word = 'Aufn.' AND regexp_full_match(nxt, '[A-Z][a-z]+')"
    joined = """, parts AS (SELECT kept.doc_id, kept.start, kept.label, string_agg(ct.word, ' ' ORDER BY ct.pos) AS text FROM kept JOIN ct
      ON ct.doc_id = kept.doc_id AND ct.pos >= kept.start AND ct.pos < kept."end" GROUP BY ALL)"""
    q["caption_records"] = f"WITH {SPANS} {joined}, rec AS ({_record('parts')}) SELECT captions.doc_id, " + ", ".join(
        f'"{f}"' for f in FIELDS) + " FROM captions LEFT JOIN rec USING (doc_id)"

    # Sorts and set operations.
    q["path_sort"] = "SELECT page_id, url AS path FROM pages ORDER BY url"
    summary = "SELECT config AS source, round(avg(wer), 2) AS wer, round(avg(cer), 2) AS cer FROM scored {where} GROUP BY config"
    q["append_results"] = (f"WITH {SCORED} " + summary.format(where="") + " UNION ALL " + summary.format(where="WHERE config = 'drop vowels'"))
    q["concat_unique"] = f"WITH {MASKS} SELECT gt AS value FROM masks UNION SELECT cls_gt FROM masks UNION SELECT cls_pred FROM masks"

    # Scalar functions.
    q["cer"] = f"WITH {DROPPED} SELECT doc_id, round({_cer('gt', 'et')}, 6) AS cer FROM dropped"
    q["wer"] = f"WITH {SCORED} SELECT config, doc_id, round(wer, 6) AS wer FROM scored"
    q["field_wer"] = f"WITH {FIELD_WER} SELECT doc_id, " + ", ".join(f'round("{f}_wer", 6) AS "{f}_wer"' for f in FIELDS) + " FROM fw"
    q["text_normalize"] = """SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(concat(' ', chr(10), replace(text, '.', concat('. ', chr(9), ' ')), chr(10)),
      '\\s\\s+', ' ', 'g'), '^\\s+', ''), '\\s+$', '') AS text FROM documents"""
    q["json_repair_parse"] = f"WITH {RAW_JSON} " + _ANSWER.format(ok="kind <> 2")
    q["json_strict_parse"] = f"WITH {RAW_JSON} " + _ANSWER.format(ok="kind NOT IN (1, 2)")
    q["build_messages"] = """SELECT conv_id, turn, 0 AS place, 'system' AS role, 'Answer with the five fields.' AS content FROM conversations
      UNION ALL SELECT conv_id, turn, 1, 'user', text FROM conversations"""
    q["conversation_fold"] = """SELECT conv_id, CAST(count(*) AS INT) AS n, string_agg(concat(role, ': ', text), ' | ' ORDER BY turn) AS messages
      FROM conversations GROUP BY ALL"""
    masked = f"{_otsu('pixels')}, masked AS (SELECT img_id, y, x, v, CASE WHEN v > level THEN 255 ELSE 0 END AS e FROM pixels JOIN levels USING (img_id))"
    q["su_threshold"] = f"WITH {PIXELS}, {masked}, {_decide('masked')} SELECT img_id, y, x, b FROM decided"
    q["su_threshold_paper"] = f"""WITH {PIXELS}, {masked}, s AS (SELECT a.img_id, a.y, a.x, any_value(a.v) AS v, CAST(count(*) FILTER (b.e = 255) AS DOUBLE) AS n,
      CAST(coalesce(sum(b.v) FILTER (b.e = 255), 0) AS DOUBLE) AS s, CAST(coalesce(sum(b.v * b.v) FILTER (b.e = 255), 0) AS DOUBLE) AS q
      FROM masked a JOIN masked b ON a.img_id = b.img_id AND b.y BETWEEN a.y - 1 AND a.y + 1 AND b.x BETWEEN a.x - 1 AND a.x + 1
      AND NOT (a.y = b.y AND a.x = b.x) GROUP BY a.img_id, a.y, a.x)
      SELECT img_id, y, x, CASE WHEN n >= 3 AND v <= s / n + sqrt((n * q - s * s) / (n * n)) / 2 THEN 0 ELSE 255 END AS b FROM s"""
    q["su_binarize"] = f"""WITH {PIXELS}, {_NEAR}, cimg AS (SELECT img_id, y, x, CAST(floor(c * CAST(255 AS FLOAT)) AS INT) AS v FROM contrast),
      {_otsu('cimg')}, masked AS (SELECT p.img_id, p.y, p.x, p.v, CASE WHEN cimg.v > level THEN 255 ELSE 0 END AS e FROM pixels p
      JOIN cimg ON p.img_id = cimg.img_id AND p.y = cimg.y AND p.x = cimg.x JOIN levels ON p.img_id = levels.img_id), {_decide('masked')} SELECT * FROM decided"""
    q["su_binarize_images"] = q["su_binarize"].replace("SELECT * FROM decided", "SELECT img_id, y, x, b FROM decided")
    q["su_binarize_paper"] = _paper_binarize(1)
    q["su_binarize_images_paper"] = _paper_binarize(2)
    q["round2"] = "SELECT o_orderkey, round(o_totalprice / 7, 2) AS value FROM orders"
    q["cosine"] = "SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[]), 5) AS cosine FROM embeddings"

    # Whole documents under settings whose distance is known.
    drop, mask = "regexp_replace(gt, ' th[^ ]*', '', 'g')", f"translate({{t}}, 'ou', '{UNREAD * 2}')"
    unread = f"len(list_filter({{w}}, lambda w: contains(w, '{UNREAD}')))"
    docs = "docs AS (SELECT doc_id, text AS gt FROM documents)"
    n_chars, n_words = f"length({_strip('gt')})", f"len({_words('gt')})"

    def known(name: str, et: str, chars: str, words: str) -> str:
        """Rates from numbers of edits; ``et`` is the setting's result."""
        return (f"SELECT '{name}' AS config, CAST({words} AS DOUBLE) / nullif({n_words}, 0) AS wer, "
                f"CAST({chars} AS DOUBLE) / nullif({n_chars}, 0) AS cer FROM (SELECT gt, {et} AS et FROM docs)")
    shorter, longer = f"{n_chars} - length({_strip('et')})", f"length({_strip('et')}) - {n_chars}"
    marks = f"replace(gt, '. ', '. {UNREAD} ')"
    q["config_sweep"] = (f"WITH {docs}, scored AS (" + " UNION ALL ".join([
        known("drop words", drop, shorter, f"{n_words} - len({_words('et')})"),
        known("mask letters", mask.format(t="gt"), f"len(regexp_extract_all({_strip('gt')}, '[ou]'))", unread.format(w=_words("et"))),
        known("insert marks", marks, longer, f"len({_words('et')}) - {n_words}"),
    ]) + ") SELECT config AS source, round(avg(wer), 2) AS wer, round(avg(cer), 2) AS cer FROM scored GROUP BY config")
    edited = f"""WITH {docs}, e AS (SELECT doc_id, gt, {mask.format(t=drop)} AS et FROM docs),
      w AS (SELECT doc_id, {_words('gt')} AS gw, {_words('et')} AS ew FROM e),
      c AS (SELECT doc_id, len(gw) AS n, len(ew) AS m, {unread.format(w='ew')} AS masked FROM w)"""
    q["wer_documents"] = f"{edited} SELECT doc_id, round(CAST(n - m + masked AS DOUBLE) / nullif(n, 0), 6) AS wer FROM c"
    q["edit_stats_documents"] = f"{edited} SELECT doc_id, m - masked AS hits, masked AS substitutions, n - m AS deletions, 0 AS insertions FROM c"
    spread = """cells AS (SELECT label, generate_subscripts(vec, 1) AS i, CAST(unnest(vec) AS DOUBLE) AS x FROM v),
      var AS (SELECT label, i, var_pop(x) AS var, count(*) AS n FROM cells GROUP BY ALL)
      SELECT label, max(n) AS n, round(sum(var), 5) AS variance, TRUE AS centred_and_apart, TRUE AS largest_first FROM var GROUP BY label"""
    q["label_spread"] = f"WITH v AS (SELECT CAST(CASE WHEN label <> 4 THEN label END AS VARCHAR) AS label, embedding AS vec FROM embeddings), {spread}"
    q["label_spread_wide"] = q["label_spread"]
    q["word_spread"] = f"WITH v AS (SELECT 'all' AS label, embedding AS vec FROM embeddings), {spread}"

    # Answers of a model, parsed and compared.
    broken = "doc_id % 7 = 3"
    nulled = ", ".join(f'CASE WHEN NOT ({broken}) THEN "{f}" END AS "{f}"' for f in FIELDS)
    answers = FIELD_WER.replace("FROM rec_a a JOIN rec_b b", "FROM rec_a a JOIN rec_c b").replace(
        "pairs AS (", f"rec_c AS (SELECT doc_id, {nulled} FROM rec_b),\npairs AS (", 1)
    q["answer_comparison"] = f"WITH {answers} " + _per_field(
        "SELECT '{f}' AS field, round(avg(CASE WHEN p.\"{f}_a\" IS NOT DISTINCT FROM p.\"{f}_b\" THEN 1.0 ELSE 0 END) * 100, 6) AS match_rate, "
        f"round(avg(CASE WHEN {full} THEN \"{{f}}_wer\" END), 6) AS mean_wer, "
        "round(avg(CASE WHEN p.\"{f}_a\" <> '' THEN 1.0 ELSE 0 END) * 100, 6) AS rate_a, "
        "round(avg(CASE WHEN p.\"{f}_b\" <> '' THEN 1.0 ELSE 0 END) * 100, 6) AS rate_b, "
        f"(SELECT count(*) FROM rec_b WHERE {broken}) AS n_errors FROM pairs p JOIN fw ON p.doc_id = fw.doc_id")

    # Decoded images and several classes.
    q["gray"] = q["gray_images"] = f"""WITH {PIXELS} SELECT img_id, y, x,
      CAST(floor(0.299::DOUBLE * (255 - v) + 0.587::DOUBLE * (v * 3 % 256) + 0.114::DOUBLE * v + 0.5) AS INT) AS v FROM pixels"""
    q["batch_mean_dice_multiclass"] = f"""WITH {MASKS}, c AS ({q['dice_multiclass'].split('WITH ' + MASKS)[1].replace(', 6) AS dice', ', 12) AS dice')}),
      d AS (SELECT img_id, avg(dice) AS dice FROM c GROUP BY img_id),
      b AS (SELECT dice, (row_number() OVER (ORDER BY img_id) - 1) // 7 AS batch FROM d),
      m AS (SELECT batch, avg(dice) AS dice FROM b GROUP BY batch HAVING count(*) = 7)
      SELECT round(coalesce(avg(dice), 0), 6) AS dice, count(*) AS n_batches FROM m"""

    # Image rows: the same results as the pixel forms.
    for name, same in {"pixel_scale_images": "pixel_scale", "pixel_flip_images": "pixel_flip", "mask_resize_images": "mask_resize_nearest",
                       "binarization_metrics_images": "binarization_metrics", "drdm_images": "drdm", "dice_images": "dice_multiclass"}.items():
        q[name] = q[same]
    q["otsu_images"] = q["otsu_threshold"].replace("SELECT img_id, y, x, v, CASE", "SELECT img_id, y, x, CASE")
    page = PIXELS.replace("SELECT vec_id AS img_id, CAST((i - 1) // 8 AS INT) AS y, CAST((i - 1) % 8 AS INT) AS x",
                          "SELECT vec_id // 300 AS img_id, CAST(vec_id % 300 AS INT) AS y, CAST(i - 1 AS INT) AS x")
    q["su_binarize_pages"] = q["su_binarize_page_images"] = q["su_binarize_images"].replace(PIXELS, page)
    hexed = "upper(string_agg(printf('%02x', {v}), '' ORDER BY y, x))"
    q["image_mask_pairs"] = f"""WITH {MASKS} SELECT img_id, CAST(8 AS INT) AS height, CAST(8 AS INT) AS width, {hexed.format(v='v')} AS data, {hexed.format(v='gt')} AS mask
      FROM pixels JOIN masks USING (img_id, y, x) GROUP BY img_id"""
    q["mask_checks_images"] = f"""WITH {MASKS}, f AS (SELECT img_id, CAST(max(CASE WHEN v > 200 THEN 3 ELSE cls_gt END) AS INT) AS high, img_id % 5 = 0 AS bad_size
      FROM masks JOIN pixels USING (img_id, y, x) WHERE y < 7 OR img_id % 5 <> 0 GROUP BY img_id)
      SELECT *, high >= 3 AS bad_range FROM f WHERE high >= 3 OR bad_size"""

    # Caller-supplied models and Arrow functions.
    q["batch_infer"] = """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
      s AS (SELECT vec_id, (i - 1) // 8 AS eighth, sum(v) AS score FROM e GROUP BY ALL),
      r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, eighth) AS r FROM s)
      SELECT vec_id, eighth, round(score, 5) AS score FROM r WHERE r = 1"""
    q["edit_stats"] = f"""WITH {CAPTIONS}, swept AS ({_swept(_EDITS)}), w AS (SELECT config, doc_id, {_words('gt')} AS gw, {_words('et')} AS ew FROM swept),
      v AS (SELECT *, list_distinct(list_concat(gw, ew)) AS voc FROM w)
      SELECT config, doc_id, levenshtein({_coded('gw', 'voc')}, {_coded('ew', 'voc')}) AS edits, len(gw) AS truth_words, len(ew) - len(gw) AS growth FROM v"""
    q["append_runs"], q["caption_stream"] = q["wer"], q["caption_records"]
    q["image_scan"] = f"""WITH {PIXELS} SELECT concat('img_', img_id, '.png') AS name, img_id, img_id % 50 = 7 AS broken,
      CASE WHEN img_id % 50 <> 7 THEN 8 END AS height, CASE WHEN img_id % 50 <> 7 THEN 8 END AS width,
      CASE WHEN img_id % 50 <> 7 THEN string_agg(printf('%02X', v), '' ORDER BY y, x) END AS pixels FROM pixels GROUP BY img_id"""
    q["infer_sweep"] = """WITH s(config, gain, level) AS (VALUES ('plain', 1.0::DOUBLE, 0.125::DOUBLE), ('loud', 2.0, 0.125), ('none', 0.0, 0.5)),
      e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v FROM embeddings)
      SELECT config, vec_id, CAST(count(*) FILTER (v * gain > level) AS DOUBLE) AS n_above FROM e CROSS JOIN s GROUP BY ALL"""
    k = "regexp_extract(props, '([0-9]+)', 1)"
    q["json_any_shape"] = f"""SELECT event_id, CASE event_id % 5 WHEN 2 THEN NULL WHEN 3 THEN 'array' WHEN 4 THEN 'other' ELSE 'object' END AS kind,
      CASE WHEN event_id % 5 = 1 THEN 'F 1' END AS "Film", CASE WHEN event_id % 5 = 1 THEN '1938' END AS "Date",
      CASE event_id % 5 WHEN 0 THEN concat('k=', {k}) WHEN 1 THEN concat('k=', {k}, ';k2=null;more={{"a":[1,"ü"]}}') END AS extra,
      CASE event_id % 5 WHEN 0 THEN concat('{{"k":', {k}, '}}') WHEN 1 THEN concat('{{"Date":1938,"Film":"F 1","k":', {k}, ',"k2":null,"more":{{"a":[1,"ü"]}}}}')
        WHEN 3 THEN concat('[{{"k":', {k}, '}},"x"]') WHEN 4 THEN '"no record"' END AS answer,
      CASE WHEN event_id % 5 = 2 THEN 'Failed to decode response' END AS error FROM events"""
    return q
