"""DuckDB SQL with the same rows as the query of the same name."""

from __future__ import annotations

from recolith import lexicon as lx
from recolith.queries import CUT, SAMPLE_LIMIT
from recolith.sources.view import FORMS, LANGUAGES


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(items) -> str:
    return "[" + ", ".join(_q(x) for x in items) + "]"


def _map(table: dict[str, str]) -> str:
    return f"MAP {{{', '.join(f'{_q(k)}: {_q(v)}' for k, v in table.items())}}}"


def _fold(expr: str, rules) -> str:
    for pattern, new in rules:
        expr = f"regexp_replace({expr}, {_q(pattern)}, {_q(new)}, 'g')"
    return expr


def _tokens(expr: str) -> str:
    return f"list_filter(string_split(regexp_replace({expr}, '[^a-z0-9]+', ' ', 'g'), ' '), lambda t: t <> '')"


def _replaced(tokens: str, table: dict[str, str]) -> str:
    return f"list_transform({tokens}, lambda t: coalesce({_map(table)}[t], t))"


_DOTS = (
    r"array_to_string(list_transform(regexp_extract_all({s}, '(?s)(?:\b[a-z](?:\.[a-z]\b)*\.[a-z0-9_])|.'), "
    r"lambda m: CASE WHEN regexp_full_match(m, '[a-z](\.[a-z])*\.[a-z0-9_]') THEN replace(m, '.', '') ELSE m END), '')"
)

W = "string_split(regexp_replace(coalesce(text, ''), '[ \\t\\r\\n\\f]+', ' ', 'g'), ' ')"
_word = [f"coalesce(w[{k}], '')" for k in range(1, 6)]
REC = f"""
d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, {W} AS w FROM documents),
rec AS (
  SELECT 'S' || (1 + doc_id % 3) || '-' || lpad(doc_id::VARCHAR, 8, '0') AS entity_id,
    {_word[0]} || ' ' || {_word[1]} || ' ' || {_word[2]} || CASE WHEN f <> '' THEN ' ' || f ELSE '' END AS business_name,
    (100 + length({_word[0]}) * 10 + length({_word[1]})) || ' ' || {_word[3]} || ' Street, ' || {_word[4]}
      || CASE WHEN doc_id % 4 = 0 THEN '' ELSE ' ' || (10000 + length({_word[0]}) * 1000 + length({_word[1]}) * 100 + length({_word[2]}) * 10) END AS business_address,
    CASE WHEN doc_id % 97 = 0 THEN '' ELSE coalesce({_map(LANGUAGES)}[lang], lang) END AS country,
    doc_id AS load_seq, substr(text, 1, 60) AS head, lang
  FROM (SELECT *, {_list(FORMS)}[1 + doc_id % 5] AS f FROM d)
),
truth AS (
  SELECT a.entity_id AS s1_id, b.entity_id AS target_id FROM rec a JOIN rec b ON a.head = b.head AND a.lang = b.lang
  WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%'
),
entities AS (SELECT entity_id AS s1_id FROM rec WHERE entity_id LIKE 'S1-%'),
truth_table AS (
  SELECT s1_id AS source1_entity_id, coalesce(string_agg(target_id, ',' ORDER BY target_id), '') AS matched_entity_ids
  FROM entities LEFT JOIN truth USING (s1_id) GROUP BY s1_id
)"""

_plain = "strip_accents(business_name)"
_lowered = "replace(replace(lower(strip_accents(business_name)), '&', ' and '), '@', ' at ')"
_controls = r"regexp_replace({s}, '[\x{{FFFD}}\x00-\x1f\x7f-\x9f]', ' ', 'g')"
_name2 = _fold(_DOTS.format(s="n1"), [(r"\bwal-mart\b", "walmart"), (r"['’]s\b", "s"), ("['’]", ""), *lx.LEGAL_PHRASES])
_stop = "|".join(x for x in lx.TRAILING_STOPWORDS if x.isalpha())
_legal = _list(sorted(set(lx.LEGAL_SUFFIXES.values())))
_address = _fold(_controls.format(s="replace(lower(strip_accents(business_address)), '&', ' and ')"), [(rf"\b{k}\b", v) for k, v in lx.STATES.items()])

CLEAN = f"""{REC},
n1 AS (SELECT *, {_controls.format(s=_lowered)} AS n1 FROM rec),
n2 AS (SELECT *, array_to_string({_replaced(_tokens(_name2), lx.LEGAL_SUFFIXES)}, ' ') AS clean_name,
    array_to_string({_replaced(_tokens(_address), lx.ADDRESS_ABBREVIATIONS)}, ' ') AS clean_address, upper(trim(country)) AS label FROM n1),
n3 AS (SELECT *, ltrim(regexp_replace(' ' || array_to_string(list_filter(string_split(clean_name, ' '), lambda t: t <> '' AND NOT list_contains({_legal}, t)), ' '), '( ({_stop}))+$', '')) AS core FROM n2),
clean AS (SELECT entity_id, business_name, load_seq, clean_name, CASE WHEN core = '' THEN clean_name ELSE core END AS core_name, clean_address,
    coalesce({_map(lx.COUNTRIES)}[label], label) AS clean_country FROM n3)"""

_NAME = f"list_filter(string_split(core_name, ' '), lambda t: t <> '' AND NOT list_contains({_list(lx.GENERIC_NAME_WORDS)}, t))"
_PARTS = "list_filter(string_split(clean_address, ' '), lambda t: t <> '')"
KEYS = f"""{CLEAN},
k1 AS (SELECT entity_id, CASE WHEN clean_country = '' THEN 'UNK' ELSE clean_country END AS country, core_name AS c, replace(core_name, ' ', '') AS j, {_NAME} AS nw,
    list_filter({_PARTS}, lambda t: regexp_full_match(t, '[0-9]+')) AS dg,
    list_filter({_PARTS}, lambda t: NOT regexp_full_match(t, '[0-9]+') AND length(t) >= 4 AND NOT list_contains({_list(lx.GENERIC_ADDRESS_WORDS)}, t)) AS st FROM clean),
keys AS (
  SELECT entity_id, country, 'CN' AS key_type, c AS key FROM k1 WHERE length(c) >= 3
  UNION ALL SELECT entity_id, country, '2W', nw[1] || '_' || nw[2] FROM k1 WHERE len(nw) >= 2
  UNION ALL SELECT entity_id, country, '1W', nw[1] FROM k1 WHERE length(nw[1]) >= 3
  UNION ALL SELECT entity_id, country, 'PFX4', j[1:4] FROM k1 WHERE length(j) >= 4
  UNION ALL SELECT entity_id, country, 'PFX5', j[1:5] FROM k1 WHERE length(j) >= 5
  UNION ALL SELECT entity_id, country, 'PIN_NAME', list_filter(dg, lambda t: length(t) IN (5, 6))[1] || '_' || nw[1] FROM k1 WHERE length(nw[1]) >= 3 AND len(list_filter(dg, lambda t: length(t) IN (5, 6))) > 0
  UNION ALL SELECT entity_id, country, 'ADDR2W', st[1] || '_' || st[2] FROM k1 WHERE len(st) >= 2
  UNION SELECT entity_id, country, 'ADDR', n || '_' || s FROM (SELECT entity_id, country, unnest(dg[1:2]) AS n, st FROM k1) x, LATERAL (SELECT unnest(x.st[1:3]) AS s) y
)"""
SCORES = f"""{KEYS},
scores AS (
  SELECT a.entity_id AS s1_id, b.entity_id AS target_id, sum({_map({k: str(v) for k, v in lx.KEY_WEIGHTS.items()})}[a.key_type]::BIGINT)::BIGINT AS score
  FROM keys a JOIN keys b USING (country, key_type, key) WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%' GROUP BY ALL
)"""
RANKED = f"""{SCORES},
ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, target_id) AS rank FROM scores) WHERE rank <= 25)"""

_words = "list_distinct(list_filter(string_split({c}, ' '), lambda t: t <> ''))"
_grams = "CASE WHEN length({c}) >= 3 THEN list_distinct(list_transform(range(1, length({c}) - 1), lambda i: substr({c}, i, 3))) ELSE [] END"


def _jac(a: str, b: str) -> str:
    common = f"len(list_intersect({a}, {b}))"
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE {common}::DOUBLE / (len({a}) + len({b}) - {common}) END"


FEATS = f"""{RANKED},
p AS (SELECT entity_id AS id, clean_name AS cn, core_name AS co, clean_address AS ca, {_words.format(c="core_name")} AS nw, {_grams.format(c="core_name")} AS ng,
    {_words.format(c="clean_address")} AS aw, {_grams.format(c="clean_address")} AS ag FROM clean),
p2 AS (SELECT *, list_filter(aw, lambda t: regexp_full_match(t, '[0-9]+')) AS an, list_filter(aw, lambda t: regexp_full_match(t, '[0-9]{{5,6}}')) AS ap FROM p),
feats AS (
  SELECT s1_id, target_id,
    CASE WHEN a.co <> '' AND a.co = b.co THEN 1.0 ELSE 0.0 END::DOUBLE AS feat_name_exact_core,
    CASE WHEN a.cn <> '' AND a.cn = b.cn THEN 1.0 ELSE 0.0 END::DOUBLE AS feat_name_exact_clean,
    {_jac("a.nw", "b.nw")}::DOUBLE AS feat_name_token_jaccard, {_jac("a.ng", "b.ng")}::DOUBLE AS feat_name_char_trigram_jaccard,
    CASE WHEN a.co = b.co THEN 1.0 WHEN a.co = '' OR b.co = '' THEN 0.0 ELSE 1 - levenshtein(a.co, b.co)::DOUBLE / greatest(length(a.co), length(b.co)) END::DOUBLE AS feat_name_levenshtein_ratio,
    abs(length(a.co) - length(b.co))::DOUBLE AS feat_name_length_diff,
    CASE WHEN greatest(length(a.co), length(b.co)) = 0 THEN 0.0 ELSE least(length(a.co), length(b.co))::DOUBLE / greatest(length(a.co), length(b.co)) END::DOUBLE AS feat_name_length_ratio,
    CASE WHEN a.ca <> '' AND a.ca = b.ca THEN 1.0 ELSE 0.0 END::DOUBLE AS feat_addr_exact_clean,
    {_jac("a.aw", "b.aw")}::DOUBLE AS feat_addr_token_jaccard, {_jac("a.ag", "b.ag")}::DOUBLE AS feat_addr_char_trigram_jaccard,
    CASE WHEN len(a.ap) > 0 AND len(b.ap) > 0 THEN CASE WHEN len(list_intersect(a.ap, b.ap)) > 0 THEN 1.0 ELSE 0.0 END ELSE 0.5 END::DOUBLE AS feat_postal_exact_match,
    {_jac("a.an", "b.an")}::DOUBLE AS feat_number_overlap_ratio,
    CASE WHEN target_id LIKE 'S2-%' THEN 1.0 ELSE 0.0 END::DOUBLE AS feat_is_s2, CASE WHEN target_id LIKE 'S3-%' THEN 1.0 ELSE 0.0 END::DOUBLE AS feat_is_s3
  FROM ranked JOIN p2 a ON s1_id = a.id JOIN p2 b ON target_id = b.id
)"""
SCORED = f"""{FEATS},
scored AS (SELECT s1_id, target_id, round(0.35::DOUBLE * feat_name_token_jaccard + 0.25::DOUBLE * feat_name_char_trigram_jaccard + 0.20::DOUBLE * feat_addr_token_jaccard
    + 0.10::DOUBLE * feat_postal_exact_match + 0.10::DOUBLE * feat_name_exact_core, 6) AS prob FROM feats)"""

_F = """
    CASE WHEN n_true = 0 THEN CASE WHEN n_pred = 0 THEN 1.0 ELSE 0.0 END WHEN n_pred = 0 OR n_tp = 0 THEN 0.0
      ELSE 1.25 * (n_tp / n_pred) * (n_tp / n_true) / (0.25 * (n_tp / n_pred) + (n_tp / n_true)) END::DOUBLE AS f05,
    CASE WHEN n_true = 0 THEN CASE WHEN n_pred = 0 THEN 1.0 ELSE 0.0 END WHEN n_pred = 0 THEN 0.0 ELSE n_tp / n_pred END::DOUBLE AS precision,
    CASE WHEN n_true = 0 THEN CASE WHEN n_pred = 0 THEN 1.0 ELSE 0.0 END WHEN n_pred = 0 THEN 0.0 ELSE n_tp / n_true END::DOUBLE AS recall"""
PER = f"""{SCORED},
pred AS (SELECT s1_id, target_id FROM scored WHERE prob >= {CUT}),
per AS (SELECT *, {_F} FROM (
  SELECT s1_id, (SELECT count(*) FROM truth t WHERE t.s1_id = e.s1_id) AS n_true, (SELECT count(*) FROM pred p WHERE p.s1_id = e.s1_id) AS n_pred,
    (SELECT count(*) FROM truth t JOIN pred p USING (s1_id, target_id) WHERE t.s1_id = e.s1_id) AS n_tp FROM entities e))"""
SWEEP = f"""{SCORED},
grid AS (SELECT step, 0.1::DOUBLE + step * ((0.1::DOUBLE + 0.01::DOUBLE) - 0.1::DOUBLE) AS threshold FROM range(86) t(step)),
hit AS (SELECT s.s1_id, prob, t.s1_id IS NOT NULL AS tp FROM scored s LEFT JOIN truth t USING (s1_id, target_id)),
tcount AS (SELECT s1_id, count(*) AS n FROM truth GROUP BY s1_id),
pcount AS (SELECT step, s1_id, count(*) AS n_pred, count(*) FILTER (tp) AS n_tp FROM grid JOIN hit ON prob >= threshold GROUP BY ALL),
cell AS (SELECT step, threshold, s1_id, coalesce(n, 0) AS n_true, coalesce(n_pred, 0) AS n_pred, coalesce(n_tp, 0) AS n_tp
  FROM grid CROSS JOIN entities LEFT JOIN tcount USING (s1_id) LEFT JOIN pcount USING (step, s1_id)),
sweep AS (SELECT step, threshold, avg(f05) AS f05, avg(precision) AS precision, avg(recall) AS recall FROM (SELECT step, threshold, {_F} FROM cell) GROUP BY ALL)"""
TAKEN = f"""{RANKED},
taken AS (SELECT s1_id, target_id FROM ranked UNION SELECT s1_id, target_id FROM truth),
neg AS (SELECT s1_id, count(*) AS n FROM ranked ANTI JOIN truth USING (s1_id, target_id) GROUP BY s1_id),
need AS (SELECT entity_id AS s1_id, clean_country, 5 - coalesce(n, 0) AS needed FROM clean LEFT JOIN neg ON entity_id = s1_id WHERE entity_id LIKE 'S1-%'),
distractors AS (SELECT s1_id, target_id FROM (
  SELECT n.s1_id, c.entity_id AS target_id, needed, row_number() OVER (PARTITION BY n.s1_id ORDER BY load_seq) AS r
  FROM need n JOIN clean c ON n.clean_country = c.clean_country AND c.entity_id NOT LIKE 'S1-%' ANTI JOIN taken t ON t.s1_id = n.s1_id AND t.target_id = c.entity_id WHERE needed > 0) WHERE r <= needed)"""

_ID_COLS = ("entity_id", "business_name", "business_address", "country")
_norm_core = "ltrim(regexp_replace(' ' || trim(regexp_replace(replace(lower(business_name), '&', ' and '), '[^a-z0-9]+', ' ', 'g')), '( (" + "|".join(lx.INDEX_LEGAL) + "))+$', ''))"
NORM = f"""{REC},
m1 AS (SELECT entity_id, load_seq, coalesce({_map(lx.COUNTRIES)}[upper(trim(country))], upper(trim(country))) AS country, {_norm_core} AS core,
    regexp_extract(business_address, '(?:^|\\D)(\\d{{5,6}})(?:\\D|$)', 1) AS postal FROM rec),
norm AS (SELECT entity_id, load_seq, country, core, CASE WHEN length(replace(core, ' ', '')) >= 4 THEN replace(core, ' ', '')[1:4] ELSE '' END AS pfx, postal FROM m1)"""
TIERS = (
    f"{NORM}, "
    + ", ".join(
        f"t{k} AS (SELECT * FROM (SELECT a.entity_id AS s1_id, b.entity_id AS target_id, {k} AS tier, b.load_seq, row_number() OVER (PARTITION BY a.entity_id ORDER BY b.load_seq) AS n "
        f"FROM norm a JOIN norm b USING (country, {c}) WHERE {c} <> '' AND a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%') WHERE n <= 25)"
        for k, c in enumerate(("core", "pfx", "postal"), 1)
    )
    + """, every AS (SELECT s1_id, target_id, min(tier) AS tier, min(load_seq) AS load_seq FROM (FROM t1 UNION ALL FROM t2 UNION ALL FROM t3) GROUP BY ALL)"""
)
LINES = f"""{REC},
raw AS (SELECT substr(source1_entity_id, 4, 8)::BIGINT AS n, source1_entity_id AS s1, matched_entity_ids AS m FROM truth_table),
line AS (SELECT n + 2 AS line_no, s1, n % 50 <> 0 AS tab, CASE WHEN n % 70 = 0 THEN ['S1-1', 'X-2', 'X-2'] WHEN m = '' THEN [] ELSE string_split(m, ',') END AS ids FROM raw),
bad AS (
  SELECT 'V3_no_tab' AS rule, line_no::VARCHAR AS x FROM line WHERE NOT tab
  UNION ALL SELECT 'V5_repeated_id', s1 FROM line WHERE tab AND len(ids) <> len(list_distinct(ids))
  UNION ALL SELECT 'V6_self_match', id FROM (SELECT unnest(ids) AS id FROM line WHERE tab) WHERE id LIKE 'S1-%'
  UNION ALL SELECT 'V7_prefix', id FROM (SELECT unnest(ids) AS id FROM line WHERE tab) WHERE id NOT LIKE 'S_-%'
  UNION ALL SELECT 'V9_missing_row', s1 FROM line WHERE NOT tab
)"""

BROKEN = f"""{REC},
raw AS (SELECT substr(source1_entity_id, 4, 8)::BIGINT AS n, source1_entity_id AS s1, CASE WHEN matched_entity_ids = '' THEN [] ELSE string_split(matched_entity_ids, ',') END AS ids FROM truth_table),
item AS (SELECT s1, unnest(CASE WHEN n % 36 = 0 THEN list_append(ids, 'S3-none') ELSE ids END) AS id FROM raw),
broken AS (
  SELECT 'V4_duplicate_row' AS rule, 'error' AS severity, s1 AS x FROM raw WHERE n % 30 = 0
  UNION ALL SELECT 'V8_unknown_id', 'error', id FROM item WHERE id = 'S3-none'
  UNION ALL SELECT 'V10_extra_row', 'error', 'S1-x' || n FROM raw WHERE n % 45 = 0
  UNION ALL SELECT 'V11_not_candidate', 'warning', s1 FROM item WHERE id = 'S3-none'
)"""
#: Letters of a are matched, in order, to the first free equal letter of b within reach.
WINKLER = """
couple AS (SELECT s1_id, target_id, a.core_name AS a, b.core_name AS b FROM ranked JOIN clean a ON s1_id = a.entity_id JOIN clean b ON target_id = b.entity_id),
walk AS (
  SELECT DISTINCT a, b, greatest(0, greatest(length(a), length(b)) // 2 - 1) AS reach, 0 AS i, []::BIGINT[] AS taken, '' AS letters FROM couple WHERE a <> b AND a <> '' AND b <> ''
  UNION ALL SELECT a, b, reach, i + 1, CASE WHEN j IS NULL THEN taken ELSE list_append(taken, j) END, letters || CASE WHEN j IS NULL THEN '' ELSE substr(a, i + 1, 1) END
  FROM (SELECT *, list_min(list_filter(range(greatest(1, i + 1 - reach), least(length(b), i + 1 + reach) + 1), lambda k: substr(b, k, 1) = substr(a, i + 1, 1) AND NOT list_contains(taken, k))) AS j FROM walk WHERE i < length(a))
),
met AS (SELECT a, b, len(taken)::DOUBLE AS m, len(list_filter(range(1, len(taken) + 1), lambda k: substr(letters, k, 1) <> substr(b, list_sort(taken)[k], 1))) / 2.0::DOUBLE AS moved FROM walk WHERE i = length(a)),
jaro AS (SELECT a, b, CASE WHEN m = 0 THEN 0.0 ELSE (m / length(a) + m / length(b) + (m - moved) / m) / 3 END::DOUBLE AS j,
  len(list_filter([1, 2, 3, 4], lambda k: least(length(a), length(b)) >= k AND substr(a, 1, k) = substr(b, 1, k))) AS prefix FROM met),
winkler AS (SELECT s1_id, target_id, CASE WHEN a = b THEN 1.0 WHEN a = '' OR b = '' THEN 0.0 WHEN j = 0 THEN 0.0 ELSE j + prefix * 0.1::DOUBLE * (1 - j) END::DOUBLE AS jw FROM couple LEFT JOIN jaro USING (a, b))"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def _feature(*names: str) -> str:
    return _with(FEATS, "SELECT s1_id, target_id, " + ", ".join(f"round({n}, 6) AS {n}" for n in names) + " FROM feats")


_native = [f for f in lx.FEATURES if f != "feat_name_jaro_winkler"]
_rx = {k: _q(v) for k, v in lx.PATTERNS.items()}
_profile = " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) AS n, count(*) FILTER (trim(v) = '') AS missing, count(*) FILTER (v <> '' AND trim(v) = '') AS whitespace_only, "
    f"count(*) FILTER (contains(v, chr(65533))) AS corrupt, round(100.0 * count(*) FILTER (trim(v) = '') / count(*), 3)::DOUBLE AS missing_pct FROM (SELECT {c} AS v FROM rec)"
    for c in _ID_COLS
)
_lengths = " UNION ALL ".join(
    f"SELECT '{c}' AS column, min(n) AS shortest, round(avg(n), 2) AS mean, median(n)::DOUBLE AS middle, max(n) AS longest, count(*) FILTER (n <= 1) AS very_short, count(*) FILTER (n > 150) AS very_long FROM (SELECT length({c}) AS n FROM rec)"
    for c in _ID_COLS[1:3]
)
_fr, _in, _us = "c IN ('FR', 'FRANCE')", "c IN ('IN', 'INDIA')", "c IN ('US', 'USA', 'UNITED STATES')"


def _hits(who: str, what: str, name: str) -> str:
    return f"count(*) FILTER ({who} AND {what}) AS {name}"


def _has(col: str, key: str) -> str:
    return f"regexp_matches({col}, {_rx[key]})"


ORACLES: dict[str, str] = {
    "scan_records": _with(REC, "SELECT entity_id, business_name, business_address, country FROM rec"),
    "record_projection": _with(CLEAN, "SELECT entity_id, clean_name, core_name, clean_address, clean_country FROM clean"),
    "strip_accents": _with(REC, f"SELECT entity_id, {_plain} AS plain FROM rec"),
    "clean_country": _with(CLEAN, "SELECT entity_id, clean_country FROM clean"),
    "clean_name": _with(CLEAN, "SELECT entity_id, clean_name FROM clean"),
    "core_name": _with(CLEAN, "SELECT entity_id, core_name FROM clean"),
    "clean_address": _with(CLEAN, "SELECT entity_id, clean_address FROM clean"),
    "index_norm": _with(NORM, "SELECT entity_id, country, core, pfx, postal FROM norm"),
    "country_filter": _with(CLEAN, "SELECT entity_id, clean_country FROM clean WHERE clean_country = 'FR'"),
    "id_format_filter": _with(REC, "SELECT entity_id FROM rec WHERE regexp_full_match(entity_id, 'S2-[A-Za-z0-9_-]+')"),
    "prefix_filter": _with(REC, "SELECT entity_id FROM rec WHERE entity_id LIKE 'S2-%' OR entity_id LIKE 'S3-%'"),
    "blank_filter": _with(REC, "SELECT entity_id FROM rec WHERE trim(country) = ''"),
    "length_filter": _with(REC, "SELECT entity_id, length(business_name) AS n FROM rec WHERE length(business_name) <= 1 OR length(business_name) > 40"),
    "length_filter_address": _with(REC, "SELECT entity_id, length(business_address) AS n FROM rec WHERE length(business_address) <= 1 OR length(business_address) > 30"),
    "membership_filters": _with(REC, "SELECT entity_id, CASE WHEN entity_id IN (SELECT target_id FROM truth) THEN 'true' ELSE 'other' END AS kind FROM rec WHERE entity_id NOT LIKE 'S1-%'"),
    "blocking_keys": _with(KEYS, "SELECT * FROM keys"),
    "key_histogram": _with(KEYS, "SELECT country, key_type, count(*) AS n, count(DISTINCT key) AS n_keys FROM keys GROUP BY ALL"),
    "block_scores": _with(SCORES, "SELECT * FROM scores"),
    "block_topk": _with(RANKED, "SELECT * FROM ranked"),
    "block_lists": _with(RANKED, "SELECT s1_id AS source1_entity_id, coalesce(string_agg(target_id, ',' ORDER BY rank), '') AS candidate_entity_ids FROM entities LEFT JOIN ranked USING (s1_id) GROUP BY s1_id"),
    "tiered_topk": _with(TIERS, "SELECT s1_id, target_id, tier::BIGINT AS tier, rank FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY tier, load_seq) AS rank FROM every) WHERE rank <= 25"),
    "last_wins": _with(REC, "SELECT country, max_by(entity_id, load_seq) AS entity_id FROM rec GROUP BY country"),
    "truth_pairs": _with(REC, "SELECT s1_id, target_id FROM truth"),
    "label_pairs": _with(RANKED, "SELECT r.s1_id, r.target_id, (t.s1_id IS NOT NULL)::BIGINT AS label FROM ranked r LEFT JOIN truth t USING (s1_id, target_id)"),
    "coverage_anti": _with(REC, "SELECT source1_entity_id AS entity_id FROM truth_table WHERE matched_entity_ids = ''"),
    "subset_anti": _with(RANKED, "SELECT s1_id, target_id FROM truth ANTI JOIN ranked USING (s1_id, target_id)"),
    "unknown_targets": _with(CLEAN, "SELECT DISTINCT target_id FROM truth WHERE target_id NOT IN (SELECT entity_id FROM clean WHERE clean_country <> 'FR')"),
    "distractors": _with(TAKEN, "SELECT * FROM distractors"),
    "training_pairs": _with(TAKEN, "SELECT p.s1_id, p.target_id, (t.s1_id IS NOT NULL)::BIGINT AS label FROM (SELECT s1_id, target_id FROM ranked UNION SELECT * FROM distractors) p LEFT JOIN truth t USING (s1_id, target_id)"),
    "target_union": _with(REC, "SELECT entity_id, business_name, 0::BIGINT AS part FROM rec WHERE entity_id LIKE 'S2-%' UNION ALL SELECT entity_id, business_name, 1 FROM rec WHERE entity_id LIKE 'S3-%'"),
    "id_set_ops": _with(
        RANKED,
        "SELECT s1_id, len(list_intersect(l, r)) AS n_common, len(l) + len(r) - len(list_intersect(l, r)) AS n_union, len(l) - len(list_intersect(l, r)) AS n_extra, len(list_intersect(l, r)) = len(l) AS is_subset "
        "FROM (SELECT s1_id, list(target_id) AS l FROM truth GROUP BY s1_id) JOIN (SELECT s1_id, coalesce(list(target_id) FILTER (target_id IS NOT NULL), []) AS r FROM entities LEFT JOIN ranked USING (s1_id) GROUP BY s1_id) USING (s1_id)",
    ),
    "lev_ratio": _feature("feat_name_levenshtein_ratio"),
    "token_jaccard": _feature("feat_name_token_jaccard", "feat_addr_token_jaccard"),
    "trigram_jaccard": _feature("feat_name_char_trigram_jaccard", "feat_addr_char_trigram_jaccard"),
    "length_feats": _feature("feat_name_length_diff", "feat_name_length_ratio"),
    "exact_feats": _feature("feat_name_exact_core", "feat_name_exact_clean", "feat_addr_exact_clean", "feat_is_s2", "feat_is_s3"),
    "postal_match": _feature("feat_postal_exact_match"),
    "number_overlap": _feature("feat_number_overlap_ratio"),
    "pair_features_native": _feature(*_native),
    "pair_features_all": _with(
        f"RECURSIVE {FEATS}, {WINKLER}",
        "SELECT s1_id, target_id, " + ", ".join(f"round({n}, 6) AS {n}" for n in _native) + ", round(jw, 6) AS feat_name_jaro_winkler FROM feats JOIN winkler USING (s1_id, target_id)",
    ),
    "jaro_winkler": _with(f"RECURSIVE {RANKED}, {WINKLER}", "SELECT s1_id, target_id, round(jw, 6) AS feat_name_jaro_winkler FROM winkler"),
    "f05_per_entity": _with(PER, "SELECT s1_id, n_true, n_pred, n_tp, round(f05, 6) AS f05, round(precision, 6) AS precision, round(recall, 6) AS recall FROM per"),
    "macro_f05": _with(PER, "SELECT round(avg(f05), 6) AS f05, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall FROM per"),
    "threshold_sweep": _with(SWEEP, "SELECT step, round(threshold, 6) AS threshold, round(f05, 6) AS f05, round(precision, 6) AS precision, round(recall, 6) AS recall FROM sweep"),
    "best_threshold": _with(SWEEP, "SELECT round(threshold, 6) AS threshold, round(f05, 6) AS f05 FROM sweep ORDER BY round(f05, 12) DESC, CASE WHEN round(f05, 12) > 0 THEN step ELSE -step END DESC LIMIT 1"),
    "blocking_recall": _with(
        RANKED,
        "SELECT found, true_pairs, round(100.0::DOUBLE * found / true_pairs, 6) AS recall, round(c::DOUBLE / e, 6) AS mean_candidates FROM (SELECT count(*) AS found FROM truth SEMI JOIN ranked USING (s1_id, target_id)), "
        "(SELECT count(*) AS true_pairs, count(DISTINCT s1_id) AS e FROM truth), (SELECT count(*) AS c FROM ranked WHERE s1_id IN (SELECT s1_id FROM truth))",
    ),
    "reduction_ratio": _with(RANKED, "SELECT c AS candidates, a * (t - a) AS all_pairs, round(1 - c::DOUBLE / (a * (t - a)), 6) AS reduction FROM (SELECT count(*) AS c FROM ranked), (SELECT count(*) AS a FROM entities), (SELECT count(*) AS t FROM rec)"),
    "match_counts": _with(SCORED, f"SELECT count(*) FILTER (m) AS matched, count(*) FILTER (NOT m) AS singletons FROM (SELECT s1_id IN (SELECT s1_id FROM scored WHERE prob >= {CUT}) AS m FROM entities)"),
    "null_profile": _with(REC, _profile),
    "length_stats": _with(REC, _lengths),
    "id_audit": _with(
        REC,
        "SELECT count(*)::BIGINT AS total, count(DISTINCT entity_id) AS distinct_ids, count(*) FILTER (entity_id NOT LIKE 'S2-%') AS wrong_prefix, count(*) FILTER (NOT regexp_full_match(entity_id, 'S2-[A-Za-z0-9_-]+')) AS bad_format, "
        "count(*) FILTER (trim(entity_id) <> entity_id) AS padded, (count(*) - count(DISTINCT entity_id))::BIGINT AS duplicates, '' AS duplicate_examples, "
        "array_to_string(list_sort(list(DISTINCT entity_id) FILTER (entity_id NOT LIKE 'S2-%'))[1:5], ',') AS prefix_examples, array_to_string(list_sort(list(DISTINCT entity_id) FILTER (entity_id NOT LIKE 'S2-%'))[1:5], ',') AS format_examples FROM rec",
    ),
    "gt_cardinality": _with(
        REC,
        "SELECT count(*) AS total, count(*) FILTER (n = 0) AS singletons, count(*) FILTER (n = 1) AS one_to_one, count(*) FILTER (n > 1) AS one_to_many, max(n) AS largest, round(avg(n), 3) AS mean_matches, "
        "round(100.0 * count(*) FILTER (n = 0) / count(*), 2)::DOUBLE AS singleton_pct FROM (SELECT s1_id, count(target_id) AS n FROM entities LEFT JOIN truth USING (s1_id) GROUP BY s1_id)",
    ),
    "gt_sources": _with(
        REC,
        "SELECT count(*) FILTER (b AND NOT c) AS s2_only, count(*) FILTER (c AND NOT b) AS s3_only, count(*) FILTER (b AND c) AS both, 0::BIGINT AS self_matches, 0::BIGINT AS with_repeats "
        "FROM (SELECT s1_id, bool_or(target_id LIKE 'S2-%') AS b, bool_or(target_id LIKE 'S3-%') AS c FROM truth GROUP BY s1_id)",
    ),
    "country_counts": _with(REC, "SELECT upper(trim(country)) AS country, count(*) AS n FROM rec GROUP BY 1"),
    "distinct_countries": _with(CLEAN, "SELECT DISTINCT clean_country FROM clean WHERE entity_id LIKE 'S1-%' AND clean_country <> ''"),
    "region_profile": _with(
        REC,
        f"SELECT count(*) FILTER ({_fr}) AS france_records, {_hits(_fr, f'({_has("n", "fr_accent")} OR {_has("a", "fr_accent")})', 'france_accents')}, {_hits(_fr, _has('a', 'fr_postal'), 'france_postal')}, "
        f"{_hits(_fr, _has('a', 'fr_street'), 'france_street')}, {_hits(_fr, _has('n', 'fr_legal'), 'france_legal')}, {_hits(_in, _has('a', 'in_pin'), 'india_pin')}, {_hits(_in, _has('a', 'in_landmark'), 'india_landmark')}, "
        f"{_hits(_us, _has('a', 'us_zip'), 'us_zip')} FROM (SELECT upper(trim(country)) AS c, business_name AS n, business_address AS a FROM rec)",
    ),
    "validation_report": _with(LINES, "SELECT 'matching' AS file, rule, 'error' AS severity, count(DISTINCT x) AS n, array_to_string(list_sort(list(DISTINCT x))[1:5], ',') AS examples FROM bad GROUP BY rule"),
    "schema_audit": _with(LINES, "SELECT true AS header_ok, 2::BIGINT AS n_columns, count(*) AS n_rows, count(*) FILTER (NOT tab) AS n_ragged, array_to_string(list_sort(list(line_no) FILTER (NOT tab))[1:5], ',') AS first_ragged FROM line"),
    "validation_rules": _with(
        BROKEN,
        "SELECT 'rows' AS case, 'matching' AS file, rule, severity, count(DISTINCT x) AS n, array_to_string(list_sort(list(DISTINCT x))[1:5], ',') AS examples FROM broken GROUP BY ALL "
        "UNION ALL SELECT 'comma', 'matching', 'V2_comma_separated', 'error', 1, 'a,b' UNION ALL SELECT 'comma', 'candidate', 'V11_no_candidate_file', 'warning', 1, '' "
        "UNION ALL SELECT 'labels', 'matching', 'V2_header', 'error', 1, 'source1_entity_id' || chr(9) || 'wrong_entity_ids' "
        "UNION ALL SELECT 'empty', 'matching', 'V1_empty_file', 'error', 1, '' UNION ALL SELECT 'empty', 'candidate', 'V11_no_candidate_file', 'warning', 1, ''",
    ),
    "sample_limit": _with(
        RANKED,
        f"SELECT * FROM ranked WHERE s1_id IN (SELECT entity_id FROM clean WHERE entity_id LIKE 'S1-%' ORDER BY clean_country, entity_id LIMIT {SAMPLE_LIMIT})",
    ),
    "group_folds_hashed": _with(RANKED, "SELECT count(*) AS n_pairs, count(DISTINCT s1_id) AS n_groups, 1::BIGINT AS most_folds, true AS all_folds FROM ranked"),
    "group_folds": _with(RANKED, "SELECT substr(s1_id, 4, 8)::BIGINT % 5 AS fold, count(*) AS n, count(DISTINCT s1_id) AS n_groups FROM ranked GROUP BY 1"),
}
