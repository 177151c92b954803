"""DuckDB SQL for the core's queries, over the same tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

_KB = """
concepts AS (SELECT cidx, ui, concept_type, regexp_extract(ui, '^(.+)[0-9]{7}$', 1) AS prefix, try_cast(regexp_extract(ui, '([0-9]{7})$', 1) AS BIGINT) AS num FROM ingredients),
atoms_ AS (SELECT cidx, unnest(synonyms) AS s, (generate_subscripts(synonyms, 1) - 1)::INT AS pos FROM ingredients),
atoms AS (SELECT cidx, pos, s.term AS term, lower(s.term) AS term_lc, s.src AS src, s.src_id AS src_id, s.term_type AS term_type,
  coalesce(s.is_preferred, false) AS is_preferred, s.linking_score AS linking_score FROM atoms_ WHERE s IS NOT NULL AND s.term IS NOT NULL),
attrs_ AS (SELECT cidx, unnest(attributes) AS a, (generate_subscripts(attributes, 1) - 1)::INT AS pos FROM ingredients),
attrs AS (SELECT cidx, pos, a.atr_name AS atr_name, a.atr_value AS atr_value, a.src AS src FROM attrs_ WHERE a IS NOT NULL),
rels_ AS (SELECT cidx, unnest(relationships) AS r, (generate_subscripts(relationships, 1) - 1)::INT AS ridx FROM ingredients),
rels AS (SELECT cidx, ridx, r.rel_name AS rel_name, r.object AS object_ui, r.src AS src FROM rels_ WHERE r IS NOT NULL),
rattrs_ AS (SELECT cidx, ridx, unnest(r.attributes) AS a, (generate_subscripts(r.attributes, 1) - 1)::INT AS pos FROM rels_ WHERE r IS NOT NULL),
rattrs AS (SELECT cidx, ridx, pos, a.atr_name AS atr_name, a.atr_value AS atr_value, a.src AS src FROM rattrs_ WHERE a IS NOT NULL)"""
_PAIRS = "cpairs AS (SELECT DISTINCT least(i, j) AS i, greatest(i, j) AS j FROM connections WHERE i IS NOT NULL AND j IS NOT NULL AND i <> j)"
_PREF = """pref AS (SELECT a.* FROM atoms a LEFT JOIN source_rank r ON upper(r.src) = upper(a.src)
  QUALIFY row_number() OVER (PARTITION BY cidx ORDER BY is_preferred DESC, coalesce(src_rank, 1000000), pos) = 1)"""
_ROOTS = """e AS (SELECT i AS u, j AS v FROM cpairs WHERE i IN (SELECT cidx FROM ingredients) AND j IN (SELECT cidx FROM ingredients)),
ee AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
reach(v, o) AS (SELECT u, u FROM ee UNION SELECT r.v, x.v FROM reach r JOIN ee x ON x.u = r.o),
roots AS (SELECT c.cidx, coalesce(m.root, c.cidx) AS root FROM concepts c LEFT JOIN (SELECT v, min(o) AS root FROM reach GROUP BY v) m ON m.v = c.cidx)"""
_DOCS = """dt AS (SELECT DISTINCT doc_id AS cidx, coalesce(lang, '') AS concept_type, lower(trim(l)) AS term_lc
  FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS l FROM documents WHERE text IS NOT NULL) WHERE trim(l) <> ''),
hub AS (SELECT concept_type, term_lc, min(cidx) AS i FROM dt GROUP BY ALL HAVING count(*) > 1),
st AS (SELECT DISTINCT h.i, d.cidx AS j FROM dt d JOIN hub h USING (concept_type, term_lc) WHERE d.cidx <> h.i)"""
_DCOMP = """ee AS (SELECT i AS u, j AS v FROM st UNION SELECT j, i FROM st),
reach(v, o) AS (SELECT DISTINCT cidx, cidx FROM dt UNION SELECT r.v, x.v FROM reach r JOIN ee x ON x.u = r.o),
comp AS (SELECT v, min(o) AS root FROM reach GROUP BY v)"""
_IDS = """ranked AS (SELECT cidx, num, CASE WHEN num IS NULL THEN 2 ELSE row_number() OVER (PARTITION BY num ORDER BY cidx) END AS n FROM concepts),
ids AS (SELECT cidx, printf('DC%07d', num) AS cui FROM ranked WHERE n = 1
  UNION ALL SELECT cidx, printf('DC%07d', (SELECT coalesce(max(num), 0) FROM concepts) + row_number() OVER (ORDER BY cidx)) FROM ranked WHERE n > 1),
firstui AS (SELECT ui, min(cidx) AS cidx FROM concepts GROUP BY ui),
ro AS (SELECT r.*, f.cidx AS object_cidx FROM rels r LEFT JOIN firstui f ON f.ui = r.object_ui)"""
_SETS = """sets AS (SELECT c.cidx, upper(c.concept_type) AS t,
  coalesce(list(DISTINCT term_lc) FILTER (WHERE term_lc IS NOT NULL), []) AS al,
  coalesce(list(DISTINCT term_lc) FILTER (WHERE is_preferred AND linking_score IS NULL), []) AS pl,
  coalesce(list(DISTINCT term_lc) FILTER (WHERE is_preferred AND linking_score IS NOT NULL), []) AS li,
  coalesce(list(DISTINCT term_lc) FILTER (WHERE is_preferred AND linking_score IS NOT NULL AND src_id IN (SELECT src_id FROM strong)), []) AS st
  FROM concepts c LEFT JOIN atoms a USING (cidx) GROUP BY c.cidx, c.concept_type)"""
_IDF = """idf AS (SELECT src_id, ln((SELECT count(*) FROM concepts) / count(DISTINCT cidx)) AS idf FROM atoms WHERE linking_score IS NOT NULL AND src_id IS NOT NULL GROUP BY src_id),
strong AS (SELECT src_id FROM idf WHERE idf >= (SELECT min(idf) + (max(idf) - min(idf)) / 1.5 FROM idf))"""
_SQUEEZE = r"trim(regexp_replace({}, '[\s\p{{Z}}]+', ' ', 'g'))"
_STRIP = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def _invalid(c: str) -> str:
    t = _STRIP.format(f"coalesce({c}, '')")
    digits = f"ltrim({t}, '.,')"
    return f"(length({t}) < 2 OR regexp_matches({digits}, '^([0-9]{{2,}}|[0-9]+[.,]+[0-9]+)$') OR regexp_matches({t}, '^[[:punct:]]+$'))"


_NHP = f"""nrows AS (SELECT *, {_SQUEEZE.format('proper_name')} AS name FROM (
  SELECT ingredient_id, product_id, proper_name, proper_name_f, common_name, common_name_f, source_material, source_material_f, min(row_id) AS row_id
  FROM nhp_medicinal_ingredients WHERE proper_name IS NOT NULL GROUP BY ALL)),
nkept AS (SELECT * FROM nrows WHERE NOT {_invalid('name')}),
ncells AS (SELECT row_id, replace(ingredient_id, '.0', '') AS src_id, k AS col, t AS term, CASE WHEN k < 2 THEN 'SN' ELSE 'SY' END AS term_type FROM (
  SELECT row_id, ingredient_id, 0 AS k, {_SQUEEZE.format("coalesce(proper_name, '')")} AS t FROM nkept
  UNION ALL SELECT row_id, ingredient_id, 1, {_SQUEEZE.format("coalesce(proper_name_f, '')")} FROM nkept
  UNION ALL SELECT row_id, ingredient_id, 2, {_SQUEEZE.format("coalesce(common_name, '')")} FROM nkept
  UNION ALL SELECT row_id, ingredient_id, 3, {_SQUEEZE.format("coalesce(common_name_f, '')")} FROM nkept) WHERE t <> ''),
natoms AS (SELECT row_id, src_id, term, term_type, col = 0 AS is_preferred FROM ncells
  QUALIFY col = 0 OR row_number() OVER (PARTITION BY term, term_type ORDER BY row_id, col) = 1),
nprod AS (SELECT replace(product_id, '.0', '') AS src_id, min({_SQUEEZE.format('product_name')}) AS term FROM nhp_products
  WHERE product_id IS NOT NULL AND {_SQUEEZE.format("coalesce(product_name, '')")} <> '' GROUP BY 1),
nedges AS (SELECT DISTINCT replace(ingredient_id, '.0', '') AS ingredient_id, replace(product_id, '.0', '') AS product_id FROM nkept WHERE product_id IS NOT NULL)"""


def _clean(c: str, filter_words: Sequence[str] = ()) -> str:
    """The cuts of label names, nested."""
    from termloom.functions import text

    c = _SQUEEZE.format(f"string_split_regex({c}, '{text.LABEL_GAP}')[1]")
    for pattern, by in text.label_cuts(filter_words):
        pattern, by = pattern.replace("'", "''"), re.sub(r"\$(\d)", r"\\\1", by)
        c = _SQUEEZE.format(f"regexp_replace({c}, '{pattern}', '{by}', 'g')")
    return c


def _with(body: str, *parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {body}"


def _skew(c: str) -> str:
    return f"(avg({c}^3) - 3 * avg({c}) * avg({c}^2) + 2 * avg({c})^3) / power(avg({c}^2) - avg({c})^2, 1.5)"


def _stats(source: str) -> str:
    x = "n::DOUBLE"
    each = [("min(n)", "least"), ("max(n)", "most"), ("avg(n)", "mean"), ("stddev_samp(n)", "sd"), (_skew(f"({x})"), "skew"), ("kurtosis_pop(n)", "kurtosis")]
    return "SELECT " + ", ".join(f"round(({e})::DOUBLE, 6) AS {a}" for e, a in each) + f" FROM ({source})"


def _merged(table: str, keys: str, order: str, extra: str) -> str:
    return f"SELECT t.*, r.root, (t.cidx <> r.root) AS later FROM {table} t JOIN roots r USING (cidx) QUALIFY row_number() OVER (PARTITION BY root, {keys} ORDER BY later, t.cidx, {order}) = 1" + extra


_PER = "SELECT cidx, count(*) AS n FROM atoms WHERE cidx IN (SELECT cidx FROM concepts WHERE concept_type = 'SDSI') GROUP BY cidx"
_CODES = "SELECT cidx, count(DISTINCT src_id) AS n FROM atoms WHERE src = 'UMLS' AND cidx IN (SELECT cidx FROM concepts WHERE concept_type = 'SDSI') GROUP BY cidx"
_NODES = {
    "SDSI": "umls_semantic_type preferred_name synonym scientific_name source_material ingredient_category background safety mechanism_of_action links_to",
    "DSP": "preferred_name langual_type",
    **{k: "preferred_name umls_semantic_type links_to" for k in ("PD", "DIS", "TC", "SOC", "SS")},
}
_EDGES = {"HAS_INGREDIENT": "", "INTERACTS_WITH": "rating severity", "IS_EFFECTIVE_FOR": "rating", "HAS_THERAPEUTIC_CLASS": "", "HAS_ADVERSE_EFFECT_ON": "", "HAS_ADVERSE_REACTION": ""}
_SCHEMA = "nodes(k, p) AS (VALUES {}), edges(k, p) AS (VALUES {})".format(
    ", ".join(f"('{k}', '{p}')" for k, v in _NODES.items() for p in v.split()), ", ".join(f"('{k}', {repr(p) if p else 'NULL'})" for k, v in _EDGES.items() for p in [None, *v.split()])
)
_LINT = r"""
SELECT cidx, 'concept_type' AS rule, concept_type AS value FROM concepts WHERE upper(coalesce(concept_type, '')) NOT IN (SELECT k FROM nodes)
UNION SELECT cidx, 'relationship', rel_name FROM rels WHERE upper(coalesce(rel_name, '')) NOT IN (SELECT k FROM edges)
UNION SELECT a.cidx, 'attribute', a.atr_name FROM attrs a JOIN concepts c USING (cidx) WHERE upper(c.concept_type) IN (SELECT k FROM nodes)
  AND NOT EXISTS (SELECT 1 FROM nodes n WHERE n.k = upper(c.concept_type) AND n.p = coalesce(a.atr_name, ''))
UNION SELECT a.cidx, 'rel_attribute', a.atr_name FROM rattrs a JOIN rels r ON r.cidx = a.cidx AND r.ridx = a.ridx WHERE upper(r.rel_name) IN (SELECT k FROM edges)
  AND NOT EXISTS (SELECT 1 FROM edges n WHERE n.k = upper(r.rel_name) AND n.p = coalesce(a.atr_name, ''))
UNION SELECT cidx, 'ui', ui FROM concepts WHERE NOT regexp_matches(coalesce(ui, ''), '^[a-zA-Z_]+[0-9]{7}')
UNION SELECT cidx, 'term', term FROM atoms WHERE regexp_matches(term, '[\n\t\r]')
UNION SELECT cidx, 'value', atr_value FROM attrs WHERE regexp_matches(atr_value, '[\n\t\r]')
UNION SELECT cidx, 'no_atoms', ui FROM concepts WHERE cidx NOT IN (SELECT cidx FROM atoms)"""
_ORGANS = """organs(k, m, term, code) AS (VALUES ('cardiovascular','cardio','Cardiac disorders','10007541'),('cardiovascular','vascular','Vascular disorders','10047065'),
('dental','dental','Dental and gingival conditions','10044018'),('dermatologic','dermatologic','Skin and subcutaneous tissue disorders','10040785'),('endocrine','endocrine','Endocrine disorders','10014698'),
('gastrointestinal','gastrointestinal','Gastrointestinal disorders','10017947'),('genitourinary','genito','Reproductive system and breast disorders','10038604'),('genitourinary','urinary','Renal and urinary disorders','10038359'),
('hematologic','hematologic','Blood and lymphatic system disorders','10005329'),('hepatic','hepatic','Hepatobiliary disorders','10019805'),('immunologic','immunologic','Immune system disorders','10021428'),
('musculoskeletal','musculoskeletal','Musculoskeletal and connective tissue disorders','10028395'),('neurologic/cns','neurologic/cns','Nervous system disorders','10029205'),('ocular/otic','ocular/otic','Eye disorders','10015919'),
('oncologic','oncologic','Neoplasms benign, malignant and unspecified (incl cysts and polyps)','10029104'),('psychiatric','psychiatric','Psychiatric disorders','10037175'),
('pulmonary/respiratory','pulmonary/respiratory','Respiratory, thoracic and mediastinal disorders','10038738'),('renal','renal','Renal and urinary disorders','10038359')),
keyed AS (SELECT (row_number() OVER () - 1)::VARCHAR AS id, k FROM (SELECT k, min(rn) AS rn FROM (SELECT k, row_number() OVER () AS rn FROM organs) GROUP BY k ORDER BY 2)),
qs AS (SELECT id, k FROM keyed UNION ALL SELECT 'p' || p_partkey, lower(p_name) FROM part)"""
_LINKABLE = f"""lk AS (SELECT c.ui AS id, c.cidx, p.term AS text, CASE WHEN upper(c.concept_type) = 'SOC' THEN 'meddra.rules' ELSE 'umls.dictionary' END AS terminology
  FROM concepts c JOIN pref p USING (cidx) WHERE upper(c.concept_type) IN ('SDSI', 'PD', 'DIS', 'TC', 'SOC', 'SS') QUALIFY row_number() OVER (PARTITION BY c.ui ORDER BY c.cidx) = 1)"""
_CLONES = "cl AS (SELECT DISTINCT l.cidx AS old, l.text FROM lk l JOIN reference_terms r ON r.ref_term = lower(l.text))"
_MTH = """matoms AS (SELECT cidx, pos, term, CASE WHEN src = 'UMLS' THEN printf('C%07d', ((try_cast(src_id AS BIGINT) % 2000) + 2000) % 2000) ELSE src_id END AS src_id, src FROM atoms),
mine AS (SELECT cidx FROM concepts WHERE concept_type = 'SDSI'),
links AS (SELECT DISTINCT cidx, src_id AS cui FROM matoms WHERE src = 'UMLS' AND cidx IN (SELECT cidx FROM mine) AND src_id IN (SELECT printf('C%07d', ref_id) FROM reference_terms)),
fresh AS (SELECT cidx, printf('DC%07d', (SELECT max(ref_id) FROM reference_terms) + row_number() OVER (ORDER BY cidx)) AS CUI FROM mine WHERE cidx NOT IN (SELECT cidx FROM links)),
owner AS (SELECT cidx, 'D' || cui AS CUI FROM links UNION ALL SELECT * FROM fresh),
refs AS (SELECT ref_id, ref_term, CASE WHEN printf('C%07d', ref_id) IN (SELECT cui FROM links) THEN 'D' ELSE '' END || printf('C%07d', ref_id) AS CUI,
  CASE concept_type WHEN 'PD' THEN 'T121' WHEN 'SS' THEN 'T184' ELSE 'T047' END AS TUI FROM reference_terms)"""

_VALID = "lower({0}) NOT IN ('', 'general', 'none reports.', 'none known.', 'case reports', 'none reported.')"
_SYN = "term || '|' || '{0}' || '|' || coalesce(src_id, '') || '|' || term_type || '|' || is_preferred"


def _flat(src: str) -> str:
    """Records with each list as one text, of ``con, fatoms (cidx, pos, ...), fattrs, frels``."""
    return f"""SELECT c.ui, c.concept_type, s.synonyms, a.attributes, r.relationships FROM con c
  LEFT JOIN (SELECT cidx, string_agg({_SYN.format(src)}, '; ' ORDER BY pos) AS synonyms FROM fatoms GROUP BY cidx) s USING (cidx)
  LEFT JOIN (SELECT cidx, string_agg(atr_name || '|' || atr_value || '|{src}', '; ' ORDER BY pos) AS attributes FROM fattrs GROUP BY cidx) a USING (cidx)
  LEFT JOIN (SELECT cidx, string_agg(rel_name || '|' || object_ui || '|{src}', '; ' ORDER BY pos) AS relationships FROM frels GROUP BY cidx) r USING (cidx)"""


_REGISTRY = f"""made AS (SELECT DISTINCT replace(product_id, '.0', '') AS src_id, {_SQUEEZE.format('product_name')} AS term FROM nhp_products WHERE product_id IS NOT NULL AND {_SQUEEZE.format("coalesce(product_name, '')")} <> ''),
rnames AS (SELECT row_id, col, coalesce(src_id, '') AS src_id, term, term_type FROM ncells QUALIFY col = 0 OR row_number() OVER (PARTITION BY term, term_type ORDER BY row_id, col) = 1),
con0 AS (SELECT 'SDSI' AS concept_type, 0 AS part, min(row_id) AS f, src_id FROM rnames GROUP BY src_id UNION ALL SELECT DISTINCT 'DSP', 1, 0, src_id FROM made),
con AS (SELECT *, row_number() OVER (ORDER BY part, f, src_id) - 1 AS cidx, printf('NHPID%07d', row_number() OVER (ORDER BY part, f, src_id)) AS ui FROM con0),
fa AS (SELECT cidx, row_id, col, r.src_id, term, term_type, col = 0 AS is_preferred FROM rnames r JOIN con ON con.part = 0 AND con.src_id = r.src_id
  UNION ALL SELECT cidx, 0, row_number() OVER (ORDER BY term), m.src_id, term, 'SY', true FROM made m JOIN con ON con.part = 1 AND con.src_id = m.src_id),
fatoms AS (SELECT *, row_number() OVER (PARTITION BY cidx ORDER BY row_id, col) AS pos FROM (SELECT * FROM fa QUALIFY row_number() OVER (PARTITION BY cidx, lower(term), src_id, term_type ORDER BY row_id, col) = 1)),
fattrs AS (SELECT cidx, 0 AS pos, 'source_material' AS atr_name, CASE WHEN coalesce(source_material, '') <> '' THEN {_STRIP.format('source_material')} ELSE {_STRIP.format('source_material_f')} END AS atr_value
  FROM con JOIN nkept k ON con.part = 0 AND k.row_id = con.f WHERE coalesce(source_material, '') <> '' OR coalesce(source_material_f, '') <> ''),
ed AS (SELECT a.cidx AS i, a.ui AS iui, b.cidx AS p, b.ui AS pui, x.f FROM (SELECT coalesce(replace(ingredient_id, '.0', ''), '') AS src_id, replace(product_id, '.0', '') AS product, min(row_id) AS f FROM nkept WHERE product_id IS NOT NULL GROUP BY ALL) x
  JOIN con a ON a.part = 0 AND a.src_id = x.src_id JOIN con b ON b.part = 1 AND b.src_id = x.product),
frels AS (SELECT i AS cidx, row_number() OVER (PARTITION BY i ORDER BY f, p) AS pos, 'ingredient_of' AS rel_name, pui AS object_ui FROM ed
  UNION ALL SELECT p, row_number() OVER (PARTITION BY p ORDER BY i), 'has_ingredient', iui FROM ed)"""

_GROUPS = f"""g AS (SELECT ingredient_id AS group_id, min(proper_name) AS group_name, list(DISTINCT common_name) FILTER (WHERE common_name IS NOT NULL) AS s FROM nhp_medicinal_ingredients GROUP BY ingredient_id),
one AS (SELECT group_id, group_name, unnest(string_split(replace(array_to_string(list_sort(s), ';'), '"', ''), ';')) AS x FROM g),
clean AS (SELECT DISTINCT group_id, group_name, {_clean('x')} AS c FROM one WHERE x IS NOT NULL),
wide AS (SELECT DISTINCT group_id, group_name, unnest(list_concat([{_SQUEEZE.format("regexp_replace(c, '" + chr(92) + "(.*" + chr(92) + ")', '')")}], list_transform(regexp_extract_all(c, '\\(.*?\\)'), lambda x: regexp_replace(x, '[()]', '', 'g')))) AS synonym FROM clean WHERE c <> '' AND group_id IS NOT NULL AND group_name IS NOT NULL)"""
_LABEL = """sold AS (SELECT DISTINCT replace(n.product_id, '.0', '') AS src_id, n.product_name AS name, CASE WHEN replace(n.product_id, '.0', '') LIKE '%0' THEN '' ELSE 'Dietary supplement' END AS detail, r.ids
  FROM nhp_products n JOIN (SELECT product_id, list_sort(coalesce(list(DISTINCT ingredient_id) FILTER (WHERE ingredient_id IS NOT NULL), [])) AS ids FROM nhp_medicinal_ingredients WHERE product_id IS NOT NULL GROUP BY product_id) r ON r.product_id = replace(n.product_id, '.0', '') WHERE n.product_name IS NOT NULL),
con0 AS (SELECT 'SDSI' AS concept_type, 0 AS part, group_id AS src_id, group_name AS name, 'other' AS detail, list_sort(list(synonym)) AS l FROM wide WHERE lower(group_name) NOT IN ('header', 'fat calories', 'polyunsaturated fat') GROUP BY group_id, group_name
  UNION ALL SELECT 'DSP', 1, src_id, name, detail, ids FROM sold),
con AS (SELECT *, row_number() OVER (ORDER BY part, src_id, name, detail, l) - 1 AS cidx, printf('DSLD%07d', row_number() OVER (ORDER BY part, src_id, name, detail, l)) AS ui FROM con0),
fa AS (SELECT cidx, src_id, unnest(n) AS term, generate_subscripts(n, 1) AS k FROM (SELECT cidx, src_id, CASE part WHEN 0 THEN list_concat([name], list_filter(l, lambda x: x <> '')) ELSE [name] END AS n FROM con)),
fatoms AS (SELECT cidx, src_id, term, k AS pos, 'SY' AS term_type, k = 1 AS is_preferred FROM fa QUALIFY row_number() OVER (PARTITION BY cidx, lower(term) ORDER BY k) = 1),
fattrs AS (SELECT cidx, 0 AS pos, CASE part WHEN 0 THEN 'ingredient_category' ELSE 'langual_type' END AS atr_name, detail AS atr_value FROM con WHERE detail <> ''),
frels AS (SELECT w.cidx, min(k) AS pos, 'has_ingredient' AS rel_name, t.ui AS object_ui FROM (SELECT cidx, unnest(l) AS x, generate_subscripts(l, 1) AS k FROM con WHERE part = 1) w JOIN con t ON t.part = 0 AND t.src_id = w.x GROUP BY w.cidx, t.ui)"""

_HERB = f"""ft AS (SELECT cidx, arg_min(term, pos) AS t, min(pos) AS low FROM atoms GROUP BY cidx),
firstui AS (SELECT ui, min(cidx) AS cidx FROM concepts GROUP BY ui),
ot AS (SELECT r.cidx, r.ridx, r.rel_name, f.t FROM rels r JOIN firstui u ON u.ui = r.object_ui JOIN ft f ON f.cidx = u.cidx),
herb AS (SELECT c.cidx AS page, {_SQUEEZE.format('t')} AS t, low FROM concepts c JOIN ft USING (cidx) WHERE concept_type = 'SDSI' AND {_VALID.format(_SQUEEZE.format('t'))}),
cuts AS (SELECT cidx, 2 AS place, pos AS a, string_split_regex(term, ', |; ') AS l FROM atoms JOIN ft USING (cidx) WHERE pos > low
  UNION ALL SELECT cidx, place, ridx, CASE WHEN regexp_matches(x, '[0-9]') THEN [x] ELSE string_split(x, '/') END FROM (
    SELECT cidx, 6 AS place, ridx, unnest(string_split(t, chr(10))) AS x FROM ot WHERE rel_name = 'IS_EFFECTIVE_FOR'
    UNION ALL SELECT cidx, 7, ridx, t FROM ot WHERE rel_name = 'HAS_ADVERSE_REACTION'
    UNION ALL SELECT cidx, 8, ridx, {_STRIP.format("regexp_replace(regexp_replace(split_part(t || ' (class): may interact', ':', 1), ' ?" + chr(92) + "([^)]+" + chr(92) + ")', '', 'g'), '[^" + chr(92) + "x00-" + chr(92) + "x7F]+', '', 'g')")} FROM ot WHERE rel_name = 'INTERACTS_WITH')),
said AS (SELECT cidx AS page, place, a, b, v FROM (SELECT cidx, place, a, generate_subscripts(l, 1) AS b, {_SQUEEZE.format('unnest(l)')} AS v FROM cuts) WHERE {_VALID.format('v')} AND cidx IN (SELECT page FROM herb)
  QUALIFY row_number() OVER (PARTITION BY cidx, place, v ORDER BY a, b) = 1),
con0 AS (SELECT page, 0 AS last, place, a, b, v, CASE place WHEN 6 THEN 'DIS' WHEN 7 THEN 'SS' ELSE 'PD' END AS concept_type FROM said WHERE place > 2 UNION ALL SELECT page, 1, 0, 0, 0, t, 'SDSI' FROM herb),
con AS (SELECT *, row_number() OVER (ORDER BY page, last, place, a, b) - 1 AS cidx, printf('MSKCC%07d', row_number() OVER (ORDER BY page, last, place, a, b)) AS ui FROM con0),
hc AS (SELECT page, cidx FROM con WHERE last = 1),
fa AS (SELECT cidx, 0 AS place, 0 AS a, 0 AS b, v AS term, 'SY' AS term_type, last = 1 AS is_preferred FROM con
  UNION ALL SELECT hc.cidx, 2, a, b, v, 'CN', false FROM said JOIN hc USING (page) WHERE place = 2),
fatoms AS (SELECT cidx, '0' AS src_id, term, term_type, is_preferred, row_number() OVER (PARTITION BY cidx ORDER BY place, a, b) AS pos FROM (SELECT * FROM fa QUALIFY row_number() OVER (PARTITION BY cidx, lower(term), term_type ORDER BY place, a, b) = 1)),
fattrs AS (SELECT cidx, 0 AS pos, 'background' AS atr_name, v AS atr_value FROM (SELECT hc.cidx, {_SQUEEZE.format("string_agg(atr_value, ' ' ORDER BY pos)")} AS v FROM attrs JOIN hc ON hc.page = attrs.cidx WHERE atr_value IS NOT NULL AND {_VALID.format(_STRIP.format('atr_value'))} GROUP BY hc.cidx) WHERE {_VALID.format('v')}),
frels AS (SELECT hc.cidx, row_number() OVER (PARTITION BY hc.cidx ORDER BY place, a, b) AS pos, CASE place WHEN 6 THEN 'is_effective_for' WHEN 7 THEN 'has_adverse_reaction' ELSE 'interacts_with' END AS rel_name, con.ui AS object_ui FROM con JOIN hc USING (page) WHERE last = 0)"""

_PREFIX = "pf AS (SELECT root AS cidx, string_agg(DISTINCT x, '_' ORDER BY x) AS prefix FROM (SELECT root, unnest(string_split(prefix, '_')) AS x FROM concepts JOIN roots USING (cidx)) GROUP BY root)"
_PROPS = """props AS (SELECT cidx, string_agg(atr_name || '=' || v, '; ' ORDER BY atr_name) FILTER (WHERE v IS NOT NULL) AS properties FROM (SELECT cidx, atr_name, arg_max(atr_value, pos) AS v FROM attrs WHERE atr_name IS NOT NULL GROUP BY ALL) GROUP BY cidx),
rprops AS (SELECT cidx, ridx, string_agg(atr_name || '=' || v, '; ' ORDER BY atr_name) FILTER (WHERE v IS NOT NULL) AS properties FROM (SELECT cidx, ridx, atr_name, arg_max(atr_value, pos) AS v FROM rattrs WHERE atr_name IS NOT NULL GROUP BY ALL) GROUP BY cidx, ridx)"""
# the merge order replayed link by link: every concept's root and, per root, the distinct atoms under it
_REPLAY = """lk0 AS (SELECT i, j, row_number() OVER (ORDER BY i, j) AS k FROM cpairs WHERE i IN (SELECT cidx FROM ingredients) AND j IN (SELECT cidx FROM ingredients)),
vs AS (SELECT v, row_number() OVER (ORDER BY v) AS slot FROM (SELECT i AS v FROM lk0 UNION SELECT j FROM lk0)),
links0 AS (SELECT k, a.slot AS a, b.slot AS b FROM lk0 JOIN vs a ON a.v = i JOIN vs b ON b.v = j),
aid AS (SELECT DISTINCT cidx, dense_rank() OVER (ORDER BY term_lc, src, src_id, term_type) AS x FROM (SELECT cidx, term_lc, coalesce(src, '') AS src, coalesce(src_id, '') AS src_id, coalesce(term_type, '') AS term_type FROM atoms)),
own AS (SELECT slot, coalesce(list(x) FILTER (WHERE x IS NOT NULL), []) AS l FROM vs LEFT JOIN aid ON aid.cidx = vs.v GROUP BY slot),
st(k, p, s) AS (SELECT 0::BIGINT, (SELECT list(slot ORDER BY slot) FROM vs), (SELECT list(l ORDER BY slot) FROM own)
  UNION ALL SELECT n.k, CASE WHEN f = g THEN p ELSE list_transform(p, lambda x: CASE WHEN x = lose THEN win ELSE x END) END,
    CASE WHEN f = g THEN s ELSE list_transform(s, lambda l, i: CASE WHEN i = win THEN list_distinct(list_concat(l, s[lose])) ELSE l END) END
  FROM (SELECT l.k, p, s, p[l.a] AS f, p[l.b] AS g, CASE WHEN len(s[p[l.b]]) > len(s[p[l.a]]) THEN p[l.b] ELSE p[l.a] END AS win, CASE WHEN len(s[p[l.b]]) > len(s[p[l.a]]) THEN p[l.a] ELSE p[l.b] END AS lose FROM st JOIN links0 l ON l.k = st.k + 1) n),
fin AS (SELECT unnest(p) AS r, generate_subscripts(p, 1) AS slot FROM (SELECT p FROM st ORDER BY k DESC LIMIT 1)),
roots AS (SELECT c.cidx, coalesce(m.root, c.cidx) AS root FROM concepts c LEFT JOIN (SELECT a.v, b.v AS root FROM fin JOIN vs a USING (slot) JOIN vs b ON b.slot = fin.r) m ON m.v = c.cidx)"""
_CAPTURED = _LINKABLE + """, cap AS (SELECT l.id, l.text AS matched, r.ref_id, r.ref_term AS term, printf('C%07d', r.ref_id) AS code, r.concept_type AS st, (700 + (r.ref_id * 37) % 300)::DOUBLE AS score
  FROM lk l JOIN reference_terms r ON lower(substr(l.text, 1, 1)) = substr(r.ref_term, 1, 1) AND length(l.text) = length(r.ref_term)),
svc AS (SELECT id, matched, at0, r.ref_term AS term, printf('C%07d', r.ref_id) AS code FROM (SELECT id, unnest(string_split(lower(text), ' ')) AS matched, generate_subscripts(string_split(text, ' '), 1) AS at0 FROM lk) w JOIN reference_terms r ON split_part(r.ref_term, ' ', 1) = w.matched)"""
_NEW = """hi AS (SELECT max(cidx) AS c, max(num) AS n FROM concepts),
nw AS (SELECT old, text, row_number() OVER (ORDER BY old) - 1 AS off, (SELECT c FROM hi) + row_number() OVER (ORDER BY old) AS cidx, (SELECT n FROM hi) + row_number() OVER (ORDER BY old) AS num FROM cl),
gone AS (SELECT cidx FROM lk),
ncon AS (SELECT nw.cidx, printf('%s%07d', c.prefix, nw.num) AS ui, c.prefix, nw.num, c.concept_type, nw.old, c.ui AS old_ui FROM nw JOIN concepts c ON c.cidx = nw.old),
cand AS (SELECT DISTINCT nw.cidx, r.ref_term AS term, printf('C%07d', r.ref_id) AS code, r.concept_type AS st, nw.text FROM nw JOIN reference_terms r ON r.ref_term = lower(nw.text))"""

SQL: dict[str, str] = {
    "kb_concepts": _with("SELECT * FROM concepts", _KB),
    "kb_atoms": _with("SELECT a.*, x.s.linked_string AS linked_string FROM atoms a JOIN atoms_ x USING (cidx, pos)", _KB),
    "kb_attributes": _with("SELECT * FROM attrs", _KB),
    "kb_rel_attributes": _with("SELECT * FROM rattrs", _KB),
    "kb_relationships": _with("SELECT * FROM rels", _KB),
    "product_records": "SELECT event_id, json_extract_string(props, '$.page') AS page, json_extract_string(props, '$.k') AS k FROM events",
    "connection_classes": _with("SELECT cidx, min(cidx) OVER (PARTITION BY concept_type, ts) AS rep FROM (SELECT a.cidx, c.concept_type, list_sort(list(DISTINCT term_lc)) AS ts FROM atoms a JOIN concepts c USING (cidx) GROUP BY ALL)", _KB),
    "find_connections": _with(
        "SELECT DISTINCT a.cidx AS i, b.cidx AS j FROM t a JOIN t b USING (concept_type, term_lc) WHERE a.cidx < b.cidx",
        _KB,
        "cls AS (SELECT cidx, min(cidx) OVER (PARTITION BY concept_type, ts) AS rep FROM (SELECT a.cidx, c.concept_type, list_sort(list(DISTINCT term_lc)) AS ts FROM atoms a JOIN concepts c USING (cidx) GROUP BY ALL))",
        "t AS (SELECT DISTINCT a.cidx, c.concept_type, term_lc FROM atoms a JOIN concepts c USING (cidx) JOIN cls ON cls.cidx = a.cidx AND cls.rep = a.cidx)",
    ),
    "connection_stars_docs": _with("SELECT i, j FROM st", _DOCS),
    "components_docs": _with("SELECT v AS doc_id, root AS component FROM comp", _DOCS, _DCOMP, recursive=True),
    "intersection_docs": _with("SELECT root, count(*) AS n FROM comp GROUP BY root HAVING count(*) > 1", _DOCS, _DCOMP, recursive=True),
    "difference_docs": _with("SELECT root FROM comp GROUP BY root HAVING count(*) = 1", _DOCS, _DCOMP, recursive=True),
    "components_connections": _with("SELECT cidx, root FROM roots", _KB, _PAIRS, _ROOTS, recursive=True),
    "merged_atoms": _with(
        "SELECT root AS cidx, (row_number() OVER (PARTITION BY root ORDER BY later, cidx, pos) - 1)::INT AS pos, term, term_lc, src, src_id, term_type, is_preferred, linking_score FROM m",
        _KB, _PAIRS, _ROOTS, f"m AS ({_merged('atoms', 'term_lc, src, src_id, term_type', 'pos', '')})", recursive=True,
    ),
    "merged_attributes": _with(
        "SELECT root AS cidx, (row_number() OVER (PARTITION BY root ORDER BY later, cidx, pos) - 1)::INT AS pos, atr_name, atr_value, src FROM m",
        _KB, _PAIRS, _ROOTS, f"m AS ({_merged('attrs', 'atr_name, atr_value, src', 'pos', '')})", recursive=True,
    ),
    "repointed_relationships": _with(
        "SELECT m.root AS cidx, (row_number() OVER (PARTITION BY m.root ORDER BY later, m.cidx, ridx) - 1)::INT AS ridx, rel_name, coalesce(t.root_ui, object_ui) AS object_ui, src FROM m LEFT JOIN t ON t.ui = m.object_ui",
        _KB, _PAIRS, _ROOTS, f"m AS ({_merged('rels', 'rel_name, object_ui, src', 'ridx', '')})",
        "firstui AS (SELECT ui, min(cidx) AS cidx FROM concepts GROUP BY ui)",
        "t AS (SELECT f.ui, c.ui AS root_ui FROM firstui f JOIN roots r USING (cidx) JOIN firstui c ON c.cidx = r.root)", recursive=True,
    ),
    "union_roots": _with("SELECT cidx, root FROM roots", _KB, _PAIRS, _REPLAY, recursive=True),
    "union_atoms": _with(
        "SELECT root AS cidx, (row_number() OVER (PARTITION BY root ORDER BY later, cidx, pos) - 1)::INT AS pos, term, term_lc, src, src_id, term_type, is_preferred, linking_score FROM m",
        _KB, _PAIRS, _REPLAY, f"m AS ({_merged('atoms', 'term_lc, src, src_id, term_type', 'pos', '')})", recursive=True,
    ),
    "merged_concepts": _with("SELECT cidx, ui, coalesce(p.prefix, c.prefix) AS prefix, num, concept_type FROM concepts c LEFT JOIN pf p USING (cidx) WHERE cidx IN (SELECT root FROM roots)", _KB, _PAIRS, _ROOTS, _PREFIX, recursive=True),
    "intersection_atoms": _with(
        "SELECT root AS cidx, (row_number() OVER (PARTITION BY root ORDER BY later, cidx, pos) - 1)::INT AS pos, term, src FROM m WHERE root IN (SELECT root FROM roots GROUP BY root HAVING count(*) > 1)",
        _KB, _PAIRS, _ROOTS, f"m AS ({_merged('atoms', 'term_lc, src, src_id, term_type', 'pos', '')})", recursive=True,
    ),
    "intersection_concepts": _with("SELECT cidx, ui, coalesce(p.prefix, c.prefix) AS prefix, concept_type FROM concepts c LEFT JOIN pf p USING (cidx) WHERE cidx IN (SELECT root FROM roots GROUP BY root HAVING count(*) > 1)", _KB, _PAIRS, _ROOTS, _PREFIX, recursive=True),
    "difference_relationships": _with(
        "SELECT m.root AS cidx, rel_name, coalesce(t.root_ui, object_ui) AS object_ui, src FROM m LEFT JOIN t ON t.ui = m.object_ui WHERE m.root IN (SELECT root FROM roots GROUP BY root HAVING count(*) = 1)",
        _KB, _PAIRS, _ROOTS, f"m AS ({_merged('rels', 'rel_name, object_ui, src', 'ridx', '')})",
        "firstui AS (SELECT ui, min(cidx) AS cidx FROM concepts GROUP BY ui)",
        "t AS (SELECT f.ui, c.ui AS root_ui FROM firstui f JOIN roots r USING (cidx) JOIN firstui c ON c.cidx = r.root)", recursive=True,
    ),
    "removed_elements": _with(
        "SELECT cidx, pos FROM atoms a WHERE NOT EXISTS (SELECT 1 FROM atoms b WHERE b.src = 'MSKCC' AND b.is_preferred AND b.cidx = a.cidx AND b.term_lc = a.term_lc AND b.src = a.src AND b.src_id IS NOT DISTINCT FROM a.src_id AND b.term_type IS NOT DISTINCT FROM a.term_type)", _KB
    ),
    "merged_source_ids": _with("SELECT cidx, CASE WHEN src_id IS NULL THEN cidx ELSE min(cidx) OVER (PARTITION BY src_id) END AS root FROM pref", _KB, _PREF),
    "preferred_atoms": _with("SELECT cidx, pos, term FROM pref", _KB, _PREF),
    "atoms_by_name": _with("SELECT cidx, pos, term, src, src_id FROM atoms WHERE term = (SELECT term FROM atoms GROUP BY term ORDER BY count(DISTINCT cidx) DESC, term LIMIT 1)", _KB),
    "attributes_by_name": _with("SELECT * FROM attrs WHERE atr_name = 'source_material'", _KB),
    "relationships_by_name": _with("SELECT * FROM rels WHERE rel_name = 'INTERACTS_WITH'", _KB),
    "atom_counts": _with("SELECT cidx, count(*) AS n FROM atoms GROUP BY cidx", _KB),
    "resolve_objects": _with("SELECT * FROM ro", _KB, _IDS),
    "dangling_objects": _with("SELECT object_ui, count(*) AS n FROM rels WHERE object_ui NOT IN (SELECT ui FROM concepts WHERE concept_type = 'SDSI' AND ui IS NOT NULL) GROUP BY object_ui", _KB),
    "dedupe_first_wins": _with("SELECT cidx, min(pos) AS pos FROM atoms GROUP BY cidx, term_lc, src, src_id, term_type", _KB),
    "surrogate_ids": "SELECT proper_name, printf('%04d', row_number() OVER (ORDER BY f)) AS id FROM (SELECT proper_name, min(row_id) AS f FROM nhp_medicinal_ingredients WHERE proper_name IS NOT NULL GROUP BY proper_name)",
    "vocabulary_breaches": _with(
        "SELECT 'src' AS what, src AS value, count(*) AS n FROM atoms WHERE upper(coalesce(src, '')) NOT IN ('UMLS','MEDDRA','NMCD','MSKCC','DSLD','NHPID') GROUP BY src UNION ALL SELECT 'term_type', term_type, count(*) FROM atoms WHERE upper(coalesce(term_type, '')) NOT IN ('SN','CN','SY') GROUP BY term_type UNION ALL SELECT 'concept_type', concept_type, count(*) FROM concepts WHERE upper(coalesce(concept_type, '')) NOT IN ('SDSI','DSP','PD','DIS','TC','SOC','SS') GROUP BY concept_type",
        _KB,
    ),
    "filter_pairs_basic": _with(
        "SELECT p.i, p.j FROM cpairs p JOIN sets a ON a.cidx = p.i JOIN sets b ON b.cidx = p.j WHERE coalesce(a.t, '') NOT IN ('SS', 'PD') AND CASE WHEN len(a.li) = 0 OR len(b.li) = 0 THEN len(list_intersect(a.al, b.pl)) > 0 OR len(b.pl) > 0 ELSE len(list_intersect(a.li, b.li)) >= least(len(a.li), len(b.li)) END",
        _KB, _PAIRS, _IDF, _SETS,
    ),
    "filter_pairs_basic_symmetric": _with(
        "SELECT p.i, p.j FROM cpairs p JOIN sets a ON a.cidx = p.i JOIN sets b ON b.cidx = p.j WHERE coalesce(a.t, '') NOT IN ('SS', 'PD') AND CASE WHEN len(a.li) = 0 OR len(b.li) = 0 THEN len(list_intersect(a.al, b.pl)) > 0 OR len(list_intersect(b.al, a.pl)) > 0 ELSE len(list_intersect(a.li, b.li)) >= least(len(a.li), len(b.li)) END",
        _KB, _PAIRS, _IDF, _SETS,
    ),
    "linked_idf": _with("SELECT src_id, round(idf, 9) AS idf FROM idf", _KB, _IDF),
    "filter_pairs_idf": _with(
        "SELECT p.i, p.j FROM cpairs p JOIN sets a ON a.cidx = p.i JOIN sets b ON b.cidx = p.j WHERE CASE WHEN len(a.st) = 0 OR len(b.st) = 0 THEN len(list_intersect(a.pl, b.pl)) > 0 ELSE len(list_intersect(a.st, b.st)) > 1 END",
        _KB, _PAIRS, _IDF, _SETS,
    ),
    "filter_pairs_annotated": _with("SELECT i, j FROM cpairs WHERE (i + j) % 3 <> 0 OR (i + j) % 2 = 0", _PAIRS),
    "annotation_tasks": _with(
        "SELECT p.i, p.j, a.term AS term_i, b.term AS term_j, array_to_string(list_sort(list_intersect(x.al, y.al)), '|') AS matched_on FROM cpairs p JOIN pref a ON a.cidx = p.i JOIN pref b ON b.cidx = p.j JOIN sets x ON x.cidx = p.i JOIN sets y ON y.cidx = p.j WHERE lower(a.term) <> lower(b.term)",
        _KB, _PAIRS, _PREF, _IDF, _SETS,
    ),
    "lint_schema": _with(_LINT, _KB, _SCHEMA),
    "remove_source_atoms": _with("SELECT cidx, pos FROM atoms WHERE coalesce(src, '') <> 'NMCD'", _KB),
    "remove_source_relationships": _with(
        "SELECT r.cidx, ridx FROM rels r JOIN kept k USING (cidx) WHERE NOT (k.concept_type IN ('SS', 'DIS') AND coalesce(r.src, '') = 'NMCD') AND NOT (r.object_ui IN (SELECT ui FROM concepts) AND r.object_ui NOT IN (SELECT ui FROM kept WHERE ui IS NOT NULL))",
        _KB,
        "kept AS (SELECT * FROM concepts c WHERE NOT (concept_type IN ('SS', 'DIS') AND NOT EXISTS (SELECT 1 FROM atoms a WHERE a.cidx = c.cidx AND coalesce(a.src, '') <> 'NMCD')))",
    ),
    "count_concepts": _with("SELECT count(DISTINCT ui) AS n FROM concepts", _KB),
    "count_types": _with("SELECT concept_type, count(DISTINCT ui) AS n FROM concepts GROUP BY concept_type", _KB),
    "count_type_source": _with("SELECT concept_type, src, count(DISTINCT ui) AS n FROM atoms JOIN concepts USING (cidx) GROUP BY ALL", _KB),
    "source_overlap": _with(
        "SELECT sources, count(*) AS n FROM (SELECT ui, replace(array_to_string(list_sort(coalesce(list(DISTINCT src) FILTER (WHERE src IS NOT NULL), [])), '_'), '_UMLS', '') AS sources FROM atoms JOIN concepts USING (cidx) WHERE concept_type = 'SDSI' GROUP BY ui) GROUP BY sources",
        _KB,
    ),
    "atom_count_stats": _with(_stats(_PER), _KB),
    "atom_count_extremes": _with("(SELECT 'low' AS side, cidx, n FROM per ORDER BY n, cidx LIMIT 3) UNION ALL (SELECT 'high', cidx, n FROM per ORDER BY n DESC, cidx DESC LIMIT 3)", _KB, f"per AS ({_PER})"),
    "linked_code_stats": _with(_stats(_CODES), _KB),
    "linked_code_ratio": _with("SELECT count(DISTINCT src_id) AS codes, count(DISTINCT cidx) AS concepts, round(count(DISTINCT src_id) / nullif(count(DISTINCT cidx), 0), 6) AS ratio FROM atoms WHERE src = 'UMLS' AND cidx IN (SELECT cidx FROM concepts WHERE concept_type = 'SDSI')", _KB),
    "rel_counts": _with("SELECT rel_name, src, count(*) AS n, grouping(rel_name, src)::BIGINT AS level FROM rels GROUP BY ROLLUP (rel_name, src)", _KB),
    "attr_counts": _with("SELECT atr_name, src, count(*) AS n, grouping(atr_name, src)::BIGINT AS level FROM (SELECT atr_name, src FROM attrs UNION ALL SELECT atr_name, src FROM rattrs) GROUP BY ROLLUP (atr_name, src)", _KB),
    "invalid_names": f"SELECT potency_amount, count(*) AS n FROM nhp_medicinal_ingredients WHERE {_invalid('potency_amount')} GROUP BY potency_amount",
    "expand_parens": f"SELECT name, unnest(list_concat([{_SQUEEZE.format(chr(39).join(['regexp_replace(name, ', chr(92) + '(.*' + chr(92) + ')', ', ', '', ')']))}], list_transform(regexp_extract_all(name, '\\(.*?\\)'), lambda x: regexp_replace(x, '[()]', '', 'g')))) AS part FROM (SELECT DISTINCT common_name AS name FROM nhp_medicinal_ingredients WHERE common_name IS NOT NULL)",
    "clean_synonyms": f"SELECT name, {_clean('name')} AS clean FROM (SELECT DISTINCT common_name AS name FROM nhp_medicinal_ingredients WHERE common_name IS NOT NULL)",
    "group_synonyms": f"""WITH g AS (SELECT ingredient_id AS group_id, min(proper_name) AS group_name, list(DISTINCT common_name) FILTER (WHERE common_name IS NOT NULL) AS s FROM nhp_medicinal_ingredients GROUP BY ingredient_id),
        one AS (SELECT group_id, group_name, unnest(string_split(replace(array_to_string(list_sort(s), ';'), '"', ''), ';')) AS x FROM g),
        clean AS (SELECT DISTINCT group_id, group_name, {_clean('x')} AS c FROM one WHERE x IS NOT NULL),
        wide AS (SELECT DISTINCT group_id, unnest(list_concat([{_SQUEEZE.format("regexp_replace(c, '" + chr(92) + "(.*" + chr(92) + ")', '')")}], list_transform(regexp_extract_all(c, '\\(.*?\\)'), lambda x: regexp_replace(x, '[()]', '', 'g')))) AS synonym FROM clean WHERE c <> '' AND group_id IS NOT NULL AND group_name IS NOT NULL)
        SELECT group_id, array_to_string(list_sort(list(synonym)), '|') AS synonyms FROM wide GROUP BY group_id""",
    "page_sections": rf"""WITH d AS (SELECT doc_id, regexp_extract_all(text, '(?m)^(?:<h\d>)?([A-Z][A-Za-z ]{{2,40}})(?:</h\d>)?:[ \t]+\S', 1) AS h,
          string_split_regex(regexp_replace(chr(10) || text, '\n(?:<h\d>)?[A-Z][A-Za-z ]{{2,40}}(?:</h\d>)?:[ \t]+(\S)', chr(1) || '\1', 'g'), chr(1)) AS v FROM documents WHERE source = 'herb_page'),
        e AS (SELECT doc_id, unnest(h) AS h, generate_subscripts(h, 1) AS k, v FROM d WHERE len(h) > 0)
        SELECT doc_id, (k - 1)::INT AS pos, replace(lower(h), ' ', '_') AS header, {_STRIP.format('v[k + 1]')} AS value FROM e""",
    "section_headers": r"""SELECT replace(lower(h), ' ', '_') AS header, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '(?m)^(?:<h\d>)?([A-Z][A-Za-z ]{2,40})(?:</h\d>)?:[ \t]+\S', 1)) AS h FROM documents WHERE source = 'herb_page') GROUP BY 1""",
    "lint_lines": "SELECT line_no FROM ingredients_jsonl WHERE NOT coalesce(json_valid(line), false) OR CASE WHEN json_valid(line) THEN json_type(line) <> 'OBJECT' ELSE true END",
    "split_content": "SELECT doc_id, unnest(list_distinct(flatten(list_transform(list_filter(string_split(text, chr(10)), lambda x: x <> ''), lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN [x] ELSE string_split(x, '/') END)))) AS part FROM documents WHERE text IS NOT NULL",
    "normalize_queries": f"SELECT name, {_SQUEEZE.format(chr(39).join(['regexp_replace(regexp_replace(name, ', '[^' + chr(92) + 'x00-' + chr(92) + 'x7F]+', ', ', ' ', ', ', 'g', '), ', chr(92) + '([^)]*' + chr(92) + ')', ', ', '', ', ', 'g', ')']))} AS query FROM (SELECT DISTINCT proper_name AS name FROM nhp_medicinal_ingredients WHERE proper_name IS NOT NULL)",
    "registry_atoms": _with("SELECT * FROM natoms", _NHP),
    "registry_attributes": _with(
        f"SELECT row_id, 'source_material' AS atr_name, CASE WHEN coalesce(source_material, '') <> '' THEN {_STRIP.format('source_material')} ELSE {_STRIP.format('source_material_f')} END AS atr_value FROM nkept WHERE coalesce(source_material, '') <> '' OR coalesce(source_material_f, '') <> ''",
        _NHP,
    ),
    "registry_products": _with("SELECT src_id, term FROM nprod", _NHP),
    "connect_products": _with("SELECT * FROM nedges WHERE product_id IN (SELECT src_id FROM nprod)", _NHP),
    "unknown_products": _with("SELECT product_id, count(*) AS n FROM nedges WHERE product_id NOT IN (SELECT src_id FROM nprod) GROUP BY product_id", _NHP),
    "registry_records": _with(_flat("NHPID"), _NHP, _REGISTRY),
    "label_records": _with(_flat("DSLD"), _GROUPS, _LABEL),
    "herb_records": _with(_flat("MSKCC"), _KB, _HERB),
    "registry_concepts": _with(
        "SELECT src_id, n_atoms, n_rows FROM (SELECT src_id, count(DISTINCT (lower(term), term_type)) AS n_atoms FROM natoms GROUP BY src_id) JOIN (SELECT replace(ingredient_id, '.0', '') AS src_id, count(*) AS n_rows FROM nkept GROUP BY 1) USING (src_id)",
        _NHP,
    ),
    "link_rules": _with("SELECT id, m AS matched, term, code FROM qs JOIN organs USING (k)", _ORGANS),
    "link_rules_best": _with("SELECT id, m AS matched, code FROM qs JOIN organs USING (k)", _ORGANS),
    "linkables": _with("SELECT * FROM lk", _KB, _PREF, _LINKABLE),
    "captured_links": _with("SELECT id, matched, term, code, score FROM cap WHERE st IN ('DIS', 'SS')", _KB, _PREF, _CAPTURED),
    "captured_links_best": _with("SELECT id, matched, code, score FROM cap WHERE score >= 800 QUALIFY row_number() OVER (PARTITION BY id, matched ORDER BY score DESC, ref_id) <= 2", _KB, _PREF, _CAPTURED),
    "annotator_links": _with("SELECT id, matched, term, code FROM svc QUALIFY row_number() OVER (PARTITION BY id, matched ORDER BY at0, code) = 1", _KB, _PREF, _CAPTURED),
    "routed_links": _with(
        "SELECT id, 'rules' AS terminology, m AS matched, code, 0.0::DOUBLE AS score FROM qs JOIN organs USING (k) UNION ALL (SELECT id, 'mapper', matched, code, score FROM cap WHERE score >= 800 AND id IN (SELECT id FROM lk JOIN concepts USING (cidx) WHERE concept_type = 'DIS') QUALIFY row_number() OVER (PARTITION BY id, matched ORDER BY score DESC, ref_id) = 1) "
        "UNION ALL (SELECT id, 'service', matched, code, 0.0 FROM svc WHERE id IN (SELECT id FROM lk JOIN concepts USING (cidx) WHERE concept_type = 'SS') QUALIFY row_number() OVER (PARTITION BY id, matched ORDER BY at0, code) = 1)",
        _KB, _PREF, _CAPTURED, _ORGANS,
    ),
    "rewritten_concepts": _with("SELECT * FROM concepts WHERE cidx NOT IN (SELECT cidx FROM gone) UNION ALL SELECT cidx, ui, concept_type, prefix, num FROM ncon", _KB, _PREF, _LINKABLE, _CLONES, _NEW),
    "rewritten_atoms": _with(
        "SELECT a.cidx, a.pos, term, src, src_id, term_type, is_preferred, linking_score, x.s.linked_string AS linked_string FROM atoms a JOIN atoms_ x USING (cidx, pos) WHERE cidx NOT IN (SELECT cidx FROM gone) "
        "UNION ALL SELECT nw.cidx, a.pos, term, src, src_id, term_type, is_preferred, linking_score, x.s.linked_string FROM atoms a JOIN atoms_ x USING (cidx, pos) JOIN nw ON nw.old = a.cidx "
        "UNION ALL SELECT cidx, (1000000 + row_number() OVER (PARTITION BY cidx ORDER BY code))::INT, term, 'UMLS', code, 'SY', true, 1.0, text FROM cand",
        _KB, _PREF, _LINKABLE, _CLONES, _NEW,
    ),
    "rewritten_attributes": _with(
        "SELECT * FROM attrs WHERE cidx NOT IN (SELECT cidx FROM gone) UNION ALL SELECT nw.cidx, pos, atr_name, atr_value, src FROM attrs JOIN nw ON nw.old = attrs.cidx "
        "UNION ALL SELECT cidx, (1000000 + row_number() OVER (PARTITION BY cidx ORDER BY st))::INT, 'umls_semantic_type', st, 'UMLS' FROM (SELECT DISTINCT cidx, st FROM cand)",
        _KB, _PREF, _LINKABLE, _CLONES, _NEW,
    ),
    "rewritten_relationships": _with(
        "SELECT r.cidx, (row_number() OVER (PARTITION BY r.cidx ORDER BY r.ridx, n.ui) - 1)::INT AS ridx, r.rel_name, n.ui AS object_ui, r.src FROM (SELECT * FROM rels WHERE cidx NOT IN (SELECT cidx FROM gone) UNION ALL SELECT nw.cidx, ridx, rel_name, object_ui, src FROM rels JOIN nw ON nw.old = rels.cidx) r JOIN ncon n ON n.old_ui = r.object_ui",
        _KB, _PREF, _LINKABLE, _CLONES, _NEW,
    ),
    "rrf_mrsty": _with('SELECT cui AS "CUI", concept_type AS "STY" FROM concepts JOIN ids USING (cidx)', _KB, _IDS),
    "rrf_mrconso": _with(
        "SELECT cui AS \"CUI\", 'DA' || cidx || '_' || pos AS \"AUI\", term AS \"STR\", term_type AS \"TTY\", src AS \"SAB\", src_id AS \"SCODE\", CASE WHEN is_preferred THEN 'Y' ELSE 'N' END AS \"ISPREF\" FROM atoms JOIN ids USING (cidx)", _KB, _IDS
    ),
    "rrf_mrsat": _with(
        "SELECT 'DAT' || cidx || '_' || pos AS \"ATUI\", cui AS \"UI\", 'DSCUI' AS \"STYPE\", atr_name AS \"ATN\", atr_value AS \"ATV\", src AS \"SAB\" FROM attrs JOIN ids USING (cidx) UNION ALL SELECT 'DAT' || a.cidx || '_R_' || a.ridx || '_' || pos, 'DR' || a.cidx || '_' || a.ridx, 'DSRUI', atr_name, atr_value, a.src FROM rattrs a JOIN ro ON ro.cidx = a.cidx AND ro.ridx = a.ridx WHERE object_cidx IS NOT NULL",
        _KB, _IDS,
    ),
    "rrf_mrrel": _with("SELECT 'DR' || ro.cidx || '_' || ridx AS \"RUI\", a.cui AS \"CUI1\", rel_name AS \"REL\", b.cui AS \"CUI2\", src AS \"SAB\" FROM ro JOIN ids a ON a.cidx = ro.cidx JOIN ids b ON b.cidx = object_cidx", _KB, _IDS),
    "graph_nodes": _with(
        "SELECT cui AS id, concept_type AS label, p.term AS name, properties FROM concepts JOIN ids USING (cidx) LEFT JOIN pref p USING (cidx) LEFT JOIN props USING (cidx) UNION ALL SELECT 'DA' || cidx || '_' || pos, concept_type || '_ATOM', term, 'is_preferred=' || is_preferred || coalesce('; src=' || src, '') || coalesce('; src_id=' || src_id, '') FROM atoms JOIN concepts USING (cidx)",
        _KB, _IDS, _PREF, _PROPS,
    ),
    "graph_edges": _with(
        "SELECT cui AS src_id, 'has_synonym' AS type, 'DA' || cidx || '_' || pos AS dst_id, NULL AS properties FROM atoms JOIN ids USING (cidx) UNION ALL SELECT a.cui, rel_name, b.cui, properties FROM ro JOIN ids a ON a.cidx = ro.cidx JOIN ids b ON b.cidx = object_cidx LEFT JOIN rprops p ON p.cidx = ro.cidx AND p.ridx = ro.ridx",
        _KB, _IDS, _PROPS,
    ),
    "mth_conso": _with(
        "SELECT CUI AS \"CUI\", '' AS \"LAT\", '' AS \"TS\", '' AS \"LUI\", '' AS \"STT\", '' AS \"SUI\", '' AS \"ISPREF\", '' AS \"AUI\", '' AS \"SAUI\", '' AS \"SCUI\", '' AS \"SDUI\", 'REF' AS \"SAB\", '' AS \"TTY\", '' AS \"CODE\", ref_term AS \"STR\", '' AS \"SRL\", '' AS \"SUPPRESS\", '' AS \"CVF\", '' AS \"END\" FROM refs "
        "UNION ALL SELECT o.CUI, 'ENG', 'S', 'DL' || a.cidx || '_' || a.pos, 'PF', 'DS' || a.cidx || '_' || a.pos, 'N', 'DA' || a.cidx || '_' || a.pos, '', '', '', 'TLKB', x.s.term_type, ids.cui, a.term, '0', 'N', '', '' FROM owner o JOIN matoms a USING (cidx) JOIN atoms_ x USING (cidx, pos) JOIN ids USING (cidx) WHERE coalesce(a.src, '') <> 'UMLS' AND NOT regexp_matches(a.term, '[^\\x00-\\x7F]')",
        _KB, _IDS, _MTH,
    ),
    "mth_semtypes": _with(
        "SELECT CUI AS \"CUI\", TUI AS \"TUI\", '' AS \"STN\", '' AS \"STY\", printf('AT%08d', ref_id) AS \"ATUI\", '' AS \"CVF\" FROM refs UNION ALL SELECT CUI, TUI, tree, long, printf('DAT%07d', (SELECT max(ref_id) FROM refs) + row_number() OVER (ORDER BY CUI || '|' || TUI)), '111' FROM added",
        _KB, _MTH,
        "types(short, TUI, tree, long) AS (VALUES ('phsu', 'T121', 'A1.4.1.1.1', 'Pharmacologic Substance'), ('sosy', 'T184', 'A2.2.2', 'Sign or Symptom'), ('dsyn', 'T047', 'B2.2.1.2.1', 'Disease or Syndrome'), ('fndg', 'T033', 'A2.2', 'Finding'))",
        "added AS (SELECT DISTINCT CUI, TUI, tree, long FROM (SELECT o.CUI, t.TUI, t.tree, t.long FROM owner o JOIN attrs a USING (cidx) JOIN types t ON t.short = a.atr_value OR t.TUI = a.atr_value WHERE atr_name = 'umls_semantic_type' UNION SELECT o.CUI, t.TUI, t.tree, t.long FROM owner o, types t WHERE t.short = 'phsu') WHERE (CUI, TUI) NOT IN (SELECT (CUI, TUI) FROM refs))",
    ),
    "mth_new_cuis": _with('SELECT cidx, CUI AS "CUI" FROM fresh', _KB, _MTH),
    "mth_source_row": _with("SELECT 'TLKB_v1.0.1' AS \"VSAB\", 'TLKB' AS \"RSAB\", '1.0.1' AS \"SVER\", count(*) AS \"TFR\", count(DISTINCT ui) AS \"CFR\", 'SN,CN,SY' AS \"TTYL\", 'ENG' AS \"LAT\", 'UTF-8' AS \"CENC\", 'Y' AS \"CURVER\", 'Y' AS \"SABIN\" FROM atoms JOIN concepts USING (cidx) WHERE concept_type = 'SDSI'", _KB),
    "mth_rank": "SELECT printf('%04d', src_rank + 3) AS rank, src AS \"SAB\", 'PT' AS \"TTY\", 'N' AS suppress FROM source_rank UNION ALL VALUES ('0003', 'TLKB', 'SN', 'N'), ('0002', 'TLKB', 'CN', 'N'), ('0001', 'TLKB', 'SY', 'N')",
}
