"""Checking SQL for the queries over the star tables (ANSI SQL plus list functions).

`WITH` clauses shared by several checks are written once. They follow the
row-level definitions, not the rolled-up plans the Spark side uses.
"""
from __future__ import annotations

from .. import rules
from . import star_profile as p


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(rows) -> str:
    cell = lambda v: q(v) if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)


def words(expr: str) -> str:
    return f"list_filter(string_split_regex({expr}, '\\s+'), lambda w: w <> '')"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


def plain_words(expr: str) -> str:
    return words(f"regexp_replace(replace(upper({expr}), '&', ' AND '), '[^A-Z0-9 ]+', ' ', 'g')")


def strip_prefix(expr: str) -> str:
    return strip(f"regexp_replace(regexp_replace({expr}, '{rules.RECORD_PREFIX}', ''), '[* ]+$', '')")


def norm_name(expr: str) -> str:
    legal = f"string_split_regex(upper({strip_prefix(f'coalesce({expr}, {q(str())})')}), '{rules.TRADE_NAME_CUT}')[1]"
    joined = f"regexp_replace(array_to_string({plain_words(legal)}, ' '), '\\bL L C\\b', 'LLC', 'g')"
    suffixes = ", ".join(q(s) for s in rules.LEGAL_SUFFIXES)
    return f"array_to_string(list_filter({words(joined)}, lambda t: t NOT IN ({suffixes})), ' ')"


def norm_address(expr: str) -> str:
    street = f"string_split_regex(upper(coalesce({expr}, '')), '{rules.UNIT_CUT}')[1]"
    cases = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in rules.STREET_WORDS)
    return f"array_to_string(list_transform({plain_words(street)}, lambda t: CASE t {cases} ELSE t END), ' ')"


def zip_key(expr: str) -> str:
    digits = f"regexp_replace(coalesce({expr}, ''), '[^0-9]', '', 'g')"
    return f"CASE WHEN {digits} = '' THEN '' ELSE lpad(substr({digits}, 1, 5), 5, '0') END"


def capital(w: str) -> str:
    return f"(upper(substr({w}, 1, 1)) || lower(substr({w}, 2)))"


def pretty(expr: str) -> str:
    name = strip_prefix(expr)
    keep = ", ".join(q(s) for s in rules.KEEP_UPPER)
    small = ", ".join(q(s) for s in rules.SMALL_WORDS)
    core = "regexp_replace(w, '^[.,]+|[.,]+$', '', 'g')"
    return (f"CASE WHEN regexp_matches({name}, '[A-Z]') AND NOT regexp_matches({name}, '[a-z]') THEN "
            f"array_to_string(list_transform({words(name)}, lambda w, i: CASE WHEN {core} IN ({keep}) "
            f"OR (length({core}) <= 3 AND NOT regexp_full_match({core}, '[A-Za-z]+')) THEN w "
            f"WHEN {core} IN ({small}) AND i > 1 THEN lower(w) ELSE {capital('w')} END), ' ') ELSE {name} END")


def title(expr: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(coalesce({expr}, ''), '[A-Za-z]+|[^A-Za-z]+'), "
            f"lambda w: {capital('w')}), '')")


def numbers(expr: str) -> str:
    bare = "regexp_replace(replace(t, ',', ''), '^0+([0-9])', '\\1')"
    norm = f"CASE WHEN contains(t, '.') THEN regexp_replace({bare}, '\\.?0+$', '') ELSE {bare} END"
    return f"list_distinct(list_transform(regexp_extract_all({expr}, '[0-9][0-9,]*(?:\\.[0-9]+)?'), lambda t: {norm}))"


def readable(expr: str) -> str:
    return f"coalesce(strftime({expr}, '%b %-d, %Y'), 'no date')"


def parse(source: str) -> str:
    """SELECT standard, citation, title, category FROM source(standard)."""
    mark = ("CASE WHEN regexp_full_match(t, '[A-Z][0-9]{2}') THEN '(' || lower(substr(t, 1, 1)) || ')(' || "
            "CAST(CAST(substr(t, 2) AS INT) AS VARCHAR) || ')' WHEN i > 1 AND regexp_full_match(t, '[IVX]+') "
            "THEN '(' || lower(t) || ')' ELSE '(' || t || ')' END")
    return f"""
  SELECT standard,
    CASE WHEN fed THEN '29 CFR ' || part || '.' || CAST(section AS VARCHAR)
           || array_to_string(list_transform({words('rest')}, lambda t, i: {mark}), '')
         WHEN starts_with(up, '5A0001') THEN 'OSH Act 5(a)(1)'
         WHEN starts_with(up, '408.1011') THEN 'MCL 408.1011'
         WHEN st THEN rtrim('Mich. R ' || series || '.' || digits || letter || tail)
         WHEN raw = '' THEN 'unknown' ELSE raw END AS citation,
    CASE WHEN fed AND part = '1910' AND section = 252 AND starts_with(rest, 'C') THEN {q(rules.WELDING_TITLE)}
         WHEN fed THEN coalesce(s.title, o.title, part || '.' || CAST(section AS VARCHAR))
         WHEN starts_with(up, '5A0001') THEN 'General Duty Clause'
         WHEN starts_with(up, '408.1011') THEN 'Michigan general duty clause'
         WHEN st AND series = '325' THEN 'MIOSHA ' || coalesce(r.title, 'occupational health rule')
         WHEN st AND num = 10015 THEN 'MIOSHA Part 1 Housekeeping'
         WHEN st AND num BETWEEN 10000 AND 19999 THEN 'MIOSHA ' || coalesce(m.title, 'Part ' || CAST(mpart AS VARCHAR))
         WHEN st AND num BETWEEN 22101 AND 22199 THEN 'MIOSHA Part 11 Recordkeeping'
         WHEN st THEN 'MIOSHA rule' ELSE 'State or other rule' END AS title,
    CASE WHEN fed AND part = '1910' AND section = 252 AND starts_with(rest, 'C') THEN 'adjacent'
         WHEN fed THEN coalesce(s.category, 'other')
         WHEN starts_with(up, '5A0001') OR starts_with(up, '408.1011') THEN 'other'
         WHEN st AND series = '325' THEN coalesce(r.category, 'other')
         WHEN st AND num = 10015 THEN 'adjacent'
         WHEN st AND num BETWEEN 10000 AND 19999 THEN CASE mpart WHEN 77 THEN 'dust' WHEN 76 THEN 'adjacent' ELSE 'other' END
         ELSE 'other' END AS category
  FROM (SELECT *, regexp_matches(up, '^19[0-9][0-9][0-9]{{4}}') AS fed,
          regexp_extract(up, '^(19[0-9][0-9])', 1) AS part,
          TRY_CAST(regexp_extract(up, '^19[0-9][0-9]([0-9]{{4}})', 1) AS INT) AS section,
          regexp_extract(up, '^19[0-9][0-9][0-9]{{4}}\\s*(.*)$', 1) AS rest,
          regexp_matches(raw, '^(325|408)\\.[0-9]{{4,5}}') AS st,
          regexp_extract(raw, '^(325|408)\\.', 1) AS series,
          regexp_extract(raw, '^(?:325|408)\\.([0-9]{{4,5}})', 1) AS digits,
          TRY_CAST(regexp_extract(raw, '^(?:325|408)\\.([0-9]{{4,5}})', 1) AS INT) AS num,
          regexp_extract(raw, '^(?:325|408)\\.[0-9]{{4,5}}([a-zA-Z]?)', 1) AS letter,
          regexp_extract(raw, '^(?:325|408)\\.[0-9]{{4,5}}[a-zA-Z]?\\s*(.*)$', 1) AS tail,
          coalesce(nullif((TRY_CAST(regexp_extract(raw, '^(?:325|408)\\.([0-9]{{4,5}})', 1) AS INT) // 100) % 100, 0), 1) AS mpart
        FROM (SELECT standard, {strip("coalesce(standard, '')")} AS raw,
                upper({strip("coalesce(standard, '')")}) AS up FROM {source}))
  LEFT JOIN (VALUES {values(rules.FEDERAL_SECTIONS)}) s(number, title, category) ON part = '1910' AND section = s.number
  LEFT JOIN (VALUES {values(rules.FEDERAL_PARTS)}) o(number, title) ON part = o.number
  LEFT JOIN (VALUES {values(rules.STATE_HEALTH_RANGES)}) r(lo, hi, title, category) ON series = '325' AND num BETWEEN r.lo AND r.hi
  LEFT JOIN (VALUES {values(rules.STATE_SAFETY_PARTS)}) m(number, title) ON mpart = m.number"""


def _sel(columns: list[str]) -> str:
    return ",\n    ".join(columns)


_DUSTY = "(title IN ('General Duty Clause', 'Michigan general duty clause') OR lower(title) LIKE '%hazard communication%')"
#: Fields of an entity that come from its newest record, null values passed over.
_NEWEST = {"name": "estab_name", "address": "site_address", "city": "site_city", "state": "site_state", "zip5": "zip5",
           "naics": "naics_code", "employees": "employees"}

def _industry(pick) -> str:
    flat = sorted(((pre, label, pts) for label, pres, pts in rules.INDUSTRIES for pre in pres),
                  key=lambda r: -len(r[0]))
    return "CASE " + " ".join(f"WHEN starts_with(naics, {q(pre)}) THEN {pick(label, pts)}"
                              for pre, label, pts in flat) + " END"


def match_ctes(forms: str, entities: str, prefix: str = "") -> str:
    """forms_ok, keys and matched over a forms table and an entity table."""
    amount = lambda c: (f"CASE WHEN upper(trim(coalesce({c}, ''))) IN ('', 'NA', 'N/A', 'NE', 'NR') THEN 0 "
                        f"ELSE CAST(replace(trim({c}), ',', '') AS DECIMAL(28, 6)) END")
    target = " OR ".join(f"starts_with(trim(coalesce(naics_{i}, '')), {q(pre)})"
                         for i in range(1, 7) for pre in rules.DEFAULT_RULES.prefixes)
    return f"""
{prefix}forms_ok AS (
  SELECT {norm_name('facility_name')} AS n, upper(trim(state)) AS s, {zip_key('zip')} AS z,
    trim(chemical) AS chemical, {amount('fugitive_air')} + {amount('stack_air')} AS release, ({target}) AS target
  FROM {forms} WHERE upper(trim(metal)) = 'YES' AND upper(trim(form_type)) = 'R' AND lower(trim(unit)) = 'pounds'
    AND {amount('fugitive_air')} + {amount('stack_air')} > 0),
{prefix}keys AS (
  SELECT n, s, z, count(DISTINCT facility_id) AS c, min(facility_id) AS facility_id
  FROM (SELECT facility_id, {norm_name('name')} AS n, state AS s, {zip_key('zip5')} AS z FROM {entities})
  WHERE n <> '' AND s <> '' AND z <> '' GROUP BY n, s, z),
{prefix}matched AS (
  SELECT f.*, k.facility_id, coalesce(k.c, 0) AS c FROM {prefix}forms_ok f
  LEFT JOIN {prefix}keys k ON f.n = k.n AND f.s = k.s AND f.z = k.z)"""


CTES = f"""
insp AS (
  SELECT *, CASE WHEN employees_reported BETWEEN 1 AND 4999 THEN employees_reported END AS employees
  FROM (SELECT {_sel(p.INSPECTION)} FROM orders JOIN customer ON o_custkey = c_custkey)),
viol AS (SELECT {_sel(p.VIOLATION)} FROM lineitem WHERE NOT ({p.WITHDRAWN})),
withdrawn AS (SELECT {_sel(p.VIOLATION[:3])} FROM lineitem WHERE {p.WITHDRAWN}),
inj AS (SELECT {_sel(p.INJURY)} FROM lineitem WHERE {p.INJURY_ROWS}),
prog AS (
  SELECT o_orderkey AS activity_nr, {q(rules.DUST_PROGRAM)} AS program FROM orders WHERE {p.NEP_ROWS}
  UNION SELECT o_orderkey, {q(rules.SILICA_PROGRAM)} FROM orders WHERE {p.SILICA_ROWS}),
labels AS (SELECT activity_nr, array_to_string(list_sort(list(program)), '; ') AS dust_program FROM prog GROUP BY ALL),
fi AS (FROM insp LEFT JOIN labels USING (activity_nr)),
params AS (
  SELECT as_of, CAST(as_of - INTERVAL 36 MONTH AS DATE) AS window_start, CAST(as_of - INTERVAL 24 MONTH AS DATE) AS injury_start
  FROM (SELECT max(d) AS as_of FROM (SELECT open_date AS d FROM insp UNION ALL SELECT issuance_date FROM viol))),
codes AS (SELECT DISTINCT standard FROM viol),
lookup AS ({parse('codes')}),
found AS (
  SELECT 'citation' AS kind, issuance_date AS evidence_date, viol.* EXCLUDE (standard, issuance_date),
    lookup.* EXCLUDE (standard, category), category AS own_category
  FROM lookup JOIN viol ON viol.standard = lookup.standard
  UNION ALL BY NAME
  SELECT 'program_inspection' AS kind, open_date AS evidence_date, activity_nr, concat('Inspected under ', dust_program) AS title,
    'adjacent' AS own_category
  FROM fi WHERE dust_program IS NOT NULL),
evidence AS (
  SELECT found.* EXCLUDE (own_category), facility_id, dust_program, open_date,
    CASE WHEN kind = 'citation' AND contains(dust_program, {q(rules.DUST_PROGRAM)}) AND {_DUSTY} THEN 'dust'
      ELSE own_category END AS category
  FROM found JOIN fi ON fi.activity_nr = found.activity_nr, params WHERE evidence_date >= window_start),
newest AS (
  SELECT facility_id, {', '.join(f"arg_max({c}, (open_date, activity_nr)) FILTER (WHERE {c} IS NOT NULL) AS {n}" for n, c in _NEWEST.items())}
  FROM fi GROUP BY facility_id),
tallies AS (
  SELECT facility_id, len(list_distinct(list(substr(naics_code, 1, 3)))) > 1 AS naics_conflict,
    len(list_distinct(list(estab_name))) AS name_variants, count(*) AS n_inspections, max(review_required) AS facility_match_review_required,
    sum(CASE WHEN open_date >= window_start THEN 1 ELSE 0 END)::BIGINT AS n_inspections_window,
    min(open_date) AS first_inspection, max(open_date) AS last_inspection
  FROM fi, params GROUP BY facility_id),
facilities AS (FROM newest JOIN tallies USING (facility_id)),
accidents AS (  -- newest day of each kind of accident of a record, at all and in its window
  SELECT activity_nr, max(CASE WHEN degree = 'fatality' THEN event_date END) AS death,
    count_if(degree = 'fatality' AND event_date IS NULL) > 0 AS undated_death,
    count_if(degree = 'hospitalized' AND event_date IS NULL) > 0 AS undated_harm,
    max(CASE WHEN degree = 'fatality' AND event_date >= window_start THEN event_date END) AS recent_death,
    max(CASE WHEN degree = 'hospitalized' THEN event_date END) AS harm,
    max(CASE WHEN degree = 'hospitalized' AND event_date >= injury_start THEN event_date END) AS recent_harm
  FROM inj, params GROUP BY activity_nr),
disputes AS (SELECT activity_nr, max(contest_date) AS disputed FROM viol WHERE final_order_date IS NULL GROUP BY activity_nr),
holds AS (
  SELECT facility_id,
    max(CASE WHEN insp_type = 'M' AND open_date >= window_start THEN greatest(death, CASE WHEN death IS NULL OR undated_death THEN open_date END) ELSE recent_death END) AS fatality_date,
    max(CASE WHEN insp_type = 'A' AND open_date >= injury_start THEN greatest(harm, CASE WHEN harm IS NULL OR undated_harm THEN open_date END) ELSE recent_harm END) AS hospitalization_date,
    max(disputed) AS contested_date
  FROM fi LEFT JOIN accidents USING (activity_nr) LEFT JOIN disputes USING (activity_nr), params GROUP BY facility_id),
forms AS (SELECT {_sel(p.FORM)} FROM events JOIN customer ON user_id = c_custkey),
{match_ctes('forms', 'facilities')},
signals AS (
  SELECT facility_id, CAST(sum(release) AS DOUBLE) AS release_lbs,
    list_sort(list(DISTINCT chemical)) AS chemicals, CAST(count(*) AS INTEGER) AS forms
  FROM matched WHERE c = 1 GROUP BY facility_id),
points AS (
  SELECT facility_id,
    max(evidence_date) FILTER (WHERE kind = 'citation' AND category = 'dust') AS dust_date,
    max(evidence_date) FILTER (WHERE (kind = 'citation' AND category = 'adjacent') OR kind = 'program_inspection') AS adjacent_date,
    bool_or(kind = 'citation' AND viol_type IN ('S', 'W', 'R')) AS serious
  FROM evidence GROUP BY facility_id),
scored AS (
  SELECT f.*, h.fatality_date, h.hospitalization_date, h.contested_date,
    t.release_lbs, t.chemicals, t.forms,
    {_industry(lambda label, pts: q(label))} AS industry,
    coalesce({_industry(lambda label, pts: pts)}, 0) AS industry_pts,
    CASE WHEN dust_date IS NOT NULL THEN 3 WHEN adjacent_date IS NOT NULL THEN 2 WHEN serious THEN 1 ELSE 0 END AS dust_pts,
    coalesce(dust_date, adjacent_date) AS evidence_date,
    CASE WHEN dust_date IS NOT NULL THEN 'dust-specific citation'
      WHEN adjacent_date IS NOT NULL THEN 'dust-related citation or dust-program inspection'
      WHEN serious THEN 'serious citation, not dust-related' ELSE 'no citations in the last 36 months' END AS dust_reason,
    CASE WHEN coalesce(dust_date, adjacent_date) >= (SELECT as_of - INTERVAL 12 MONTH FROM params) THEN 3
      WHEN coalesce(dust_date, adjacent_date) >= (SELECT as_of - INTERVAL 24 MONTH FROM params) THEN 2
      WHEN coalesce(dust_date, adjacent_date) >= (SELECT as_of - INTERVAL 36 MONTH FROM params) THEN 1 ELSE 0 END AS recency_pts,
    CASE WHEN employees BETWEEN 20 AND 500 THEN 2 WHEN employees BETWEEN 10 AND 1000 THEN 1 ELSE 0 END AS size_pts,
    CASE WHEN coalesce(t.release_lbs, 0) > 0 THEN 1 ELSE 0 END AS tri_air_pts,
    CASE (CASE WHEN employees IS NULL THEN 1 ELSE 0 END) + (CASE WHEN naics_conflict THEN 1 ELSE 0 END)
      WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END AS confidence,
    CASE WHEN fatality_date IS NOT NULL THEN 'fatality in the last 36 months'
      WHEN hospitalization_date IS NOT NULL THEN 'serious injury in the last 24 months'
      WHEN contested_date IS NOT NULL THEN 'citation under contest' END AS hold_reason
  FROM facilities f JOIN holds h USING (facility_id) LEFT JOIN points p USING (facility_id)
  LEFT JOIN signals t USING (facility_id)),
totals AS (SELECT *, industry_pts + dust_pts + recency_pts + size_pts + tri_air_pts AS total FROM scored),
tiers AS (
  SELECT *, CASE WHEN dust_pts = 0 THEN 'Archive' WHEN total >= 8 THEN 'Hot' WHEN total >= 5 THEN 'Warm'
    ELSE 'Archive' END AS tier FROM totals),
scores AS (SELECT *, tier <> 'Archive' AND hold_reason IS NULL AND confidence <> 'Low' AS outreach_eligible FROM tiers),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY total DESC, evidence_date DESC NULLS LAST, employees DESC NULLS LAST,
    name NULLS LAST, facility_id) AS rank FROM scores),
territory AS (SELECT n_nationkey + 1 AS position, 'S' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state FROM nation),
shown AS (SELECT * FROM ranked WHERE tier IN ('Hot', 'Warm')),
cites AS (
  SELECT facility_id, activity_nr, open_date, dust_program, citation AS standard, title, category,
    CASE viol_type {" ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in rules.VIOLATION_TYPES)} ELSE viol_type END AS type,
    evidence_date AS issued, CAST(round_even(coalesce(current_penalty, initial_penalty, 0), 0) AS BIGINT) AS penalty_usd,
    contest_date IS NOT NULL AND final_order_date IS NULL AS under_contest
  FROM evidence WHERE kind = 'citation' AND category <> 'other' AND facility_id IN (SELECT facility_id FROM shown)),
insps AS (
  SELECT facility_id, activity_nr, max(open_date) AS opened, max(dust_program) AS dust_program,
    count(*) FILTER (WHERE kind = 'citation' AND category <> 'other') AS citation_count,
    count(*) FILTER (WHERE kind = 'citation' AND category = 'other') AS other_citations
  FROM evidence WHERE facility_id IN (SELECT facility_id FROM shown) GROUP BY 1, 2
  HAVING count(*) FILTER (WHERE kind = 'citation' AND category <> 'other') > 0 OR max(dust_program) IS NOT NULL)
"""


def check(select: str, more: str = "", recursive: bool = False) -> str:
    """A full statement: shared clauses, extra clauses, final select."""
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + CTES.strip() + (",\n" + more.strip() if more else "") + "\n" + select.strip()
