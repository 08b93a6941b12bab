"""SQL of the whole pipeline for DuckDB: one chain of tables from raw records to profiles.

Each stage is stated by its result, with the means of SQL: lists by windows and ordered
aggregates, components by a recursive closure, the ratio of names by a table of the longest
common subsequence.
"""

from __future__ import annotations

from rosterweave.functions import normalize as N
from rosterweave.plans.oracle import country, date, email, kind_of, open_end, skill, trim, url, years
from rosterweave.sources.people import PROFILE_BASE

SCALARS = {"full_name": 1, "location_city": 1, "location_region": 1, "location_country": 1, "headline": 2, "years_experience": 2}
LINKS = ("linkedin", "github", "portfolio")
REASONS = {"email": "not a valid email address", "phone": "unparseable as a valid phone number"}


def let(value: str, name: str, body: str) -> str:
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def phone(x: str) -> str:
    """As text: the number of a raw value, seven digits being local."""
    valid = "|".join(f"{code}(?:{rest})" for code, rest in N.NATIONAL_NUMBERS.items())
    spelled = "CASE WHEN regexp_matches(t, '^[\\d\\s().+/-]*$') THEN t WHEN regexp_matches(t, '^[\\d\\s().+-]{3,}[A-Z-]{3,}$') THEN translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '22233344455566677778889999') END"
    wide = f"regexp_replace(regexp_replace(regexp_replace({spelled}, '[^\\d+]', '', 'g'), '^011', '+'), '^1?(\\d{{10}})$', '+1\\1')"
    good = f"CASE WHEN regexp_matches(w, '^\\+(?:{valid})$') AND NOT regexp_matches(w, '^\\+1(?:\\d11|555)') THEN w END"
    bare = f"regexp_replace(upper({trim(x)}), '^TEL:|\\s*(?:EXT\\.?|X|#)\\s*\\d{{1,6}}$|\\(0\\)', '', 'g')"
    return f"coalesce({let(let(bare, 't', wide), 'w', good)}, CASE WHEN length(regexp_replace({x}, '\\D', '', 'g')) = 7 THEN '+1415' || regexp_replace({x}, '\\D', '', 'g') END)"


def _log(field: str, raw: str, reason: str) -> str:
    return f"{{'field': {field}, 'raw_value': left({raw}, 120), 'source': source, 'reason': '{reason}'}}"


def _refused(field: str, raw: str, value: str, reason: str) -> str:
    return f"CASE WHEN coalesce({raw}, '') <> '' AND {value} IS NULL THEN [{_log(repr(field), raw, reason)}] ELSE [] END"


def _refused_each(field: str, raw: str, read: str, reason: str) -> str:
    return f"list_transform(list_filter(coalesce({raw}, []), lambda v: v <> '' AND ({read}) IS NULL), lambda v: {_log(repr(field), 'v', reason)})"


def _job_log(end: str) -> str:
    x = f"e.{end}"
    return f"CASE WHEN coalesce({x}, '') <> '' AND NOT {open_end(x)} AND {date(x)} IS NULL THEN {_log(f'''printf('experience[%d].{end}', i - 1)''', x, 'unparseable date')} END"


def ordered_distinct(items: str) -> str:
    return let(items, "l", "list_filter(l, lambda x, i: list_position(l, x) = i)")


_JOB = "{'company': company, 'title': title, 'start': start_ym, 'end': end_ym, 'summary': summary}"
_SCHOOL = "{'institution': institution, 'degree': degree, 'field': field, 'cgpa': cgpa, 'start_year': start_year, 'end_year': end_year}"
_JOB_NULL = "{" + ", ".join(f"'{k}': NULL::VARCHAR" for k in ("company", "title", "start", "end", "summary")) + "}"
_SCHOOL_NULL = "{" + ", ".join(f"'{k}': NULL::{t}" for k, t in (("institution", "VARCHAR"), ("degree", "VARCHAR"), ("field", "VARCHAR"), ("cgpa", "VARCHAR"), ("start_year", "INT"), ("end_year", "INT"))) + "}"
RAW = f"""raw AS MATERIALIZED (
  SELECT DISTINCT rec_id AS record_ix, src_file AS source, name AS full_name, email, NULL::VARCHAR[] AS emails, phone, NULL::VARCHAR[] AS phones, location_city, NULL::VARCHAR AS location_region, location_country,
    linkedin, github, NULL::VARCHAR AS portfolio, NULL::VARCHAR AS headline, years_experience, skills AS skills_text, NULL::VARCHAR[] AS skills_list, CASE WHEN FALSE THEN [{_JOB_NULL}] END AS experience, CASE WHEN FALSE THEN [{_SCHOOL_NULL}] END AS education FROM recruiter
  UNION ALL
  SELECT p.profile_id + {PROFILE_BASE}, src_file, full_name, NULL, emails, NULL, phones, location_city, location_region, location_country, linkedin, github, portfolio, headline,
    CASE WHEN isnan(years_experience) THEN 'NaN' ELSE CAST(years_experience AS VARCHAR) END, NULL, s.l, e.l, d.l
  FROM (SELECT DISTINCT ON (profile_id) * FROM candidate_profile) p
  LEFT JOIN (SELECT profile_id, list(name ORDER BY pos, skill_id) AS l FROM (SELECT DISTINCT skill_id, profile_id, pos, name FROM skill WHERE name IS NOT NULL) GROUP BY profile_id) s USING (profile_id)
  LEFT JOIN (SELECT profile_id, list({_JOB} ORDER BY pos, exp_id) AS l FROM (SELECT DISTINCT exp_id, profile_id, pos, company, title, start_ym, end_ym, summary FROM experience) GROUP BY profile_id) e USING (profile_id)
  LEFT JOIN (SELECT profile_id, list({_SCHOOL} ORDER BY pos, edu_id) AS l FROM education GROUP BY profile_id) d USING (profile_id))"""


def _validated() -> str:
    contact = {"email": ("emails", email), "phone": ("phones", phone)}
    one = lambda c, many: f"CASE WHEN coalesce({c}, '') <> '' THEN {c} ELSE {many}[1] END"
    singles = ", ".join(f"{one(c, many)} AS raw_{c}" for c, (many, _) in contact.items())
    read = ", ".join(f"{f(f'raw_{c}')} AS v_{c}" for c, (_, f) in contact.items())
    listed = ", ".join(f"v_{c} AS {c}, CASE WHEN {many} IS NOT NULL THEN list_filter(list_transform({many}, lambda v: {f('v')}), lambda v: v IS NOT NULL) WHEN v_{c} IS NOT NULL THEN [v_{c}] ELSE []::VARCHAR[] END AS {many}" for c, (many, f) in contact.items())
    logs = [x for c, (many, f) in contact.items() for x in (_refused(c, f"raw_{c}", f"v_{c}", REASONS[c]), _refused_each(f"{many}[]", many, f("v"), REASONS[c]))]
    logs += [_refused("location_country", "location_country", country("location_country"), "unrecognized country name/code"), *[_refused(k, trim(k), url(k), "not a URL") for k in LINKS]]
    logs += [_refused("years_experience", "years_experience", years("years_experience"), "not a number from 0 to 60"), f"list_filter(flatten(list_transform(coalesce(experience, []), lambda e, i: [{_job_log('start')}, {_job_log('end')}])), lambda x: x IS NOT NULL)"]
    log = "[]"
    for part in logs:
        log = f"list_concat({log}, {part})"
    skills = ordered_distinct(f"list_filter(list_transform(coalesce(skills_list, string_split_regex(skills_text, '[,;]+'), []), lambda x: {skill('x')}), lambda x: x IS NOT NULL)")
    dated = ", ".join(f"'{k}': CASE WHEN NOT {open_end(f'e.{k}')} THEN {date(f'e.{k}')} END" for k in ("start", "end"))
    return f"""validated AS MATERIALIZED (SELECT record_ix, source, {kind_of('source')} AS kind, {listed}, {", ".join(f"nullif({c}, '') AS {c}" for c in ("full_name", "location_city", "location_region", "headline"))},
  {country("location_country")} AS location_country, {", ".join(f"{url(k)} AS {k}" for k in LINKS)}, {years("years_experience")} AS years_experience, {skills} AS skills,
  list_transform(coalesce(experience, []), lambda e: {{'company': e.company, 'title': e.title, {dated}, 'summary': e.summary}}) AS experience, coalesce(education, []) AS education, {log} AS log
  FROM (SELECT *, {read} FROM (SELECT *, {singles} FROM raw)))"""


VALIDATED = f"{RAW}, {_validated()}"

# the table of the common subsequence, row by row; lists hold what a fold carries
_ROW = "list_reduce(list_transform(range(1, length(na) + 1), lambda j: [j]), lambda acc, j: list_append(acc, CASE WHEN unicode(na[j[1]]) = y[1] THEN coalesce(old[j[1] - 1], 0) + 1 ELSE greatest(old[j[1]], coalesce(acc[j[1] - 1], 0)) END), []::BIGINT[])"
_LCS = f"list_reduce(list_transform(string_split(nb, ''), lambda y: [unicode(y)::BIGINT]), lambda old, y: {_ROW}, list_transform(range(1, length(na) + 1), lambda j: 0::BIGINT))"
_SORTED = "array_to_string(list_sort(list_filter(string_split_regex(name, '\\s+'), lambda t: t <> '')), ' ')"
KEYS = f"""keyed AS MATERIALIZED (SELECT record_ix, {ordered_distinct("list_filter(list_append(emails, email), lambda x: x IS NOT NULL)")} AS emails, {ordered_distinct("list_filter(list_append(phones, phone), lambda x: x IS NOT NULL)")} AS phones,
  lower({trim("coalesce(full_name, '')")}) AS name FROM validated)"""
EDGES = f"""{KEYS}, mailed AS (SELECT record_ix, unnest(emails) AS email FROM keyed), first_mailed AS (SELECT email, min(record_ix) AS src FROM mailed GROUP BY email),
  email_edges AS (SELECT DISTINCT src, record_ix AS dst FROM mailed JOIN first_mailed USING (email) WHERE record_ix > src),
  phoned AS (SELECT record_ix, unnest(phones) AS phone, {_SORTED} AS name FROM keyed WHERE name <> ''), phone_names AS MATERIALIZED (SELECT phone, name, min(record_ix) AS ix FROM phoned GROUP BY ALL),
  near AS MATERIALIZED (SELECT least(ia, ib) AS src, greatest(ia, ib) AS dst, CASE WHEN na = '' THEN 100.0 ELSE 200.0 * list_last({_LCS}) / (length(na) + length(nb)) END AS score FROM (
    SELECT a.name AS na, b.name AS nb, a.ix AS ia, b.ix AS ib FROM phone_names a JOIN phone_names b ON a.phone = b.phone AND a.name < b.name AND a.ix <> b.ix WHERE 200 * least(length(a.name), length(b.name)) >= 85 * (length(a.name) + length(b.name)))),
  name_edges AS (SELECT src, dst, max(score) AS score FROM (SELECT ix AS src, record_ix AS dst, 100.0 AS score FROM phoned JOIN phone_names USING (phone, name) WHERE record_ix > ix UNION ALL SELECT * FROM near WHERE score >= 85) GROUP BY ALL),
  edges AS MATERIALIZED (SELECT src, dst, max(score) AS score FROM (SELECT src, dst, NULL AS score FROM email_edges UNION ALL SELECT * FROM name_edges) GROUP BY src, dst)"""
CLUSTERS = f"""{VALIDATED}, {EDGES}, both_ways AS MATERIALIZED (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges),
  reach AS (SELECT a AS node, a AS label FROM both_ways UNION SELECT e.b, r.label FROM reach r JOIN both_ways e ON e.a = r.node),
  clusters AS MATERIALIZED (SELECT v.record_ix, coalesce(c.label, v.record_ix) AS cluster_id FROM validated v LEFT JOIN (SELECT node, min(label) AS label FROM reach GROUP BY node) c ON c.node = v.record_ix)"""


def _entry(field: str, value: str, source: str, method: str) -> str:
    return f"{{'field': '{field}', 'value': ({value})::VARCHAR, 'source': {source}, 'method': {method}}}"


def _merged() -> str:
    base = lambda k: f"CASE WHEN {k} = 1 THEN 'csv_direct' ELSE 'regex_extract' END"
    aggs = ["count(*) AS n", "list(DISTINCT source ORDER BY source) AS every_source"]
    for c, p in SCALARS.items():
        row = f"{{'v': {c}, 's': source, 'k': kind}}"
        aggs += [f"first({row} ORDER BY kind <> {p}, record_ix) FILTER (WHERE {c} IS NOT NULL) AS best_{c}", f"count(DISTINCT {c}) > 1 AS differ_{c}"]
    for c in ("experience", "education"):
        full = f"len({c}) > 0 AND kind IN (1, 2)"
        aggs += [f"first({{'v': {c}, 's': source, 'k': kind}} ORDER BY kind <> 2, record_ix) FILTER (WHERE {full}) AS best_{c}", f"count(*) FILTER (WHERE {full}) AS n_{c}"]
    aggs += [f"first({{'v': {c}, 's': source, 'k': kind}} ORDER BY record_ix) FILTER (WHERE {c} IS NOT NULL) AS first_{c}" for c in LINKS]
    lists, joins, shown = [], [], []
    for c in ("emails", "phones", "skills"):
        key, order = ("right(v, 10)", "size > 1 AND v NOT LIKE '+91%', record_ix, pos") if c == "phones" else ("lower(v)", "record_ix, pos")
        lists.append(f"""{c}_values AS (SELECT *, {key} AS key, count(DISTINCT record_ix) OVER (PARTITION BY cluster_id) AS holders FROM (SELECT cluster_id, record_ix, source, kind, unnest({c}) AS v, generate_subscripts({c}, 1) AS pos FROM members)),
          {c}_kept AS (SELECT *, row_number() OVER (PARTITION BY cluster_id, key ORDER BY {order}) AS again FROM {c}_values JOIN sizes USING (cluster_id)),
          {c}_list AS (SELECT cluster_id, list({{'v': v, 's': source, 'k': kind, 'key': key}} ORDER BY {order}) AS {c}_l FROM {c}_kept WHERE size = 1 OR again = 1 GROUP BY cluster_id)""")
        joins.append(f"LEFT JOIN {c}_list USING (cluster_id)")
        shown.append(f"coalesce({c}_l, []) AS {c}_l")
    list_entries = {c: f"list_transform({c}_l, lambda x: {{'field': '{c}', 'value': x.v, 'source': x.s, 'method': CASE WHEN x.k = 2 AND {'TRUE' if c == 'skills' else 'n > 1'} THEN 'resume_keyword' ELSE {base('x.k')} END}})" for c in ("emails", "phones", "skills")}
    scalar_entries = []
    for c, p in SCALARS.items():
        won = f"CASE WHEN best_{c}.k = {p} THEN 'merge_conflict_{'csv' if p == 1 else 'resume'}_won' WHEN best_{c}.k = 1 THEN 'merge_conflict_csv_won' ELSE 'merge_conflict_resume_won' END"
        # without a conflict the first holder is named, whatever its kind
        scalar_entries.append(f"CASE WHEN best_{c} IS NULL THEN CASE WHEN n > 1 THEN [{_entry(c, 'NULL', repr('none'), repr('default'))}] ELSE [] END WHEN n > 1 AND differ_{c} THEN [{_entry(c, f'best_{c}.v', f'best_{c}.s', won)}] ELSE [{_entry(c, f'one_{c}.v', f'one_{c}.s', base(f'one_{c}.k'))}] END")
    aggs += [f"first({{'v': {c}, 's': source, 'k': kind}} ORDER BY record_ix) FILTER (WHERE {c} IS NOT NULL) AS one_{c}" for c in SCALARS]
    block_entries = [f"CASE WHEN best_{c} IS NULL THEN CASE WHEN n > 1 THEN [{_entry(c, 'NULL', repr('none'), repr('default'))}] ELSE [] END ELSE [{_entry(c, 'NULL', f'best_{c}.s', f'''CASE WHEN best_{c}.k = 1 THEN 'csv_direct' WHEN n > 1 AND n_{c} > 1 THEN 'merge_conflict_resume_won' ELSE 'regex_extract' END''')}] END" for c in ("experience", "education")]
    link_entries = [f"CASE WHEN first_{c} IS NULL THEN [] ELSE [{_entry(f'links.{c}', f'first_{c}.v', f'first_{c}.s', base(f'first_{c}.k'))}] END" for c in LINKS]

    def chain(parts: list[str]) -> str:
        out = "[]"
        for x in parts:
            out = f"list_concat({out}, {x})"
        return out

    several, alone = chain([*list_entries.values(), *scalar_entries]), chain([*scalar_entries, *list_entries.values()])
    provenance = f"list_concat(CASE WHEN n > 1 THEN {several} ELSE {alone} END, {chain([*block_entries, *link_entries])})"
    scalars = ", ".join(f"best_{c}.v AS {c}" for c in SCALARS)
    return f"""members AS MATERIALIZED (SELECT * FROM validated JOIN clusters USING (record_ix)), sizes AS (SELECT cluster_id, count(*) AS size FROM members GROUP BY cluster_id), {", ".join(lists)},
  skill_sources AS (SELECT cluster_id, key, list(source ORDER BY record_ix, pos) AS sources FROM (SELECT DISTINCT ON (cluster_id, key, source) * FROM skills_values ORDER BY record_ix, pos) GROUP BY cluster_id, key),
  source_order AS (SELECT cluster_id, list(source ORDER BY ix) AS merged_sources FROM (SELECT cluster_id, source, min(record_ix) AS ix FROM members GROUP BY ALL) GROUP BY cluster_id),
  gathered AS MATERIALIZED (SELECT * FROM (SELECT cluster_id, {", ".join(aggs)} FROM members GROUP BY cluster_id) JOIN source_order USING (cluster_id) {" ".join(joins)}),
  merged AS MATERIALIZED (SELECT cluster_id, n, merged_sources, {scalars}, {", ".join(f"first_{c}.v AS {c}" for c in LINKS)}, coalesce(best_experience.v, []) AS experience, coalesce(best_education.v, []) AS education,
    list_transform(emails_l, lambda x: x.v) AS emails, list_transform(phones_l, lambda x: x.v) AS phones, skills_l, {provenance} AS provenance FROM (SELECT * REPLACE ({", ".join(shown)}) FROM gathered))"""


MERGED = f"{CLUSTERS}, {_merged()}"


def weight(source: str) -> str:
    return f"CASE {kind_of(source)} WHEN 1 THEN 1.0::DOUBLE WHEN 2 THEN 0.85::DOUBLE ELSE 0.8::DOUBLE END"


def rounded(x: str) -> str:
    """Four digits, half up by the digits that are shown."""
    return f"CAST(round(CAST(printf('%.17g', {x}) AS DECIMAL(38, 20)), 4) AS DOUBLE)"


_SKILL_CONFIDENCE = "CASE WHEN n >= 3 THEN 0.95 WHEN n = 2 THEN 0.9 ELSE 0.7 END::DOUBLE * ((n1 * 1.0::DOUBLE + n2 * 0.85::DOUBLE + n3 * 0.8::DOUBLE) / n) + 1e-9"


def _mean_or(items: str, value: str, none: str) -> str:
    return f"CASE WHEN len({items}) > 0 THEN list_reduce(list_transform({items}, lambda e: {value}), lambda a, x: a + x) / len({items}) ELSE {none} END"


def _scored() -> str:
    has = lambda x: f"(CASE WHEN coalesce({x}::VARCHAR, '') <> '' THEN 1.0 ELSE 0.0 END)::DOUBLE"
    contact = lambda c: f"CASE WHEN len({c}) > 0 THEN least(1.0::DOUBLE, 0.85::DOUBLE + 0.15::DOUBLE * (len({c}) - 1)) ELSE 0.0::DOUBLE END"
    job = f"0.5::DOUBLE + 0.2::DOUBLE * {has('e.company')} + 0.15::DOUBLE * {has('e.title')} + 0.15::DOUBLE * {has('e.start')} * {has('e.end')}"
    school = f"0.5::DOUBLE + 0.2::DOUBLE * {has('e.institution')} + 0.2::DOUBLE * {has('e.degree')} + (CASE WHEN coalesce(e.end_year, 0) <> 0 THEN 0.1 ELSE 0.0 END)::DOUBLE"
    skill_ = f"CASE WHEN len(skills) > 0 THEN least(1.0::DOUBLE, {_mean_or('skills', 'e.confidence', '0')} + least(0.05::DOUBLE, len(skills) / 10.0::DOUBLE * 0.05::DOUBLE)) ELSE 0.3::DOUBLE END"
    total = f"(1.5::DOUBLE * ({contact('emails')}) + 1.5::DOUBLE * ({contact('phones')}) + 2.0::DOUBLE * ({_mean_or('experience', job, '0.3::DOUBLE')}) + 1.0::DOUBLE * ({_mean_or('education', school, '0.3::DOUBLE')}) + 1.0::DOUBLE * ({skill_})) / 7.0::DOUBLE"
    return f"""rated AS (SELECT cluster_id, pos, v, sources, round({_SKILL_CONFIDENCE}, 4) AS confidence FROM (SELECT s.cluster_id, s.pos, s.x.v AS v, k.sources, len(k.sources) AS n,
      len(list_filter(k.sources, lambda f: {kind_of('f')} = 1)) AS n1, len(list_filter(k.sources, lambda f: {kind_of('f')} = 2)) AS n2, len(list_filter(k.sources, lambda f: {kind_of('f')} = 3)) AS n3
      FROM (SELECT cluster_id, unnest(skills_l) AS x, generate_subscripts(skills_l, 1) AS pos FROM merged) s JOIN skill_sources k ON k.cluster_id = s.cluster_id AND k.key = s.x.key)),
  scored AS MATERIALIZED (SELECT *, {rounded(total)} AS overall_confidence FROM (SELECT m.*, coalesce(r.skills, []) AS skills FROM merged m LEFT JOIN (SELECT cluster_id, list({{'name': v, 'confidence': confidence, 'sources': sources}} ORDER BY pos) AS skills FROM rated GROUP BY cluster_id) r USING (cluster_id)))"""


SCORED = f"{MERGED}, {_scored()}"
_CANDIDATE = f"substr(sha256(coalesce(nullif(lower({trim('emails[1]')}), ''), nullif(lower({trim('full_name')}), '') || coalesce(phones[1], ''))), 1, 16)"
_MADE = "[{'field': 'candidate_id', 'source': 'pipeline', 'method': 'generated'}]"
PROFILES = f"""{SCORED}, profiles AS MATERIALIZED (SELECT * FROM (SELECT cluster_id, {_CANDIDATE} AS candidate_id, coalesce(full_name, '') AS full_name, emails, phones, location_city, location_region, location_country, {", ".join(LINKS)}, headline, years_experience,
  list_filter(skills, lambda s: {trim('s.name')} <> '') AS skills, experience, list_filter(education, lambda e: e.end_year IS NULL OR e.end_year BETWEEN 1900 AND 2100) AS education,
  {ordered_distinct(f"list_concat(list_filter(list_transform(provenance, lambda p: {{'field': p.field, 'source': p.source, 'method': p.method}}), lambda p: p.field <> '' AND p.source <> '' AND p.method <> ''), {_MADE})")} AS provenance, overall_confidence
  FROM scored) WHERE candidate_id IS NOT NULL AND (years_experience IS NULL OR years_experience BETWEEN 0 AND 60))"""


def _json(fields: dict[str, str], nulls: bool = False) -> str:
    """A JSON object; without ``nulls`` a null value has no key."""
    parts = ", ".join(f"""'"{k}":' || coalesce(to_json({x})::VARCHAR, 'null')""" if nulls else f"""CASE WHEN ({x}) IS NOT NULL THEN '"{k}":' || to_json({x})::VARCHAR END""" for k, x in fields.items())
    return f"'{{' || array_to_string(list_filter([{parts}], lambda z: z IS NOT NULL), ',') || '}}'"


def _json_list(items: str, fields: dict[str, str]) -> str:
    return f"'[' || array_to_string(list_transform({items}, lambda e: {_json(fields)}), ',') || ']'"


def queries() -> dict[str, str]:
    run = lambda tables, body: f"WITH RECURSIVE {tables} {body}"
    joined = lambda c: f"array_to_string({c}, '|') AS {c}"
    shared = "list_sort(list_filter(a.emails, lambda x: list_contains(b.emails, x)))"
    reason = f"CASE WHEN len({shared}) > 0 THEN 'email_exact:' || array_to_string({shared}, ',') ELSE printf('name_phone_fuzzy:score=%d', floor(score)::INT) END"
    canonical = f"list_filter(list_transform(skills, lambda s: {skill('s.name')}), lambda x: x IS NOT NULL)"
    custom = f"cluster_id, full_name, emails[1] AS primary_email, phones[1] AS phone, {canonical} AS skills, headline, years_experience, overall_confidence"
    violations = "CASE WHEN primary_email IS NULL THEN ['required field missing: primary_email'] ELSE []::VARCHAR[] END"
    checked = f"SELECT * REPLACE (to_json(skills)::VARCHAR AS skills), to_json({violations})::VARCHAR AS violations, '[]' AS warnings, len({violations}) > 0 AS should_abort FROM (SELECT {custom} FROM profiles)"
    entries = "SELECT cluster_id, unnest(provenance) AS p, generate_subscripts(provenance, 1) - 1 AS place FROM"
    own = f"SELECT kind, CASE kind WHEN 1 THEN 0.7::DOUBLE * (1.0::DOUBLE) + 1e-9 WHEN 2 THEN 0.7::DOUBLE * (0.85::DOUBLE) + 1e-9 ELSE 0.7::DOUBLE * (0.8::DOUBLE) + 1e-9 END AS c FROM (VALUES (1), (2), (3)) t(kind)"
    omit = {"full_name": "full_name", "primary_email": "emails[1]", "phone": "phones[1]", "headline": "headline", "years_experience": "years_experience"}
    omit_parts = [f"""CASE WHEN {x} IS NOT NULL THEN '"{k}":' || to_json({x})::VARCHAR END""" for k, x in omit.items()]
    omit_parts.insert(3, f"""'"skills":' || to_json({canonical})::VARCHAR""")
    omit_parts.append("""'"overall_confidence":' || to_json(overall_confidence)::VARCHAR""")
    default = {
        "emails": "to_json(emails)::VARCHAR", "phones": "to_json(phones)::VARCHAR", "location": _json({"city": "location_city", "region": "location_region", "country": "location_country"}), "links": f"regexp_replace({_json({k: k for k in LINKS})}, '\\}}$', '') || CASE WHEN coalesce({', '.join(LINKS)}) IS NULL THEN '' ELSE ',' END || '\"other\":[]}}'",
        "skills": _json_list("skills", {"name": "e.name", "confidence": "e.confidence", "sources": "e.sources"}), "experience": _json_list("experience", {k: f"e.{k}" for k in ("company", "title", "start", "end", "summary")}),
        "education": _json_list("education", {k: f"e.{k}" for k in ("institution", "degree", "field", "end_year")}), "provenance": _json_list("provenance", {k: f"e.{k}" for k in ("field", "source", "method")}),
    }
    months = lambda x: f"CAST({x}[1:4] AS INT) * 12 + CAST({x}[6:7] AS INT)"
    worked = f"list_transform(list_filter(experience, lambda e: e.start IS NOT NULL), lambda e: greatest(0, coalesce({months('e.end')}, 2025 * 12 + 6) - ({months('e.start')})))"
    missing = lambda on, what, text: f"CASE WHEN {on} THEN ['{what}: {text}'] ELSE [] END"
    wrong = lambda c, t, on: missing(f"{on} IS NOT NULL", "type mismatch", f"{c} is not {t}")
    typed_violations = f"list_concat({missing('years_experience IS NULL', 'required field missing', 'years')}, list_concat({wrong('years', 'string', 'years_experience')}, {missing('emails[1] IS NULL', 'required field missing', 'mail')}))"
    typed_warnings = f"list_concat({wrong('headline', 'number', 'headline')}, {wrong('links', 'object[]', '1')})"
    needed = "primary_email IS NOT NULL AND phone IS NOT NULL AND headline IS NOT NULL AND years_experience IS NOT NULL"
    return {
        "validation_log": run(VALIDATED, "SELECT record_ix, place, r.field AS field, r.raw_value AS raw_value, r.source AS source, r.reason AS reason FROM (SELECT record_ix, CAST(generate_subscripts(log, 1) - 1 AS INT) AS place, unnest(log) AS r FROM validated)"),
        "rejections_by_field": run(VALIDATED, "SELECT r.field AS field, count(*) AS n FROM (SELECT unnest(log) AS r FROM validated) GROUP BY 1"),
        "match_keys": run(f"{VALIDATED}, {KEYS}", f"SELECT record_ix, {joined('emails')}, {joined('phones')}, name FROM keyed"),
        "phone_name_edges": run(f"{VALIDATED}, {EDGES}", "SELECT src, dst, round(score, 6) AS score FROM name_edges"),
        "match_reasons": run(f"{VALIDATED}, {EDGES}", f"SELECT src, dst, {reason} AS reason FROM edges JOIN keyed a ON a.record_ix = src JOIN keyed b ON b.record_ix = dst"),
        "clusters": run(CLUSTERS, "SELECT record_ix, cluster_id FROM clusters"),
        "cluster_sizes": run(CLUSTERS, "SELECT size, count(*) AS clusters FROM (SELECT cluster_id, count(*) AS size FROM clusters GROUP BY cluster_id) GROUP BY size"),
        "merge_lists": run(MERGED, f"SELECT cluster_id, {joined('emails')}, {joined('phones')}, array_to_string(list_transform(skills_l, lambda x: x.v), '|') AS skills FROM merged"),
        "merge_blocks": run(MERGED, "SELECT cluster_id, CAST(len(experience) AS INT) AS jobs, CAST(len(education) AS INT) AS schools FROM merged"),
        "cluster_scalars": run(MERGED, f"SELECT cluster_id, n, {', '.join(SCALARS)} FROM merged"),
        "cluster_links": run(MERGED, f"SELECT cluster_id, {', '.join(LINKS)} FROM merged"),
        "cluster_sources": run(MERGED, f"SELECT cluster_id, {joined('merged_sources')} FROM merged"),
        "provenance": run(MERGED, f"SELECT cluster_id, CAST(place AS INT) AS place, p.field AS field, p.value AS value, p.source AS source, p.method AS method FROM ({entries} merged)"),
        "provenance_detail": run(SCORED, f"""SELECT e.cluster_id, p.field AS field, p.value AS value, p.source AS source, p.method AS method, CASE WHEN p.field = 'skills' THEN coalesce(r.confidence, round(o.c, 4)) WHEN p.source = 'none' THEN 0.0 ELSE {weight('p.source')} END AS confidence
            FROM ({entries} merged) e LEFT JOIN rated r ON p.field = 'skills' AND r.cluster_id = e.cluster_id AND r.v = p.value JOIN ({own}) o ON o.kind = {kind_of('p.source')}"""),
        "provenance_summary": run(PROFILES, f"SELECT cluster_id, p.field AS field, string_agg(p.method || '@' || p.source, '|' ORDER BY place) AS entries FROM ({entries} profiles) GROUP BY ALL"),
        "provenance_sources": run(PROFILES, f"SELECT cluster_id, string_agg(s, '|' ORDER BY place) AS sources FROM (SELECT cluster_id, p.source AS s, min(place) AS place FROM ({entries} profiles) WHERE p.field = 'skills' GROUP BY ALL) GROUP BY cluster_id"),
        "overall_confidence": run(SCORED, "SELECT cluster_id, overall_confidence FROM scored"),
        "profiles": run(PROFILES, "SELECT cluster_id, candidate_id, full_name, headline, years_experience, CAST(len(skills) AS INT) AS n_skills, location_country AS country, overall_confidence FROM profiles"),
        "profile_accessors": run(PROFILES, "SELECT cluster_id, emails[1] AS primary_email, phones[1] AS primary_phone, array_to_string(list_transform(skills, lambda s: s.name), '|') AS skill_names FROM profiles"),
        "tenure": run(VALIDATED, f"SELECT record_ix, least(round(coalesce(list_sum({worked}), 0) / 12.0::DOUBLE, 1), 60.0::DOUBLE) AS years FROM validated"),
        "check_output": run(PROFILES, f"SELECT cluster_id, array_to_string({typed_violations}, '|') AS violations, array_to_string({typed_warnings}, '|') AS warnings, len({typed_violations}) > 0 AS should_abort FROM profiles"),
        "project_custom": run(PROFILES, checked),
        "project_error": run(PROFILES, f"SELECT * FROM ({checked}) WHERE {needed}"),
        "project_omit": run(PROFILES, f"SELECT cluster_id, '{{' || array_to_string(list_filter([{', '.join(omit_parts)}], lambda z: z IS NOT NULL), ',') || '}}' AS json FROM profiles"),
        "project_default": run(PROFILES, f"SELECT cluster_id, candidate_id, full_name, headline, years_experience, overall_confidence, {', '.join(f'{x} AS {k}' for k, x in default.items())}, '[]' AS violations, '[]' AS warnings, FALSE AS should_abort FROM profiles"),
        "valid_output": run(PROFILES, f"SELECT {custom.replace(f'{canonical} AS skills', f'''array_to_string({canonical}, '|') AS skills''')} FROM profiles WHERE emails[1] IS NOT NULL"),
        "batch_counters": run(PROFILES, """SELECT * FROM (SELECT 'records' AS counter, (SELECT count(*) FROM validated) AS n UNION ALL SELECT 'rejections', (SELECT CAST(sum(len(log)) AS BIGINT) FROM validated) UNION ALL SELECT 'clusters', (SELECT count(*) FROM merged)
            UNION ALL SELECT 'built', (SELECT count(*) FROM profiles) UNION ALL SELECT 'skipped', (SELECT count(*) FROM merged) - (SELECT count(*) FROM profiles) UNION ALL SELECT 'aborted', (SELECT count(*) FROM profiles WHERE emails[1] IS NULL))"""),
    }
