"""SQL equivalents of the core queries for DuckDB, composed from the same fixed values."""

from __future__ import annotations

from rosterweave.functions import extract as X, normalize as N
from rosterweave.sources.files import EXPORT_COLUMNS
from rosterweave.sources.people import PROFILE_BASE


def trim(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def email(x: str) -> str:
    return f"CASE WHEN regexp_full_match(lower({trim(x)}), '{N.EMAIL}') THEN lower({trim(x)}) END"


def _map(table: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in table.items()) + "}"


def country(x: str) -> str:
    return f"({_map(N.COUNTRY_CODES)})[lower({trim(x)})]"


def skill(x: str) -> str:
    low = f"nullif(lower({trim(x)}), '')"
    return f"coalesce(({_map(N.SKILL_ALIASES)})[{low}], {low})"


def kind_of(source: str) -> str:
    """1 for a structured source, 2 for a document, 3 for another."""
    return f"CASE WHEN lower({source}) LIKE '%.csv' THEN 1 WHEN regexp_matches(lower({source}), '\\.(pdf|docx|txt)$') THEN 2 ELSE 3 END"


def url(x: str) -> str:
    return f"CASE WHEN regexp_matches({trim(x)}, '(?i)^https?://') THEN {trim(x)} END"


def years(x: str) -> str:
    return f"CASE WHEN regexp_full_match({trim(x)}, '[+-]?(?:\\d+\\.?\\d*|\\.\\d+)(?:[eE][+-]?\\d+)?') AND try_cast({trim(x)} AS DOUBLE) BETWEEN 0 AND 60 THEN try_cast({trim(x)} AS DOUBLE) END"


def date(x: str) -> str:
    t = f"lower({trim(x)})"
    months = "[" + ", ".join(f"'{m}'" for m in N.MONTHS) + "]"
    year = f"try_cast(CASE WHEN regexp_full_match({t}, '\\d{{4}}(-\\d{{2}})?') THEN {t}[1:4] WHEN regexp_full_match({t}, '\\d{{1,2}}[/-]\\d{{4}}') OR regexp_full_match({t}, '(?:{N.MONTH_WORDS})\\s+\\d{{4}}') THEN right({t}, 4) END AS INT)"
    month = f"CASE WHEN regexp_full_match({t}, '\\d{{4}}-\\d{{2}}') THEN try_cast(right({t}, 2) AS INT) WHEN regexp_full_match({t}, '\\d{{1,2}}[/-]\\d{{4}}') THEN try_cast(regexp_extract({t}, '^\\d+') AS INT) WHEN regexp_full_match({t}, '(?:{N.MONTH_WORDS})\\s+\\d{{4}}') THEN list_position({months}, {t}[1:3]) WHEN regexp_full_match({t}, '\\d{{4}}') THEN 1 END"
    return f"CASE WHEN {year} BETWEEN 1900 AND 2100 AND {month} BETWEEN 1 AND 12 THEN printf('%d-%02d', {year}, {month}) END"


def open_end(x: str) -> str:
    return f"lower({trim(x)}) IN ({', '.join(repr(w) for w in N.OPEN_END)})"


def _phones(rows: str) -> str:
    """``(id, pos, raw)`` to ``(id, pos, phone)``, as a query."""
    valid = "|".join(f"{code}(?:{rest})" for code, rest in N.NATIONAL_NUMBERS.items())
    return f"""SELECT id, pos, coalesce(CASE WHEN regexp_matches(wide, '^\\+(?:{valid})$') AND NOT regexp_matches(wide, '^\\+1(?:\\d11|555)') THEN wide END,
      CASE WHEN length(regexp_replace(raw, '\\D', '', 'g')) = 7 THEN '+1415' || regexp_replace(raw, '\\D', '', 'g') END) AS phone
    FROM (SELECT *, regexp_replace(regexp_replace(regexp_replace(CASE WHEN regexp_matches(t, '^[\\d\\s().+/-]*$') THEN t WHEN regexp_matches(t, '^[\\d\\s().+-]{{3,}}[A-Z-]{{3,}}$') THEN translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '22233344455566677778889999') END,
      '[^\\d+]', '', 'g'), '^011', '+'), '^1?(\\d{{10}})$', '+1\\1') AS wide
    FROM (SELECT *, regexp_replace(upper({trim("raw")}), '^TEL:|\\s*(?:EXT\\.?|X|#)\\s*\\d{{1,6}}$|\\(0\\)', '', 'g') AS t FROM ({rows})))"""


_RECORDS = f"""records AS (
  SELECT DISTINCT rec_id AS record_ix, src_file AS source, nullif(name, '') AS full_name, nullif(location_city, '') AS location_city, NULL::VARCHAR AS location_region, {country("location_country")} AS location_country,
    {url("linkedin")} AS linkedin, {url("github")} AS github, NULL::VARCHAR AS portfolio, NULL::VARCHAR AS headline, {years("years_experience")} AS years_experience, [{email("email")}] AS emails
  FROM recruiter
  UNION ALL
  SELECT DISTINCT profile_id + {PROFILE_BASE}, src_file, nullif(full_name, ''), nullif(location_city, ''), nullif(location_region, ''), {country("location_country")},
    {url("linkedin")}, {url("github")}, {url("portfolio")}, nullif(headline, ''), CASE WHEN NOT isnan(years_experience) AND years_experience BETWEEN 0 AND 60 THEN years_experience END, list_transform(emails, lambda e: {email("e")})
  FROM candidate_profile)"""
_ADDRESSED = f"""{_RECORDS}, addressed AS (SELECT *, emails[1] AS email, min(record_ix) OVER (PARTITION BY emails[1]) AS cluster_id FROM records WHERE emails[1] IS NOT NULL)"""
_PREFER = {"csv": "CASE WHEN lower(source) LIKE '%.csv' THEN 0 ELSE 1 END", "resume": "CASE WHEN regexp_matches(lower(source), '\\.(pdf|docx|txt)$') THEN 0 ELSE 1 END"}
_HELD = f"""{_RECORDS}, held AS (SELECT DISTINCT record_ix, e AS email FROM (SELECT record_ix, unnest(emails) AS e FROM records) WHERE e IS NOT NULL AND e <> '')
  , stars AS (SELECT src, record_ix AS dst, email FROM held JOIN (SELECT email, min(record_ix) AS src FROM held GROUP BY email) USING (email) WHERE record_ix > src)"""


def _first_of(list_sql: str, key: str, where: str = "TRUE", same: str = "x") -> str:
    """``(key, v)``: elements of a list, the first of equal ones, joined in order."""
    return f"""SELECT {key}, string_agg(x, '|' ORDER BY pos) AS v FROM (SELECT {key}, arg_min(x, pos) AS x, min(pos) AS pos FROM (
      SELECT {key}, unnest(l) AS x, generate_subscripts(l, 1) AS pos FROM ({list_sql})) WHERE {where} GROUP BY {key}, {same}) GROUP BY {key}"""


# what Unicode takes for white space, and for the end of a line
_BLANK = "[\\s\\x{b}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
_LINE_END = "\\r\\n|[\\n\\x{b}\\f\\r\\x{85}\\x{2028}\\x{2029}]"


def _wide_trim(x: str) -> str:
    return f"regexp_replace({x}, '^{_BLANK}+|{_BLANK}+$', '', 'g')"


def _initcap(x: str) -> str:
    return f"list_transform([{x}], lambda w: upper(w[1]) || lower(w[2:]))[1]"


def _national(x: str) -> str:
    return f"""CASE WHEN regexp_full_match({x}, '\\+1\\d{{10}}') THEN '(' || {x}[3:5] || ') ' || {x}[6:8] || '-' || {x}[9:12] WHEN regexp_full_match({x}, '\\+91\\d{{10}}') THEN '0' || {x}[4:8] || ' ' || {x}[9:13]
      WHEN regexp_full_match({x}, '\\+\\d{{8,15}}') THEN regexp_replace({x}, '^\\+(?:44|33|49|61|81|82|353)(\\d+)$', '0\\1') END"""


_HEADS = "|".join(X.SECTIONS)
# lines of every document with the heading each begins with, and the number of headings up to it
_SECTIONS = f"""lined AS (SELECT doc_id, line, no, nullif(upper(regexp_extract(line, '^(?i)({_HEADS})', 1)), '') AS head FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents)),
  parted AS (SELECT doc_id, part, max(head) AS head, string_agg(CASE WHEN head IS NULL THEN line ELSE line[length(head) + 1:] END, chr(10) ORDER BY no) AS body FROM (SELECT *, count(head) OVER (PARTITION BY doc_id ORDER BY no) AS part FROM lined) GROUP BY doc_id, part),
  sectioned AS (SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN {_wide_trim("coalesce(max(body) FILTER (WHERE part = 0), '')")} END AS header, {", ".join(f"arg_max(body, part) FILTER (WHERE head = '{k}') AS {k.lower()}_body" for k in ("SKILLS", "EXPERIENCE", "EDUCATION"))}
    FROM documents d LEFT JOIN parted p USING (doc_id) GROUP BY d.doc_id, d.text)"""


def _section_text(name: str) -> str:
    return _wide_trim(f"{name.lower()}_body")


def oracle_sql() -> dict[str, str]:
    from rosterweave.plans import oracle_pipeline

    return single_sql() | oracle_pipeline.queries()


def single_sql() -> dict[str, str]:
    """SQL of queries that need one stage only."""
    scalars = {"full_name": "csv", "location_city": "csv", "location_region": "csv", "location_country": "csv", "headline": "resume", "years_experience": "resume"}
    merged = ", ".join(f"first({c} ORDER BY {_PREFER[p]}, record_ix) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c, p in scalars.items())
    links = ", ".join(f"first({c} ORDER BY record_ix) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ("linkedin", "github", "portfolio"))
    rec_phone = _phones("SELECT DISTINCT rec_id AS id, 1 AS pos, phone AS raw FROM recruiter")
    kind = "CASE WHEN lower(src_file) LIKE '%.csv' THEN 1 WHEN regexp_matches(lower(src_file), '\\.(pdf|docx|txt)$') THEN 2 ELSE 3 END"
    return {
        "normalize_email": f"SELECT DISTINCT rec_id, {email('email')} AS email FROM recruiter",
        "normalize_phone": f"SELECT id AS rec_id, phone FROM ({rec_phone})",
        "format_phone_national": f"""SELECT id AS rec_id, CASE WHEN regexp_full_match(phone, '\\+1\\d{{10}}') THEN '(' || phone[3:5] || ') ' || phone[6:8] || '-' || phone[9:12]
            WHEN regexp_full_match(phone, '\\+91\\d{{10}}') THEN '0' || phone[4:8] || ' ' || phone[9:13] WHEN regexp_full_match(phone, '\\+\\d{{8,15}}') THEN regexp_replace(phone, '^\\+(?:44|33|49|61|81|82|353)(\\d+)$', '0\\1') END AS phone FROM ({rec_phone})""",
        "normalize_country": f"SELECT DISTINCT profile_id, {country('location_country')} AS country FROM candidate_profile",
        "normalize_skill": f"SELECT DISTINCT skill_id, {skill('name')} AS name FROM skill",
        "normalize_date": f"SELECT DISTINCT exp_id, {date('start_ym')} AS start_ym FROM experience",
        "validate_years": f"SELECT DISTINCT rec_id, {years('years_experience')} AS years FROM recruiter",
        "validate_url": f"SELECT DISTINCT rec_id, {url('linkedin')} AS linkedin FROM recruiter",
        "skills_split": f"""WITH r AS (SELECT DISTINCT rec_id, skills FROM recruiter) SELECT r.rec_id, CASE WHEN r.skills IS NOT NULL THEN coalesce(s.v, '') END AS skills FROM r LEFT JOIN
            ({_first_of(f"SELECT rec_id, list_transform(string_split_regex(skills, '[,;]+'), lambda x: {skill('x')}) AS l FROM r", "rec_id", "x IS NOT NULL")}) s ON s.rec_id = r.rec_id""",
        "experience_dates": f"SELECT DISTINCT exp_id, CASE WHEN NOT {open_end('start_ym')} THEN {date('start_ym')} END AS start_ym, CASE WHEN NOT {open_end('end_ym')} THEN {date('end_ym')} END AS end_ym FROM experience",
        "source_type": "SELECT src_file, count(DISTINCT profile_id) AS n, CASE WHEN lower(src_file) LIKE '%.csv' THEN 'structured' WHEN regexp_matches(lower(src_file), '\\.(pdf|docx|txt)$') THEN 'unstructured' ELSE 'other' END AS source_type FROM candidate_profile GROUP BY src_file",
        "profile_contacts": f"SELECT DISTINCT profile_id, CASE WHEN emails IS NOT NULL THEN coalesce(array_to_string(list_filter(list_transform(emails, lambda e: {email('e')}), lambda x: x IS NOT NULL), '|'), '') END AS emails FROM candidate_profile",
        "union_sources": f"""SELECT source, count(*) AS n, CAST(sum(CASE WHEN {trim("coalesce(full_name, '')")} <> '' THEN 1 ELSE 0 END) AS BIGINT) AS named FROM (
            SELECT DISTINCT rec_id AS id, src_file AS source, name AS full_name FROM recruiter UNION ALL SELECT DISTINCT profile_id + {PROFILE_BASE}, src_file, full_name FROM candidate_profile) GROUP BY source""",
        "usable_records": f"SELECT DISTINCT profile_id + {PROFILE_BASE} AS record_ix FROM candidate_profile WHERE full_name IS NOT NULL OR len(emails) > 0",
        "csv_remap": "SELECT DISTINCT rec_id AS record_ix, src_file AS source, name AS full_name, skills AS skills_text FROM recruiter",
        "extract_emails": f"SELECT doc_id, v AS emails FROM ({_first_of(f"SELECT doc_id, regexp_extract_all(text, '{N.EMAIL}') AS l FROM documents", 'doc_id')})",
        "extract_phones": f"""SELECT rec_id, v AS phones FROM ({_first_of(f"SELECT rec_id, list_transform(regexp_extract_all(notes, '{X.PHONE}'), lambda x: {trim('x')}) AS l FROM (SELECT DISTINCT rec_id, notes FROM recruiter)", 'rec_id', same="regexp_replace(x, '\\D', '', 'g')")})""",
        "split_sections": f"WITH {_SECTIONS} SELECT doc_id, header, {', '.join(f'{_section_text(k)} AS {k.lower()}' for k in ('SKILLS', 'EXPERIENCE', 'EDUCATION'))} FROM sectioned",
        "resume_heads": f"""WITH {_SECTIONS}, heads AS (SELECT doc_id, header, list_transform(string_split_regex(header, '{_LINE_END}'), lambda x: {_wide_trim('x')}) AS lines FROM sectioned)
            SELECT doc_id, list_filter(lines, lambda x: NOT regexp_matches(x, '[@|+]|http|\\d{{3}}') AND regexp_full_match(x, '[A-Za-z\\-''.]+(?:{_BLANK}+[A-Za-z\\-''.]+){{1,4}}'))[1] AS full_name,
            {_initcap(f"list_filter(list_transform(lines, lambda x: regexp_extract(x, '(?i)\\b({X.CITIES})\\b', 1)), lambda x: x <> '')[-1]")} AS city, CASE WHEN regexp_matches(header, '(?i)\\bindia\\b') THEN 'India' END AS country FROM heads""",
        "resume_skills": f"""WITH {_SECTIONS} SELECT doc_id, array_to_string(list_filter(list_transform(list_filter(list_transform(string_split_regex(regexp_replace(s, '[\\n\\r]+', ', ', 'g'), '[,;]+'), lambda x: {_wide_trim('x')}), lambda x: length(x) > 1),
            lambda x: {_wide_trim(f"regexp_replace({_wide_trim("regexp_replace(x, '^[^:]+:[ \\t\\n\\x0b\\f\\r]*', '')")}, '[ \\t\\n\\x0b\\f\\r]*\\(.*?\\)$', '')")}), lambda x: lower(x) IN ({', '.join(repr(x) for x in X.LISTED_SKILLS)})), '|') AS skills
            FROM (SELECT doc_id, {_section_text('SKILLS')} AS s FROM sectioned) WHERE s IS NOT NULL""",
        "normalize_dispatch": f"""SELECT r.rec_id, p.phone AS e164, {email('email')} AS email, {skill('title')} AS canonical, {country('location_country')} AS country, {_national('p.phone')} AS national
            FROM (SELECT DISTINCT rec_id, email, title, location_country FROM recruiter) r JOIN ({rec_phone}) p ON p.id = r.rec_id""",
        "missing_columns": " UNION ALL ".join(f"SELECT '{t}' AS table_name, coalesce((SELECT string_agg(h, '|' ORDER BY h) FROM (SELECT unnest({list(EXPORT_COLUMNS)}) AS h) WHERE h NOT IN (SELECT column_name FROM (DESCRIBE {t}))), '') AS missing" for t in ("recruiter", "candidate_profile")),
        "csv_round_trip": f"SELECT DISTINCT rec_id, {', '.join(f"nullif({_wide_trim(c)}, '') AS {n}" for c, n in (('name', 'full_name'), ('email', 'email'), ('phone', 'phone'), ('location_city', 'location_city'), ('skills', 'skills_text'), ('notes', 'notes')))} FROM recruiter",
        "extract_links": "SELECT doc_id, portfolio FROM (SELECT doc_id, list_filter(regexp_extract_all(text, '(?i)https?://[\\w\\-./]+'), lambda x: NOT regexp_matches(x, '(?i)^https?://(www\\.)?(linkedin|github)\\.com'))[1] AS portfolio FROM documents) WHERE portfolio IS NOT NULL",
        "email_edges": f"WITH {_HELD} SELECT src, dst, 'email_exact:' || email AS reason FROM stars",
        "email_clusters": f"""WITH RECURSIVE {_HELD}, e AS (SELECT src AS a, dst AS b FROM stars UNION SELECT dst, src FROM stars), r AS (SELECT a AS node, a AS label FROM e UNION SELECT e.b, r.label FROM r JOIN e ON e.a = r.node)
            SELECT node AS record_ix, min(label) AS cluster_id FROM r GROUP BY node""",
        "merge_scalars": f"WITH {_ADDRESSED} SELECT cluster_id, count(*) AS n, {merged} FROM addressed GROUP BY cluster_id",
        "merge_links": f"WITH {_ADDRESSED} SELECT cluster_id, {links} FROM addressed GROUP BY cluster_id",
        "merged_sources": f"WITH {_ADDRESSED} SELECT cluster_id, string_agg(source, '|' ORDER BY ix) AS merged_sources FROM (SELECT cluster_id, source, min(record_ix) AS ix FROM addressed GROUP BY ALL) GROUP BY cluster_id",
        "skill_confidence": f"""SELECT name, round(CASE WHEN count(*) >= 3 THEN 0.95 WHEN count(*) = 2 THEN 0.90 ELSE 0.70 END::DOUBLE * ((count(*) FILTER (WHERE k = 1) * 1.0::DOUBLE + count(*) FILTER (WHERE k = 2) * 0.85::DOUBLE + count(*) FILTER (WHERE k = 3) * 0.8::DOUBLE) / count(*)) + 1e-9, 4) AS confidence FROM (
            SELECT DISTINCT {skill('name')} AS name, src_file, {kind} AS k FROM skill WHERE src_file IS NOT NULL) WHERE name IS NOT NULL GROUP BY name""",
        "candidate_id": f"""WITH {_RECORDS}, raw AS (SELECT DISTINCT rec_id AS id, 1 AS pos, phone AS raw FROM recruiter UNION ALL SELECT profile_id + {PROFILE_BASE}, pos, raw FROM (SELECT profile_id, unnest(phones) AS raw, generate_subscripts(phones, 1) AS pos FROM (SELECT DISTINCT profile_id, phones FROM candidate_profile))),
            first AS (SELECT id, arg_min(phone, pos) AS phone FROM ({_phones("SELECT * FROM raw")}) WHERE phone IS NOT NULL GROUP BY id)
            SELECT record_ix, substr(sha256(coalesce(list_filter(emails, lambda x: x IS NOT NULL)[1], nullif(lower({trim('full_name')}), '') || coalesce(phone, ''))), 1, 16) AS candidate_id FROM records LEFT JOIN first ON id = record_ix""",
    }
