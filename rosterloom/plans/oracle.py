"""ANSI SQL counterparts of the registered queries, composed from named steps.

Written independently of the operators: arrays appear as joined rows, windows instead of
aggregates, recursion instead of prefix sums.
"""

from __future__ import annotations

import re

from rosterloom import vocabulary as V
from rosterloom.plans import derived


def _list(values: list[str]) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def norm(x: str) -> str:
    """Folded words of text in the Latin-1 range, where NFKC changes nothing."""
    return (f"trim(regexp_replace(replace(lower(coalesce({x}, '')), 'ß', 'ss'), "
            "'[^\\p{L}\\p{N}_''\\-]+', ' ', 'g'))")


def fold(x: str) -> str:
    return norm(f"strip_accents(replace(coalesce({x}, ''), 'ß', 'ss'))")


def pkey(x: str) -> str:
    return f"trim(regexp_replace(replace(replace({fold(x)}, '-', ' '), '''', ''), ' +', ' ', 'g'))"


def url(x: str) -> str:
    return (f"rtrim(regexp_replace(trim(lower(coalesce({x}, ''))), "
            "'^(https?://)?(www\\.)?', ''), '/')")


def _name_problem(x: str, key: str) -> str:
    return f"""CASE WHEN {x} = '' THEN 'String should have at least 1 character'
      WHEN length({x}) > 100 THEN 'longer than 100 characters'
      WHEN contains({x}, '@') THEN 'looks like an email address (columns swapped?)'
      WHEN regexp_matches({x}, '\\p{{Nd}}') THEN 'contains digits'
      WHEN NOT regexp_matches({x}, '\\p{{L}}') THEN 'contains no letters'
      WHEN {key} IN {_list(V.NAME_PLACEHOLDERS)} THEN concat('placeholder value ''', {x}, '''')
      END"""


STEPS: dict[str, str] = {
    "registrants": derived.REGISTRANTS,
    "profiles": derived.PROFILES,
    "experience": f"""SELECT * REPLACE (cast(position_no AS bigint) AS position_no)
        FROM ({derived.EXPERIENCE}) AS x""",
    "calls": derived.PROVIDER_CALLS,
    "tidy": """SELECT batch_id, batch_date, cast(row_number AS bigint) AS row_number, trim(first_name) AS first_name,
        trim(last_name) AS last_name, trim(email) AS email, trim(company) AS company,
        trim(location) AS location, trim(linkedin_url) AS linkedin_url, trim(consent) AS consent
        FROM registrants""",
    "keyed": f"""SELECT *, {pkey('first_name')} AS first_key, {pkey('last_name')} AS last_key,
        {pkey('company')} AS company_key, {pkey('location')} AS location_key,
        {pkey('consent')} AS consent_key,
        regexp_extract({url('linkedin_url')},
          '^(?:[a-z]{{2,3}}\\.)?(linkedin\\.com/(?:in|pub)/[^/?#\\s]+)', 1) AS profile_url,
        regexp_matches(email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s.]+$') AS email_ok FROM tidy""",
    "cleaned": f"""SELECT batch_id, batch_date, row_number, first_name, last_name,
        CASE WHEN email_ok THEN lower(email) END AS email,
        CASE WHEN company <> '' AND company_key NOT IN {_list(V.ORG_PLACEHOLDERS)} THEN company END
          AS company,
        CASE WHEN location <> '' AND location_key NOT IN {_list(V.ORG_PLACEHOLDERS)} THEN location
          END AS location,
        CASE WHEN profile_url <> '' THEN profile_url END AS linkedin_url,
        CASE WHEN consent_key IN {_list(V.CONSENT_YES)} THEN true
             WHEN consent_key IN {_list(V.CONSENT_NO)} THEN false END AS consent,
        concat_ws(',', CASE WHEN email <> '' AND NOT email_ok THEN 'input.email_invalid' END,
          CASE WHEN linkedin_url <> '' AND profile_url = '' THEN 'input.linkedin_url_invalid' END,
          CASE WHEN company_key IN {_list(V.ORG_PLACEHOLDERS)} THEN 'input.company_placeholder' END,
          CASE WHEN location_key IN {_list(V.ORG_PLACEHOLDERS)} THEN 'input.location_placeholder' END,
          CASE WHEN consent <> '' AND consent_key NOT IN {_list(V.CONSENT_YES + V.CONSENT_NO)}
               THEN 'input.consent_unrecognised' END) AS notes,
        coalesce(nullif(concat_ws('; ',
            'first_name: ' || ({_name_problem('first_name', 'first_key')}),
            'last_name: ' || ({_name_problem('last_name', 'last_key')})), ''),
          CASE WHEN consent_key IN {_list(V.CONSENT_NO)} THEN 'consent: withheld' END) AS reason,
        first_name AS raw_first_name, last_name AS raw_last_name, email AS raw_email,
        company AS raw_company, location AS raw_location, linkedin_url AS raw_linkedin_url,
        consent AS raw_consent
        FROM keyed""",
    "valid": "SELECT * FROM cleaned WHERE reason IS NULL",
    "rejected": "SELECT * FROM cleaned WHERE reason IS NOT NULL",
    "laddered": """SELECT *, CASE WHEN email IS NOT NULL THEN 'email'
        WHEN linkedin_url IS NOT NULL THEN 'linkedin'
        WHEN company IS NOT NULL OR location IS NOT NULL THEN 'name_context'
        ELSE 'name_only' END AS lookup_method FROM valid""",
    "planned": f"""SELECT *, CASE lookup_method WHEN 'name_only' THEN 'identify' ELSE 'enrich' END
          AS call_kind,
        sha256(concat({norm('first_name')}, '|', {norm('last_name')}, '|', coalesce(email, ''), '|',
          {norm('company')}, '|',
          CASE WHEN lookup_method = 'name_context' THEN {norm('location')} ELSE '' END, '|',
          coalesce(linkedin_url, ''), '|', CASE lookup_method WHEN 'name_only'
          THEN 'identify_min_score 70 identify_min_margin 20' ELSE 'min_likelihood 4' END))
          AS lookup_key,
        CASE WHEN lookup_method = 'email' THEN email WHEN lookup_method = 'linkedin'
             THEN linkedin_url
             WHEN company IS NOT NULL THEN concat({norm("concat(first_name, ' ', last_name)")},
                  '|company|', {norm('company')})
             WHEN location IS NOT NULL THEN concat({norm("concat(first_name, ' ', last_name)")},
                  '|place|', {norm('location')})
             ELSE {norm("concat(first_name, ' ', last_name)")} END AS identifier
        FROM laddered""",
    "named": f"""SELECT *, {norm("concat(first_name, ' ', last_name)")} AS name_key
        FROM profiles""",
    "identifiers": f"""SELECT method, identifier, person_id, likelihood FROM (
        SELECT *, row_number() OVER (PARTITION BY method, identifier
                                     ORDER BY likelihood DESC, person_id DESC) AS nth FROM (
          SELECT 'email' AS method, email AS identifier, person_id, likelihood FROM named
          UNION ALL SELECT 'linkedin', linkedin_url, person_id, likelihood FROM named
          UNION ALL SELECT 'name_context', concat(name_key, '|company|', {norm('company_name')}),
                    person_id, likelihood FROM named
          UNION ALL SELECT 'name_context', concat(name_key, '|place|', {norm('country')}),
                    person_id, likelihood FROM named) AS u WHERE likelihood >= 4) AS r
        WHERE nth = 1""",
    "ranked": """SELECT name_key, person_id, match_score,
        row_number() OVER (PARTITION BY name_key ORDER BY match_score DESC, person_id) AS nth,
        coalesce(lead(match_score) OVER (PARTITION BY name_key
                 ORDER BY match_score DESC, person_id), 0) AS second,
        count(*) OVER (PARTITION BY name_key) AS candidates FROM named""",
    "gated": """SELECT name_key, match_score AS likelihood, candidates,
        CASE WHEN match_score >= 70 AND match_score - second >= 20 THEN person_id END AS person_id,
        CASE WHEN match_score >= 70 AND match_score - second >= 20 THEN 'matched'
             ELSE 'ambiguous' END AS gate FROM ranked WHERE nth = 1""",
    "answers": """SELECT p.*, coalesce(i.person_id, g.person_id) AS person_id,
        coalesce(i.likelihood, g.likelihood) AS likelihood,
        CASE WHEN i.person_id IS NOT NULL THEN 1 ELSE g.candidates END AS candidates, g.gate,
        CASE WHEN i.person_id IS NOT NULL OR g.gate IS NOT NULL THEN 200 ELSE 404 END AS http_status
        FROM planned p LEFT JOIN identifiers i
          ON p.lookup_method = i.method AND p.identifier = i.identifier
        LEFT JOIN gated g ON p.lookup_method = 'name_only' AND p.identifier = g.name_key""",
    "faulted": """SELECT * EXCLUDE (http_status, person_id, likelihood, candidates, gate),
        CASE left(lookup_key, 1) WHEN '0' THEN 500 WHEN '1' THEN 402 WHEN '2' THEN 400
             ELSE http_status END AS http_status,
        CASE WHEN left(lookup_key, 1) NOT IN ('0', '1', '2') THEN person_id END AS person_id,
        CASE WHEN left(lookup_key, 1) NOT IN ('0', '1', '2') THEN likelihood END AS likelihood,
        CASE WHEN left(lookup_key, 1) NOT IN ('0', '1', '2') THEN candidates END AS candidates,
        CASE WHEN left(lookup_key, 1) NOT IN ('0', '1', '2') THEN gate END AS gate
        FROM answers""",
    "held": """SELECT e.*, CASE WHEN is_primary OR end_date IS NULL THEN 0 ELSE 1 END AS past,
        NOT coalesce(regexp_matches(start_date,
          '^(19\\d\\d|20\\d\\d|2100)(-(0[1-9]|1[0-2])(-(0[1-9]|[12]\\d|3[01]))?)?$'), true)
        OR NOT coalesce(regexp_matches(end_date,
          '^(19\\d\\d|20\\d\\d|2100)(-(0[1-9]|1[0-2])(-(0[1-9]|[12]\\d|3[01]))?)?$'), true) AS bad
        FROM experience e JOIN profiles p ON e.person_id = p.person_id WHERE p.likelihood < 10""",
    "doubts": """SELECT person_id, count(*) AS jobs, bool_or(bad) AS malformed,
        bool_or(NOT bad AND coalesce(end_date < start_date, false)) AS backwards
        FROM held GROUP BY person_id""",
    "flagged": f"""SELECT f.*,
        CASE WHEN http_status = 402 THEN 'budget_deferred' WHEN http_status = 404 THEN 'not_found'
             WHEN http_status <> 200 THEN 'error' WHEN gate = 'ambiguous' THEN 'ambiguous'
             ELSE 'matched' END AS status,
        CASE WHEN http_status = 402 THEN 'account maximum reached'
             WHEN http_status NOT IN (200, 404) THEN concat('HTTP ', http_status) END AS error_message,
        CASE WHEN http_status = 200 AND f.person_id IS NOT NULL THEN concat_ws(',',
          CASE WHEN len(list_intersect(string_split({fold('f.last_name')}, ' '),
                    string_split({fold("concat_ws(' ', p.full_name, p.first_name, p.last_name)")},
                    ' '))) = 0 THEN 'match.name_mismatch' END,
          CASE WHEN p.full_name IS NULL OR p.job_title IS NULL THEN 'match.sparse_profile' END,
          CASE WHEN d.jobs IS NULL THEN 'match.no_employment' END,
          CASE WHEN call_kind = 'enrich' AND f.likelihood <= 4 THEN 'match.likelihood_at_floor' END,
          CASE WHEN d.malformed THEN 'match.malformed_dates' END,
          CASE WHEN d.backwards THEN 'match.end_before_start' END) ELSE '' END AS match_flags,
        CASE WHEN http_status = 200 OR (call_kind = 'identify' AND http_status = 404) THEN 1
             ELSE 0 END AS credits
        FROM faulted f LEFT JOIN profiles p ON f.person_id = p.person_id
        LEFT JOIN doubts d ON f.person_id = d.person_id""",
    "results": """SELECT * EXCLUDE (status, http_status, credits),
        CASE WHEN repeated THEN 'cached' ELSE status END AS status,
        CASE WHEN NOT repeated THEN http_status END AS http_status,
        CASE WHEN repeated THEN 0 ELSE credits END AS credits_consumed,
        CASE WHEN repeated THEN 0 ELSE 1 END AS attempts,
        concat('raw/provider=recorded/batch_date=', batch_date, '/batch_id=', batch_id, '/',
               lookup_key, '.json') AS raw_ref,
        strftime(cast(batch_date AS timestamp) + to_seconds(row_number), '%Y-%m-%d %H:%M:%S')
          AS requested_at
        FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, lookup_key ORDER BY row_number) > 1
                AND status IN ('matched', 'not_found', 'ambiguous') AS repeated FROM flagged) AS x""",
    "persons": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, person_id
          ORDER BY row_number) AS nth FROM results
          WHERE status IN ('matched', 'cached') AND person_id IS NOT NULL) AS x WHERE nth = 1""",
    "dim_person": """SELECT r.person_id, 'recorded' AS provider, batch_id, batch_date,
        row_number AS input_row_number, r.first_name AS input_first_name,
        r.last_name AS input_last_name, r.email AS input_email, p.full_name, p.first_name,
        p.last_name, p.linkedin_url, p.country AS location_country, p.job_title AS current_job_title,
        CASE WHEN p.job_title IS NOT NULL THEN p.company_name END AS current_company_name,
        p.years_experience AS inferred_years_experience, r.likelihood AS match_likelihood,
        lookup_method, concat_ws(',', nullif(notes, ''), nullif(match_flags, '')) AS quality_flags,
        requested_at AS enriched_at FROM persons r JOIN profiles p ON r.person_id = p.person_id""",
    "fact_employment": """SELECT h.person_id, batch_id, batch_date,
        row_number() OVER (PARTITION BY batch_id, h.person_id
          ORDER BY past, coalesce(start_date, '') DESC, position_no) - 1 AS sequence_no,
        h.company_name, h.company_industry, company_country AS company_location_country, title_name,
        title_role, CASE WHEN level_a = '' OR level_a = level_b THEN level_b
                         ELSE concat(level_a, ',', level_b) END AS title_levels,
        start_date, end_date, try_cast(left(start_date, 4) AS integer) AS start_year,
        past = 0 AS is_current FROM persons r JOIN held h ON r.person_id = h.person_id""",
    "fact_lookup": """SELECT batch_id, batch_date, row_number, first_name AS input_first_name,
        last_name AS input_last_name, email AS input_email, company AS input_company, lookup_key,
        status, lookup_method, person_id, likelihood, candidates, http_status, error_message,
        credits_consumed, attempts, raw_ref,
        concat_ws(',', nullif(notes, ''), nullif(match_flags, '')) AS quality_flags, requested_at
        FROM results
        UNION ALL
        SELECT batch_id, batch_date, row_number, nullif(raw_first_name, ''),
        nullif(raw_last_name, ''), nullif(raw_email, ''), nullif(raw_company, ''), NULL,
        'invalid_input', NULL, NULL, NULL, NULL, NULL, reason, 0, 0, NULL, 'input.rejected',
        '2030-01-01 00:00:00' FROM rejected""",
    "flags": """SELECT batch_id, row_number, status, flag, i FROM (
        SELECT batch_id, row_number, status, unnest(string_split(quality_flags, ',')) AS flag,
               generate_subscripts(string_split(quality_flags, ','), 1) AS i
        FROM fact_lookup WHERE quality_flags <> '' AND status <> 'invalid_input') AS x""",
    "doubtful": """SELECT batch_id, flag, count(*) AS n, row_number() OVER (PARTITION BY batch_id
        ORDER BY count(*) DESC, min(row_number * 100 + i)) AS nth
        FROM flags WHERE flag LIKE 'match.%' GROUP BY batch_id, flag""",
    "top_doubts": """SELECT batch_id, string_agg(concat(flag, ' x', n), ', ' ORDER BY nth) AS doubts
        FROM doubtful WHERE nth <= 3 GROUP BY batch_id""",
    "counted": """SELECT l.batch_id, min(batch_date) AS batch_date,
        count(*) FILTER (status <> 'invalid_input') AS rows_valid,
        count(*) FILTER (status = 'invalid_input') AS rows_invalid,
        count(*) FILTER (status = 'matched') AS matched,
        count(*) FILTER (status = 'cached') AS cached,
        count(*) FILTER (status = 'not_found') AS not_found,
        count(*) FILTER (status = 'ambiguous') AS ambiguous,
        count(*) FILTER (status = 'budget_deferred') AS budget_deferred,
        count(*) FILTER (status = 'provider_unavailable') AS provider_unavailable,
        count(*) FILTER (status = 'error') AS error,
        count(*) FILTER (status IN ('matched', 'cached') AND contains(quality_flags, 'match.'))
          AS flagged_matches,
        cast(sum(credits_consumed) AS bigint) AS credits_spent
        FROM fact_lookup l GROUP BY l.batch_id""",
    "warned": """SELECT c.*, CASE WHEN rows_valid > 0
          THEN (matched + cached) / rows_valid END AS match_rate,
        concat_ws('; ', CASE WHEN rows_valid >= 5 AND (matched + cached) / rows_valid < 0.2 THEN
            concat('low_match_rate: ', matched + cached, ' of ', rows_valid, ' valid rows matched (',
              cast(round_even(100 * (matched + cached) / rows_valid, 0) AS int),
              '%), below 20%; check the input columns and the provider''s credit state') END,
          CASE WHEN rows_invalid / (rows_valid + rows_invalid) >= 0.2 THEN
            concat('high_invalid_rate: ', rows_invalid, ' of ', rows_valid + rows_invalid,
              ' rows rejected (', cast(round_even(100 * rows_invalid / (rows_valid + rows_invalid), 0)
              AS int), '%); see fact_lookup rows with status invalid_input') END,
          CASE WHEN flagged_matches > 0 THEN concat('flagged_matches: ', flagged_matches,
              ' matched rows carry quality flags (', doubts, ')') END) AS warnings
        FROM counted c LEFT JOIN top_doubts t ON c.batch_id = t.batch_id""",
    "fact_batch_quality": """SELECT w.*, 0 AS rows_unrecorded,
        (SELECT count(*) FROM dim_person d WHERE d.batch_id = w.batch_id) AS persons,
        (SELECT count(*) FROM fact_employment e WHERE e.batch_id = w.batch_id) AS employment_rows,
        (length(warnings) - length(replace(warnings, '; ', ''))) // 2
          + CASE WHEN warnings <> '' THEN 1 ELSE 0 END
          - CASE WHEN contains(warnings, 'rejected (') THEN 1 ELSE 0 END
          - CASE WHEN contains(warnings, 'below 20%') THEN 1 ELSE 0 END AS warning_count
        FROM warned w""",
}


def compose(select: str, recursive: str = "", **extra: str) -> str:
    """``select`` behind the steps it needs, in dependency order."""
    steps = {**STEPS, **extra}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN)\s+([a-z_]+)\b", text):
            if name in steps and name not in order:
                visit(steps[name])
                if name not in order:
                    order.append(name)

    visit(select)
    if recursive:
        visit(recursive)
    parts = [f"{name} AS MATERIALIZED (\n{steps[name]}\n)" for name in order]
    if recursive:
        parts.append(recursive)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ",\n".join(parts) + "\n" + select) if parts else select
