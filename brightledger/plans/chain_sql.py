"""The batch in SQL for DuckDB: folding, staging, resolution and facts as common table expressions, which the queries' SQL builds upon."""

from __future__ import annotations

from brightledger.config import Settings
from brightledger.functions.text import CONFUSABLES, ENTITIES, EXTRA_LATIN
from brightledger.operators import resolve, staging


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _unmarked(c: str) -> tuple[str, str]:
    """The text ``c`` composed (as look-alikes are counted), and with look-alikes and accents gone."""
    for entity, char in sorted(ENTITIES.items(), key=lambda x: x[0] == "amp"):
        c = f"regexp_replace({c}, {_q('&' + entity + ';')}, {_q(char)}, 'gi')"
    composed = rf"nfc_normalize(regexp_replace({c}, '[\x{{00A0}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{3000}}]', ' ', 'g'))"
    one = {k: v for k, v in (CONFUSABLES | EXTRA_LATIN).items() if len(v) == 1}
    out = f"translate({composed}, {_q(''.join(one))}, {_q(''.join(one.values()))})"
    for k, v in EXTRA_LATIN.items():
        if len(v) > 1:
            out = f"replace({out}, {_q(k)}, {_q(v)})"
    return composed, rf"regexp_replace(strip_accents({out}), '\p{{M}}', '', 'g')"


def fold_sql(c: str) -> dict[str, str]:
    """SQL of the key, the look-alikes and the lost letters of the name ``c``."""
    composed, plain = _unmarked(c)
    return {
        "key": rf"trim(regexp_replace(upper(regexp_replace({plain}, '[^\x00-\x7F]', ' ', 'g')), '[\s\x0B\x1C-\x1F]+', ' ', 'g'))",
        "confusables": f"(length({composed}) - length(translate({composed}, {_q(''.join(CONFUSABLES))}, '')))::INT",
        "dropped": rf"(length(regexp_replace({plain}, '[^\p{{L}}]', '', 'g')) - length(regexp_replace({plain}, '[^A-Za-z]', '', 'g')))::INT",
    }


def _single(c: str) -> str:
    """``c`` without outer blanks, inner ones single."""
    return f"trim(regexp_replace({c}, ' +', ' ', 'g'))"


def clean_sql(c: str) -> str:
    c = f"regexp_replace(replace(replace({c}, '&', ' AND '), '''', ''), '[^A-Z0-9 ]', ' ', 'g')"
    # Every word gets blanks of its own, so that neighbouring single letters can be marked and drawn together.
    c = f"regexp_replace(' ' || replace({_single(c)}, ' ', '  ') || ' ', ' ([A-Z]) ', '<\\1>', 'g')"
    c = f"replace(replace(replace({c}, '><', ''), '<', ' '), '>', ' ')"
    for word, short in resolve.LEGAL_WORDS.items():
        c = f"replace({c}, ' {word} ', ' {short} ')"
    return _single(c)


def head_sql(c: str) -> str:
    pattern = _q(rf"^(.*\b(?:{resolve.BRANCH_FORMS})\b[.,]?)\s*-\s*\S.*$")
    head = f"regexp_extract({c}, {pattern}, 1)"
    return rf"CASE WHEN regexp_matches({c}, {pattern}) AND NOT regexp_matches({c}, {_q(resolve.JOINT)}) AND len(regexp_split_to_array(trim({head}), '\s+')) >= 2 THEN {clean_sql(head)} END"


def matches_sql(keys: str, level: int) -> str:
    """SQL of (key, clean_key, match_key, rule) for the keys of the table expression ``keys`` (column key)."""
    heads = head_sql("key") if level >= 2 else "NULL::VARCHAR"
    last = rf"regexp_replace(base, '( ({resolve.LEGAL_FORMS}))+$', '')" if level >= 3 else "base"
    return f"""(SELECT key, clean_key, {last} AS match_key, coalesce(nullif(concat_ws('+', CASE WHEN clean_key <> key THEN 'punctuation' END, CASE WHEN branched THEN 'branch_suffix' END,
        CASE WHEN {last} <> base THEN 'legal_form_dropped' END), ''), 'identical') AS rule FROM
        (SELECT *, CASE WHEN branched THEN head ELSE clean_key END AS base FROM
            (SELECT k.*, k.head IS NOT NULL AND k.head IN (SELECT {clean_sql("key")} FROM {keys}) AS branched FROM
                (SELECT key, {clean_sql("key")} AS clean_key, {heads} AS head FROM (SELECT DISTINCT key FROM {keys})) k)))"""


TYPED = """SELECT id AS award_id, nullif(trim(reference_id), '') AS reference_id, nullif(trim(contract_no), '') AS contract_no, nullif(trim(award_title), '') AS award_title,
    nullif(trim(notice_title), '') AS notice_title, organization_name AS agency_raw, awardee_name AS supplier_raw, nullif(trim(area_of_delivery), '') AS area_raw, business_category,
    CASE WHEN isnan(contract_amount) THEN NULL ELSE contract_amount END AS contract_amount, award_date::DATE AS award_date FROM raw_awards"""
CONTENT = ", ".join(f"coalesce({c}::VARCHAR, '')" for c in staging.CONTENT)


def agency_sql(rows: str) -> str:
    """SQL of the agencies of ``rows`` (agency_key, agency_raw, contract_amount, award_date)."""
    kinds = " ".join(f"WHEN {' OR '.join(f'starts_with(agency_key, {_q(p)})' for p in prefixes)} THEN {_q(kind)}" for kind, prefixes in resolve.AGENCY_KINDS)
    return f"""SELECT substr(md5(agency_key), 1, 16) AS agency_id, agency_key, arg_min(agency_raw, (-n, agency_raw)) AS agency_name, CASE {kinds} ELSE 'national_or_other' END AS agency_type,
        count(*) AS name_variants, sum(n)::BIGINT AS award_count, sum(v) AS total_value, min(d0) AS first_award_date, max(d1) AS last_award_date FROM
        (SELECT agency_key, agency_raw, count(*) AS n, sum(contract_amount) AS v, min(award_date) AS d0, max(award_date) AS d1 FROM {rows} GROUP BY 1, 2) GROUP BY agency_key"""


def chain(cfg: Settings, level: int = 3) -> str:
    """The common table expressions, from ``c_typed`` to ``c_facts``, to put before a query."""

    def names(side: str) -> str:
        f = fold_sql("raw")
        return f"SELECT raw, {f['key']} AS key, {f['confusables']} AS confusables, {f['dropped']} AS dropped FROM (SELECT DISTINCT {side}_raw AS raw FROM c_typed WHERE {side}_raw IS NOT NULL)"

    tables = {
        "c_typed": TYPED,
        "c_agency_names": names("agency"),
        "c_supplier_names": names("supplier"),
        "c_reviewed": f"SELECT award_id FROM c_typed WHERE contract_amount > {cfg.large_amount} AND contract_no IS NOT NULL",
        "c_flagged": f"SELECT *, min(award_id) OVER (PARTITION BY {CONTENT}) AS keep_id, award_id <> min(award_id) OVER (PARTITION BY {CONTENT}) AS is_duplicate FROM c_typed",
        "c_ruled": f"""SELECT f.*, coalesce(a.key, '') AS agency_key, coalesce(s.key, '') AS supplier_key, CASE WHEN is_duplicate THEN 'exact_duplicate' WHEN award_date IS NULL THEN 'missing_award_date'
            WHEN award_date < DATE '{cfg.first_day}' THEN 'award_date_before_first_day' WHEN award_date > DATE '{cfg.snapshot_day}' THEN 'award_date_after_snapshot'
            WHEN coalesce(contract_amount < {cfg.least_amount}, true) THEN 'amount_too_small'
            WHEN contract_amount > {cfg.large_amount} AND NOT EXISTS (SELECT 1 FROM c_reviewed r WHERE r.award_id = f.award_id) THEN 'amount_too_large_unreviewed'
            WHEN coalesce(a.key, '') = '' OR coalesce(s.key, '') = '' THEN 'empty_name' END AS rule
            FROM c_flagged f LEFT JOIN c_agency_names a ON a.raw = f.agency_raw LEFT JOIN c_supplier_names s ON s.raw = f.supplier_raw""",
        "c_staged": "SELECT * FROM c_ruled WHERE rule IS NULL",
        "c_rejected": "SELECT * FROM c_ruled WHERE rule IS NOT NULL",
        "c_matches": f"SELECT * FROM {matches_sql('c_supplier_names', level)}",
        "c_agencies": agency_sql("c_staged"),
        "c_aliases": """SELECT supplier_raw, supplier_key, clean_key, match_key, substr(md5(match_key), 1, 16) AS supplier_id, m.rule, award_count, total_value FROM
            (SELECT supplier_raw, supplier_key, count(*) AS award_count, sum(contract_amount) AS total_value FROM c_staged GROUP BY 1, 2) v JOIN c_matches m ON m.key = v.supplier_key""",
        "c_suppliers": """SELECT supplier_id, any_value(match_key) AS match_key, arg_min(supplier_raw, (contains(rule, 'branch_suffix'), -award_count, supplier_raw)) AS supplier_name, count(*) AS alias_count,
            sum(award_count)::BIGINT AS award_count, sum(total_value) AS total_value FROM c_aliases GROUP BY supplier_id""",
        "c_facts": """SELECT s.award_id, a.agency_id, l.supplier_id, s.award_date, year(s.award_date)::INT AS award_year, s.contract_amount, s.business_category, s.reference_id FROM c_staged s
            JOIN c_agencies a USING (agency_key) JOIN c_aliases l USING (supplier_raw)""",
        "c_tokens": """SELECT DISTINCT p.award_id, p.token, nullif(s.canonical, '') AS area_name, s.kind, s.token IS NOT NULL AS is_known FROM
            (SELECT award_id, trim(unnest(string_split(area_raw, ','))) AS token FROM c_staged WHERE area_raw IS NOT NULL) p LEFT JOIN areas s USING (token)""",
        "c_award_areas": "SELECT DISTINCT award_id, area_name, kind FROM c_tokens WHERE area_name IS NOT NULL",
        "c_area_agency": "SELECT area_name, agency_id, count(*) AS awards, sum(contract_amount) AS total_value FROM c_facts JOIN (SELECT DISTINCT award_id, area_name FROM c_award_areas) USING (award_id) GROUP BY 1, 2",
        "c_area_year": "SELECT area_name, award_year, count(*) AS awards, sum(contract_amount) AS total_value FROM c_facts JOIN (SELECT DISTINCT award_id, area_name FROM c_award_areas) USING (award_id) GROUP BY 1, 2",
    }
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in tables.items()) + "\n"


def checks_sql(cfg: Settings, bands: str, national: str, concentration: str, same_day: str) -> str:
    """SQL of the 21 checks over the chain; the marts are given as table expressions over ``c_facts``."""
    none = lambda table, keys: f"(SELECT count(*) FROM (SELECT {keys} FROM {table} GROUP BY ALL HAVING count(*) > 1))"
    count = lambda table, where: f"(SELECT count(*) FROM {table} WHERE {where})"
    both = lambda where: f"{count('c_agency_names', where)} + {count('c_supplier_names', where)}"
    total = lambda table: f"(SELECT coalesce(fsum(contract_amount), 0) FROM {table})"
    rolled = " UNION ALL ".join(
        f"SELECT sum(n) AS n, coalesce(fsum(v), 0) AS v FROM (SELECT count(*) AS n, sum(contract_amount) AS v FROM c_facts GROUP BY {k})" for k in ("award_year", "agency_id, award_year", "agency_id, award_year, supplier_id")
    )
    rules = {
        "row_counts_reconcile": """(SELECT count(*) FROM (SELECT year(award_date) AS y, count(*) AS n FROM c_typed GROUP BY 1) r FULL JOIN (SELECT year(award_date) AS z, count(*) AS m FROM
            (SELECT award_date FROM c_staged UNION ALL SELECT award_date FROM c_rejected) GROUP BY 1) d ON r.y IS NOT DISTINCT FROM d.z WHERE coalesce(n, 0) <> coalesce(m, 0))""",
        "award_id_unique": none("c_staged", "award_id"),
        "no_exact_duplicates": none("c_staged", CONTENT),
        "award_date_in_range": count("c_staged", f"award_date IS NULL OR award_date < DATE '{cfg.first_day}' OR award_date > DATE '{cfg.snapshot_day}'"),
        "amount_in_range": count("c_staged", f"coalesce(contract_amount < {cfg.least_amount}, true) OR (contract_amount > {cfg.large_amount} AND award_id NOT IN (SELECT award_id FROM c_reviewed))"),
        "name_keys_are_ascii": both(r"regexp_matches(key, '[^\x20-\x7E]')"),
        "name_keys_are_lossless": both("dropped > 0"),
        "names_present": count("c_staged", "coalesce(agency_key, '') = '' OR coalesce(supplier_key, '') = ''"),
        "area_tokens_known": "(SELECT count(DISTINCT token) FROM c_tokens WHERE NOT is_known)",
        "yearly_value_within_tolerance": f"""(SELECT count(*) FROM (SELECT y, v / nullif(lag(v) OVER (ORDER BY y), 0) AS r FROM (SELECT year(award_date) AS y, sum(contract_amount) AS v FROM c_staged GROUP BY 1))
            WHERE y >= {cfg.yoy_first_year} AND y < {cfg.snapshot_day.year} AND (r < {cfg.yoy_ratio[0]} OR r > {cfg.yoy_ratio[1]}))""",
        "core_awards_complete": f"abs({count('c_staged', 'true')} - {count('c_facts', 'true')}) + {count('c_facts', 'agency_id IS NULL OR supplier_id IS NULL')} + {none('c_facts', 'award_id')}",
        "entity_ids_unique": f"{none('c_agencies', 'agency_id')} + (SELECT count(*) FROM (SELECT supplier_id FROM c_aliases GROUP BY 1 HAVING count(DISTINCT match_key) > 1))",
        "alias_maps_to_one_supplier": none("c_aliases", "supplier_raw"),
        "core_value_matches_staging": f"(abs({total('c_staged')} - {total('c_facts')}) > 1e-9 * greatest({total('c_staged')}, 1))::BIGINT",
        "thresholds_do_not_overlap": """(SELECT count(*) FROM core_thresholds a JOIN core_thresholds b ON a.threshold = b.threshold AND a.effective_from < b.effective_from
            AND coalesce(a.effective_to, DATE '9999-12-31') >= b.effective_from)""",
        "marts_reconcile_to_core": f"(SELECT count(*) FROM ({rolled}) WHERE n IS DISTINCT FROM {count('c_facts', 'true')} OR abs(v - {total('c_facts')}) > 1e-9 * greatest({total('c_facts')}, 1))",
        "bunching_counts_match_core": f"""(SELECT count(*) FROM (SELECT award_year, round_amount, count(*) FILTER (is_under) AS u, count(*) FILTER (NOT is_under) AS o FROM {bands} GROUP BY 1, 2) d
            FULL JOIN {national} m USING (award_year, round_amount) WHERE d.u IS DISTINCT FROM m.awards_under OR d.o IS DISTINCT FROM m.awards_over)""",
        "concentration_shares_valid": f"(SELECT count(*) FROM {concentration} WHERE top_supplier_share <= 0 OR top_supplier_share > 1 + 1e-9 OR herfindahl <= 0 OR herfindahl > top_supplier_share + 1e-9)",
        "same_day_groups_meet_definition": f"(SELECT count(*) FROM {same_day} WHERE notices < {cfg.day_notices} OR largest_notice > ceiling OR total_value <= ceiling)",
        "analysis_amounts_consistent": """(SELECT count(*) FROM core_thresholds t WHERE NOT EXISTS (SELECT 1 FROM analysis_amounts g WHERE g.round_amount = t.amount AND g.amount_kind = 'threshold'))
            + (SELECT (count(*) < 3)::BIGINT FROM analysis_amounts WHERE amount_kind = 'placebo') + (SELECT count(*) FROM analysis_amounts WHERE amount_kind NOT IN ('threshold', 'placebo', 'unexplained'))""",
        "raw_duplicate_value_share": f"""(SELECT count(*) FROM (SELECT year(award_date) AS y, sum(contract_amount) AS v, coalesce(sum(contract_amount) FILTER (is_duplicate), 0) AS d FROM c_ruled GROUP BY 1)
            WHERE y IS NOT NULL AND v > 0 AND d / v > {cfg.duplicate_value_share})""",
    }
    rows = " UNION ALL ".join(f"SELECT '{n}' AS name, '{'warn' if n == 'raw_duplicate_value_share' else 'error'}' AS severity, ({sql})::BIGINT AS violations" for n, sql in rules.items())
    return f"SELECT *, violations = 0 AS passed FROM ({rows})"
