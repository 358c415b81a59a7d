"""DuckDB oracle SQL for every registered query.

Written as plain SQL over the driver's views (orders, part, events, ...).
Only the stand-in shaping expressions and lookup rows are shared with the
Spark side (so both engines start from the same bronze rows); every operator
is re-expressed here in SQL: CASE chains, NOT EXISTS, LEFT JOINs, window
functions, GROUP BY counts.
"""

from __future__ import annotations

from greenledger.contracts import CATALOG, PRODUCTS, SERIES, Contract
from greenledger.operators import checks as ck
from greenledger.plans import standins as si

_DUCK_TYPES = {"double": "DOUBLE", "int": "INTEGER", "string": "VARCHAR"}


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def shaped(exprs: dict[str, str], table: str) -> str:
    return "SELECT " + ", ".join(f"{sql} AS {q(a)}" for a, sql in exprs.items()) + f" FROM {table}"


def values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({', '.join(cols)})"


# White space as the contracts see it: ASCII separators, no-break and typographic spaces.
_SPACES = "".join(chr(c) for c in [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203),
                                   8232, 8233, 8239, 8287, 12288])


def _blank(c: str) -> str:
    return f"regexp_full_match({c}, '[{_SPACES}]*')"


def _blank_null(c: str) -> str:
    return f"CASE WHEN {_blank(c)} THEN NULL ELSE {c} END"


def validation(contract: Contract, raw_cols: list[str], src: str) -> str:
    """SELECT over ``src`` adding normalised inputs, typed ``t_*`` values,
    ``violations`` and ``status``, mirroring the contract in SQL."""
    fill = dict(contract.fill_from)
    specs = {f.name: f for f in contract.fields}
    norm = []
    for c in raw_cols:
        if c in fill:
            norm.append(f"coalesce(nullif({q(c)}, ''), {q(fill[c])}) AS {q(c)}")
        elif c in specs and specs[c].null_is_empty:
            norm.append(f"coalesce({q(c)}, '') AS {q(c)}")
        elif c in specs and specs[c].blank_is_null:
            norm.append(f"{_blank_null(q(c))} AS {q(c)}")
        else:
            norm.append(q(c))
    checks, typed = [], []
    for f in contract.fields:
        c = q(f.name)
        t = c if f.dtype == "string" else f"TRY_CAST({c} AS {_DUCK_TYPES[f.dtype]})"
        typed.append(f"{t} AS {q('t_' + f.name)}")
        if f.required:
            checks.append(f"CASE WHEN {c} IS NULL THEN {lit(f.name + ': field required')} END")
        if f.non_blank:
            checks.append(f"CASE WHEN {c} IS NOT NULL AND {_blank(c)} "
                          f"THEN {lit(f.name + ': must be non-blank')} END")
        if f.dtype != "string":
            checks.append(f"CASE WHEN {c} IS NOT NULL AND {t} IS NULL "
                          f"THEN {lit(f.name + ': not a valid ' + f.dtype)} END")
            conds, words = [], []
            for op, bound in ((">", f.gt), (">=", f.ge), ("<=", f.le)):
                if bound is not None:
                    conds.append(f"{t} {op} {bound!r}")
                    words.append(f"{op} {bound:g}")
            if conds:
                ok = " AND ".join(conds) + f" AND NOT isnan({t})"
                checks.append(f"CASE WHEN {t} IS NOT NULL AND NOT ({ok}) "
                              f"THEN {lit(f.name + ': must be ' + ' and '.join(words))} END")
    if contract.measure:
        m = q(contract.measure)
        skipped = f"({m} IS NULL OR {_blank(m)})" if contract.skip_blank else f"({m} IS NULL OR {m} = '')"
    else:
        skipped = "FALSE"
    return f"""
      SELECT *,
        CASE WHEN skipped THEN 'skipped' WHEN len(violations) = 0 THEN 'valid' ELSE 'invalid' END AS status
      FROM (
        SELECT *, {skipped} AS skipped,
          CASE WHEN {skipped} THEN []::VARCHAR[]
               ELSE list_filter([{', '.join(checks)}], lambda x: x IS NOT NULL) END AS violations
        FROM (SELECT *, {', '.join(typed)} FROM (SELECT {', '.join(norm)} FROM {src}))
      )"""


def typed_valid(contract: Contract, keep=(), src="") -> str:
    cols = [f"{q('t_' + n)} AS {q(n)}" for n in contract.names] + [q(k) for k in keep]
    return f"SELECT {', '.join(cols)} FROM {src} WHERE status = 'valid'"


CAT_COLS = list(si.CATALOG_RAW)
PROD_COLS = list(si.PRODUCTS_RAW)
SERIES_COLS = ["year", "co2_per_kWh", "factor_type"]

_READINGS = shaped(si.EVENT_READINGS, "events")
_SERIES_RAW = (f"SELECT year, max(co2_per_kWh) AS co2_per_kWh, factor_type "
               f"FROM ({_READINGS}) GROUP BY factor_type, year")

BASE = {
    "cat_raw": shaped(si.CATALOG_RAW, "orders"),
    "cat_chk": validation(CATALOG, CAT_COLS, "cat_raw"),
    "cat_valid": typed_valid(CATALOG, ("row_no",), "cat_chk"),
    "prod_raw": shaped(si.PRODUCTS_RAW, "part"),
    "prod_chk": validation(PRODUCTS, PROD_COLS, "prod_raw"),
    "prod_valid": typed_valid(PRODUCTS, (), "prod_chk"),
    "series_raw": _SERIES_RAW,
    "series_chk": validation(SERIES, SERIES_COLS, "series_raw"),
    "series_valid": typed_valid(SERIES, (), "series_chk"),
    "stg_catalog": """
      SELECT md5(concat_ws('|', 'defra', CAST("ID" AS VARCHAR), CAST("year" AS INTEGER))) AS id,
        "Level 3" AS factor_name,
        round(CAST("GHG Conversion Factor" AS DOUBLE), 3) * 1000.0 AS "gCO2e_per_unit",
        "UOM" AS unit, "Scope" AS ghg_scope, 'GLOBAL' AS country_code, 'defra' AS source,
        CAST("year" AS INTEGER) AS source_year,
        make_date(CAST("year" AS INTEGER), 1, 1) AS valid_from,
        make_date(CAST("year" AS INTEGER), 12, 31) AS valid_to,
        "Level 2" AS sub_category, "Level 1" AS category,
        "Level 4" AS sub_sub_category, "Column Text" AS column_text
      FROM cat_valid
      WHERE "GHG/Unit" = 'kg CO2e' AND "GHG Conversion Factor" IS NOT NULL""",
    "stg_products": """
      SELECT md5(concat_ws('|', 'ademe', CAST("__id" AS VARCHAR))) AS id,
        "Produit à l'unité" AS factor_name,
        CAST("Facteur d'émission" AS DOUBLE) AS "gCO2e_per_unit",
        'piece' AS unit, 'Scope 3' AS ghg_scope, 'GLOBAL' AS country_code, 'ademe' AS source,
        2016 AS source_year, DATE '2016-01-01' AS valid_from, DATE '9999-12-31' AS valid_to,
        coalesce(CAST("Incertitude en %" AS DOUBLE), 0) AS uncertainty_pct,
        "CodeFede" AS sport_federation_code, "Federation" AS federation
      FROM prod_valid""",
    "stg_series": """
      SELECT md5(concat_ws('|', 'nve', lower(factor_type), CAST(year AS INTEGER))) AS id,
        concat('Electricity (', factor_type, ')') AS factor_name,
        CAST(co2_per_kWh AS DOUBLE) AS "gCO2e_per_unit",
        'kWh' AS unit, 'Scope 2' AS ghg_scope, 'NO' AS country_code, 'nve' AS source,
        CAST(year AS INTEGER) AS source_year,
        make_date(CAST(year AS INTEGER), 1, 1) AS valid_from,
        make_date(CAST(year AS INTEGER), 12, 31) AS valid_to
      FROM series_valid""",
    "translations": values(si.TRANSLATIONS, ["factor_name_fr", "factor_name_en", "federation"]),
    "translations_fanout": values(si.TRANSLATIONS_FANOUT, ["factor_name_fr", "factor_name_en", "federation"]),
    "overrides": values(si.OVERRIDES, ["category", "sub_category", "should_drop"]),
    "category_map": values(si.CATEGORY_MAP, ["category_old", "category_new"]),
    "sub_category_map": values(si.SUB_CATEGORY_MAP, ["sub_category_old", "sub_category_new"]),
    "prod_std": """
      SELECT s.*, t.factor_name_en, coalesce(t.factor_name_en, s.factor_name) AS std
      FROM stg_products s LEFT JOIN translations t
        ON s.factor_name = t.factor_name_fr AND (t.federation IS NULL OR s.federation = t.federation)""",
    "cat_kept": """
      SELECT * FROM stg_catalog s
      WHERE NOT EXISTS (SELECT 1 FROM overrides o WHERE o.should_drop
                        AND o.category = s.category AND o.sub_category = s.sub_category)""",
    "cat_rewritten": f"""
      SELECT * REPLACE (CASE WHEN category = {lit(si.REWRITE_CATEGORY)} THEN category
                             ELSE sub_category END AS sub_category)
      FROM cat_kept""",
    "cat_mapped1": """
      SELECT c.*, m.category_new FROM cat_rewritten c
      LEFT JOIN category_map m ON c.category = m.category_old""",
    "cat_mapped": """
      SELECT c.*, m.sub_category_new,
        coalesce(m.sub_category_new, c.sub_category) AS sub,
        coalesce(c.category_new, c.category) AS cat
      FROM cat_mapped1 c LEFT JOIN sub_category_map m ON c.sub_category = m.sub_category_old""",
    "cat_named": """
      SELECT *,
        CASE
          WHEN sub IN ('Hotel stay') THEN sub_category || ' - ' || factor_name
          WHEN sub_category_new IN ('Urgent') THEN factor_name || ' - ' || column_text
          WHEN sub IN ('Open orders')
            THEN factor_name || ' ' || lower(substr(sub_category, 1, 1)) || substr(sub_category, 2)
          WHEN sub IN ('5-LOW') THEN sub_category_new
          WHEN sub IN ('Medium') THEN sub || ' - ' || factor_name || ' - ' || column_text
          WHEN sub IN ('High') THEN factor_name || ' - ' || sub || ' - ' || sub_sub_category
          WHEN category_new IN ('Fulfilled') THEN factor_name || ' - ' || column_text
          WHEN sub IN ('4-NOT SPECIFIED') THEN 'Pre- ' || factor_name
          ELSE factor_name
        END AS named,
        CASE WHEN sub IN ('Urgent', '2-HIGH') THEN 'GB' ELSE country_code END AS territory
      FROM cat_mapped""",
    "clean_catalog": """
      SELECT id, named AS factor_name,
        concat('GHG Emission factor for ', sub, ' belonging to category ', cat) AS description,
        "gCO2e_per_unit", unit, ghg_scope, territory AS country_code, source, source_year,
        valid_from, valid_to, cat AS category, sub AS sub_category, sub_sub_category, column_text
      FROM cat_named""",
    "clean_products": """
      SELECT id,
        regexp_replace(std, '\\s*\\([^)]*\\)\\s*$', '') AS factor_name,
        'Cradle-to-gate GHG emissions from the production of '
          || regexp_replace(lower(substr(std, 1, 1)) || substr(std, 2), '\\s*\\([^)]*\\)\\s*$', '')
          AS description,
        CASE WHEN regexp_matches(lower(std), '\\(k(?:gco2e|ge?c)/') THEN "gCO2e_per_unit" * 1000
             ELSE "gCO2e_per_unit" END AS "gCO2e_per_unit",
        unit, ghg_scope, country_code, source, source_year, valid_from, valid_to,
        uncertainty_pct, sport_federation_code
      FROM prod_std""",
    "clean_series": """
      SELECT id, factor_name,
        concat('GHG Emission factor for ', factor_name, ' belonging to category Energy') AS description,
        "gCO2e_per_unit", unit, ghg_scope, country_code, source, source_year, valid_from, valid_to
      FROM stg_series""",
    "conformed": """
      SELECT id, factor_name, description, "gCO2e_per_unit", unit, ghg_scope, country_code, source,
             source_year, valid_from, valid_to, sub_category, category,
             CAST(NULL AS DOUBLE) AS uncertainty_pct
      FROM clean_catalog
      UNION ALL
      SELECT id, factor_name, description, "gCO2e_per_unit", unit, ghg_scope, country_code, source,
             source_year, valid_from, valid_to, 'Electricity', 'Energy', CAST(NULL AS DOUBLE)
      FROM clean_series
      UNION ALL
      SELECT id, factor_name, description, "gCO2e_per_unit", unit, ghg_scope, country_code, source,
             source_year, valid_from, valid_to, 'Sports Equipment', 'Materials', uncertainty_pct
      FROM clean_products""",
    "prepared": """
      SELECT * REPLACE (coalesce(factor_name, sub_category) AS factor_name,
                        coalesce(uncertainty_pct, 0) AS uncertainty_pct)
      FROM conformed""",
    "ranked": """
      SELECT *, row_number() OVER (PARTITION BY source, factor_name, unit
                                   ORDER BY valid_from DESC NULLS LAST, valid_to DESC NULLS LAST,
                                            id ASC NULLS LAST) AS rn
      FROM prepared""",
    "dim": """
      SELECT id AS ef_id, source, factor_name, description, "gCO2e_per_unit", unit, ghg_scope,
             category, sub_category, country_code, source_year, valid_from, valid_to,
             rn = 1 AS is_current, uncertainty_pct
      FROM ranked""",
}

# Each CTE is emitted only when reachable from the final SELECT.
_DEPS_ORDER = list(BASE)


def with_ctes(final: str) -> str:
    """Prefix ``final`` with the CTEs it (transitively) references."""
    import re
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _DEPS_ORDER:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(BASE[name])

    visit(final)
    ctes = [f"{n} AS ({BASE[n]})" for n in _DEPS_ORDER if n in needed]
    return ("WITH " + ",\n".join(ctes) + "\n" + final) if ctes else final


def checks_sql(model: str, table: str, suite: list[ck.Check]) -> str:
    parts = []
    for c in suite:
        head = f"SELECT {lit(model)} AS model, {lit(c.kind)} AS \"check\", {lit(c.label)} AS \"column\""
        if c.kind == "not_null":
            parts.append(f"{head}, CAST(count_if({c.column} IS NULL) AS BIGINT) AS failing FROM {table}")
        elif c.kind == "expression":
            parts.append(f"{head}, CAST(count_if(NOT coalesce(({c.expr}), TRUE)) AS BIGINT) AS failing "
                         f"FROM {table}")
        elif c.kind == "accepted_values":
            vals = ", ".join(lit(v) for v in c.values)
            parts.append(f"{head}, CAST(count(*) AS BIGINT) AS failing FROM (SELECT {c.column} AS k "
                         f"FROM {table} WHERE {c.column} IS NOT NULL AND {c.column} NOT IN ({vals}) "
                         f"GROUP BY 1)")
        else:
            parts.append(f"{head}, CAST(count(*) AS BIGINT) AS failing FROM (SELECT {c.column} AS k "
                         f"FROM {table} WHERE {c.column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
    return " UNION ALL ".join(f"SELECT *, failing = 0 AS passed FROM ({p})" for p in parts)


_CAT_RAW_NORM_COLS = ", ".join(q(c) for c in CAT_COLS)
_LOC_ACT = """
  SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, n_name AS nation_code, r_name AS region_code
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
_LOC_FACTORS = """
  SELECT n_name AS code, max(s_acctbal) / 1000.0 AS v
  FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name HAVING count(*) % 2 = 0
  UNION ALL
  SELECT r_name, max(c_acctbal) / 1000.0
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY r_name HAVING count(*) % 2 = 1
  UNION ALL
  SELECT 'GLOBAL', max(c_acctbal) / 1000.0 FROM customer"""


def oracle_sql() -> dict[str, str]:
    w = with_ctes
    cat_fill = f"coalesce(nullif({q('Level 3')}, ''), {q('Level 2')})"
    prod_dirty = shaped(si.PRODUCTS_DIRTY, "part")
    check_rows = " UNION ALL ".join([
        checks_sql("stg_series", "stg_series", ck.series_suite()),
        checks_sql("stg_products", "stg_products", ck.products_suite()),
        checks_sql("stg_catalog", "stg_catalog", ck.catalog_suite()),
        checks_sql("dim_factors", "dim", ck.gold_suite()),
    ])
    summary = ("SELECT {src} AS source, count(*) AS total, "
               "CAST(count_if(status = 'valid') AS BIGINT) AS valid, "
               "CAST(count_if(status = 'invalid') AS BIGINT) AS invalid, "
               "CAST(count_if(status = 'skipped') AS BIGINT) AS skipped FROM {t}")
    sql = {
        "stage_catalog": w("SELECT * FROM stg_catalog"),
        "stage_products": w("SELECT * FROM stg_products"),
        "stage_series": w("SELECT * FROM stg_series"),
        "validate_lenient_rows": w("SELECT * FROM cat_valid"),
        "validate_rejected": w(f"SELECT {_CAT_RAW_NORM_COLS}, array_to_string(violations, '; ') AS violations "
                               f"FROM cat_chk WHERE status = 'invalid'"),
        "validation_summary": w(
            summary.format(src="'defra'", t="cat_chk") + " UNION ALL "
            + summary.format(src="'ademe'", t=f"({validation(PRODUCTS, PROD_COLS, '(' + prod_dirty + ')')})")
            + " UNION ALL " + summary.format(src="'nve'", t="series_chk")),
        "error_sample": w("""
            SELECT row_no, "ID", array_to_string(violations, '; ') AS violations,
              CAST(greatest((SELECT count(*) FROM cat_chk WHERE status = 'invalid') - 20, 0) AS BIGINT)
                AS remaining
            FROM cat_chk WHERE status = 'invalid' ORDER BY row_no LIMIT 20"""),
        "parent_fill": w(f'SELECT row_no, "Level 2", {cat_fill} AS "Level 3" FROM cat_raw'),
        "blank_to_null": w(f'SELECT "__id", {_blank_null(q("Incertitude en %"))} AS "Incertitude en %", '
                           f'{_blank_null(q("Remarques"))} AS "Remarques" FROM prod_raw'),
        "wildcard_lookup": w("SELECT id, factor_name, federation, factor_name_en FROM prod_std"),
        "wildcard_fanout": w("""
            SELECT s.id, s.factor_name, s.federation, t.factor_name_en
            FROM stg_products s LEFT JOIN translations_fanout t
              ON s.factor_name = t.factor_name_fr AND (t.federation IS NULL OR s.federation = t.federation)"""),
        "drop_listed": w("SELECT id, category, sub_category FROM cat_kept"),
        "map_category": w("SELECT id, category, sub_category, category_new FROM cat_mapped1"),
        "map_chain": w("SELECT id, category, sub_category, category_new, sub_category_new FROM cat_mapped"),
        "name_rules": w("SELECT id, named AS factor_name FROM cat_named"),
        "country_rule": w("SELECT id, territory AS country_code FROM cat_named"),
        "unmatched_lookup_keys": w("""
            SELECT DISTINCT sub_category AS "key" FROM cat_rewritten c
            WHERE sub_category IS NOT NULL
              AND NOT EXISTS (SELECT 1 FROM sub_category_map m WHERE m.sub_category_old = c.sub_category)"""),
        "unit_scale": w("""
            SELECT id, std AS factor_name,
              CASE WHEN regexp_matches(lower(std), '\\(k(?:gco2e|ge?c)/') THEN "gCO2e_per_unit" * 1000
                   ELSE "gCO2e_per_unit" END AS "gCO2e_per_unit"
            FROM prod_std"""),
        "strip_unit_suffix": w("SELECT id, regexp_replace(std, '\\s*\\([^)]*\\)\\s*$', '') AS factor_name "
                               "FROM prod_std"),
        "lower_first": w("SELECT id, lower(substr(std, 1, 1)) || substr(std, 2) AS factor_name FROM prod_std"),
        "null_concat": w("""
            SELECT id, concat('L4 ', sub_sub_category, ' / ', column_text) AS skipped,
                   'L4 ' || sub_sub_category || ' / ' || column_text AS propagated
            FROM stg_catalog"""),
        "clean_products": w("SELECT * FROM clean_products"),
        "clean_catalog": w("SELECT * FROM clean_catalog"),
        "clean_series": w("SELECT * FROM clean_series"),
        "conform_union": w("SELECT * FROM conformed"),
        "rank_editions": w("SELECT * FROM ranked"),
        "flag_current": w("SELECT * FROM dim"),
        "current_only": w('SELECT id, source, factor_name, unit, source_year, "gCO2e_per_unit" '
                          'FROM ranked WHERE rn = 1'),
        "dim_factors": w("SELECT * FROM dim ORDER BY source, country_code, factor_name, source_year, "
                         "valid_from, ef_id"),
        "check_suite": w(check_rows),
        "check_unique_lookup": checks_sql(
            "translations", f"({shaped(si.PART_TRANSLATIONS, 'part')})", ck.translation_suite()),
        "rows_per_year": w('SELECT year, count(*) AS "rows" FROM cat_valid GROUP BY year ORDER BY year'),
        "distinct_years": w("SELECT DISTINCT year FROM cat_valid ORDER BY year"),
        "bronze_roundtrip": w(
            "SELECT " + ", ".join(q(c) for c in CAT_COLS if c not in ("year", "row_no"))
            + ", CAST(row_no AS VARCHAR) AS row_no, CAST(year AS INTEGER) AS year "
            "FROM cat_chk WHERE status = 'valid'"),
        "tagged_sheets": f"""
            SELECT year, co2_per_kWh, factor_type FROM (
              SELECT year, co2_per_kWh,
                CASE WHEN contains(lower(sheet), 'click') THEN 'Market-based'
                     WHEN contains(lower(sheet), 'view') THEN 'Location-based' END AS factor_type
              FROM ({_READINGS})) WHERE factor_type IS NOT NULL""",
        "publish_reconcile": w("SELECT count(*) AS src_rows, count(*) AS dst_rows, TRUE AS matched FROM dim"),
        "run_report": w("""
            SELECT 'defra' AS source,
              CASE WHEN (SELECT count(*) FROM cat_chk) > 0 THEN 'ok' ELSE 'error' END AS status,
              CAST(NULL AS VARCHAR) AS reason
            UNION ALL
            SELECT 'ademe',
              CASE WHEN (SELECT count(*) FROM prod_chk) > 0
                    AND (SELECT count(*) FROM prod_chk WHERE status = 'invalid') = 0 THEN 'ok'
                   ELSE 'error' END, NULL
            UNION ALL
            SELECT 'nve',
              CASE WHEN (SELECT count(*) FROM series_chk) > 0
                    AND (SELECT count(*) FROM series_chk WHERE status = 'invalid') = 0 THEN 'ok'
                   ELSE 'error' END, NULL
            UNION ALL
            SELECT 'unknown_src', 'error', 'unknown_source'"""),
        "usable_on": w(f"SELECT * FROM dim WHERE DATE '{USABLE_DAY}' BETWEEN valid_from AND valid_to"),
        "activity_factor_join": w(f"""
            SELECT a.event_id, a.activity_date, f.ef_id, f."gCO2e_per_unit",
                   a.quantity * f."gCO2e_per_unit" AS emissions
            FROM ({shaped(si.EVENT_ACTIVITY, 'events')}) a
            LEFT JOIN dim f
              ON a.factor_name = f.factor_name AND a.unit = f.unit
             AND a.activity_date >= f.valid_from AND a.activity_date <= f.valid_to"""),
        "geo_fallback": f"""
            WITH act AS ({_LOC_ACT}), lf AS ({_LOC_FACTORS})
            SELECT a.l_orderkey, a.l_linenumber, a.l_suppkey,
              CASE WHEN f1.v IS NOT NULL THEN 'nation' WHEN f2.v IS NOT NULL THEN 'region'
                   WHEN f3.v IS NOT NULL THEN 'global' END AS geo_level,
              coalesce(f1.v, f2.v, f3.v) AS "gCO2e_per_unit",
              a.l_quantity * coalesce(f1.v, f2.v, f3.v) AS emissions
            FROM act a
            LEFT JOIN lf f1 ON f1.code = a.nation_code
            LEFT JOIN lf f2 ON f2.code = a.region_code
            LEFT JOIN lf f3 ON f3.code = 'GLOBAL'""",
    }
    prod_rows = f"({validation(PRODUCTS, [*PROD_COLS, 'row_no'], '(' + prod_dirty + ')')})"
    sql |= {
        "gated_publish": w(f"""
            SELECT 'declared' AS gate, CASE WHEN ok THEN 'published' ELSE 'refused' END AS outcome,
                   CASE WHEN ok THEN (SELECT count(*) FROM dim) END AS "rows"
            FROM (SELECT coalesce(bool_and(passed), TRUE) AS ok FROM ({check_rows}))
            UNION ALL SELECT 'failing', 'refused', NULL"""),
        "all_sources_ok": w("""
            SELECT (SELECT count(*) FROM cat_chk) > 0 AND (SELECT count(*) FROM prod_chk) > 0
               AND (SELECT count(*) FROM prod_chk WHERE status = 'invalid') = 0
               AND (SELECT count(*) FROM series_chk) > 0
               AND (SELECT count(*) FROM series_chk WHERE status = 'invalid') = 0 AS ok, 'registered' AS run
            UNION ALL SELECT FALSE, 'with an unknown source'"""),
        "strict_failure": f"""
            WITH chk AS {prod_rows},
                 bad AS (SELECT row_no, array_to_string(violations, '; ') AS v,
                                row_number() OVER (ORDER BY row_no) AS k FROM chk WHERE status = 'invalid'),
                 n AS (SELECT count(*) AS bad, (SELECT count(*) FROM chk) AS total FROM bad)
            SELECT 'ademe' AS source, CASE WHEN bad = 0 THEN 'ok' ELSE 'error' END AS status,
              CASE WHEN bad > 0 THEN 'ademe: validation failed: ' || bad || ' / ' || total || ' rows invalid.' || chr(10)
                || (SELECT string_agg('row ' || row_no || ': ' || v, chr(10) ORDER BY k) FROM bad WHERE k <= 20)
                || CASE WHEN bad > 20 THEN chr(10) || '... and ' || (bad - 20) || ' more row(s) with errors' ELSE '' END
              END AS reason
            FROM n""",
        "publisher_landing": w("SELECT * FROM series_valid"),
        "catalog_exports": w("SELECT * EXCLUDE (row_no) FROM cat_valid"),
        "series_sheets": f"""
            SELECT CAST(year AS INTEGER) AS year, co2_per_kWh, factor_type FROM ({sql["tagged_sheets"]})
            WHERE co2_per_kWh >= 0 AND NOT isnan(co2_per_kWh)""",
        "edition_slice": w(f'SELECT "ID", "Scope", "UOM", CAST(year AS INTEGER) AS year FROM cat_valid '
                           f"WHERE CAST(year AS INTEGER) = {SLICE_YEAR}"),
        "lookup_csv": shaped({c: e if c != "federation" else f"nullif({e}, '')"
                              for c, e in si.PART_TRANSLATIONS.items()}, "part"),
        "missing_column": w("""
            SELECT 'defra' AS source, count(*) AS total, 0::BIGINT AS valid,
                   CAST(count_if(status <> 'skipped') AS BIGINT) AS invalid,
                   CAST(count_if(status = 'skipped') AS BIGINT) AS skipped FROM cat_chk"""),
    }
    editions = ", ".join(f"{e} AS {c}" for c, e in si.EDITION_KEYS.items())
    edition_values = ", ".join(f'{e} AS "{c}"' for c, e in si.EDITION_VALUES.items())
    newest = "ORDER BY f.valid_from DESC, f.valid_to DESC, f.ef_id DESC"
    sql["asof_editions"] = f"""
        WITH f AS (SELECT factor_name, unit, edition AS ef_id, {edition_values}
                   FROM (SELECT {editions}, l_shipdate, l_extendedprice FROM lineitem) GROUP BY ALL),
             a AS (SELECT row_number() OVER () AS r, * FROM ({shaped(si.EDITION_ACTIVITY, 'lineitem')}))
        SELECT a.l_orderkey, a.l_linenumber, a.activity_date, f.ef_id, f."gCO2e_per_unit",
               a.quantity * f."gCO2e_per_unit" AS emissions
        FROM a LEFT JOIN f ON a.factor_name = f.factor_name AND a.unit = f.unit
             AND a.activity_date BETWEEN f.valid_from AND f.valid_to
        QUALIFY row_number() OVER (PARTITION BY a.r {newest}) = 1"""
    located = " UNION ALL ".join(f"""
        SELECT {place} AS country_code, l_linestatus AS unit, '{level} ' || CAST({edition} AS STRING) AS ef_id,
               {", ".join(f'{e.format(days=days)} AS "{c}"' for c, e in si.LOCATED_VALUES.items())}
        FROM act WHERE l_returnflag = '{flag}' GROUP BY ALL""" for level, (flag, place, edition, days) in si.LOCATED_LEVELS.items())
    sql["geo_fallback_dated"] = f"""
        WITH act AS ({_LOC_ACT.replace("l_orderkey, l_linenumber, l_suppkey, l_quantity,", "lineitem.*,")}),
             f AS ({located}),
             a AS (SELECT row_number() OVER () AS r, l_orderkey, l_linenumber, nation_code, region_code,
                          l_linestatus AS unit, CAST(l_shipdate AS DATE) AS activity_date FROM act)
        SELECT a.* EXCLUDE (r), f.ef_id, f."gCO2e_per_unit",
               CASE f.country_code WHEN a.nation_code THEN 'nation' WHEN a.region_code THEN 'region' WHEN 'GLOBAL' THEN 'global' END AS geo_level
        FROM a LEFT JOIN f ON a.unit = f.unit AND a.activity_date BETWEEN f.valid_from AND f.valid_to
             AND f.country_code IN (a.nation_code, a.region_code, 'GLOBAL')
        QUALIFY row_number() OVER (PARTITION BY a.r ORDER BY CASE f.country_code WHEN a.nation_code THEN 1
                WHEN a.region_code THEN 2 ELSE 3 END, {newest.removeprefix('ORDER BY ')}) = 1"""
    sql["incremental_landing"] = sql["bronze_roundtrip"]
    sql["rule_table"] = sql["name_rules"]
    sql["incremental_dimension"] = w("SELECT * FROM dim")
    sql["landing_counters"] = w(summary.format(src="'defra'", t="cat_chk"))
    return sql


USABLE_DAY = "2019-06-30"
SLICE_YEAR = 2015
