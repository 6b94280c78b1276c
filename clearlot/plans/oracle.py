"""The expected result of each query as SQL over the star-schema tables."""

from __future__ import annotations

from clearlot import contracts as C
from clearlot.operators.dirt import KINDS

# ---------------------------------------------------------------- building blocks

_COUNTRY_LIST = ", ".join(f"'{code}'" for code in C.COUNTRIES)
_SUPPLIERS = """
sup0 AS (
  SELECT s_suppkey AS k, s_name, s_acctbal / 100 AS score, n_name, n_regionkey,
         CASE WHEN s_suppkey % 23 = 7 THEN 'XX'
              ELSE list_extract([COUNTRY_LIST], CAST(n_nationkey % 9 + 1 AS INTEGER)) END AS country,
         '{"lat": ' || (s_suppkey % 90) || '.5, "lon": -' || (s_suppkey % 180) || '.25}' AS geo
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
sup AS (
  SELECT k,
    'S' || lpad(CAST(k AS VARCHAR), 8, '0') AS supplier_id,
    s_name AS supplier_code,
    'tenant_' || n_regionkey AS tenant_id,
    CASE WHEN k % 17 <> 5 THEN s_name END AS legal_name,
    CASE WHEN k % 3 = 0 THEN s_name || ' Trading' END AS dba_name,
    country,
    CASE WHEN country IN ('US', 'MX') THEN 'AMERICAS' WHEN country IN ('CN', 'JP', 'KR', 'IN', 'VN') THEN 'APAC'
         WHEN country IN ('DE', 'PL') THEN 'EMEA' ELSE 'OTHER' END AS region,
    '  ' || (k % 500) || '  mill' || chr(9) || 'Lane ' AS address_line1,
    CASE WHEN k % 5 = 0 THEN 'unit ' || (k % 100) WHEN k % 5 = 1 THEN '  ' END AS address_line2,
    lower(n_name) AS city,
    CASE WHEN country = 'US' THEN 'CA' END AS state,
    lpad(CAST(k % 100000 AS VARCHAR), 5, '0') AS postal_code,
    CASE WHEN k % 13 <> 0 THEN 'contact' || k || '@example.com' END AS contact_email,
    '+1-555-' || lpad(CAST(k % 10000000 AS VARCHAR), 7, '0') AS contact_phone,
    CASE country WHEN 'CN' THEN 'CNY' WHEN 'DE' THEN 'EUR' WHEN 'MX' THEN 'MXN' WHEN 'IN' THEN 'INR'
         WHEN 'VN' THEN 'VND' WHEN 'PL' THEN 'PLN' WHEN 'JP' THEN 'JPY' WHEN 'KR' THEN 'KRW'
         ELSE 'USD' END AS preferred_currency,
    CASE k % 4 WHEN 0 THEN 'DDP' WHEN 1 THEN 'FOB' WHEN 2 THEN 'CIF' ELSE 'EXW' END AS incoterms,
    CAST(CASE WHEN k % 37 = 1 THEN -1 ELSE k % 60 + 3 END AS INTEGER) AS lead_time_days_avg,
    CAST(k % 80 + 7 AS INTEGER) AS lead_time_days_p95,
    CAST(CASE WHEN k % 19 = 3 THEN 104 ELSE k * 7 % 41 + 60 END AS DOUBLE) AS on_time_delivery_rate,
    CAST(k * 37 % 900 AS INTEGER) AS defect_rate_ppm,
    CAST(k * 53 % 9000 + 100 AS INTEGER) AS capacity_units_per_week,
    score AS risk_score,
    CASE WHEN score < 35 THEN 'LOW' WHEN score < 60 THEN 'MEDIUM' ELSE 'HIGH' END AS financial_risk_tier,
    CASE WHEN k % 27 = 4 THEN 'ISO9001,ISO9999' WHEN k % 3 = 0 THEN 'ISO9001'
         WHEN k % 3 = 1 THEN 'ISO9001,AS9100' ELSE 'IATF16949,ISO14001' END AS certifications,
    CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN 'REACH' ELSE 'ITAR,ROHS' END AS compliance_flags,
    CASE WHEN k % 41 = 2 THEN 'UNKNOWN' WHEN k % 10 = 9 THEN 'PENDING' ELSE 'APPROVED' END AS approved_status,
    CASE WHEN k % 2 = 0 THEN '' ELSE 'CONTRACT_' || lpad(CAST(k AS VARCHAR), 8, '0') END AS contracts,
    (k % 5 + 1) || '.' || (k % 10) AS terms_version,
    CASE WHEN k % 11 = 6 THEN NULL WHEN k % 9 = 2 THEN '{"lat": null, "lon": null}'
         WHEN k % 9 = 5 THEN '' ELSE geo END AS geo_coords,
    CASE WHEN k % 11 = 6 THEN geo ELSE 'synthetic.v1' END AS data_source,
    '2024-01-' || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0') || ' 00:00:00' AS moment,
    '1.0.0' AS schema_version,
    CASE WHEN k % 11 = 6 OR NOT (k % 9 = 2 OR k % 9 = 5) THEN CAST((k % 90) || '.5' AS DOUBLE) END AS geo_lat,
    CASE WHEN k % 11 = 6 OR NOT (k % 9 = 2 OR k % 9 = 5) THEN CAST('-' || (k % 180) || '.25' AS DOUBLE) END AS geo_lon
  FROM sup0
)""".replace("COUNTRY_LIST", _COUNTRY_LIST)

_SUPPLIER_TAGS = """
sup_tag AS (
  SELECT *, concat_ws(',',
    CASE WHEN supplier_id IS NULL THEN 'MISSING_SUPPLIER_ID' END,
    CASE WHEN tenant_id IS NULL THEN 'MISSING_TENANT_ID' END,
    CASE WHEN legal_name IS NULL THEN 'MISSING_LEGAL_NAME' END,
    CASE WHEN on_time_delivery_rate < 0 OR on_time_delivery_rate > 100 THEN 'INVALID_ON_TIME_RATE' END,
    CASE WHEN risk_score < 0 OR risk_score > 100 THEN 'INVALID_RISK_SCORE' END,
    CASE WHEN lead_time_days_avg < 0 THEN 'NEGATIVE_LEAD_TIME' END,
    CASE WHEN defect_rate_ppm < 0 THEN 'NEGATIVE_DEFECT_RATE' END,
    CASE WHEN financial_risk_tier NOT IN ('LOW', 'MEDIUM', 'HIGH') THEN 'INVALID_FINANCIAL_TIER' END,
    CASE WHEN approved_status NOT IN ('PENDING', 'APPROVED', 'SUSPENDED', 'BLACKLISTED') THEN 'INVALID_STATUS' END,
    CASE WHEN length(country) <> 2 OR country = 'XX' THEN 'INVALID_COUNTRY_CODE' END) AS violations
  FROM sup
),
valid_sup AS (SELECT supplier_id FROM sup_tag WHERE violations = '')"""

_PARTS = """
used AS (
  SELECT l_partkey, min(l_suppkey) AS first_key, max(l_suppkey) AS last_key FROM lineitem GROUP BY l_partkey
),
prt0 AS (
  SELECT p_partkey AS k, part.*,
    (first_key + p_partkey) % (SELECT count(*) FROM supplier) AS lo,
    (last_key + p_partkey) % (SELECT count(*) FROM supplier) AS hi
  FROM part LEFT JOIN used ON p_partkey = l_partkey
),
prt1 AS (
  SELECT *, 'S' || lpad(CAST(lo AS VARCHAR), 8, '0') AS lo_id, 'S' || lpad(CAST(hi AS VARCHAR), 8, '0') AS hi_id
  FROM prt0
),
prt AS (
  SELECT k,
    'P' || lpad(CAST(k AS VARCHAR), 8, '0') AS part_id,
    'tenant_' || (k % 5) AS tenant_id,
    p_name AS part_number,
    'Part ' || k || ' ' || p_type AS description,
    CASE WHEN k % 43 = 6 THEN 'BOGUS' WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'ELECTRICAL'
         WHEN p_type IN ('STANDARD', 'LARGE') THEN 'MECHANICAL' WHEN p_type = 'ECONOMY' THEN 'RAW_MATERIAL'
         ELSE 'OTHER' END AS category,
    CASE WHEN k % 20 = 0 THEN 'EOL' WHEN k % 10 = 3 THEN 'NEW' ELSE 'ACTIVE' END AS lifecycle_status,
    CASE WHEN k % 53 = 9 THEN 'INVALID_UOM' WHEN k % 3 = 0 THEN 'EA' WHEN k % 3 = 1 THEN 'KG' ELSE 'M' END AS uom,
    'SPEC_' || lpad(CAST(k AS VARCHAR), 16, '0') AS spec_hash,
    CASE WHEN k % 2 = 0 THEN '' ELSE 'BOM_' || lpad(CAST(k % 1000 AS VARCHAR), 8, '0') END AS bom_compatibility,
    CASE WHEN k % 47 = 8 THEN '' ELSE lo_id END AS default_supplier_id,
    CASE WHEN k % 29 = 11 THEN lo_id || ',S99999999' WHEN lo = hi THEN lo_id
         ELSE lo_id || ',' || hi_id END AS qualified_supplier_ids,
    CAST(CAST(CASE WHEN k % 31 = 4 THEN -p_retailprice ELSE p_retailprice END AS DECIMAL(18,6)) AS DOUBLE) AS unit_cost,
    p_size AS moq,
    p_size % 40 AS lead_time_days_avg,
    p_size % 40 + 8 AS lead_time_days_p95,
    CASE k % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS quality_grade,
    CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN 'ROHS' ELSE 'REACH,ITAR' END AS compliance_flags,
    CASE WHEN k % 10 = 0 THEN CASE k % 4 WHEN 0 THEN 'CLASS_1' WHEN 1 THEN 'CLASS_3' WHEN 2 THEN 'CLASS_8'
         ELSE 'CLASS_9' END END AS hazard_class,
    '2023-' || lpad(CAST(k % 12 + 1 AS VARCHAR), 2, '0') || '-' || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0')
      AS last_price_change,
    'synthetic.v1' AS data_source,
    '2024-01-' || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0') || ' 00:00:00' AS moment,
    '1.0.0' AS schema_version
  FROM prt1
),
members AS (
  SELECT part_id, tenant_id, unnest(string_split(qualified_supplier_ids, ',')) AS member FROM prt
  WHERE qualified_supplier_ids IS NOT NULL
)"""

_PART_TAGS = """
broken AS (SELECT DISTINCT part_id FROM members WHERE member NOT IN (SELECT supplier_id FROM valid_sup)),
prt_tag AS (
  SELECT *, concat_ws(',',
    CASE WHEN part_id IS NULL THEN 'MISSING_PART_ID' END,
    CASE WHEN tenant_id IS NULL THEN 'MISSING_TENANT_ID' END,
    CASE WHEN part_number IS NULL THEN 'MISSING_PART_NUMBER' END,
    CASE WHEN category IS NULL THEN 'MISSING_CATEGORY' END,
    CASE WHEN default_supplier_id IS NULL OR default_supplier_id = '' THEN 'MISSING_DEFAULT_SUPPLIER'
         WHEN default_supplier_id NOT IN (SELECT supplier_id FROM valid_sup) THEN 'ORPHAN_DEFAULT_SUPPLIER' END,
    CASE WHEN part_id IN (SELECT part_id FROM broken) THEN 'ORPHAN_QUALIFIED_SUPPLIER' END,
    CASE WHEN unit_cost < 0 THEN 'NEGATIVE_UNIT_COST' END,
    CASE WHEN moq < 0 THEN 'NEGATIVE_MOQ' END,
    CASE WHEN lead_time_days_avg < 0 THEN 'NEGATIVE_LEAD_TIME' END,
    CASE WHEN category NOT IN ('ELECTRICAL', 'MECHANICAL', 'RAW_MATERIAL', 'OTHER') THEN 'INVALID_CATEGORY' END,
    CASE WHEN lifecycle_status NOT IN ('NEW', 'ACTIVE', 'NRND', 'EOL') THEN 'INVALID_LIFECYCLE_STATUS' END)
    AS violations
  FROM prt
)"""

_LANDED_SUPPLIERS = """
lsup AS (
  SELECT k, supplier_id, tenant_id AS supplier_code, 'S' || (k % 900000 + 100000) AS tenant_id,
    CASE WHEN k % 13 = 1 THEN 'abc' WHEN k % 13 = 2 THEN '' ELSE (k * 7 % 41 + 60) || '.5' END AS on_time_delivery_rate,
    CASE WHEN k % 13 = 1 THEN 'abc' WHEN k % 13 = 2 THEN '' ELSE ' ' || (k % 101) || ' ' END AS risk_score,
    CASE WHEN k % 7 = 3 THEN (k % 900) || '.9' WHEN k % 29 = 5 THEN '99999999999' WHEN k % 31 = 6 THEN '1e3'
         ELSE CAST(k % 900 AS VARCHAR) END AS defect_rate_ppm,
    CASE WHEN k % 13 = 1 THEN 'abc' WHEN k % 13 = 2 THEN '' ELSE '+' || (k % 9000) END AS capacity_units_per_week,
    CASE WHEN k % 17 = 2 THEN '-3.9' ELSE CAST(k % 60 AS VARCHAR) END AS lead_time_days_avg,
    CAST(k % 80 AS VARCHAR) AS lead_time_days_p95
  FROM sup
)"""

_LANDED_PARTS = """
lprt0 AS (
  SELECT k, part_id, 'S' || lpad(CAST(k % 100 AS VARCHAR), 8, '0') AS one,
         'S' || lpad(CAST(k % 70 AS VARCHAR), 8, '0') AS two, prt.* EXCLUDE (k, part_id)
  FROM prt
),
lprt AS (
  SELECT k, part_id, one, two,
    CASE WHEN k % 37 = 5 OR k % 37 = 6 THEN 0 ELSE 2 END AS items,
    CASE WHEN k % 13 = 1 THEN 'n/a' ELSE (k % 5000) || '.' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') END AS unit_cost,
    CASE WHEN k % 11 = 2 THEN '' ELSE CAST(k % 500 AS VARCHAR) END AS moq,
    (k % 40) || '.7' AS lead_time_days_avg,
    CAST(k % 50 AS VARCHAR) AS lead_time_days_p95
  FROM lprt0
)"""

_ACCOUNTS = """
base AS (SELECT s_suppkey AS account, s_name AS name, CAST(s_acctbal AS DOUBLE) AS balance FROM supplier),
batch AS (
  SELECT c_custkey AS account, c_name AS name, CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS DOUBLE) END AS balance
  FROM customer
),
order_batch AS (
  SELECT o_custkey AS account, o_orderpriority AS name, CAST(o_totalprice AS DOUBLE) AS balance FROM orders
)"""

_S = (_SUPPLIERS,)
_ST = (_SUPPLIERS, _SUPPLIER_TAGS)
_P = (_PARTS,)
_PT = (_SUPPLIERS, _SUPPLIER_TAGS, _PARTS, _PART_TAGS)


def _sql(blocks: tuple[str, ...], body: str) -> str:
    return "WITH " + ",".join(blocks) + "\n" + body


def _rate(part: str, whole: str) -> str:
    return f"round(coalesce({part} * 100.0 / nullif({whole}, 0), 0.0), 6)"


def _int(text: str) -> str:
    plain = r"'\s*[+-]?(\d+(\.\d*)?|\.\d+)\s*'"
    return (
        f"CASE WHEN regexp_full_match({text}, {plain}) "
        f"THEN TRY_CAST(trunc(TRY_CAST({text} AS DECIMAL(38,6))) AS INTEGER) END"
    )


def _counted(table: str, label: str, tests: dict[str, str]) -> str:
    """One row per label with the number of rows that meet the test."""
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS {label}, count(*) FILTER (WHERE {test}) AS rows FROM {table}"
        for name, test in tests.items()
    )


def _json_list(text: str) -> str:
    return f"CASE WHEN {text} <> '' THEN '[\"' || replace({text}, ',', '\",\"') || '\"]' END"


def _shares(table: str, column: str) -> str:
    return f"SELECT {column}, count(*) AS rows, count(*) / (SELECT count(*) FROM {table}) AS share FROM {table} GROUP BY 1"


def _against(table: str, column: str, expected: dict[str, float], tolerance: float) -> str:
    cases = " ".join(f"WHEN '{value}' THEN {share}" for value, share in expected.items())
    target = f"CAST(CASE {column} {cases} ELSE 0.0 END AS DOUBLE)"
    return (
        f"SELECT {column}, rows, round(share, 6) AS share, {target} AS expected, "
        f"abs(share - {target}) <= {tolerance} AS within FROM ({_shares(table, column)})"
    )


def _ranges(table: str, bounds: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"column\", CAST(min({name}) AS DOUBLE) AS smallest, "
        f"CAST(max({name}) AS DOUBLE) AS largest, count(*) FILTER (WHERE {outside}) AS outside, "
        f"count(*) FILTER (WHERE {outside}) = 0 AS in_range FROM {table}"
        for name, outside in bounds.items()
    )


def _spec(column: str, expected: dict[str, float]) -> str:
    return ", ".join(f"('{column}', '{value}', CAST({share} AS DOUBLE), true)" for value, share in expected.items())


def _fields(entity: str, table: str, names: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{entity}' AS entity, '{name}' AS field, true AS present, count({column}) AS filled FROM {table}"
        for name, column in names.items()
    )


ORACLE: dict[str, str] = {}

# ---------------------------------------------------------------- tagging and rates

_METRICS = "count(*) AS total, count(*) FILTER (WHERE violations = '') AS valid, " + _rate(
    "count(*) FILTER (WHERE violations = '')", "count(*)"
)

ORACLE["supplier_tagged"] = _sql(
    _ST, "SELECT supplier_id, tenant_id, violations, violations = '' AS is_valid FROM sup_tag"
)
ORACLE["supplier_violation_counts"] = _sql(
    _ST,
    "SELECT violation, count(*) AS rows FROM (SELECT unnest(string_split(violations, ',')) AS violation FROM sup_tag "
    "WHERE violations <> '') GROUP BY 1",
)
ORACLE["supplier_violation_profile"] = _sql(_ST, "SELECT violations, count(*) AS rows FROM sup_tag GROUP BY 1")
ORACLE["supplier_metrics"] = _sql(_ST, f"SELECT {_METRICS} AS pass_rate FROM sup_tag")
ORACLE["part_tagged"] = _sql(_PT, "SELECT part_id, tenant_id, violations, violations = '' AS is_valid FROM prt_tag")
ORACLE["part_violation_counts"] = _sql(
    _PT,
    "SELECT violation, count(*) AS rows FROM (SELECT unnest(string_split(violations, ',')) AS violation FROM prt_tag "
    "WHERE violations <> '') GROUP BY 1",
)
ORACLE["part_violation_profile"] = _sql(_PT, "SELECT violations, count(*) AS rows FROM prt_tag GROUP BY 1")
ORACLE["part_metrics"] = _sql(_PT, f"SELECT {_METRICS} AS pass_rate FROM prt_tag")
ORACLE["overall_pass_rate"] = _sql(
    _PT,
    f"SELECT {_METRICS} AS pass_rate FROM (SELECT violations FROM sup_tag UNION ALL SELECT violations FROM prt_tag)",
)
ORACLE["tenant_metrics"] = _sql(_ST, f"SELECT tenant_id, {_METRICS} AS pass_rate FROM sup_tag GROUP BY 1")
ORACLE["tenant_part_violations"] = _sql(
    _PT,
    "SELECT tenant_id, violation, count(*) AS rows FROM (SELECT tenant_id, unnest(string_split(violations, ',')) "
    "AS violation FROM prt_tag WHERE violations <> '') GROUP BY 1, 2",
)
ORACLE["quality_gate"] = _sql(
    _PT,
    f"SELECT *, pass_rate >= 45 AS passed FROM (SELECT tenant_id, {_METRICS} AS pass_rate FROM prt_tag GROUP BY 1)",
)
ORACLE["domain_rules"] = _sql(
    _P,
    """SELECT concat_ws(',',
      CASE WHEN category NOT IN ('ELECTRICAL', 'MECHANICAL', 'RAW_MATERIAL', 'OTHER') THEN 'INVALID_CATEGORY' END,
      CASE WHEN lifecycle_status NOT IN ('NEW', 'ACTIVE', 'NRND', 'EOL') THEN 'INVALID_LIFECYCLE_STATUS' END,
      CASE WHEN uom NOT IN ('EA', 'KG', 'M') THEN 'INVALID_UOM' END,
      CASE WHEN quality_grade NOT IN ('A', 'B', 'C') THEN 'INVALID_QUALITY_GRADE' END) AS violations,
      count(*) AS rows FROM prt GROUP BY 1""",
)
ORACLE["freshness_rule"] = _sql(
    _ST,
    """SELECT supplier_id, concat_ws(',', nullif(violations, ''),
      CASE WHEN moment > '2024-01-20 00:00:00' THEN 'FUTURE_SOURCE_TIMESTAMP' END) AS violations FROM sup_tag""",
)

# ---------------------------------------------------------------- references

_ORPHAN_DEFAULT = (
    "default_supplier_id <> '' AND default_supplier_id NOT IN (SELECT supplier_id FROM valid_sup)"
)
ORACLE["orphan_defaults"] = _sql(_PT, f"SELECT part_id, default_supplier_id FROM prt WHERE {_ORPHAN_DEFAULT}")
ORACLE["orphan_list_members"] = _sql(
    _PT, "SELECT part_id, member FROM members WHERE member NOT IN (SELECT supplier_id FROM valid_sup)"
)
ORACLE["orphan_counts"] = _sql(
    _PT,
    f"SELECT 'default' AS reference, count(*) AS rows FROM prt WHERE {_ORPHAN_DEFAULT} UNION ALL "
    "SELECT 'qualified', count(*) FROM members WHERE member NOT IN (SELECT supplier_id FROM valid_sup)",
)
ORACLE["parts_with_valid_default"] = _sql(
    _PT,
    "SELECT part_id, default_supplier_id FROM prt WHERE default_supplier_id IN (SELECT supplier_id FROM valid_sup)",
)
ORACLE["default_in_list"] = _sql(
    _P,
    "SELECT part_id, list_contains(string_split(qualified_supplier_ids, ','), default_supplier_id) "
    "AS default_in_list FROM prt",
)
ORACLE["declared_foreign_key"] = _sql(
    (*_S, *_P),
    "SELECT tenant_id, count(*) AS accepted FROM prt WHERE default_supplier_id IS NULL "
    "OR default_supplier_id IN (SELECT supplier_id FROM sup) GROUP BY 1",
)
ORACLE["lineitem_references"] = _sql(
    _ST,
    "SELECT l_linenumber, count(*) AS rows FROM lineitem WHERE 'S' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') IN "
    "(SELECT supplier_id FROM valid_sup) GROUP BY 1",
)

ORACLE["lineitem_references_answered"] = _sql(
    _ST,
    "SELECT l_linenumber, count(*) FILTER (WHERE 'S' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') IN "
    "(SELECT supplier_id FROM valid_sup)) AS rows FROM lineitem GROUP BY 1",
)
ORACLE["landing_uploads"] = """
SELECT 'tenant_a' AS landing_tenant, 'suppliers' AS landing_entity, '2024-01-31' AS landing_date,
  '20240131_060000' AS landing_run_id, count(*) AS rows FROM supplier
UNION ALL SELECT 'tenant b', 'parts', '2024-01-31', '20240131_060000', count(*) FROM part"""
ORACLE["compaction_report"] = _sql(
    _ST,
    """SELECT 't_tenant_1' AS tenant_key, 4 * count(*) AS rows, true AS fewer_files, CAST(0 AS BIGINT) AS left_to_do
    FROM sup_tag WHERE violations = '' AND tenant_id = 'tenant_1' HAVING count(*) > 0""",
)

# ---------------------------------------------------------------- curated and quarantined rows

ORACLE["curated_suppliers"] = _sql(
    _ST,
    """SELECT supplier_id, supplier_code, tenant_id, legal_name, dba_name, country, region, address_line1,
      address_line2, city, state, postal_code, contact_email, contact_phone, preferred_currency, incoterms,
      lead_time_days_avg, lead_time_days_p95, on_time_delivery_rate, defect_rate_ppm, capacity_units_per_week,
      risk_score, financial_risk_tier, certifications, compliance_flags, approved_status, contracts, terms_version,
      'synthetic.v1' AS data_source, moment AS source_timestamp, schema_version, true AS is_valid, geo_lat, geo_lon
    FROM sup_tag WHERE violations = ''""",
)
ORACLE["curated_parts"] = _sql(
    _PT,
    """SELECT part_id, tenant_id, part_number, description, category, lifecycle_status, uom, spec_hash,
      bom_compatibility, default_supplier_id, qualified_supplier_ids, unit_cost, moq, lead_time_days_avg,
      lead_time_days_p95, quality_grade, compliance_flags, hazard_class, last_price_change, data_source,
      moment AS source_timestamp, schema_version, true AS is_valid FROM prt_tag WHERE violations = ''""",
)
ORACLE["quarantine_suppliers"] = _sql(
    _ST, "SELECT supplier_id, legal_name, country, approved_status, violations FROM sup_tag WHERE violations <> ''"
)
ORACLE["quarantine_parts"] = _sql(
    _PT,
    "SELECT part_id, default_supplier_id, qualified_supplier_ids, category, violations FROM prt_tag "
    "WHERE violations <> ''",
)

# ---------------------------------------------------------------- cleaning

_LS = (_SUPPLIERS, _LANDED_SUPPLIERS)
_LP = (_PARTS, _LANDED_PARTS)

ORACLE["drop_metadata"] = _sql(
    _LS, 'SELECT supplier_id, supplier_code, tenant_id, CAST(33 AS INTEGER) AS "columns" FROM lsup'
)
ORACLE["repair_swap"] = _sql(
    _LS, "SELECT supplier_id, supplier_code AS tenant_id, tenant_id AS supplier_code FROM lsup"
)
ORACLE["repair_swap_untouched"] = _sql(_P, "SELECT part_id, tenant_id, part_number FROM prt")
ORACLE["swap_evidence"] = _sql(
    _LS,
    "SELECT round(count(*) FILTER (WHERE regexp_full_match(tenant_id, 'S[0-9]{6}')) / "
    "count(*) FILTER (WHERE tenant_id <> ''), 6) AS share FROM lsup",
)
ORACLE["cast_contract"] = _sql(
    _LS,
    f"""SELECT supplier_id, TRY_CAST(risk_score AS DOUBLE) AS risk_score,
      TRY_CAST(on_time_delivery_rate AS DOUBLE) AS on_time_delivery_rate,
      {_int("defect_rate_ppm")} AS defect_rate_ppm, {_int("capacity_units_per_week")} AS capacity_units_per_week,
      {_int("lead_time_days_avg")} AS lead_time_days_avg, {_int("lead_time_days_p95")} AS lead_time_days_p95
    FROM lsup""",
)
ORACLE["cast_contract_parts"] = _sql(
    _LP,
    f"""SELECT part_id, CAST(TRY_CAST(unit_cost AS DECIMAL(18,6)) AS DOUBLE) AS unit_cost, {_int("moq")} AS moq,
      {_int("lead_time_days_avg")} AS lead_time_days_avg, {_int("lead_time_days_p95")} AS lead_time_days_p95
    FROM lprt""",
)
ORACLE["repair_geo"] = _sql(_S, "SELECT supplier_id, geo_lat, geo_lon, true AS struct_present FROM sup")
ORACLE["text_to_list"] = _sql(
    _LP,
    "SELECT part_id, CAST(items AS BIGINT) AS items, CASE WHEN items = 0 THEN '' ELSE one || '|' || two END AS text "
    "FROM lprt",
)
ORACLE["geo_json"] = _sql(
    _S,
    """SELECT supplier_id, CASE WHEN geo_lat IS NULL THEN '{"lat":null,"lon":null}'
      ELSE '{"lat":' || geo_lat || ',"lon":' || geo_lon || '}' END AS geo_coords FROM sup""",
)
ORACLE["list_flatten"] = _sql(_S, "SELECT supplier_id, certifications, compliance_flags, contracts FROM sup")
ORACLE["pin_header"] = _sql(
    _P, "SELECT part_id, '' AS hazard_class, '' AS quality_grade, '' AS last_price_change, uom FROM prt"
)
ORACLE["apply_defaults"] = _sql(_S, "SELECT supplier_id, '1.0.0' AS schema_version, true AS stamped FROM sup")
ORACLE["normalised_address"] = _sql(
    _S,
    """SELECT supplier_id, (k % 500) || ' MILL LANE' AS address_line1,
      CASE WHEN k % 5 = 0 THEN 'UNIT ' || (k % 100) END AS address_line2, upper(city) AS city FROM sup""",
)
ORACLE["typed_view_suppliers"] = _sql(
    _S,
    """SELECT supplier_id, on_time_delivery_rate, CAST(CAST(risk_score AS DECIMAL(5,2)) AS DOUBLE) AS risk_score,
      len(string_split(certifications, ',')) AS certifications,
      CASE WHEN compliance_flags = '' THEN CAST(0 AS BIGINT) ELSE len(string_split(compliance_flags, ',')) END
        AS compliance_flags, moment AS source_timestamp FROM sup""",
)
ORACLE["typed_view_parts"] = _sql(
    _P,
    "SELECT part_id, unit_cost, CASE WHEN qualified_supplier_ids IS NOT NULL THEN "
    "len(string_split(qualified_supplier_ids, ',')) END AS qualified, last_price_change FROM prt",
)
ORACLE["sql_staging"] = _sql(
    _S,
    f"""SELECT supplier_id, tenant_id, supplier_code, {_json_list("certifications")} AS certifications,
      {_json_list("compliance_flags")} AS compliance_flags, {_json_list("contracts")} AS contracts,
      CASE WHEN geo_lat IS NULL THEN '{{"lat":null,"lon":null}}'
        ELSE '{{"lat":' || geo_lat || ',"lon":' || geo_lon || '}}' END AS geo_coords FROM sup""",
)
ORACLE["sql_staging_parts"] = _sql(
    _P,
    f"""SELECT part_id, tenant_id, CASE WHEN uom = 'INVALID_UOM' THEN 'INVALID' ELSE uom END AS uom, unit_cost,
      {_json_list("bom_compatibility")} AS bom_compatibility,
      {_json_list("qualified_supplier_ids")} AS qualified_supplier_ids,
      {_json_list("compliance_flags")} AS compliance_flags FROM prt""",
)

# ---------------------------------------------------------------- lookups and scores

ORACLE["region_currency"] = _sql(_S, "SELECT supplier_id, country, region, preferred_currency AS currency FROM sup")
ORACLE["risk_tiers"] = _sql(
    _S,
    """SELECT supplier_id, CASE WHEN risk_score >= 0 AND risk_score < 35 THEN 'LOW'
      WHEN risk_score >= 35 AND risk_score < 60 THEN 'MEDIUM' ELSE 'HIGH' END AS tier,
      financial_risk_tier AS fast_tier FROM sup""",
)
ORACLE["tier_agrees"] = _sql(
    _S, "SELECT count(*) AS rows, count(*) FILTER (WHERE risk_score < 0) AS disagreeing FROM sup"
)
ORACLE["base_risks"] = _sql(
    _S,
    """SELECT supplier_id, round(least(100.0, greatest(0.0, 100.0 - on_time_delivery_rate)), 2) AS risk,
      round(least(100.0, greatest(0.0, greatest(0.0, 100.0 - on_time_delivery_rate) + lead_time_days_avg - 30.0)), 2)
        AS noisy_risk FROM sup""",
)

# ---------------------------------------------------------------- distributions

ORACLE["country_share"] = _sql(
    _S, f"SELECT country, rows, round(share, 6) AS share FROM ({_shares('sup', 'country')})"
)
ORACLE["top_countries"] = _sql(
    _S, "SELECT country, count(*) AS rows FROM sup GROUP BY 1 ORDER BY rows DESC, country LIMIT 3"
)
ORACLE["category_share"] = _sql(
    _P,
    _against("prt", "category", {"ELECTRICAL": 0.35, "MECHANICAL": 0.35, "RAW_MATERIAL": 0.20, "OTHER": 0.10}, 0.05),
)
ORACLE["lifecycle_share"] = _sql(
    _P, _against("prt", "lifecycle_status", {"ACTIVE": 0.75, "NEW": 0.10, "NRND": 0.10, "EOL": 0.05}, 0.05)
)
ORACLE["lead_by_category"] = _sql(
    _P, "SELECT category, round(avg(lead_time_days_avg), 6) AS average FROM prt GROUP BY 1"
)
ORACLE["rate_risk_correlation"] = _sql(
    _S, "SELECT round(corr(on_time_delivery_rate, risk_score), 6) AS correlation FROM sup"
)
_ITEMS = "SELECT CASE WHEN qualified_supplier_ids IS NOT NULL THEN len(string_split(qualified_supplier_ids, ',')) END AS items FROM prt"
ORACLE["list_size_share"] = _sql(
    (*_P, f" sized AS ({_ITEMS})"),
    f"SELECT items, rows, round(share, 6) AS share FROM ({_shares('sized', 'items')})",
)
ORACLE["list_size_bounds"] = _sql(_P, f"SELECT min(items) AS smallest, max(items) AS largest FROM ({_ITEMS})")
ORACLE["duplicate_surplus"] = _sql(
    _P,
    "\nUNION ALL ".join(
        f"SELECT '{key}' AS key, count({key}) AS rows, count(DISTINCT {key}) AS distinct_values, "
        f"count({key}) - count(DISTINCT {key}) AS surplus FROM prt"
        for key in ("part_id", "part_number", "default_supplier_id")
    ),
)
ORACLE["range_summary"] = _sql(
    _S,
    _ranges(
        "sup",
        {
            "lead_time_days_avg": "lead_time_days_avg < 0",
            "lead_time_days_p95": "lead_time_days_p95 < 0",
            "on_time_delivery_rate": "on_time_delivery_rate < 0 OR on_time_delivery_rate > 100",
            "defect_rate_ppm": "defect_rate_ppm < 0",
            "capacity_units_per_week": "capacity_units_per_week < 0",
            "risk_score": "risk_score < 0 OR risk_score > 100",
        },
    ),
)
ORACLE["range_summary_parts"] = _sql(
    _P,
    _ranges(
        "prt", {name: f"{name} < 0" for name in ("unit_cost", "moq", "lead_time_days_avg", "lead_time_days_p95")}
    ),
)
ORACLE["anomaly_counts"] = _sql(
    _S,
    _counted(
        "sup",
        "kind",
        {
            "out_of_range_rate": "on_time_delivery_rate > 100",
            "missing_contact": "contact_email IS NULL",
            "bogus_country": "country = 'XX'",
            "future_timestamp": "moment > '2024-01-20 00:00:00'",
        },
    ),
)
ORACLE["anomaly_counts_parts"] = _sql(
    _P,
    _counted(
        "prt",
        "kind",
        {
            "negative_cost": "unit_cost < 0",
            "wrong_uom": "uom NOT IN ('EA', 'KG', 'M')",
            "future_timestamp": "moment > '2024-01-20 00:00:00'",
        },
    ),
)

# ---------------------------------------------------------------- merging

_A = (_ACCOUNTS,)
ORACLE["upsert_update"] = _sql(
    _A,
    """SELECT base.account, base.name, CASE WHEN batch.account IS NOT NULL THEN batch.balance ELSE base.balance END
      AS balance FROM base LEFT JOIN batch ON base.account = batch.account
    UNION ALL SELECT account, name, balance FROM batch WHERE account NOT IN (SELECT account FROM base)""",
)
ORACLE["upsert_ignore"] = _sql(
    _A,
    """SELECT account, name, balance FROM base UNION ALL
    SELECT account, name, balance FROM (
      SELECT *, row_number() OVER (PARTITION BY account ORDER BY name, balance) AS place FROM order_batch)
    WHERE place = 1 AND account NOT IN (SELECT account FROM base)""",
)
ORACLE["sql_upsert"] = _sql(
    (_PARTS, _LANDED_PARTS),
    f"""SELECT prt.part_id, prt.category, TRY_CAST(lprt.unit_cost AS DOUBLE) AS unit_cost, {_int("lprt.moq")} AS moq,
      {_int("lprt.lead_time_days_avg")} AS lead_time_days_avg,
      CASE WHEN items = 2 THEN '["' || one || '","' || two || '"]' END AS qualified_supplier_ids
    FROM prt JOIN lprt USING (k)""",
)
ORACLE["concat_runs"] = _sql(
    _A,
    """SELECT account, name, balance, CAST(NULL AS VARCHAR) AS origin FROM base
    UNION ALL SELECT account, name, balance, 'customer' FROM batch
    UNION ALL SELECT account, NULL, balance, NULL FROM order_batch""",
)
ORACLE["dedupe_latest"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
  l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
  l_linestatus DESC) AS place FROM lineitem) WHERE place = 1"""
ORACLE["streamed_latest"] = ORACLE["dedupe_latest"]
ORACLE["duplicate_codes"] = _sql(
    _P,
    "SELECT part_id, tenant_id, part_number, count(*) OVER (PARTITION BY tenant_id, part_number) > 1 AS is_duplicate "
    "FROM prt",
)
ORACLE["repeated_keys"] = (
    "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"
)
ORACLE["fresh_rows"] = """
SELECT event_type, count(*) AS rows, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS newest
FROM events WHERE ts IS NULL OR ts <= TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1"""
ORACLE["incremental_rows"] = """
SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM lineitem WHERE l_shipdate > (SELECT max(o_orderdate) FROM orders)"""
ORACLE["incremental_stream"] = (
    "SELECT event_type, count(*) AS rows, count(DISTINCT event_id) AS events FROM events GROUP BY 1"
)

# ---------------------------------------------------------------- contract

# The mapped tables hold times as text under another name, and suppliers no region.
_MOMENTS = {"source_timestamp": "moment", "ingestion_timestamp": "moment"}
_SUPPLIER_FIELDS = {name: name for name in C.columns(C.SUPPLIERS)} | _MOMENTS
_PART_FIELDS = {name: name for name in C.columns(C.PARTS)} | _MOMENTS

ORACLE["contract_fields"] = _sql(
    (*_S, *_P), _fields("suppliers", "sup", _SUPPLIER_FIELDS) + "\nUNION ALL " + _fields("parts", "prt", _PART_FIELDS)
)
_FILLED = " + ".join(f"count({column})" for name, column in _SUPPLIER_FIELDS.items() if name not in ("region", "geo_coords"))
ORACLE["contract_coverage"] = _sql(
    _S,
    "SELECT CAST(33 AS BIGINT) AS fields, CAST(31 AS BIGINT) AS present, 'geo_coords,region' AS missing, "
    "'_ab_source_file_last_modified,_ab_source_file_url,_airbyte_extracted_at,_airbyte_generation_id,_airbyte_meta,"
    f"_airbyte_raw_id' AS unknown, {_FILLED} AS filled FROM sup",
)
_TYPED = {
    "on_time_delivery_rate": ("double", "TRY_CAST({0} AS DOUBLE)"),
    "risk_score": ("double", "TRY_CAST({0} AS DOUBLE)"),
    "lead_time_days_avg": ("int", None),
    "lead_time_days_p95": ("int", None),
    "defect_rate_ppm": ("int", None),
}
ORACLE["contract_types"] = _sql(
    _LS,
    "\nUNION ALL ".join(
        [
            f"SELECT '{name}' AS field, 'string' AS actual_type, false AS accepted, count({name}) AS filled, "
            f"'landed' AS state FROM lsup"
            for name in _TYPED
        ]
        + [
            f"SELECT '{name}', '{kind}', true, count({cast.format(name) if cast else _int(name)}), 'cleaned' FROM lsup"
            for name, (kind, cast) in _TYPED.items()
        ]
    ),
)
_DRIFTED = ("bom_compatibility", "qualified_supplier_ids", "unit_cost", "moq", "lead_time_days_avg",
            "lead_time_days_p95", "compliance_flags", "last_price_change", "source_timestamp",
            "ingestion_timestamp")
_CONNECTOR = ("_airbyte_raw_id", "_airbyte_extracted_at", "_airbyte_meta", "_airbyte_generation_id",
              "_ab_source_file_url", "_ab_source_file_last_modified")
ORACLE["drift_report"] = _sql(
    _P,
    "SELECT 'hazard_class' AS field, 'missing' AS departure, '' AS actual_type, CAST(0 AS BIGINT) AS filled UNION ALL "
    # Landed values replace those of the mapping in every row but are never NULL.
    + "\nUNION ALL ".join(
        f"SELECT '{name}', 'type', 'string', count({'bom_compatibility' if name == 'bom_compatibility' else 'part_id'}) "
        f"FROM prt"
        for name in _DRIFTED
    )
    + "\nUNION ALL "
    + "\nUNION ALL ".join(f"SELECT '{name}', 'unknown', 'string', count(part_id) FROM prt" for name in _CONNECTOR),
)
_BREACHES = {
    "data_source holds coordinates": "data_source LIKE '%{%' AND data_source LIKE '%lat%'",
    "geo_coords incomplete": "geo_lat IS NULL OR geo_lon IS NULL",
    "risk_score out of range": "risk_score < 0 OR risk_score > 100",
    "on_time_delivery_rate out of range": "on_time_delivery_rate < 0 OR on_time_delivery_rate > 100",
}
ORACLE["contract_violations"] = _sql(_S, _counted("sup", '"check"', _BREACHES))
ORACLE["contract_violations_landed"] = _sql(
    _S,
    _counted("sup", '"check"', {name: test for name, test in _BREACHES.items() if name != "geo_coords incomplete"})
    + "\nUNION ALL SELECT 'geo_coords is no struct', CAST(1 AS BIGINT)",
)
ORACLE["contract_verdict"] = _sql(
    _PT,
    "SELECT 'suppliers' AS entity, count(*) FILTER (WHERE geo_lat IS NULL) = 0 AS compliant, "
    "CAST(CASE WHEN count(*) FILTER (WHERE geo_lat IS NULL) > 0 THEN 1 ELSE 0 END AS BIGINT) AS failed_checks "
    "FROM sup_tag WHERE violations = '' UNION ALL SELECT 'parts', true, CAST(0 AS BIGINT)",
)
_SUPPLIER_LENGTHS = {
    "supplier_id": 26, "tenant_id": 50, "supplier_code": 50, "legal_name": 255, "dba_name": 255, "country": 2,
    "region": 50, "address_line1": 255, "address_line2": 255, "city": 100, "state": 50, "postal_code": 20,
    "contact_email": 255, "contact_phone": 50, "preferred_currency": 3, "incoterms": 10, "financial_risk_tier": 10,
    "approved_status": 20, "terms_version": 20, "data_source": 100, "schema_version": 10,
}
_PART_LENGTHS = {
    "part_id": 26, "tenant_id": 50, "part_number": 100, "category": 50, "lifecycle_status": 20, "uom": 10,
    "spec_hash": 64, "default_supplier_id": 26, "quality_grade": 1, "hazard_class": 50, "data_source": 100,
    "schema_version": 10,
}


def _constraints(table: str, required: tuple[str, ...], lengths: dict[str, int], wide: dict[str, str], key: str) -> str:
    tests = {f"{name} is NULL": f"{name} IS NULL" for name in required}
    tests |= {f"{name} longer than {size}": f"length({name}) > {size}" for name, size in lengths.items()}
    tests |= wide
    repeated = f"SELECT '{key} repeated', count({key}) - count(DISTINCT {key}) FROM {table}"
    return _counted(table, '"constraint"', tests) + "\nUNION ALL " + repeated


ORACLE["constraint_report"] = _sql(
    _S,
    _constraints(
        "sup",
        ("supplier_id", "tenant_id", "legal_name"),
        _SUPPLIER_LENGTHS,
        {
            "on_time_delivery_rate wider than 5,2": "abs(round(on_time_delivery_rate, 2)) >= 1000",
            "risk_score wider than 5,2": "abs(round(risk_score, 2)) >= 1000",
        },
        "supplier_id",
    ),
)
ORACLE["constraint_report_parts"] = _sql(
    _P,
    _constraints(
        "prt",
        ("part_id", "tenant_id", "part_number"),
        _PART_LENGTHS,
        {"unit_cost wider than 18,6": "abs(round(unit_cost, 6)) >= 1000000000000"},
        "part_id",
    ),
)
ORACLE["id_shape"] = _sql(
    _S,
    "SELECT 'mapped' AS origin, count(*) AS rows, count(*) FILTER (WHERE regexp_full_match(supplier_id, "
    "'[0-9A-HJKMNP-TV-Z]{26}')) AS well_formed FROM sup UNION ALL "
    "SELECT 'synthesised', count(*), count(*) FROM supplier",
)
ORACLE["timestamp_shape"] = _sql(
    _P,
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"column\", count({column}) AS filled, count(TRY_CAST({column} AS TIMESTAMP)) AS readable "
        f"FROM prt"
        for name, column in {
            "source_timestamp": "moment",
            "ingestion_timestamp": "moment",
            "last_price_change": "last_price_change",
            "part_number": "part_number",
        }.items()
    ),
)
ORACLE["list_domain"] = _sql(
    _S, "SELECT supplier_id, 'ISO9999' AS unknown_items FROM sup WHERE certifications LIKE '%ISO9999%'"
)

# ---------------------------------------------------------------- files and tables

ORACLE["roundtrip_csv"] = _sql(
    _S,
    """SELECT supplier_id, coalesce(legal_name, '') AS legal_name, address_line1, certifications,
      CAST(lead_time_days_avg AS VARCHAR) AS lead_time_days_avg,
      CASE WHEN geo_lat IS NULL THEN '{"lat":null,"lon":null}'
        ELSE '{"lat":' || geo_lat || ',"lon":' || geo_lon || '}' END AS geo_coords FROM sup""",
)
ORACLE["roundtrip_csv_parts"] = _sql(
    _P,
    """SELECT part_id, '' AS spec_hash, coalesce(hazard_class, '') AS hazard_class,
      coalesce(qualified_supplier_ids, '') AS qualified_supplier_ids, bom_compatibility,
      CAST(moq AS VARCHAR) AS moq FROM prt""",
)
ORACLE["roundtrip_csv_chunked"] = (
    "SELECT o_orderstatus, o_orderpriority, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys "
    "FROM orders GROUP BY 1, 2"
)
ORACLE["roundtrip_parquet"] = _sql(_S, "SELECT supplier_id, certifications, contracts, geo_lat, geo_lon FROM sup")
ORACLE["landing_lineage"] = _sql(
    _S,
    """SELECT 'tenant_a' AS landing_tenant, 'suppliers' AS landing_entity, '2024-01-31' AS landing_date,
      '20240131_060000' AS landing_run_id, count(*) AS rows FROM sup
    UNION ALL SELECT 'tenant_a', 'suppliers', '2024-01-31', '20240131_180000', count(*) FROM sup
    UNION ALL SELECT 'tenant_a', 'parts', '2024-01-31', '20240131_060000', count(*) FROM part""",
)
ORACLE["all_tenants"] = _sql(
    _ST,
    f"""SELECT 'tenant_a' AS landing_tenant, {_METRICS} AS pass_rate FROM sup_tag
    UNION ALL SELECT 'tenant_b', {_METRICS} FROM sup_tag""",
)
ORACLE["streamed_curation"] = _sql(
    (_SUPPLIERS, _PARTS, _LANDED_PARTS),
    """SELECT concat_ws(',',
      CASE WHEN default_supplier_id IS NULL OR default_supplier_id = '' THEN 'MISSING_DEFAULT_SUPPLIER'
           WHEN default_supplier_id NOT IN (SELECT supplier_id FROM sup) THEN 'ORPHAN_DEFAULT_SUPPLIER' END,
      CASE WHEN items = 2 AND (one NOT IN (SELECT supplier_id FROM sup) OR two NOT IN (SELECT supplier_id FROM sup))
           THEN 'ORPHAN_QUALIFIED_SUPPLIER' END,
      CASE WHEN category = 'BOGUS' THEN 'INVALID_CATEGORY' END) AS violations, count(*) AS rows
    FROM prt JOIN lprt USING (k) GROUP BY 1""",
)
ORACLE["missing_source"] = _sql(
    _ST,
    f"""SELECT *, pass_rate >= 99 AS passed FROM (
      SELECT 'suppliers' AS entity, {_METRICS} AS pass_rate FROM sup_tag
      UNION ALL SELECT 'overall', {_METRICS} FROM sup_tag)""",
)
ORACLE["overwrite_partition"] = _sql(
    _PT,
    "SELECT tenant_id, count(*) AS rows, count(*) FILTER (WHERE violations = '') AS valid FROM prt_tag GROUP BY 1",
)
ORACLE["append_twice"] = _sql(
    _ST, "SELECT tenant_id, 2 * count(*) AS rows, true AS geo_is_struct FROM sup_tag WHERE violations = '' GROUP BY 1"
)
ORACLE["reload_twice"] = _sql(
    _ST, "SELECT supplier_id, tenant_id, risk_score, geo_lat AS lat FROM sup_tag WHERE violations = ''"
)
ORACLE["compacted_table"] = _sql(
    _ST, "SELECT supplier_id, 2 * count(*) AS rows FROM sup_tag WHERE violations = '' GROUP BY 1"
)
ORACLE["upsert_curated"] = _sql(
    (*_ST, _LANDED_SUPPLIERS),
    f"""SELECT supplier_id, tenant_id, CASE WHEN fresh THEN new_score ELSE risk_score END AS risk_score,
      CASE WHEN fresh THEN new_rate ELSE on_time_delivery_rate END AS on_time_delivery_rate,
      CASE WHEN fresh THEN new_defects ELSE defect_rate_ppm END AS defect_rate_ppm,
      CASE WHEN violations = '' THEN lead_time_days_avg ELSE new_lead END AS lead_time_days_avg
    FROM (
      SELECT *, legal_name IS NOT NULL AND country <> 'XX' AND approved_status <> 'UNKNOWN'
        AND coalesce(new_rate <= 100, true) AND coalesce(new_score <= 100, true) AND coalesce(new_lead >= 0, true)
        AS fresh
      FROM (
        SELECT sup_tag.*, TRY_CAST(lsup.risk_score AS DOUBLE) AS new_score,
          TRY_CAST(lsup.on_time_delivery_rate AS DOUBLE) AS new_rate, {_int("lsup.defect_rate_ppm")} AS new_defects,
          {_int("lsup.lead_time_days_avg")} AS new_lead
        FROM sup_tag JOIN lsup USING (k)))
    WHERE violations = '' OR fresh""",
)
_JOB = (
    _SUPPLIERS,
    _LANDED_SUPPLIERS,
    f"""
job_sup0 AS (
  SELECT lsup.supplier_id, sup.legal_name, sup.country, sup.financial_risk_tier, sup.approved_status,
    TRY_CAST(lsup.on_time_delivery_rate AS DOUBLE) AS rate, TRY_CAST(lsup.risk_score AS DOUBLE) AS score,
    {_int("lsup.lead_time_days_avg")} AS lead
  FROM lsup JOIN sup USING (k)
),
job_sup AS (
  SELECT supplier_id, coalesce(legal_name IS NOT NULL AND country <> 'XX' AND approved_status <> 'UNKNOWN'
    AND NOT coalesce(rate > 100, false) AND NOT coalesce(score > 100, false) AND NOT coalesce(lead < 0, false), false)
    AS is_valid
  FROM job_sup0
)""",
    _PARTS,
    _LANDED_PARTS,
    f"""
job_prt AS (
  SELECT prt.part_id,
    coalesce(default_supplier_id <> '' AND default_supplier_id IN (SELECT supplier_id FROM job_sup WHERE is_valid)
      AND (lprt.items = 0 OR (lprt.one IN (SELECT supplier_id FROM job_sup WHERE is_valid)
           AND lprt.two IN (SELECT supplier_id FROM job_sup WHERE is_valid)))
      AND category <> 'BOGUS', false) AS is_valid
  FROM prt JOIN lprt USING (k)
),
job_rows AS (
  SELECT 'suppliers' AS entity, is_valid FROM job_sup UNION ALL SELECT 'suppliers', is_valid FROM job_sup
  UNION ALL SELECT 'parts', is_valid FROM job_prt
),
job_report AS (
  SELECT entity, count(*) AS total, count(*) FILTER (WHERE is_valid) AS valid FROM job_rows GROUP BY 1
  UNION ALL SELECT 'overall', count(*), count(*) FILTER (WHERE is_valid) FROM job_rows
)""",
)
ORACLE["curation_job"] = _sql(
    _JOB,
    f"""SELECT entity, total, valid, {_rate("valid", "total")} AS pass_rate,
      {_rate("valid", "total")} >= 99 AS passed, true AS geo_is_struct FROM job_report""",
)

# ---------------------------------------------------------------- synthesis: what the specification promises

_COUNTRIES = {"CN": 0.22, "US": 0.18, "DE": 0.1, "MX": 0.1, "IN": 0.1, "VN": 0.08, "PL": 0.06, "JP": 0.08, "KR": 0.08}
_MADE_SUPPLIERS = ", ".join(
    [
        _spec("country", _COUNTRIES),
        _spec("approved_status", {"APPROVED": 0.80, "PENDING": 0.15, "SUSPENDED": 0.04, "BLACKLISTED": 0.01}),
        _spec("incoterms", {"DDP": 0.4, "FOB": 0.3, "CIF": 0.2, "EXW": 0.1}),
        _spec("certification_count", {"1": 0.6, "2": 0.3, "3": 0.1}),
        _spec("flag_count", {"0": 0.4, "1": 0.5, "2": 0.1}),
    ]
)
_MADE_PARTS = ", ".join(
    [
        _spec("category", {"ELECTRICAL": 0.35, "MECHANICAL": 0.35, "RAW_MATERIAL": 0.20, "OTHER": 0.10}),
        _spec("lifecycle_status", {"ACTIVE": 0.75, "NEW": 0.10, "NRND": 0.10, "EOL": 0.05}),
        _spec("uom", {"EA": 0.7, "KG": 0.2, "M": 0.1}),
        _spec("quality_grade", {"A": 0.6, "B": 0.3, "C": 0.1}),
        _spec("list_size", {"1": 0.6, "2": 0.3, "3": 0.1}),
        _spec("hazardous", {"true": 0.1, "false": 0.9}),
    ]
)
ORACLE["synth_suppliers_profile"] = f'SELECT * FROM (VALUES {_MADE_SUPPLIERS}) AS t("column", value, expected, within)'
ORACLE["synth_parts_profile"] = f'SELECT * FROM (VALUES {_MADE_PARTS}) AS t("column", value, expected, within)'
ORACLE["synth_suppliers_ranges"] = """
SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS ids, true AS rate_in_range, true AS risk_in_range,
  true AS lead_in_range, true AS p95_in_range, true AS capacity_in_range, true AS tiers_agree,
  true AS contracts_in_range, true AS past_only, true AS lead_mean_holds, true AS risk_follows_rate FROM orders"""
ORACLE["synth_parts_references"] = """
SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS ids, CAST(0 AS BIGINT) AS orphan_defaults,
  CAST(0 AS BIGINT) AS orphan_lists, CAST(0 AS BIGINT) AS repeating_lists, CAST(0 AS BIGINT) AS default_not_first,
  true AS cost_positive, true AS electrical_slower FROM orders"""
ORACLE["injected_profile"] = (
    "SELECT count(*) AS rows, CAST(floor(count(*) * 0.06) AS BIGINT) AS damaged, CAST(1 AS BIGINT) AS most_per_row FROM orders"
)
ORACLE["injected_parts_profile"] = ORACLE["injected_profile"]
ORACLE["injected_parts_kinds"] = "\nUNION ALL ".join(
    f"""SELECT '{kind}' AS kind, count(*) AS rows, CAST(floor(count(*) * {rate}) AS BIGINT) AS damaged,
      CAST(floor(count(*) * {rate}) AS BIGINT) AS marks, CAST(1 AS BIGINT) AS most_per_row FROM orders"""
    for kind, rate in [*[(kind, 0.01) for kind in KINDS[C.PARTS]], ("all", 0.06)]
)
ORACLE["sampled_rows"] = (
    "SELECT CAST(floor(count(*) * 0.06) AS BIGINT) AS rows, CAST(floor(count(*) * 0.06) AS BIGINT) AS orders FROM orders"
)
ORACLE["dataset_job"] = """
SELECT 'suppliers' AS entity, count(*) AS total, true AS as_predicted FROM customer
UNION ALL SELECT 'parts', count(*), true FROM part
UNION ALL SELECT 'overall', (SELECT count(*) FROM customer) + (SELECT count(*) FROM part), true"""

# ---------------------------------------------------------------- reloads, runs and tenants

_KEPT = "count(*) FILTER (WHERE violations = '') AS kept"
_REFUSED = "count(*) FILTER (WHERE violations <> '') AS refused"
ORACLE["reload_second_date"] = _sql(
    _ST,
    f"""SELECT d AS landing_date, {_KEPT}, {_REFUSED}
    FROM sup_tag, (VALUES ('2024-01-30'), ('2024-01-31')) AS dates(d) GROUP BY 1""",
)
ORACLE["reload_to_empty"] = _sql(
    _ST,
    f"""SELECT '2024-01-30' AS landing_date, {_KEPT}, {_REFUSED} FROM sup_tag
    UNION ALL SELECT '2024-01-31', 0, count(*) FROM sup_tag""",
)
ORACLE["quarantine_two_tenants"] = _sql(
    _ST,
    """SELECT t AS tenant_id, '20240131_060000' AS landing_run_id, count(*) AS rows
    FROM sup_tag, (VALUES ('tenant_a'), ('tenant_b')) AS tenants(t) WHERE violations <> '' GROUP BY 1""",
)
ORACLE["curated_lineage"] = _sql(
    _ST,
    """SELECT '2024-01-31' AS landing_date, r AS landing_run_id, count(*) AS rows
    FROM sup_tag, (VALUES ('20240131_060000'), ('20240131_180000')) AS runs(r) WHERE violations = '' GROUP BY ALL""",
)
ORACLE["all_tenants_job"] = _sql(
    _ST,
    f"""SELECT 'tenant_a' AS landing_tenant, 'suppliers' AS entity, {_METRICS} AS pass_rate,
      100.0 * count(*) FILTER (WHERE violations = '') >= 50 * count(*) AS passed FROM sup_tag
    UNION ALL SELECT 'tenant_b', 'suppliers', count(*), 0, 0.0, false FROM sup_tag""",
)
ORACLE["tenant_jobs"] = _sql(
    _ST,
    f"""SELECT *, (SELECT count(*) FROM sup_tag WHERE violations = '')
      + (SELECT count(*) FROM sup_tag WHERE violations = '' AND tenant_id <> 'tenant_1') AS stored FROM (
    SELECT 'tenant_a' AS tenant, 'suppliers' AS entity, {_METRICS} AS pass_rate,
      100.0 * count(*) FILTER (WHERE violations = '') >= 50 * count(*) AS passed, false AS failed FROM sup_tag
    UNION ALL SELECT 'tenant_b', NULL, NULL, NULL, NULL, NULL, true
    UNION ALL SELECT 'tenant_c', 'suppliers', {_METRICS},
      100.0 * count(*) FILTER (WHERE violations = '') >= 50 * count(*), false FROM sup_tag WHERE tenant_id <> 'tenant_1')""",
)
ORACLE["upsert_empty_tenant"] = _sql(
    _ST,
    """SELECT supplier_id, '' AS tenant_id, CASE WHEN supplier_id LIKE '%7' THEN 1.0 ELSE risk_score END AS risk_score
    FROM sup_tag WHERE violations = ''
    UNION ALL SELECT supplier_id || '-new', '', 1.0 FROM sup_tag WHERE violations = '' AND supplier_id LIKE '%7'""",
)
ORACLE["repair_swap_mixed_runs"] = _sql(
    _S,
    """SELECT '20240131_060000' AS landing_run_id, supplier_id, tenant_id, supplier_code FROM sup
    UNION ALL SELECT '20240131_180000', supplier_id, tenant_id, 'S' || (k % 900000 + 100000) FROM sup""",
)
ORACLE["landing_type_drift"] = _sql(
    _S,
    """SELECT r AS landing_run_id, count(*) AS rows, CAST(sum(defect_rate_ppm) AS BIGINT) AS ppm
    FROM sup, (VALUES ('20240131_060000'), ('20240131_180000')) AS runs(r) GROUP BY 1""",
)
_BIG = "CAST(substr(supplier_id, 2, 8) AS BIGINT) % 1000 * 1000000 + 12345678"
ORACLE["landing_int_double_drift"] = _sql(
    _S,
    f"""SELECT r AS landing_run_id, supplier_id, 'double,double' AS landed_as, CAST({_BIG} AS INTEGER) AS capacity_units_per_week,
      CASE WHEN r = '20240131_060000' THEN 7 ELSE CAST(substr(supplier_id, 2, 8) AS INTEGER) // 10000 END AS defect_rate_ppm,
      CASE WHEN r = '20240131_060000' THEN 70000 ELSE CAST(substr(supplier_id, 2, 8) AS BIGINT) END AS ten_thousandths
    FROM sup, (VALUES ('20240131_060000'), ('20240131_180000')) AS runs(r)""",
)
ORACLE["landing_text_double_drift"] = _sql(
    _S,
    f"""SELECT r AS landing_run_id, supplier_id, CAST(CASE WHEN r = '20240131_060000' THEN {_BIG}
      ELSE CAST(substr(supplier_id, 2, 8) AS BIGINT) END AS INTEGER) AS capacity_units_per_week
    FROM sup, (VALUES ('20240131_060000'), ('20240131_180000')) AS runs(r)""",
)
ORACLE["cast_contract_exponents"] = _sql(
    _LS,
    f"""SELECT supplier_id, CASE WHEN defect_rate_ppm = '1e3' THEN 1000 ELSE {_int("defect_rate_ppm")} END AS defect_rate_ppm,
      {_int("capacity_units_per_week")} AS capacity_units_per_week FROM lsup""",
)
ORACLE["landing_column_drift"] = _sql(
    _S,
    """SELECT '20240131_060000' AS landing_run_id, count(*) AS rows, 0 AS named, 'legal_name' AS field, 'missing' AS type
    FROM sup UNION ALL SELECT '20240131_180000', count(*), count(legal_name), 'legal_name', 'string' FROM sup""",
)
ORACLE["roundtrip_csv_newlines"] = _sql(
    _P,
    """SELECT part_id, 'say "' || description || '",' || chr(10) || 'line two' || chr(10) || part_id AS description, uom
    FROM prt""",
)
ORACLE["roundtrip_csv_split"] = _sql(_P, "SELECT part_id, description, uom FROM prt")
ORACLE["roundtrip_csv_reordered"] = _sql(
    _P, "SELECT part_id, tenant_id, description, uom, '' AS category FROM prt"
)
ORACLE["incremental_same_moment"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events
WHERE ts >= TIMESTAMP '2024-01-20' AND NOT (ts < TIMESTAMP '2024-01-21' AND event_id % 3 = 0)"""


def _chi_square(name: str, column: str, shares: dict[str, float]) -> str:
    """The tail as one less a series whose terms come from the logarithm of the gamma function."""
    listed = ", ".join(f"('{value}', {share})" for value, share in shares.items())
    degrees = len(shares) - 1
    return f"""SELECT '{name}' AS specification, rows, rows - seen AS unexpected, round(statistic, 6) AS statistic,
      CAST({degrees} AS INTEGER) AS degrees, CASE WHEN rows > seen THEN 0.0 ELSE round(greatest(0.0, 1 - (
        SELECT sum(exp(({degrees} / 2 + n) * ln(statistic / 2) - statistic / 2 - lgamma({degrees} / 2 + n + 1)))
        FROM range(1500) AS r(n))), 6) END AS p_value
    FROM (SELECT (SELECT count(*) FROM kept) AS rows, CAST(sum(n) AS BIGINT) AS seen,
            sum(pow(n - share * total, 2) / (share * total)) AS statistic
          FROM (SELECT share, (SELECT count(*) FROM kept WHERE {column} = value) AS n,
                  (SELECT count(*) FROM kept WHERE {column} IN (SELECT value FROM (VALUES {listed}) AS v(value, s))) AS total
                FROM (VALUES {listed}) AS shares(value, share)))"""


_SPECIFICATIONS = {
    "near": ("lifecycle_status", {"ACTIVE": 0.85, "NEW": 0.1, "EOL": 0.05}),
    "synthetic": ("category", {"ELECTRICAL": 0.35, "MECHANICAL": 0.35, "RAW_MATERIAL": 0.2, "OTHER": 0.1}),
    "two_of_three": ("lifecycle_status", {"ACTIVE": 0.9, "NEW": 0.1}),
}
ORACLE["distribution_shift"] = _sql(
    (*_P, "kept AS (SELECT * FROM prt WHERE category <> 'BOGUS')"),
    " UNION ALL ".join(_chi_square(name, *wanted) for name, wanted in _SPECIFICATIONS.items()),
)


def _two_samples(name: str, number: str, first: str) -> str:
    return f"""SELECT '{name}' AS "case", first_rows, second_rows, round(distance, 6) AS distance,
      round(least(1.0, greatest(0.0, (SELECT sum(CASE WHEN j % 2 = 1 THEN 2 ELSE -2 END * exp(-2 * j * j * reach * reach))
        FROM range(1, 101) AS r(j)))), 6) AS p_value
    FROM (SELECT *, (root + 0.12 + 0.11 / root) * distance AS reach
      FROM (SELECT *, sqrt(CAST(first_rows AS DOUBLE) * second_rows / (first_rows + second_rows)) AS root
        FROM (SELECT CAST(max(ones) AS BIGINT) AS first_rows, CAST(max(twos) AS BIGINT) AS second_rows,
            max(abs(ones / all_ones - twos / all_twos)) AS distance
          FROM (SELECT sum(one) OVER running AS ones, sum(two) OVER running AS twos,
                  CAST(sum(one) OVER () AS DOUBLE) AS all_ones, CAST(sum(two) OVER () AS DOUBLE) AS all_twos
                FROM (SELECT {number} AS value, count(*) FILTER (WHERE {first}) AS one,
                        count(*) FILTER (WHERE NOT ({first})) AS two FROM lineitem GROUP BY 1)
                WINDOW running AS (ORDER BY value)))))"""


ORACLE["run_shift"] = " UNION ALL ".join(
    _two_samples(*case)
    for case in (
        ("alike", "l_quantity", "l_suppkey % 2 = 0"),
        ("shifted", "l_extendedprice", "l_quantity > 25"),
        ("nearly", "l_extendedprice", "l_partkey % 3 = 0"),
    )
)
ORACLE["sketch_surplus"] = """
SELECT CAST(l_suppkey % 4 AS INTEGER) AS tenant, count(*) AS lines, count(*) - count(DISTINCT l_orderkey) AS surplus,
  true AS orders_within_error, true AS parts_within_error, true AS as_one_pass FROM lineitem GROUP BY 1"""
ORACLE["sketch_quantiles"] = """
SELECT count(*) AS lines, rank, true AS within_error
FROM lineitem, (VALUES (0.01::DOUBLE), (0.25), (0.5), (0.75), (0.99)) AS ranks(rank) GROUP BY rank"""
ORACLE["sketch_values"] = """
SELECT CAST(l_suppkey % 4 AS INTEGER) AS tenant, 'l_returnflag' AS "column", l_returnflag AS value, count(*) AS rows
FROM lineitem GROUP BY ALL
UNION ALL SELECT CAST(l_suppkey % 4 AS INTEGER), 'l_quantity', CAST(l_quantity AS VARCHAR), count(*) FROM lineitem GROUP BY ALL"""
ORACLE["incremental_null_cursor"] = """
SELECT event_id % 10 = 3 AS undated, count(*) AS rows FROM events
WHERE event_id % 10 = 3 OR ts > (SELECT max(ts) FROM events WHERE event_id % 10 <> 3 AND ts <= TIMESTAMP '2024-01-20 00:00:00')
GROUP BY 1"""
_FAULTY_SUPPLIERS = """
faulty AS (SELECT * REPLACE (
  CASE WHEN k % 9 <> 4 THEN supplier_id END AS supplier_id, CASE WHEN k % 8 <> 3 THEN tenant_id END AS tenant_id,
  CASE WHEN k % 7 = 2 THEN -1 ELSE defect_rate_ppm END AS defect_rate_ppm,
  CASE WHEN k % 6 = 5 THEN 'NONE' ELSE financial_risk_tier END AS financial_risk_tier) FROM sup)"""
_FAULTY_PARTS = """
faulty AS (SELECT * REPLACE (
  CASE WHEN k % 9 <> 4 THEN part_id END AS part_id, CASE WHEN k % 8 <> 3 THEN tenant_id END AS tenant_id,
  CASE WHEN k % 7 <> 2 THEN part_number END AS part_number, CASE WHEN k % 11 <> 5 THEN category END AS category,
  CASE WHEN k % 13 = 1 THEN -5 ELSE moq END AS moq,
  CASE WHEN k % 10 = 7 THEN -1 ELSE lead_time_days_avg END AS lead_time_days_avg,
  CASE WHEN k % 12 = 6 THEN 'OLD' ELSE lifecycle_status END AS lifecycle_status) FROM prt)"""
_COUNTED = """SELECT violation, count(*) AS rows
FROM (SELECT unnest(string_split(violations, ',')) AS violation FROM {table} WHERE violations <> '') GROUP BY 1"""
ORACLE["supplier_every_rule"] = _sql(
    (_SUPPLIERS, _FAULTY_SUPPLIERS, _SUPPLIER_TAGS.replace("FROM sup\n", "FROM faulty\n")), _COUNTED.format(table="sup_tag")
)
ORACLE["part_every_rule"] = _sql(
    (
        _SUPPLIERS, _SUPPLIER_TAGS, _PARTS, _FAULTY_PARTS,
        # lists are found by the key that the part has in the sound table
        _PART_TAGS.replace("FROM prt\n", "FROM faulty\n").replace(
            "WHEN part_id IN (SELECT", "WHEN 'P' || lpad(CAST(k AS VARCHAR), 8, '0') IN (SELECT"
        ),
    ),
    _COUNTED.format(table="prt_tag"),
)
ORACLE["part_strict_lists"] = _sql(
    _PT,
    f"""SELECT * FROM ({_COUNTED.format(table="prt_tag")}) WHERE violation <> 'ORPHAN_QUALIFIED_SUPPLIER'
    UNION ALL SELECT 'INVALID_QUALIFIED_SUPPLIER_FORMAT', count(*) FROM prt
    WHERE k % 3 <> 0 AND qualified_supplier_ids IS NOT NULL HAVING count(*) > 0""",
)
