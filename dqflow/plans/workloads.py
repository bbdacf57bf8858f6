"""Shared workloads over the driver tables: the ``contacts`` view and rule sets.

The driver tables hold no NULLs and no dirty text, so rule queries run over
``contacts``, a deterministic derivation of ``customer`` with missing,
empty and malformed values.  The SQL text below runs unchanged in Spark
(``{customer}`` bound to a DataFrame) and in DuckDB (``{customer}`` replaced
by the view name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dqflow.sources.reader import read_table

CONTACTS_SQL = """
SELECT c_custkey AS id,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 29 = 0 THEN 'B' ELSE c_name END AS name,
  CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN concat('bad-', CAST(c_custkey AS STRING)) ELSE concat('user', CAST(c_custkey AS STRING), '@example.com') END AS email,
  CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN '+1-555-123-4567' ELSE concat('+1415', lpad(CAST(c_custkey AS STRING), 7, '0')) END AS phone,
  CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 9 = 0 THEN 'n/a' WHEN c_custkey % 37 = 0 THEN '41.5' ELSE CAST(c_custkey % 200 - 20 AS STRING) END AS age_text,
  CASE WHEN c_custkey % 19 = 0 THEN '15/01/2024' ELSE concat('2024-', lpad(CAST(c_custkey % 12 + 1 AS STRING), 2, '0'), '-', lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0')) END AS reg_date,
  CASE WHEN c_custkey % 6 = 0 THEN '2024-01-15 10:00:00' ELSE '2024-01-15T10:00:00Z' END AS reg_ts,
  CASE WHEN c_custkey % 8 = 0 THEN concat('550E8400-E29B-41D4-A716-', lpad(CAST(c_custkey AS STRING), 12, '0')) ELSE concat('550e8400-e29b-41d4-a716-', lpad(CAST(c_custkey AS STRING), 12, '0')) END AS ref_uuid,
  CASE WHEN c_custkey % 10 = 0 THEN 'ftp://example.com' WHEN c_custkey % 14 = 0 THEN NULL ELSE concat('https://c', CAST(c_custkey AS STRING), '.example.com/') END AS website,
  CASE WHEN c_custkey % 4 = 0 THEN 'SW1A1AA' WHEN c_custkey % 3 = 0 THEN '10002-1234' ELSE '94105' END AS zip,
  CASE WHEN c_custkey % 21 = 0 THEN 'GOLD' WHEN c_custkey % 2 = 0 THEN 'ACTIVE' ELSE 'PENDING' END AS status,
  CASE WHEN c_custkey % 15 = 0 THEN repeat('x', 60) WHEN c_custkey % 16 = 0 THEN NULL ELSE 'vip note' END AS notes,
  c_acctbal AS balance, c_nationkey AS nation, c_mktsegment AS segment
FROM {customer}
"""


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CONTACTS_SQL, customer=read_table(spark, sf_dir, "customer"))


def contacts_duckdb_cte() -> str:
    return "contacts AS (" + CONTACTS_SQL.replace("{customer}", "customer") + ")"


# One rule per registered row rule, each on the contacts column it is meant for.
# (rule entry, field); params follow the documented spellings.
SINGLE_RULES: dict[str, tuple[str, dict | str]] = {
    "notNull": ("name", "notNull"),
    "notEmpty": ("name", "notEmpty"),
    "numeric": ("age_text", "numeric"),
    "integer": ("age_text", "integer"),
    "positive": ("age_text", "positive"),
    "nonNegative": ("age_text", "nonNegative"),
    "email": ("email", "email"),
    "phone": ("phone", "phone"),
    "dateFormat": ("reg_date", "dateFormat"),
    "datetimeFormat": ("reg_ts", "datetimeFormat"),
    "uuid": ("ref_uuid", "uuid"),
    "url": ("website", "url"),
    "minLength": ("name", {"type": "minLength", "value": 2}),
    "maxLength": ("notes", {"type": "maxLength", "max_len": 50}),
    "lengthBetween": ("zip", {"type": "lengthBetween", "min_len": 5, "max_len": 7}),
    "between": ("age_text", {"type": "between", "min": 0, "max": 150}),
    "greaterThan": ("age_text", {"type": "greaterThan", "value": 30}),
    "lessThan": ("age_text", {"type": "lessThan", "value": 90}),
    "equals": ("status", {"type": "equals", "value": "ACTIVE"}),
    "pattern": ("zip", {"type": "pattern", "regex": "^[0-9]+$"}),
    "inList": ("status", {"type": "inList", "values": ["ACTIVE", "PENDING"]}),
    "startsWith": ("website", {"type": "startsWith", "prefix": "https://"}),
    "endsWith": ("email", {"type": "endsWith", "suffix": "@example.com"}),
    "contains": ("notes", {"type": "contains", "substring": "vip"}),
    "custom_sql": ("notes", {"type": "custom_sql", "expression": "coalesce({column}, '') NOT LIKE 'xx%'"}),
}


def single_rule(rule: str) -> list[dict]:
    field, entry = SINGLE_RULES[rule]
    return [{"field": field, "validations": [entry]}]


# The full contacts rule set: all 25 row rules, grouped in blocks with a mix
# of rule messages, block messages and default labels.
CONTACT_RULES: list[dict] = [
    {"field": "name", "validations": [
        "notNull", "notEmpty", {"type": "minLength", "value": 2, "message": "name too short"}]},
    {"field": "email", "message": "bad email", "validations": [
        "email", {"type": "endsWith", "suffix": "@example.com"}]},
    {"field": "phone", "validations": [{"type": "phone", "message": "phone must be E.164"}]},
    {"field": "age_text", "validations": [
        "numeric", "integer", "positive", "nonNegative",
        {"type": "between", "min": 0, "max": 150, "message": "age out of range"},
        {"type": "greaterThan", "value": 30}, {"type": "lessThan", "value": 90}]},
    {"field": "reg_date", "validations": ["dateFormat"]},
    {"field": "reg_ts", "validations": ["datetimeFormat"]},
    {"field": "ref_uuid", "validations": ["uuid"]},
    {"field": "website", "validations": ["url", {"type": "startsWith", "prefix": "https://"}]},
    {"field": "zip", "validations": [
        {"type": "lengthBetween", "min_len": 5, "max_len": 7},
        {"type": "pattern", "regex": "^[0-9]+$", "message": "zip has other than digits"}]},
    {"field": "status", "validations": [
        {"type": "inList", "values": ["ACTIVE", "PENDING"]}, {"type": "equals", "value": "ACTIVE"}]},
    {"field": "notes", "validations": [
        {"type": "maxLength", "max_len": 50}, {"type": "contains", "substring": "vip"},
        {"type": "custom_sql", "expression": "coalesce({column}, '') NOT LIKE 'xx%'",
         "message": "placeholder notes"}]},
]
