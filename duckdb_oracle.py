"""DuckDB oracle SQL for every query in ``__spark_entry__.queries()``.

Hand-written against DuckDB's dialect (``regexp_matches`` has the same
search semantics as RLIKE; ``TRY_CAST`` mirrors the rules' safe casts).
Nothing here calls the library: these are independent statements of what
each query must return.
"""

from __future__ import annotations

from dqflow.plans.workloads import contacts_duckdb_cte

# The format rules' patterns, as SQL string literals.
EMAIL_RE = r"'^[a-zA-Z0-9!#$%&''*+/=?^_`{|}~-]+(?:\.[a-zA-Z0-9!#$%&''*+/=?^_`{|}~-]+)*@(?:[a-zA-Z0-9](?:[a-zA-Z0-9-]*[a-zA-Z0-9])?\.)*[a-zA-Z0-9](?:[a-zA-Z0-9-]*[a-zA-Z0-9])?$'"  # noqa: E501
PHONE_RE = r"'^\+?[1-9]\d{1,14}$'"
DATE_RE = r"'^\d{4}-\d{2}-\d{2}$'"
DATETIME_RE = r"'^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}'"
UUID_RE = r"'^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$'"
URL_RE = r"'^https?://[^\s/$.?#].[^\s]*$'"
INT_RE = r"'^-?\d+$'"

AGE = "TRY_CAST(age_text AS DOUBLE)"

# Single-rule predicates over contacts (one per registered row rule).
RULE_SQL = {
    "notNull": "name IS NOT NULL",
    "notEmpty": "name <> ''",
    "numeric": f"{AGE} IS NOT NULL",
    "integer": f"regexp_matches(age_text, {INT_RE})",
    "positive": f"{AGE} > 0",
    "nonNegative": f"{AGE} >= 0",
    "email": f"regexp_matches(email, {EMAIL_RE})",
    "phone": f"regexp_matches(phone, {PHONE_RE})",
    "dateFormat": f"regexp_matches(reg_date, {DATE_RE})",
    "datetimeFormat": f"regexp_matches(reg_ts, {DATETIME_RE})",
    "uuid": f"regexp_matches(ref_uuid, {UUID_RE})",
    "url": f"regexp_matches(website, {URL_RE})",
    "minLength": "length(name) >= 2",
    "maxLength": "length(notes) <= 50",
    "lengthBetween": "length(zip) BETWEEN 5 AND 7",
    "between": f"{AGE} >= 0 AND {AGE} <= 150",
    "greaterThan": f"{AGE} > 30",
    "lessThan": f"{AGE} < 90",
    "equals": "status = 'ACTIVE'",
    "pattern": "regexp_matches(zip, '^[0-9]+$')",
    "inList": "status IN ('ACTIVE', 'PENDING')",
    "startsWith": "starts_with(website, 'https://')",
    "endsWith": "suffix(email, '@example.com')",
    "contains": "contains(notes, 'vip')",
    "custom_sql": "coalesce(notes, '') NOT LIKE 'xx%'",
}

# The full contacts rule set as (field, label, predicate), in report order.
CONTACT_CHECKS = [
    ("name", "name:notNull", RULE_SQL["notNull"]),
    ("name", "name:notEmpty", RULE_SQL["notEmpty"]),
    ("name", "name too short", RULE_SQL["minLength"]),
    ("email", "bad email", RULE_SQL["email"]),
    ("email", "bad email", RULE_SQL["endsWith"]),
    ("phone", "phone must be E.164", RULE_SQL["phone"]),
    ("age_text", "age_text:numeric", RULE_SQL["numeric"]),
    ("age_text", "age_text:integer", RULE_SQL["integer"]),
    ("age_text", "age_text:positive", RULE_SQL["positive"]),
    ("age_text", "age_text:nonNegative", RULE_SQL["nonNegative"]),
    ("age_text", "age out of range", RULE_SQL["between"]),
    ("age_text", "age_text:greaterThan", RULE_SQL["greaterThan"]),
    ("age_text", "age_text:lessThan", RULE_SQL["lessThan"]),
    ("reg_date", "reg_date:dateFormat", RULE_SQL["dateFormat"]),
    ("reg_ts", "reg_ts:datetimeFormat", RULE_SQL["datetimeFormat"]),
    ("ref_uuid", "ref_uuid:uuid", RULE_SQL["uuid"]),
    ("website", "website:url", RULE_SQL["url"]),
    ("website", "website:startsWith", RULE_SQL["startsWith"]),
    ("zip", "zip:lengthBetween", RULE_SQL["lengthBetween"]),
    ("zip", "zip has other than digits", RULE_SQL["pattern"]),
    ("status", "status:inList", RULE_SQL["inList"]),
    ("status", "status:equals", RULE_SQL["equals"]),
    ("notes", "notes:maxLength", RULE_SQL["maxLength"]),
    ("notes", "notes:contains", RULE_SQL["contains"]),
    ("notes", "placeholder notes", RULE_SQL["custom_sql"]),
]
CONTACT_RULE_NAMES = [
    "notNull", "notEmpty", "minLength", "email", "endsWith", "phone", "numeric", "integer", "positive",
    "nonNegative", "between", "greaterThan", "lessThan", "dateFormat", "datetimeFormat", "uuid", "url",
    "startsWith", "lengthBetween", "pattern", "inList", "equals", "maxLength", "contains", "custom_sql",
]


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _ok(p: str) -> str:
    return f"coalesce(({p}), false)"


def _fail(p: str) -> str:
    return f"NOT coalesce(({p}), false)"


def _with_contacts(body: str) -> str:
    return f"WITH {contacts_duckdb_cte()} {body}"


def _all_ok(checks) -> str:
    return " AND ".join(_ok(p) for _, _, p in checks)


def _labels(checks) -> str:
    """list of failing labels, in rule order."""
    return "list_filter([" + ", ".join(f"CASE WHEN {_fail(p)} THEN {_lit(lab)} END" for _, lab, p in checks) + "], lambda x: x IS NOT NULL)"


def _text(checks, max_row: int = 50) -> str:
    arr = _labels(checks)
    return (f"CASE WHEN len({arr}) > {max_row} THEN array_to_string(({arr})[1:{max_row}], '; ') || '; ... (+' || "
            f"CAST(len({arr}) - {max_row} AS VARCHAR) || ' more)' ELSE array_to_string({arr}, '; ') END")


def _map_text(checks, max_field: int = 0) -> str:
    fields = sorted({f for f, _, _ in checks})
    parts = []
    for f in fields:
        sub = [c for c in checks if c[0] == f]
        arr = _labels(sub)
        kept = f"({arr})[1:{max_field}]" if max_field > 0 else arr
        parts.append(f"CASE WHEN len({arr}) > 0 THEN {_lit(f + '=')} || array_to_string({kept}, ',') END")
    return "concat_ws('|', " + ", ".join(parts) + ")"


def _ko_where(checks) -> str:
    return f"NOT ({_all_ok(checks)})"


ORDERS_ALL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

PRECEDENCE = [
    ("email", "email block message", RULE_SQL["email"]),
    ("email", "email must end in @example.com", RULE_SQL["endsWith"]),
    ("phone", "phone:phone", RULE_SQL["phone"]),
    ("phone", "phone:startsWith", "starts_with(phone, '+1')"),
]
SAME_FIELD = [
    ("name", "name:notNull", "name IS NOT NULL"),
    ("name", "name needs 2+ chars", "length(name) >= 2"),
    ("status", "status:equals", "status = 'ACTIVE'"),
]
DISABLED = [
    ("name", "name:notNull", "name IS NOT NULL"),
    ("zip", "zip:custom_expr", "length(zip) = 5"),
]
TEXT = [
    ("text", "text:minLength", "length(text) >= 40"),
    ("text", "text too long", "length(text) <= 20000"),
    ("text", "must start with a capital letter", "regexp_matches(text, '^[A-Z]')"),
    ("text", "text:contains", "contains(text, ' the ')"),
    ("lang", "lang:inList", "lang IN ('en', 'fr', 'de')"),
    ("source", "source:lengthBetween", "length(source) BETWEEN 4 AND 4"),
]
PART = [
    ("p_brand", "brand code", "regexp_matches(p_brand, '^Brand#[0-9]{2}$')"),
    ("p_size", "p_size:between", "p_size >= 5 AND p_size <= 45"),
    ("p_size", "p_size:integer", "p_size IS NOT NULL"),
    ("p_retailprice", "p_retailprice:positive", "p_retailprice > 0"),
    ("p_retailprice", "p_retailprice:lessThan", "p_retailprice < 990"),
    ("p_type", "type not sold", "p_type IN ('ECONOMY', 'SMALL', 'STANDARD', 'MEDIUM')"),
    ("p_name", "p_name:endsWith", "suffix(p_name, 'bolt')"),
    ("p_name", "p_name:maxLength", "length(p_name) <= 12"),
]
SUPPLIERS = [
    ("s_acctbal", "negative balance", "s_acctbal >= 0"),
    ("s_name", "s_name:pattern", "regexp_matches(s_name, '^Supplier#[0-9]{9}$')"),
    ("s_nationkey", "s_nationkey:between", "s_nationkey >= 0 AND s_nationkey <= 19"),
]
CONVERSATIONS = [
    ("role", "role:inList", "role IN ('user', 'assistant')"),
    ("text", "text:minLength", "length(text) >= 30"),
    ("text", "text:maxLength", "length(text) <= 1500"),
    ("turn", "turn:positive", "turn > 0"),
]
DEMO = [
    ("name", "name:notEmpty", "name <> ''"),
    ("name", "name:pattern", "regexp_matches(name, '^Customer#[0-9]{9}$')"),
    ("c_acctbal", "balance must be >= 0", "c_acctbal >= 0"),
    ("email", "email:email", f"regexp_matches(email, {EMAIL_RE})"),
    ("c_nationkey", "c_nationkey:between", "c_nationkey >= 0 AND c_nationkey <= 20"),
]
STREAM = [
    ("o_totalprice", "o_totalprice:greaterThan", "o_totalprice > 100000"),
    ("o_orderstatus", "o_orderstatus:inList", "o_orderstatus IN ('F', 'O')"),
]
DEMO_BASE = (
    "demo AS (SELECT c_custkey AS id, c_name AS name, c_nationkey, c_acctbal, "
    "CASE WHEN c_acctbal >= 5000 THEN 'high' WHEN c_acctbal >= 0 THEN 'mid' ELSE 'negative' END AS bucket, "
    "CASE WHEN c_custkey % 7 = 0 THEN 'bad-' || CAST(c_custkey AS VARCHAR) "
    "ELSE 'u' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email "
    "FROM customer WHERE c_mktsegment <> 'AUTOMOBILE')"
)


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {
        "scan_parquet_count": "SELECT count(*) AS rows FROM lineitem",
        "source_inventory": " UNION ALL ".join(
            f"SELECT '{t}' AS source, CAST(1 AS BIGINT) AS files, count(*) AS rows, true AS has_bytes FROM {t}"
            for t in TABLES
        ),
        "source_checks": " UNION ALL ".join(
            f"SELECT '{t}' AS name, 'parquet' AS format, true AS exists, CAST(1 AS BIGINT) AS files, count(*) AS rows, "
            f"true AS has_bytes FROM {t}"
            for t in TABLES
        ),
        "filter_rows": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 250000 AND o_orderstatus = 'F'",
        "filter_rows_null_drops": _with_contacts("SELECT id FROM contacts WHERE notes <> 'vip note'"),
        "derive_case": "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity >= 40 THEN 'large' "
                       "WHEN l_quantity >= 10 THEN 'medium' ELSE 'small' END AS qty_band FROM lineitem",
        "derive_cast_date": "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day FROM orders",
        "derive_literal": "SELECT o_orderkey, 'batch' AS channel FROM orders",
        "derive_explode": "SELECT doc_id, unnest([lang, source]) AS x FROM documents",
        "derive_json": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
        "derive_replace_existing": "SELECT c_custkey, upper(c_name) AS c_name, c_nationkey FROM customer",
        "select_columns": "SELECT c_custkey, c_name, c_acctbal FROM customer",
        "rename_columns": "SELECT p_partkey, p_name AS name, p_brand AS brand, p_type, p_size, p_retailprice FROM part",
        "rename_chain": "SELECT p_partkey, p_name AS b FROM part",
        "drop_columns": "SELECT c_custkey, c_nationkey, c_acctbal FROM customer",
        "add_fields": "SELECT o_orderkey, true AS has_ts FROM orders",
    }
    for rule, pred in RULE_SQL.items():
        q[f"rule_{rule}"] = _with_contacts(f"SELECT id FROM contacts WHERE {_ok(pred)}")
    q.update({
        "rule_notEmpty_on_typed": "SELECT o_orderkey FROM orders WHERE o_orderdate IS NOT NULL",
        "rule_integer_on_typed": "SELECT l_orderkey, l_linenumber FROM lineitem "
                                 "WHERE l_linenumber IS NOT NULL AND l_returnflag <> ''",
        "rule_between_on_typed": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount >= 0.02 AND l_discount <= 0.06",
        "rule_inList_on_typed": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber IN (1, 2, 3)",
        "rule_equals_on_typed": "SELECT c_custkey FROM customer WHERE c_nationkey = 7",
        "rule_numeric_on_typed": "SELECT c_custkey FROM customer WHERE c_acctbal IS NOT NULL AND c_acctbal > 0",
        "rule_notEmpty_on_array": "SELECT vec_id FROM embeddings WHERE coalesce(len(embedding) > 0, false)",
        "rule_equals_on_int_flags": "SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0",
        "rule_inList_on_roles": "SELECT conv_id, turn FROM conversations WHERE role IN ('user', 'assistant')",
        "rule_custom_sql_on_json": "SELECT event_id FROM events WHERE "
                                   "coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER) BETWEEN 10 AND 60, false) "
                                   "AND value >= 0",
        "unique_rule_composite": "SELECT conv_id, turn, count(*) OVER (PARTITION BY conv_id, turn) = 1 AS unique_ok "
                                 "FROM conversations",
        "validate_cross_field": "SELECT l_orderkey, l_linenumber FROM lineitem WHERE coalesce(l_discount <= l_tax + 0.05, false)",
    })
    c = CONTACT_CHECKS
    q.update({
        "validate_ok": _with_contacts(f"SELECT id FROM contacts WHERE {_all_ok(c)}"),
        "validate_ko_text": _with_contacts(
            f"SELECT id, {_text(c)} AS validation_errors_text FROM contacts WHERE {_ko_where(c)}"),
        "validate_annotated": _with_contacts(
            f"SELECT id, {_all_ok(c)} AS is_valid, CASE WHEN {_ko_where(c)} THEN {_text(c)} END AS validation_errors_text "
            "FROM contacts"),
        "validate_ko_map": _with_contacts(
            f"SELECT id, {_map_text(c)} AS errors_map_text FROM contacts WHERE {_ko_where(c)}"),
        "validate_ko_array": _with_contacts(
            f"SELECT id, CAST(len({_labels(c)}) AS BIGINT) AS n_errors, array_to_string({_labels(c)}, ' | ') AS errors_joined "
            f"FROM contacts WHERE {_ko_where(c)}"),
        "validate_truncated_text": _with_contacts(
            f"SELECT id, {_text(c, 2)} AS validation_errors_text, {_map_text(c, 1)} AS errors_map_text "
            f"FROM contacts WHERE {_ko_where(c)}"),
        "validate_message_precedence": _with_contacts(
            f"SELECT id, {_text(PRECEDENCE)} AS validation_errors_text FROM contacts WHERE {_ko_where(PRECEDENCE)}"),
        "validate_same_field_twice": _with_contacts(
            f"SELECT id, {_text(SAME_FIELD)} AS validation_errors_text, {_map_text(SAME_FIELD)} AS errors_map_text "
            f"FROM contacts WHERE {_ko_where(SAME_FIELD)}"),
        "validate_disabled_rule": _with_contacts(
            f"SELECT id, {_text(DISABLED)} AS validation_errors_text FROM contacts WHERE {_ko_where(DISABLED)}"),
        "validate_stats": _with_contacts(
            "SELECT total_records, valid_records, total_records - valid_records AS invalid_records, "
            "round(CASE WHEN total_records > 0 THEN valid_records * 100.0 / total_records ELSE 0.0 END, 6) AS valid_percentage, "
            "round(CASE WHEN total_records > 0 THEN (total_records - valid_records) * 100.0 / total_records ELSE 0.0 END, 6) "
            "AS invalid_percentage FROM (SELECT count(*) AS total_records, "
            f"count(*) FILTER (WHERE {_all_ok(c)}) AS valid_records FROM contacts)"),
        "validate_text_quality": f"SELECT doc_id, {_text(TEXT)} AS validation_errors_text FROM documents WHERE {_ko_where(TEXT)}",
        "validate_urls": f"SELECT page_id FROM pages WHERE {_ok(f'regexp_matches(url, {URL_RE})')} "
                         "AND starts_with(url, 'https://')",
        "validate_part_catalog": f"SELECT p_partkey, {_text(PART, 3)} AS validation_errors_text FROM part "
                                 f"WHERE {_ko_where(PART)}",
        "validate_suppliers": f"SELECT s_suppkey, {_text(SUPPLIERS)} AS validation_errors_text FROM supplier "
                              f"WHERE {_ko_where(SUPPLIERS)}",
        "validate_conversations": f"SELECT conv_id, turn, {_text(CONVERSATIONS)} AS validation_errors_text "
                                  f"FROM conversations WHERE {_ko_where(CONVERSATIONS)}",
        "failures_by_rule": _with_contacts(" UNION ALL ".join(
            f"SELECT CAST({i} AS BIGINT) AS rule_index, {_lit(f)} AS field, {_lit(rule)} AS rule, {_lit(lab)} AS message, "
            f"count(*) FILTER (WHERE {_fail(p)}) AS failures FROM contacts"
            for i, ((f, lab, p), rule) in enumerate(zip(c, CONTACT_RULE_NAMES))
        )),
        "unique_rule_documents": "SELECT doc_id, count(*) OVER (PARTITION BY text) = 1 AS unique_ok FROM documents",
        "unique_rule_lineitem": "SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey) = 1 AS unique_ok "
                                "FROM lineitem",
        "dataflow_full_ko": f"WITH {DEMO_BASE} SELECT id, bucket, {_text(DEMO)} AS validation_errors_text "
                            f"FROM demo WHERE {_ko_where(DEMO)}",
        "dataflow_full_ok": f"WITH {DEMO_BASE} SELECT id, bucket, true AS has_ts FROM demo WHERE {_all_ok(DEMO)}",
        "dataflow_fanout": "SELECT o_orderkey, 'finished' AS branch, 'o_totalprice:greaterThan' AS validation_errors_text "
                           "FROM orders WHERE o_orderstatus = 'F' AND NOT coalesce(o_totalprice > 50000, false) "
                           "UNION ALL SELECT o_orderkey, 'open' AS branch, 'o_orderpriority:startsWith' AS validation_errors_text "
                           "FROM orders WHERE o_orderstatus = 'O' AND NOT coalesce(starts_with(o_orderpriority, '1-'), false)",
        "dataflow_written_ko": f"WITH {DEMO_BASE} SELECT id, bucket, {_text(DEMO)} AS validation_errors_text "
                               f"FROM demo WHERE {_ko_where(DEMO)}",
        "dataflow_written_ok": f"WITH {DEMO_BASE} SELECT id, bucket FROM demo WHERE {_all_ok(DEMO)}",
        "sink_roundtrip_json": ORDERS_ALL,
        "sink_roundtrip_csv": ORDERS_ALL,
        "sink_roundtrip_parquet": ORDERS_ALL,
        "sink_roundtrip_orc": ORDERS_ALL,
        "sink_partitioned": ORDERS_ALL,
        "sink_roundtrip_text": ORDERS_ALL,
        "sink_csv_error_map": _with_contacts(
            f"SELECT id, {_map_text(c)} AS errors_map_text FROM contacts WHERE {_ko_where(c)}"),
        "sink_ko_json_map": _with_contacts(
            f"SELECT id, name, notes, {_map_text(c)} AS errors_map_text FROM contacts WHERE {_ko_where(c)}"),
        "versioned_latest": "SELECT * FROM customer",
        "versioned_first": "SELECT * FROM customer WHERE c_acctbal > 0",
        "stream_validate_ok": f"SELECT o_orderkey, o_orderstatus FROM orders WHERE {_all_ok(STREAM)}",
        "stream_validate_ko": f"SELECT o_orderkey, {_text(STREAM)} AS validation_errors_text FROM orders "
                              f"WHERE {_ko_where(STREAM)}",
    })
    q["failures_by_rule_observed"] = q["failures_by_rule"]
    q.update({
        "source_json": ORDERS_ALL,
        "source_csv": ORDERS_ALL,
        "source_orc": ORDERS_ALL,
        "source_csv_inferred": "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_totalprice >= 250000",
        "run_report": "SELECT 'source' AS kind, 'orders' AS name, count(*) AS rows FROM orders "
                      "UNION ALL SELECT 'step', 'finished', count(*) FROM orders WHERE o_orderstatus = 'F' "
                      "UNION ALL SELECT 'sink', 'cheap', count(*) FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 50000 "
                      "UNION ALL SELECT 'sink', 'dear', count(*) FROM orders WHERE o_orderstatus = 'F' "
                      "AND NOT coalesce(o_totalprice < 50000, false)",
        "sink_append_ignore_error": "SELECT o_orderkey, CAST(2 AS BIGINT) AS copies FROM orders",
        "validate_no_rules": "SELECT c_custkey, 'ok' AS part FROM customer",
        "user_transform": "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem",
        "all_dataflows": "SELECT 'f0' AS flow, c_custkey AS key FROM customer WHERE c_acctbal < 0 "
                         "UNION ALL SELECT 'f1', s_suppkey FROM supplier WHERE s_acctbal < 0",
        "dataflow_shared_sinks": _with_contacts(
            "SELECT id, CASE WHEN id % 5 = 0 THEN '' WHEN id % 7 = 0 THEN NULL ELSE segment END AS part FROM contacts"),
        "unique_rule_nulls": _with_contacts(
            "SELECT id, age_text IS NOT NULL AND count(*) OVER (PARTITION BY age_text) = 1 AS unique_ok FROM contacts"),
        "unique_rule_with_row_rules": "SELECT l_orderkey, l_linenumber FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n "
                                      "FROM lineitem) WHERE n = 1 AND l_quantity < 25",
        "stream_unique": "SELECT o_orderkey, concat_ws('; ', CASE WHEN n > 1 THEN 'o_custkey:unique' END, "
            "CASE WHEN NOT o_totalprice > 20000 THEN 'o_totalprice:greaterThan' END) AS errors FROM (SELECT *, count(*) OVER ("
            "PARTITION BY o_custkey, floor(epoch(o_orderdate) / (30 * 86400))) AS n FROM orders)",
        "stream_totals": "SELECT 'greaterThan' AS rule, count(*) FILTER (NOT o_totalprice > 100000) AS failures FROM orders "
            "UNION ALL SELECT 'inList', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders",
        "unique_rule_fields": "SELECT doc_id, count(*) OVER (PARTITION BY source, substr(text, 1, 12)) = 1 AS unique_ok FROM documents",
        "stream_two_queries": f"SELECT o_orderkey, v FROM orders, (SELECT unnest([1, 2]) AS v) WHERE {_all_ok(STREAM)}".replace(
            "SELECT o_orderkey, v", "SELECT o_orderkey, CAST(2 AS BIGINT) AS versions"),
        "versioned_csv_latest": "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer",
        "versioned_compacted": "SELECT c_custkey, concat('run-', c_custkey % 7) AS version_id FROM customer WHERE c_custkey % 7 >= 3",
        "versioned_json_latest": "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(NULL AS DOUBLE) AS bonus FROM customer",
        "source_checks_empty": "SELECT 'all' AS name, true AS exists, CAST(1 AS BIGINT) AS files, count(*) AS rows FROM customer "
                               "UNION ALL SELECT 'none', true, 1, 0 UNION ALL SELECT 'missing', false, 0, 0",
    })
    return q
