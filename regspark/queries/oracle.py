"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Views ``region nation customer ... conversations`` are registered over the
same parquet files. NULLs sort last in DuckDB by default, matching the
``asc_nulls_last`` orders of the Spark side.
"""

from __future__ import annotations

_PREF_ORDERS = """
  SELECT *, ROW_NUMBER() OVER (
      PARTITION BY o_custkey
      ORDER BY CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END,
               o_orderdate, o_orderkey) AS rn
  FROM orders"""

_PARTNER_COUNTS = """
  SELECT o.o_custkey AS c_custkey, CAST(COUNT(*) AS BIGINT) AS partner_count
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey"""

_NEWCOMERS = """
  SELECT * FROM customer
  UNION ALL
  SELECT * REPLACE (-c_custkey AS c_custkey) FROM customer WHERE c_custkey % 7 = 0"""

SQL: dict[str, str] = {}

SQL["preferred_order"] = f"""
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority, o_orderstatus, o_totalprice
FROM ({_PREF_ORDERS}) WHERE rn = 1
"""

SQL["preferred_order_context"] = f"""
SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment,
       n.n_name AS nation_name, p.o_orderkey,
       CAST(p.o_orderdate AS DATE) AS o_orderdate, p.o_orderpriority
FROM customer c
LEFT JOIN ({_PREF_ORDERS}) p ON p.o_custkey = c.c_custkey AND p.rn = 1
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
"""

SQL["preferred_company"] = """
SELECT c_nationkey, c_mktsegment, c_custkey, c_name FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY c_nationkey, c_mktsegment
                               ORDER BY c_name, c_custkey) AS rn
  FROM customer) WHERE rn = 1
"""

SQL["preferred_unmatched"] = f"""
SELECT c.c_custkey, c.c_name, p.o_orderkey, CAST(p.o_orderdate AS DATE) AS o_orderdate
FROM ({_NEWCOMERS}) c
LEFT JOIN ({_PREF_ORDERS}) p ON p.o_custkey = c.c_custkey AND p.rn = 1
"""

SQL["company_context"] = f"""
WITH comp AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY c_custkey
      ORDER BY c_name, c_nationkey, c_acctbal, c_mktsegment) AS rn
  FROM customer)
SELECT c.c_custkey, c.c_name, c.c_mktsegment, c.c_acctbal, p.o_orderkey,
       CAST(p.o_orderdate AS DATE) AS o_orderdate, p.o_orderpriority,
       p.o_orderstatus, p.o_totalprice, n.n_name AS nation_name,
       n.n_regionkey AS region_code, r.r_name AS region_name
FROM comp c
LEFT JOIN ({_PREF_ORDERS}) p ON p.o_custkey = c.c_custkey AND p.rn = 1
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
WHERE c.rn = 1
"""

SQL["branch_context"] = """
SELECT o.o_orderkey, o.o_custkey,
       CAST(o.o_custkey AS VARCHAR) || CAST(o.o_orderkey AS VARCHAR) || o.o_orderstatus AS full_id,
       o.o_orderstatus, o.o_totalprice, CAST(o.o_orderdate AS DATE) AS o_orderdate,
       c.c_name AS customer_name, c.c_nationkey AS nation_code, n.n_name AS nation_name
FROM orders o
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
"""

SQL["partner_context"] = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name AS part_name,
       l.l_suppkey, s.s_name AS supplier_name, l.l_quantity, l.l_returnflag
FROM lineitem l
LEFT JOIN part p ON p.p_partkey = l.l_partkey
LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
"""

SQL["consolidated"] = f"""
WITH comp AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY c_custkey
      ORDER BY c_name, c_nationkey, c_acctbal, c_mktsegment) AS rn
  FROM ({_NEWCOMERS})),
pc AS ({_PARTNER_COUNTS})
SELECT c.c_custkey, c.c_name, c.c_mktsegment, p.o_orderkey,
       CAST(p.o_orderdate AS DATE) AS o_orderdate, p.o_orderpriority, p.o_orderstatus,
       n.n_name AS nation_name, COALESCE(pc.partner_count, 0) AS partner_count
FROM comp c
LEFT JOIN ({_PREF_ORDERS}) p ON p.o_custkey = c.c_custkey AND p.rn = 1
LEFT JOIN pc ON pc.c_custkey = c.c_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
WHERE c.rn = 1
"""

SQL["dedup_by_key"] = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type
                               ORDER BY event_id, ts, value, props) AS rn
  FROM events) WHERE rn = 1
"""

_MARKER_CASE = """CASE {k} % 9 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN 'null' WHEN 3 THEN ' N/A '
      WHEN 4 THEN 'na' WHEN 5 THEN 'NaN' WHEN 6 THEN 'nao aplicavel' WHEN 7 THEN 'não aplicável'
      ELSE ' ' || {v} || ' ' END"""

SQL["null_markers"] = f"""
WITH m AS (
  SELECT 'events' AS source_table, event_id AS row_id,
         {_MARKER_CASE.format(k='event_id', v='event_type')} AS raw_value FROM events
  UNION ALL
  SELECT 'documents', doc_id, {_MARKER_CASE.format(k='doc_id', v='lang')} FROM documents)
SELECT *, CASE WHEN trim(raw_value) = ''
                 OR upper(trim(raw_value)) IN ('NULL', 'N/A', 'NA', 'NAN', 'NAO APLICAVEL', 'NÃO APLICÁVEL')
               THEN NULL ELSE trim(raw_value) END AS clean_value
FROM m
"""

SQL["string_tidy"] = """
WITH m AS (
  SELECT 'customer' AS source_table, c_custkey AS row_id,
         CASE WHEN c_custkey % 3 = 0 THEN ' "' || c_name || '" '
              WHEN c_custkey % 3 = 1 THEN '''' || c_name || ''''
              ELSE ' " ' || c_name || ' " ' END AS raw_value
  FROM customer
  UNION ALL
  SELECT 'documents', doc_id, text FROM documents)
SELECT *, replace(replace(trim(raw_value), '"', ''), '''', '') AS tidy_value FROM m
"""

_BR = "translate(format('{:,.2f}', c_acctbal), ',.', '.,')"
SQL["money_parse"] = f"""
WITH t AS (
  SELECT c_custkey,
         CASE c_custkey % 5 WHEN 0 THEN {_BR}
                            WHEN 1 THEN 'R$ ' || {_BR}
                            WHEN 2 THEN printf('%.2f', c_acctbal)
                            WHEN 3 THEN '"' || {_BR} || '"'
                            ELSE {_BR} || '.5' END AS money_text
  FROM customer),
k AS (SELECT *, regexp_replace(trim(money_text), '[^0-9,.\\-]', '', 'g') AS kept FROM t)
SELECT c_custkey, money_text,
       TRY_CAST(CASE WHEN strpos(kept, ',') > 0 THEN translate(kept, ',.', '.') ELSE kept END
                AS DECIMAL(18, 2)) AS capital_social
FROM k
"""

SQL["date_parse"] = """
WITH b AS (
  SELECT o_orderkey,
         CASE o_orderkey % 7 WHEN 0 THEN '00000000'
              WHEN 1 THEN strftime(o_orderdate, '%Y%m%d') || 'x'
              WHEN 2 THEN substr(strftime(o_orderdate, '%Y%m%d'), 1, 7)
              WHEN 3 THEN substr(strftime(o_orderdate, '%Y%m%d'), 1, 6) || '31'
              WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d')
              ELSE strftime(o_orderdate, '%Y%m%d') END AS r
  FROM orders)
SELECT o_orderkey, r AS data_inicio_raw,
       CASE WHEN regexp_full_match(r, '[0-9]{8}')
            THEN CAST(try_strptime(r, '%Y%m%d') AS DATE) END AS data_inicio
FROM b
"""

_OM = "strftime(o_orderdate, '%Y-%m')"
SQL["month_distinct"] = f"""
SELECT {_OM} AS data_version, COUNT(DISTINCT o_custkey) AS distinct_companies
FROM orders GROUP BY 1
"""
SQL["year_month_distinct"] = f"""
SELECT left({_OM}, 4) AS year, {_OM} AS data_version,
       COUNT(DISTINCT o_custkey) AS distinct_companies
FROM orders GROUP BY 1, 2
"""
SQL["year_filtered_distinct"] = f"""
SELECT '1996' AS year, {_OM} AS data_version, COUNT(DISTINCT o_custkey) AS distinct_companies
FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 2
"""
SQL["year_distinct"] = f"""
SELECT left({_OM}, 4) AS year, COUNT(DISTINCT o_custkey) AS distinct_companies
FROM orders GROUP BY 1
"""
SQL["month_slice_top"] = f"""
SELECT o_orderkey, o_custkey, {_OM} AS data_version, o_totalprice
FROM orders WHERE {_OM} = '1997-05' ORDER BY o_orderkey LIMIT 100
"""

_RULES = {
    "required_name": "c_name IS NOT NULL AND trim(c_name) <> ''",
    "name_format": "regexp_full_match(c_name, 'Customer#[0-9]{9}')",
    "valid_nation": "nf IS NOT NULL",
    "balance_range": "c_acctbal BETWEEN 0 AND 10000",
    "segment_domain": "c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')",
    "unique_key": "kn = 1",
}
_RULE_FIELDS = {
    "required_name": ("c_name", "ERROR"), "name_format": ("c_name", "WARNING"),
    "valid_nation": ("c_nationkey", "ERROR"), "balance_range": ("c_acctbal", "WARNING"),
    "segment_domain": ("c_mktsegment", "WARNING"), "unique_key": ("c_custkey", "CRITICAL"),
}
_FLAWED = """
  SELECT c.* REPLACE (
           CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 43 = 0 THEN '  '
                WHEN c_custkey % 37 = 0 THEN lower(c_name) ELSE c_name END AS c_name,
           CASE WHEN c_custkey % 31 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS c_nationkey,
           CASE WHEN c_custkey % 29 = 0 THEN 'OTHER' ELSE c_mktsegment END AS c_mktsegment)
  FROM customer c, range(CASE WHEN c.c_custkey % 47 = 0 THEN 2 ELSE 1 END)"""
_CUST_CHECKED = f"""
  SELECT c.*, n.n_nationkey AS nf, COUNT(*) OVER (PARTITION BY c.c_custkey) AS kn
  FROM ({_FLAWED}) c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey"""
_PASSED = " + ".join(f"CAST(COALESCE({e}, false) AS INTEGER)" for e in _RULES.values())
_SCORES = f"""
  SELECT c_custkey, c_nationkey, {_PASSED} AS rules_passed, 6 AS rules_total
  FROM ({_CUST_CHECKED})"""

SQL["quality_score"] = f"""
SELECT c_custkey, c_nationkey, rules_passed, rules_total,
       CAST(rules_passed AS DOUBLE) * CAST(100.0 AS DOUBLE) / CAST(6.0 AS DOUBLE) AS quality_score,
       CASE WHEN rules_passed * 100 >= 540 THEN 'ready'
            WHEN rules_passed * 100 >= 420 THEN 'minor_alerts' ELSE 'held' END AS quality_band
FROM ({_SCORES})
"""

SQL["quality_alerts"] = "WITH c AS (" + _CUST_CHECKED + ")\n" + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS alert_type, 'rule {name} failed on {field}' AS alert_message, "
    f"CAST(c_custkey AS BIGINT) AS record_line, '{sev}' AS severity, '{field}' AS field_name "
    f"FROM c WHERE NOT COALESCE({_RULES[name]}, false)"
    for name, (field, sev) in _RULE_FIELDS.items()
)

SQL["state_rollup"] = f"""
WITH s AS (SELECT DISTINCT c_custkey, c_nationkey,
                  CAST(CAST(rules_passed AS DOUBLE) * 100.0::DOUBLE / 6.0::DOUBLE AS DECIMAL(9, 6)) AS q
           FROM ({_SCORES})),
o AS (SELECT o.o_orderkey, o.o_custkey, s.c_nationkey AS nation_code, s.q
      FROM orders o LEFT JOIN s ON s.c_custkey = o.o_custkey)
SELECT n.n_name AS uf, COUNT(*) AS n_rows, COUNT(DISTINCT o.o_custkey) AS n_companies,
       CAST(SUM(o.q) AS DOUBLE) / CAST(COUNT(o.q) AS DOUBLE) AS mean_quality
FROM o LEFT JOIN nation n ON n.n_nationkey = o.nation_code
GROUP BY n.n_name
"""

SQL["table_sizes"] = "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS tabela, COUNT(*) AS total FROM {t}"
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
) + ") ORDER BY total DESC, tabela"

SQL["months_present"] = """
SELECT DISTINCT data_version FROM (
  SELECT strftime(o_orderdate, '%Y-%m') AS data_version FROM orders
  UNION ALL
  SELECT strftime(l_shipdate, '%Y-%m') FROM lineitem)
"""

SQL["null_rate"] = """
WITH e AS (SELECT CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id END AS user_id, event_type
           FROM events),
k AS (SELECT user_id, event_type, COUNT(*) AS n FROM e GROUP BY ALL)
SELECT CAST(SUM(n) AS BIGINT) AS total_rows,
       CAST(SUM(CASE WHEN user_id IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_rows,
       CAST(SUM(CASE WHEN user_id IS NULL THEN n ELSE 0 END) AS DOUBLE) / CAST(SUM(n) AS DOUBLE) AS null_rate,
       COUNT(*) AS distinct_keys,
       COUNT(*) FILTER (WHERE user_id IS NULL) AS null_keys,
       CAST(COUNT(*) FILTER (WHERE user_id IS NULL) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS null_rate_dedup,
       90 AS threshold,
       COUNT(*) FILTER (WHERE user_id IS NULL) * 100 <= 10 * COUNT(*) AS passed
FROM k
"""

SQL["orphan_codes"] = """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN -o_custkey ELSE o_custkey END AS o_custkey FROM orders)
SELECT o_orderkey, o_custkey FROM o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
"""

SQL["bad_char_cells"] = """
WITH d AS (
  SELECT doc_id, lang, replace(text, 'é', chr(65533)) AS text,
         CASE WHEN source = 'src7' THEN 'src' || chr(65533) ELSE source END AS source
  FROM documents)
SELECT lang, COUNT(*) AS n_docs,
       MAX(CASE WHEN strpos(text, chr(65533)) > 0 THEN 1 ELSE 0 END) AS bad_text,
       MAX(CASE WHEN strpos(source, chr(65533)) > 0 THEN 1 ELSE 0 END) AS bad_source,
       CAST(SUM(CASE WHEN strpos(text, chr(65533)) > 0 THEN 1 ELSE 0 END)
            + SUM(CASE WHEN strpos(source, chr(65533)) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS bad_cells,
       CAST(SUM(length(replace(text, chr(65533), ''))) AS BIGINT) AS clean_chars
FROM d GROUP BY lang
"""

# Latin-1 reading of UTF-8 bytes: every byte of a character's UTF-8 form
# becomes the code point with that byte value.
_LATIN1_VIEW = """list_aggregate(list_transform(string_split(text, ''), lambda ch:
    CASE WHEN unicode(ch) < 128 THEN ch
         WHEN unicode(ch) < 2048 THEN chr(192 + unicode(ch) // 64) || chr(128 + unicode(ch) % 64)
         WHEN unicode(ch) < 65536 THEN chr(224 + unicode(ch) // 4096)
              || chr(128 + (unicode(ch) // 64) % 64) || chr(128 + unicode(ch) % 64)
         ELSE chr(240 + unicode(ch) // 262144) || chr(128 + (unicode(ch) // 4096) % 64)
              || chr(128 + (unicode(ch) // 64) % 64) || chr(128 + unicode(ch) % 64) END),
  'string_agg', '')"""


def _n(pattern: str) -> str:
    return f"COALESCE(len(regexp_extract_all(t, {pattern})), 0)"


_ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇ"
# windows-1252 reading of the same bytes: other characters for 0x80 to 0x9F.
_CP1252 = "translate(t, '" + "".join(map(chr, range(128, 160))) + "', '€\ufffd‚ƒ„…†‡ˆ‰Š‹Œ\ufffdŽ\ufffd\ufffd‘’“”•–—˜™š›œ\ufffdžŸ')"
_FLAWED_TEXT = """CASE doc_id % 7 WHEN 1 THEN 'Ã©Â© ' || text WHEN 2 THEN text || chr(1) || chr(2)
    WHEN 3 THEN chr(65533) || text ELSE text END"""


def _scored(extra_byte: bool) -> str:
    """Every candidate's terms for every document."""
    latin1_tail, utf8_tail = ("CASE WHEN doc_id % 7 = 4 THEN 'é' ELSE '' END", "CASE WHEN doc_id % 7 = 4 THEN chr(65533) ELSE '' END") \
        if extra_byte else ("''", "''")
    return f"""
  d AS (SELECT doc_id, source, lang, {_FLAWED_TEXT} AS text FROM documents),
  l AS (SELECT doc_id, source, lang, {_LATIN1_VIEW} || {latin1_tail} AS t, text || {utf8_tail} AS u FROM d),
  c AS (
    SELECT doc_id, source, lang, 0 AS pos, 'latin1' AS encoding, t FROM l
    UNION ALL SELECT doc_id, source, lang, 1, 'cp1252', {_CP1252} FROM l
    UNION ALL SELECT doc_id, source, lang, 2, 'utf-8', u FROM l
    UNION ALL SELECT doc_id, source, lang, 3, 'utf-8-sig', u FROM l),
  m AS (
    SELECT doc_id, source, lang, pos, encoding,
           {_n("chr(65533)")} AS decode_errors,
           {_n("'Ã[^\\n]'")} + {_n("'Â[^\\n]'")} + {_n("chr(65533)")} AS mojibake_hits,
           {_n("'[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]'")} AS control_chars,
           {_n("'[" + _ACCENTED + "]'")} AS accented_chars
    FROM c),
  s AS (SELECT *, decode_errors * 100 + mojibake_hits * 10 + control_chars * 5 - accented_chars AS score
        FROM m)"""


_ENC_BEST = f"""
  WITH {_scored(True)}
  SELECT doc_id, source, encoding, CAST(score AS BIGINT) AS score,
         CAST(decode_errors AS BIGINT) AS decode_errors, CAST(mojibake_hits AS BIGINT) AS mojibake_hits,
         CAST(control_chars AS BIGINT) AS control_chars, CAST(accented_chars AS BIGINT) AS accented_chars
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY score, pos) AS rn FROM s)
  WHERE rn = 1"""

SQL["folder_encoding_scores"] = f"""
WITH {_scored(False)}
SELECT lang AS folder, encoding, CAST(SUM(score) AS BIGINT) AS score,
       CAST(SUM(decode_errors) AS BIGINT) AS decode_errors, CAST(SUM(mojibake_hits) AS BIGINT) AS mojibake_hits,
       CAST(SUM(control_chars) AS BIGINT) AS control_chars, CAST(SUM(accented_chars) AS BIGINT) AS accented_chars
FROM s GROUP BY lang, encoding
"""

SQL["folder_layout_profile"] = """
SELECT lang AS folder, COUNT(*) AS n_lines, CAST(MIN(n) AS INTEGER) AS min_fields, CAST(MAX(n) AS INTEGER) AS max_fields
FROM (SELECT lang, len(string_split(l, ',')) AS n
      FROM (SELECT lang, unnest(string_split(regexp_replace(text, '\n$', ''), chr(10))) AS l FROM documents))
GROUP BY lang
"""

SQL["encoding_score"] = _ENC_BEST

SQL["encoding_vote"] = f"""
WITH best AS ({_ENC_BEST}),
v AS (SELECT source, encoding, COUNT(*) AS wins FROM best GROUP BY ALL)
SELECT source, encoding, wins FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY source ORDER BY wins DESC,
      CASE encoding WHEN 'latin1' THEN 1 WHEN 'cp1252' THEN 2 WHEN 'utf-8' THEN 3
                    WHEN 'utf-8-sig' THEN 4 END) AS rn
  FROM v) WHERE rn = 1
"""

SQL["field_profile"] = """
SELECT doc_id, CAST(len(fc) AS BIGINT) AS n_lines, CAST(list_min(fc) AS INTEGER) AS min_fields,
       CAST(list_max(fc) AS INTEGER) AS max_fields,
       array_to_string(list_sort(list_distinct(fc)), ',') AS distinct_fields
FROM (SELECT doc_id,
             list_transform(string_split(text, chr(10)), lambda l: len(string_split(l, ','))) AS fc
      FROM documents)
"""

SQL["typed_to_text"] = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment
FROM customer
"""

SQL["month_overwrite_roundtrip"] = """
SELECT data_version, COUNT(*) AS n_orders FROM (
  SELECT strftime(o_orderdate, '%Y-%m') AS data_version, o_orderstatus FROM orders)
WHERE data_version <> '1998-01' AND (data_version <> '1997-05' OR o_orderstatus = 'F')
GROUP BY data_version
"""

SQL["manifest_publish"] = """
WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS data_version, o_orderstatus FROM orders)
SELECT data_version, COUNT(*) AS n_before,
       CASE WHEN data_version <> '1997-05' THEN COUNT(*) ELSE NULLIF(COUNT(*) FILTER (WHERE o_orderstatus = 'F'), 0) END AS n_after,
       true AS rival_refused, (SELECT COUNT(*) FROM o WHERE data_version = '1998-01')::INTEGER AS would_drop
FROM o WHERE data_version <> '1998-02' GROUP BY data_version
"""

_STATUS = "CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END"

SQL["runs_by_stage"] = """
SELECT event_type AS stage, 'events' AS dataset, COUNT(*) AS runs,
       CAST(SUM(user_id) AS BIGINT) AS records,
       CAST(SUM(CAST(value AS DECIMAL(12, 2))) AS DOUBLE) / CAST(COUNT(value) AS DOUBLE) AS mean_duration,
       MAX(CAST(value AS DECIMAL(12, 2))) AS max_duration
FROM events GROUP BY event_type
"""

SQL["runs_by_state"] = f"""
SELECT event_type AS stage, 'events' AS dataset, {_STATUS} AS status, strftime(ts, '%Y-%m') AS data_version,
       COUNT(*) AS runs, CAST(SUM(user_id) AS BIGINT) AS records,
       CAST(SUM(CAST(value AS DECIMAL(12, 2))) AS DOUBLE) / CAST(COUNT(value) AS DOUBLE) AS mean_duration,
       MAX(CAST(value AS DECIMAL(12, 2))) AS max_duration
FROM events GROUP BY ALL
"""

SQL["record_rates"] = """
WITH e AS (SELECT event_type AS stage, CAST(SUM(user_id) AS BIGINT) AS processed,
                  CAST(SUM(CASE WHEN event_type = 'error' THEN event_id % 11 ELSE 0 END) AS BIGINT) AS failed
           FROM events GROUP BY event_type)
SELECT stage, processed, failed,
       CASE WHEN processed + failed = 0 THEN 0::DOUBLE
            ELSE processed::DOUBLE * 100::DOUBLE / (processed + failed)::DOUBLE END AS record_success_rate,
       CASE WHEN processed + failed = 0 THEN 0::DOUBLE
            ELSE failed::DOUBLE * 100::DOUBLE / (processed + failed)::DOUBLE END AS record_error_rate
FROM e
"""

SQL["recent_failed_runs"] = """
SELECT event_id AS run_id, event_type AS stage, 'failed' AS status, ts AS finished_at
FROM events WHERE event_type = 'error' ORDER BY ts DESC NULLS LAST, event_id DESC LIMIT 20
"""

SQL["recent_critical_alerts"] = """
SELECT event_id AS record_line, ts AS created_at, 'CRITICAL' AS severity
FROM events WHERE event_type = 'error' AND value >= 100 ORDER BY ts DESC NULLS LAST, event_id DESC LIMIT 20
"""

SQL["run_rates"] = """
SELECT COUNT(*) AS total_runs,
       COUNT(*) FILTER (WHERE event_type <> 'error') AS successes,
       COUNT(*) FILTER (WHERE event_type = 'error') AS failures,
       CASE WHEN COUNT(*) = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST(COUNT(*) FILTER (WHERE event_type <> 'error') AS DOUBLE) * CAST(100 AS DOUBLE)
                 / CAST(COUNT(*) AS DOUBLE) END AS success_rate,
       CASE WHEN COUNT(*) = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST(COUNT(*) FILTER (WHERE event_type = 'error') AS DOUBLE) * CAST(100 AS DOUBLE)
                 / CAST(COUNT(*) AS DOUBLE) END AS error_rate
FROM events
"""

_BOUNDS = ["0.5", "1", "2", "5", "10", "30", "60", "120", "300", "600", "1200", "1800", "3600"]
SQL["run_duration_hist"] = """
WITH r AS (SELECT event_type AS stage, CAST(value AS DECIMAL(12, 2)) AS d FROM events),
b AS (SELECT * FROM (VALUES """ + ", ".join(
    f"('{b}', CAST({b} AS DOUBLE))" for b in _BOUNDS) + """, ('+Inf', CAST('inf' AS DOUBLE))
     ) t(le, le_value))
SELECT r.stage, b.le, b.le_value,
       CAST(COUNT(*) FILTER (WHERE CAST(r.d AS DOUBLE) <= b.le_value) AS BIGINT) AS runs_le
FROM r CROSS JOIN b GROUP BY r.stage, b.le, b.le_value
"""

SQL["latest_run"] = f"""
SELECT event_type AS stage, 'events' AS dataset, {_STATUS} AS status, MAX(ts) AS last_finished_at
FROM events GROUP BY ALL
"""

SQL["recent_runs"] = f"""
SELECT event_id AS run_id, event_type AS stage, {_STATUS} AS status, ts AS finished_at
FROM events ORDER BY ts DESC NULLS LAST, event_id DESC LIMIT 20
"""

SQL["run_summary"] = """
WITH runs AS (
  SELECT user_id AS run_id,
         CASE WHEN COUNT(*) FILTER (WHERE event_type = 'error') > 0 THEN 'failed' ELSE 'completed' END AS status,
         MIN(ts) AS s, MAX(ts) AS f
  FROM events GROUP BY user_id),
a AS (
  SELECT user_id AS run_id, COUNT(*) AS alert_count,
         COUNT(*) FILTER (WHERE value >= 100) AS critical_alerts
  FROM events WHERE event_type = 'error' GROUP BY user_id)
SELECT r.run_id, r.status, (epoch_us(r.f) - epoch_us(r.s)) // 1000000 AS duration_seconds,
       COALESCE(a.alert_count, 0) AS alert_count, COALESCE(a.critical_alerts, 0) AS critical_alerts
FROM runs r LEFT JOIN a ON a.run_id = r.run_id
"""

# --- registry views over registry-shaped tables derived from the test tables -------

_M = "'2026-03'"
_V = "CAST(NULL AS VARCHAR)"
_MONTHS = "(VALUES ('2026-03'), ('2026-04')) mon(m)"
_SECOND = "mon.m = '2026-03' OR"
_REG = f"""
kinds AS (SELECT * FROM (VALUES ('own', 1), ('new', 10), ('twin', 15)) k(kind, every)),
empresas AS (
  SELECT CASE WHEN kind = 'new' THEN 'N' ELSE '' END || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico,
         CASE WHEN kind = 'twin' THEN 'A ' ELSE '' END || c_name AS razao_social,
         CAST(c_nationkey AS VARCHAR) AS natureza_juridica, c_mktsegment AS qualificacao_responsavel,
         CAST(c_acctbal AS DECIMAL(18, 2)) AS capital_social, '01' AS porte_empresa,
         {_V} AS ente_federativo_responsavel, mon.m AS dataset_month, mon.m AS data_version
  FROM customer JOIN kinds ON c_custkey % every = 0 CROSS JOIN {_MONTHS} WHERE {_SECOND} c_custkey % 3 <> 0),
est AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS cnpj_basico,
         lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS cnpj_ordem,
         lpad(CAST(o_orderkey % 97 AS VARCHAR), 2, '0') AS cnpj_dv,
         CASE WHEN o_orderpriority = '1-URGENT' THEN '1' ELSE '2' END AS identificador_matriz_filial,
         o_orderpriority AS nome_fantasia, o_orderstatus AS situacao_cadastral,
         CAST(o_orderdate AS DATE) AS data_situacao_cadastral,
         CAST(o_orderkey % 7 AS VARCHAR) AS motivo_situacao_cadastral,
         CAST(o_orderdate AS DATE) AS data_inicio_atividade,
         CAST(o_custkey % 7 AS VARCHAR) AS cnae_fiscal_principal,
         substr(o_orderstatus, 1, 1) AS uf, CAST(o_custkey % 29 AS VARCHAR) AS municipio,
         '11' AS ddd1, CAST(o_orderkey AS VARCHAR) AS telefone1,
         CASE WHEN o_orderkey % 13 = 0 THEN '0000-000'
              WHEN o_orderkey % 13 = 1 THEN lpad(CAST(o_custkey AS VARCHAR), 5, '0') || '-001'
              ELSE lpad(CAST(o_custkey AS VARCHAR), 8, '0') END AS cep,
         {_V} AS tipo_logradouro, {_V} AS logradouro, {_V} AS numero, {_V} AS complemento,
         {_V} AS bairro, {_V} AS ddd2, {_V} AS telefone2, {_V} AS correio_eletronico,
         mon.m AS dataset_month, mon.m AS data_version
  FROM orders CROSS JOIN {_MONTHS} WHERE {_SECOND} o_orderkey % 4 <> 0),
soc AS (
  SELECT lpad(CAST(o.o_custkey AS VARCHAR), 8, '0') AS cnpj_basico,
         CAST(l.l_linenumber AS VARCHAR) AS identificador_socio,
         'SOCIO ' || CAST(l.l_suppkey AS VARCHAR) AS nome_socio,
         CAST(l.l_partkey AS VARCHAR) AS cnpj_cpf_socio,
         CAST(l.l_linenumber AS VARCHAR) AS qualificacao_socio,
         CAST(l.l_shipdate AS DATE) AS data_entrada_sociedade,
         CAST(l.l_suppkey % 30 AS VARCHAR) AS pais,
         {_V} AS representante_legal, {_V} AS nome_representante,
         {_V} AS qualificacao_representante_legal,
         CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) AS faixa_etaria,
         mon.m AS dataset_month, mon.m AS data_version
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  CROSS JOIN {_MONTHS} WHERE {_SECOND} l.l_linenumber <= 2),
nations AS (SELECT *, mon.m AS data_version FROM nation CROSS JOIN {_MONTHS} WHERE {_SECOND} n_nationkey < 20),
regions AS (SELECT *, mon.m AS data_version FROM region CROSS JOIN {_MONTHS} WHERE {_SECOND} r_regionkey < 20),
municipios AS (SELECT CAST(n_nationkey AS VARCHAR) AS codigo, n_name AS descricao, data_version FROM nations),
paises AS (SELECT CAST(n_nationkey AS VARCHAR) AS codigo, 'PAIS ' || n_name AS descricao, data_version FROM nations),
qualificacoes AS (SELECT CAST(n_nationkey AS VARCHAR) AS codigo, 'QUALIF ' || n_name AS descricao, data_version FROM nations),
cnaes AS (SELECT CAST(r_regionkey AS VARCHAR) AS codigo, r_name AS descricao, data_version FROM regions),
motivos AS (SELECT CAST(r_regionkey AS VARCHAR) AS codigo, 'MOTIVO ' || r_name AS descricao, data_version FROM regions),
pref_est AS (
  SELECT unnest(arg_min(est, {{'f': identificador_matriz_filial <> '1', 'o': cnpj_ordem, 'd': cnpj_dv}})), 1 AS rn
  FROM est GROUP BY cnpj_basico, data_version),
pref_emp AS (
  SELECT unnest(arg_min(empresas, razao_social)), 1 AS rn FROM empresas GROUP BY cnpj_basico, data_version)"""

SQL["registry_companies_with_state"] = f"""
WITH {_REG}
SELECT e.cnpj_basico, e.razao_social, e.natureza_juridica, e.qualificacao_responsavel,
       e.capital_social, e.porte_empresa, e.ente_federativo_responsavel, p.uf, p.municipio,
       e.dataset_month, e.data_version
FROM empresas e
LEFT JOIN pref_est p ON p.cnpj_basico = e.cnpj_basico AND p.data_version = e.data_version AND p.rn = 1
"""

SQL["registry_company_context"] = f"""
WITH {_REG}
SELECT e.cnpj_basico, e.razao_social, e.natureza_juridica, e.qualificacao_responsavel,
       e.capital_social, e.porte_empresa, e.ente_federativo_responsavel,
       p.identificador_matriz_filial, p.nome_fantasia, p.situacao_cadastral,
       p.data_inicio_atividade, p.uf, p.municipio AS municipio_codigo,
       mun.descricao AS municipio_nome, p.cnae_fiscal_principal,
       cn.descricao AS cnae_principal_descricao, p.ddd1, p.telefone1, p.correio_eletronico,
       e.dataset_month, e.data_version
FROM pref_emp e
LEFT JOIN pref_est p ON p.cnpj_basico = e.cnpj_basico AND p.data_version = e.data_version AND p.rn = 1
LEFT JOIN municipios mun ON mun.codigo = p.municipio AND mun.data_version = p.data_version
LEFT JOIN cnaes cn ON cn.codigo = p.cnae_fiscal_principal AND cn.data_version = p.data_version
WHERE e.rn = 1
"""

SQL["registry_branch_context"] = f"""
WITH {_REG}
SELECT est.cnpj_basico, est.cnpj_ordem, est.cnpj_dv,
       est.cnpj_basico || est.cnpj_ordem || est.cnpj_dv AS cnpj_completo,
       est.identificador_matriz_filial, est.nome_fantasia, est.situacao_cadastral,
       est.data_situacao_cadastral, est.motivo_situacao_cadastral,
       mot.descricao AS motivo_situacao_cadastral_descricao, est.data_inicio_atividade,
       est.cnae_fiscal_principal, cn.descricao AS cnae_principal_descricao, est.uf,
       est.municipio AS municipio_codigo, mun.descricao AS municipio_nome,
       est.tipo_logradouro, est.logradouro, est.numero, est.complemento, est.bairro, est.cep,
       est.ddd1, est.telefone1, est.ddd2, est.telefone2, est.correio_eletronico,
       est.dataset_month, est.data_version
FROM est
LEFT JOIN motivos mot ON mot.codigo = est.motivo_situacao_cadastral AND mot.data_version = est.data_version
LEFT JOIN cnaes cn ON cn.codigo = est.cnae_fiscal_principal AND cn.data_version = est.data_version
LEFT JOIN municipios mun ON mun.codigo = est.municipio AND mun.data_version = est.data_version
"""

SQL["registry_partner_context"] = f"""
WITH {_REG}
SELECT soc.cnpj_basico, soc.identificador_socio, soc.nome_socio, soc.cnpj_cpf_socio,
       soc.qualificacao_socio, q.descricao AS qualificacao_socio_descricao,
       soc.data_entrada_sociedade, soc.pais AS pais_codigo, pa.descricao AS pais_nome,
       soc.representante_legal, soc.nome_representante, soc.qualificacao_representante_legal,
       soc.faixa_etaria, soc.dataset_month, soc.data_version
FROM soc
LEFT JOIN qualificacoes q ON q.codigo = soc.qualificacao_socio AND q.data_version = soc.data_version
LEFT JOIN paises pa ON pa.codigo = soc.pais AND pa.data_version = soc.data_version
"""

SQL["registry_consolidated"] = f"""
WITH {_REG},
sp AS (SELECT cnpj_basico, data_version, COUNT(*) AS quantidade_socios FROM soc GROUP BY 1, 2)
SELECT e.cnpj_basico, e.razao_social, e.natureza_juridica, e.porte_empresa, p.cnpj_ordem,
       p.cnpj_dv, p.identificador_matriz_filial, p.nome_fantasia, p.situacao_cadastral, p.uf,
       p.municipio AS municipio_codigo, mun.descricao AS municipio_nome,
       p.cnae_fiscal_principal, cn.descricao AS cnae_principal_descricao,
       COALESCE(sp.quantidade_socios, 0) AS quantidade_socios, e.dataset_month, e.data_version
FROM pref_emp e
LEFT JOIN pref_est p ON p.cnpj_basico = e.cnpj_basico AND p.data_version = e.data_version AND p.rn = 1
LEFT JOIN sp ON sp.cnpj_basico = e.cnpj_basico AND sp.data_version = e.data_version
LEFT JOIN municipios mun ON mun.codigo = p.municipio AND mun.data_version = p.data_version
LEFT JOIN cnaes cn ON cn.codigo = p.cnae_fiscal_principal AND cn.data_version = p.data_version
WHERE e.rn = 1
"""

SQL["text_ingest_companies"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS cnpj_basico,
       c_name AS razao_social,
       CAST(c_nationkey AS VARCHAR) AS natureza_juridica,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS qualificacao_responsavel,
       CAST(c_acctbal AS DECIMAL(18, 2)) AS capital_social, '01' AS porte_empresa,
       {_V} AS ente_federativo_responsavel, {_M} AS dataset_month, {_M} AS data_version
FROM customer
"""

SQL["text_ingest_partners"] = f"""
SELECT CAST(l_orderkey AS VARCHAR) AS cnpj_basico, CAST(l_linenumber AS VARCHAR) AS identificador_socio,
       'SOCIO ' || CAST(l_suppkey AS VARCHAR) AS nome_socio, CAST(l_partkey AS VARCHAR) AS cnpj_cpf_socio,
       l_returnflag AS qualificacao_socio, CAST(l_shipdate AS DATE) AS data_entrada_sociedade,
       CASE WHEN l_linestatus = 'O' THEN '105' END AS pais, {_V} AS representante_legal,
       {_V} AS nome_representante, '00' AS qualificacao_representante_legal,
       CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS faixa_etaria,
       {_M} AS dataset_month, {_M} AS data_version
FROM lineitem
"""

SQL["registry_branch_quality"] = f"""
WITH {_REG},
chk AS (
  SELECT est.*, mun.codigo AS tf,
         COUNT(*) OVER (PARTITION BY est.cnpj_basico, est.cnpj_ordem, est.cnpj_dv, est.data_version) AS kn
  FROM est LEFT JOIN municipios mun ON mun.codigo = est.municipio AND mun.data_version = est.data_version),
r AS (
  SELECT cnpj_basico, cnpj_ordem, cnpj_dv, data_version,
         CAST(COALESCE(cnpj_basico IS NOT NULL AND cnpj_ordem IS NOT NULL AND cnpj_dv IS NOT NULL, false) AS INTEGER)
       + CAST(COALESCE(regexp_full_match(cep, '[0-9]{{5}}-?[0-9]{{3}}'), false) AS INTEGER)
       + CAST(COALESCE(data_inicio_atividade IS NOT NULL, false) AS INTEGER)
       + CAST(COALESCE(tf IS NOT NULL, false) AS INTEGER)
       + CAST(COALESCE(identificador_matriz_filial IN ('1', '2'), false) AS INTEGER)
       + CAST(COALESCE(kn = 1, false) AS INTEGER) AS rules_passed
  FROM chk)
SELECT cnpj_basico, cnpj_ordem, cnpj_dv, data_version, rules_passed, 6 AS rules_total,
       CAST(rules_passed AS DOUBLE) * CAST(100.0 AS DOUBLE) / CAST(6.0 AS DOUBLE) AS quality_score,
       CASE WHEN rules_passed * 100 >= 540 THEN 'ready'
            WHEN rules_passed * 100 >= 420 THEN 'minor_alerts' ELSE 'held' END AS quality_band
FROM r
"""

SQL["stream_ingest_companies"] = f"""
WITH c AS (
  SELECT c_custkey, c_name AS nm, c_nationkey, c_mktsegment, c_acctbal FROM customer
  UNION ALL
  SELECT c_custkey, c_name || ' LTDA', c_nationkey, c_mktsegment, c_acctbal FROM customer)
SELECT CAST(c_custkey AS VARCHAR) AS cnpj_basico, nm AS razao_social,
       CAST(c_nationkey AS VARCHAR) AS natureza_juridica,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS qualificacao_responsavel,
       translate(format('{{:,.2f}}', c_acctbal), ',.', '.,') AS capital_social,
       '01' AS porte_empresa, {_V} AS ente_federativo_responsavel, 'ok' AS _layout_status,
       'empresas' AS file_type, {_M} AS dataset_month, {_M} AS data_version
FROM c
"""

SQL["text_ingest_branches"] = f"""
SELECT CAST(o_custkey AS VARCHAR) AS cnpj_basico,
       lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS cnpj_ordem,
       lpad(CAST(o_orderkey % 97 AS VARCHAR), 2, '0') AS cnpj_dv,
       CASE WHEN o_orderpriority = '1-URGENT' THEN '1' ELSE '2' END AS identificador_matriz_filial,
       o_orderpriority AS nome_fantasia, o_orderstatus AS situacao_cadastral,
       CAST(o_orderdate AS DATE) AS data_situacao_cadastral,
       CAST(o_orderkey % 7 AS VARCHAR) AS motivo_situacao_cadastral,
       {_V} AS nome_cidade_exterior, {_V} AS pais,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS data_inicio_atividade,
       CAST(o_custkey % 5 AS VARCHAR) AS cnae_fiscal_principal, {_V} AS cnae_fiscal_secundaria,
       'RUA' AS tipo_logradouro, 'RUA ' || CAST(o_orderkey AS VARCHAR) AS logradouro,
       CAST(o_orderkey % 1000 AS VARCHAR) AS numero, {_V} AS complemento, 'CENTRO' AS bairro,
       lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS cep,
       'U' || lpad(CAST(o_custkey % 27 AS VARCHAR), 2, '0') AS uf,
       CAST(o_custkey % 25 AS VARCHAR) AS municipio, '11' AS ddd1,
       CAST(o_orderkey AS VARCHAR) AS telefone1, {_V} AS ddd2, {_V} AS telefone2,
       {_V} AS ddd_fax, {_V} AS fax, {_V} AS correio_eletronico, {_V} AS situacao_especial,
       CAST(NULL AS DATE) AS data_situacao_especial, {_V} AS extra_col_1, {_V} AS extra_col_2,
       {_M} AS dataset_month, {_M} AS data_version
FROM orders
"""

SQL["run_current_state"] = """
SELECT run_id, event_id, event_ts, status FROM (
  SELECT user_id AS run_id, event_id, ts AS event_ts,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id, event_type) AS rn
  FROM events) WHERE rn = 1
"""

SQL["alert_counts"] = f"""
SELECT alert_type, severity, COUNT(*) AS alerts FROM ({SQL["quality_alerts"]}) GROUP BY 1, 2
"""

SQL["published_state_view"] = SQL["registry_companies_with_state"] + f"WHERE e.data_version = {_M}"

SQL["mart_replace_drop"] = """
SELECT '2026-03' AS data_version, lpad(CAST(o_custkey % 29 AS VARCHAR), 4, '0') AS municipio, COUNT(*) AS n_rows,
       CAST((SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'F') AS INTEGER) AS rows_written,
       CAST((SELECT COUNT(*) FROM orders WHERE o_orderkey % 4 <> 0) AS INTEGER) AS rows_dropped
FROM orders WHERE o_orderstatus = 'F' GROUP BY 2
"""

_UNEVEN = """
  SELECT c_custkey, CASE WHEN c_custkey % 500 = 1 THEN rpad(c_name, 99999, ';') || '.' ELSE c_name END AS c_name,
         c_nationkey, CASE c_custkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 7 ELSE 9 END AS w FROM customer"""

SQL["layout_audit"] = f"""
SELECT mode, CAST(c_custkey AS VARCHAR) AS cnpj_basico, c_name AS razao_social,
       CASE WHEN w > 3 THEN '01' END AS porte_empresa, CASE WHEN w > 3 THEN 'a;b' END AS ente_federativo_responsavel,
       CAST(w AS INTEGER) AS _column_count, 7 AS _layout_expected, CASE WHEN w = 7 THEN 'ok' ELSE 'mismatch' END AS _layout_status
FROM ({_UNEVEN}), (VALUES ('batch'), ('stream')) v(mode)
"""

SQL["generic_columns"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS col_1, c_name AS col_2, CAST(c_nationkey AS VARCHAR) AS col_3,
       CASE WHEN w > 3 THEN '49' END AS col_4, CASE WHEN w > 3 THEN '10,00' END AS col_5, CASE WHEN w > 3 THEN '01' END AS col_6,
       CASE WHEN w > 3 THEN 'a;b' END AS col_7, CASE WHEN w = 9 THEN 'x' END AS col_8, CASE WHEN w = 9 THEN 'y' END AS col_9,
       CAST(w AS INTEGER) AS _column_count
FROM ({_UNEVEN})
"""

SQL["source_selection"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS codigo, 'A' || c_name AS descricao, 'paises' AS file_type,
       {_M} AS dataset_month, {_M} AS data_version, true AS has_source, true AS has_time
FROM customer
"""

SQL["encoding_switch"] = """
SELECT 'paises' AS dataset, 'utf-8' AS from_encoding, 'latin1' AS to_encoding, 1::BIGINT AS switches,
       COUNT(*) FILTER (WHERE c_custkey % 2 = 0) + COUNT(*) FILTER (WHERE c_custkey % 4 = 0) AS recovered_cells
FROM customer
"""

_STAGES = "(VALUES ('bronze', 2), ('silver', 1), ('gold', 1), ('run', 1)) v(stage, times)"

SQL["runlog_stages"] = f"""
SELECT stage, 'empresas' AS dataset, 'completed' AS status, data_version, 1::BIGINT AS runs,
       times * (SELECT COUNT(*) FROM customer) AS records
FROM {_STAGES}, (VALUES ({_M}), ('2026-04')) m(data_version)
"""

SQL["runlog_record_rates"] = f"""
SELECT stage, 2 * times * (SELECT COUNT(*) FROM customer) AS processed, 0::BIGINT AS failed,
       100::DOUBLE AS record_success_rate, 0::DOUBLE AS record_error_rate
FROM {_STAGES}
"""

SQL["runlog_rates"] = """
SELECT 8::BIGINT AS total_runs, 8::BIGINT AS successes, 0::BIGINT AS failures,
       100::DOUBLE AS success_rate, 0::DOUBLE AS error_rate
"""

SQL["stream_to_gold"] = SQL["text_ingest_companies"]

SQL["reingest_companies"] = f"""
WITH n AS (SELECT COUNT(*) AS n FROM customer)
SELECT layer, {_M} AS data_version, n AS n_rows, CAST(n * times AS INTEGER) AS had, CAST(n * times AS INTEGER) AS dropped
FROM n, (VALUES ('bronze', 2), ('silver', 1), ('gold', 1)) v(layer, times)
"""

SQL["lake_distinct_companies"] = """
WITH c AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS k FROM customer
  UNION SELECT 'N' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') FROM customer WHERE c_custkey % 10 = 0
), m AS (
  SELECT '2025-12' AS data_version, k FROM c UNION ALL
  SELECT '2026-01', k FROM c WHERE k LIKE '%3' UNION ALL
  SELECT '2026-02', k FROM c WHERE k LIKE 'N%'
)
SELECT left(data_version, 4) AS year, data_version, COUNT(DISTINCT k) AS distinct_companies FROM m GROUP BY ALL
UNION ALL
SELECT left(data_version, 4), NULL, COUNT(DISTINCT k) FROM m GROUP BY ALL
"""

SQL["reduced_consolidated"] = SQL["registry_consolidated"]
SQL["reduced_company_context"] = SQL["registry_company_context"]

SQL["mixed_encoding_files"] = """
SELECT k.kind, k.encoding, CAST(c_custkey AS VARCHAR) AS codigo, c_name || ' São é' || chr(k.sign) AS descricao
FROM customer JOIN (VALUES (0, 'utf', 'utf-8-sig', 8364), (1, 'win', 'cp1252', 8364), (2, 'latin', 'latin1', 129)) k(r, kind, encoding, sign)
  ON k.r = c_custkey % 3
"""

SQL["clustered_lookup"] = f"""
WITH {_REG},
b AS (SELECT cnpj_basico, cnpj_ordem, uf, municipio, cnae_fiscal_principal, data_version FROM est WHERE data_version = {_M})
SELECT 'uf' AS asked, * FROM b WHERE uf = 'F'
UNION ALL SELECT 'municipio', * FROM b WHERE municipio = '7'
UNION ALL SELECT 'cnae_fiscal_principal', * FROM b WHERE cnae_fiscal_principal = '3'
"""
