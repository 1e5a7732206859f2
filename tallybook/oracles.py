"""Plain SQL for the registered queries, over the star-schema tables as views."""

from __future__ import annotations

TX_SOURCE = """
tx AS (
  SELECT event_id AS id, CAST(ts AS DATE) AS fecha,
         CAST(CAST(value AS DECIMAL(15,2)) - 5 AS DECIMAL(15,2)) AS monto,
         CASE event_type WHEN 'purchase' THEN 'debito' WHEN 'view' THEN ' DEBITO ' WHEN 'signup' THEN 'credito'
                         WHEN 'click' THEN 'Credito' WHEN 'error' THEN 'otro' END AS tipo
  FROM events)"""

TX = f"""WITH {TX_SOURCE},
ruled AS (
  SELECT *, lower(trim(tipo)) AS kind,
         CASE WHEN id IS NULL OR fecha IS NULL OR monto IS NULL OR tipo IS NULL OR trim(tipo) = '' THEN 'INCOMPLETE'
              WHEN lower(trim(tipo)) NOT IN ('debito', 'credito') THEN 'BAD_TYPE' END AS rule
  FROM tx),
placed AS (
  SELECT *, min(id) OVER (PARTITION BY rule IS NULL, fecha, monto, kind) AS first_id FROM ruled),
verdicts AS (
  SELECT id AS ord, id, fecha, monto, tipo, kind, first_id,
         CASE WHEN rule IS NULL AND id > first_id THEN 'DUPLICATE' ELSE rule END AS reason
  FROM placed),
accepted AS (
  SELECT id, fecha, monto, kind AS tipo, monto <= 0 AS anomalia,
         CASE WHEN monto < 0 THEN 'Monto negativo detectado' WHEN monto = 0 THEN 'Monto cero detectado'
              ELSE 'OK' END AS observacion
  FROM verdicts WHERE reason IS NULL)
"""


def _accounts(name: str, saldo: str, edad: str, unreadable: str = "CAST(NULL AS VARCHAR)") -> str:
    return f"""WITH accounts AS (
  SELECT c_custkey AS cuenta_id, {name} AS nombre, {saldo} AS saldo, {edad} AS edad, {unreadable} AS unreadable,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'ahorro' WHEN 'HOUSEHOLD' THEN ' Ahorro '
                           WHEN 'FURNITURE' THEN 'hipoteca' ELSE 'prestamo' END AS tipo
  FROM customer),
rates(rate_type, tasa) AS (
  VALUES ('ahorro', CAST(0.0100 AS DECIMAL(5,4))), ('prestamo', CAST(0.0150 AS DECIMAL(5,4)))),
ruled AS (
  SELECT a.*, lower(trim(tipo)) AS kind, tasa,
         CASE WHEN unreadable IS NOT NULL THEN unreadable
              WHEN cuenta_id IS NULL OR edad IS NULL OR nombre IS NULL OR trim(nombre) = ''
                   OR tipo IS NULL OR trim(tipo) = '' THEN 'INCOMPLETE'
              WHEN edad < 18 OR edad > 100 THEN 'BAD_AGE'
              WHEN saldo IS NULL OR saldo <= 0 THEN 'BAD_BALANCE'
              WHEN tasa IS NULL THEN 'NOT_ELIGIBLE' END AS rule
  FROM accounts a LEFT JOIN rates ON rate_type = lower(trim(tipo))),
placed AS (
  SELECT *, min(cuenta_id) OVER (PARTITION BY rule IS NULL, lower(trim(nombre)), saldo, kind, edad) AS first_id
  FROM ruled),
verdicts AS (
  SELECT *, cuenta_id AS ord,
         CASE WHEN rule IS NULL AND cuenta_id > first_id THEN 'DUPLICATE' ELSE rule END AS reason
  FROM placed),
accepted AS (
  SELECT cuenta_id, nombre, saldo AS saldo_inicial, edad, kind AS tipo, tasa AS tasa_interes,
         CAST(round(saldo * tasa, 2) AS DECIMAL(15,2)) AS interes_calculado,
         CAST(saldo + round(saldo * tasa, 2) AS DECIMAL(15,2)) AS saldo_final
  FROM verdicts WHERE reason IS NULL)
"""


ACCT = _accounts(
    "'N' || CAST(c_nationkey % 5 AS VARCHAR)",
    "CAST(floor(c_acctbal / 1000) * 1000 AS DECIMAL(15,2))",
    "CAST(16 + (c_custkey % 9) * 12 AS INTEGER)",
)
ACCT_CENTS = _accounts("c_name", "CAST(c_acctbal AS DECIMAL(15,2))", "CAST(18 + c_custkey % 83 AS INTEGER)")

ACCT_CSV = _accounts(
    "'N' || CAST(c_nationkey % 5 AS VARCHAR)",
    "CASE WHEN c_custkey % 50 NOT IN (7, 27) THEN CAST(floor(c_acctbal / 1000) * 1000 AS DECIMAL(15,2)) END",
    "CAST(16 + (c_custkey % 9) * 12 AS INTEGER)",
    "CASE c_custkey % 50 WHEN 11 THEN 'UNREADABLE_SALDO' WHEN 21 THEN 'UNREADABLE_EDAD' END",
)

MOV = """WITH movements AS (
  SELECT o_orderkey AS ord, o_custkey AS cuenta_id, CAST(o_orderdate AS DATE) AS fecha,
         CASE WHEN o_orderstatus = 'P' THEN 'Deposito' WHEN o_orderstatus = 'F' THEN 'retiro'
              WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'ajuste'
              WHEN o_orderstatus = 'O' THEN 'compra' END AS transaccion,
         CAST(CAST(o_totalprice AS DECIMAL(15,2)) - 50000 AS DECIMAL(15,2)) AS monto,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS descripcion
  FROM orders),
verdicts AS (
  SELECT *, lower(trim(transaccion)) AS kind,
         CASE WHEN cuenta_id IS NULL OR fecha IS NULL OR monto IS NULL OR transaccion IS NULL
                   OR trim(transaccion) = '' THEN 'INCOMPLETE'
              WHEN lower(trim(transaccion)) NOT IN ('deposito', 'retiro', 'compra') THEN 'BAD_TYPE'
              WHEN monto <= 0 THEN 'BAD_AMOUNT' END AS reason
  FROM movements),
accepted AS (
  SELECT ord, cuenta_id, fecha, kind AS transaccion, monto,
         CASE WHEN descripcion IS NULL OR trim(descripcion) = '' THEN 'Sin descripcion'
              ELSE descripcion END AS descripcion,
         CASE kind WHEN 'deposito' THEN 'INGRESO' ELSE 'EGRESO' END AS clasificacion
  FROM verdicts WHERE reason IS NULL)
"""

MOV_CSV = (
    MOV.replace(
        "CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS descripcion",
        """CASE WHEN o_orderkey % 50 = 31 THEN
           'a, "b"' || CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN ' ' || o_orderpriority ELSE '' END
         WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS descripcion""",
    )
    .replace(
        "CASE WHEN cuenta_id IS NULL",
        "CASE WHEN ord % 50 = 11 THEN 'UNREADABLE_CUENTA_ID' WHEN cuenta_id IS NULL",
    )
)

ACCT_GAPS = ACCT.replace(
    "'N' || CAST(c_nationkey % 5 AS VARCHAR) AS nombre",
    "CASE WHEN c_custkey % 20 = 3 THEN ' ' ELSE 'N' || CAST(c_nationkey % 5 AS VARCHAR) END AS nombre",
).replace(
    "CAST(16 + (c_custkey % 9) * 12 AS INTEGER) AS edad",
    "CASE WHEN c_custkey % 20 NOT IN (3, 5) THEN CAST(16 + (c_custkey % 9) * 12 AS INTEGER) END AS edad",
).replace("CASE c_mktsegment WHEN", "CASE WHEN c_custkey % 20 = 7 THEN NULL ELSE CASE c_mktsegment WHEN").replace(
    "ELSE 'prestamo' END AS tipo", "ELSE 'prestamo' END END AS tipo"
)
MOV_GAPS = (
    MOV.replace("o_custkey AS cuenta_id", "CASE WHEN o_orderkey % 20 NOT IN (1, 2) THEN o_custkey END AS cuenta_id")
    .replace("CAST(o_orderdate AS DATE) AS fecha", "CASE WHEN o_orderkey % 20 <> 2 THEN CAST(o_orderdate AS DATE) END AS fecha")
    .replace("CASE WHEN o_orderstatus = 'P' THEN", "CASE WHEN o_orderkey % 20 = 5 THEN NULL WHEN o_orderstatus = 'P' THEN")
)

OUTCOME = """CASE WHEN reason IS NULL THEN 'ACCEPTED' WHEN reason = 'NOT_ELIGIBLE' THEN 'FILTERED'
  WHEN reason LIKE 'UNREADABLE%' THEN 'READ_ERROR' ELSE 'SKIPPED' END"""

OUTCOME_COUNTS = f"SELECT {OUTCOME} AS outcome, reason, count(*) AS records FROM verdicts GROUP BY reason"

TX_DETAIL = """CASE reason WHEN 'DUPLICATE' THEN 'repeats the record at ' || CAST(first_id AS VARCHAR)
  WHEN 'BAD_TYPE' THEN 'type: ' || tipo END"""
ACCT_DETAIL = """CASE reason WHEN 'DUPLICATE' THEN 'repeats the record at ' || CAST(first_id AS VARCHAR)
  WHEN 'BAD_AGE' THEN 'age: ' || CAST(edad AS VARCHAR)
  WHEN 'BAD_BALANCE' THEN 'balance: ' || coalesce(CAST(saldo AS VARCHAR), 'none')
  WHEN 'NOT_ELIGIBLE' THEN 'type: ' || tipo END"""
MOV_DETAIL = """CASE reason WHEN 'BAD_TYPE' THEN 'type: ' || transaccion
  WHEN 'BAD_AMOUNT' THEN 'amount: ' || CAST(monto AS VARCHAR) END"""


def _rejects(verdicts: str, detail: str) -> str:
    return f"""{verdicts} SELECT ord, {OUTCOME} AS outcome, reason, {detail} AS detail
FROM verdicts WHERE reason IS NOT NULL"""


TX_TEXT = f"""WITH {TX_SOURCE},
texts AS (
  SELECT *, strftime(fecha, '%Y/%m/%d') AS day,
         CASE WHEN id % 2 = 1 AND monto = floor(monto) THEN CAST(CAST(monto AS BIGINT) AS VARCHAR)
              ELSE CAST(monto AS VARCHAR) END AS amount
  FROM tx),
"""

TX_LITERAL = f"""{TX_TEXT}
firsts AS (
  SELECT *, min(id) OVER (PARTITION BY fecha, amount, lower(trim(tipo))) AS first_id
  FROM texts WHERE lower(trim(tipo)) IN ('debito', 'credito'))
SELECT id, fecha, monto, lower(trim(tipo)) AS tipo FROM firsts WHERE id = first_id"""

CSV = f"""{TX_TEXT}
fields AS (
  SELECT id, fecha, monto, tipo AS given, id % 50 AS k, day, amount,
         CASE id % 50 WHEN 11 THEN left(day, 8) || '31x' WHEN 12 THEN replace(day, '/', '-') ELSE day END AS day_text,
         CASE id % 50 WHEN 21 THEN amount || ' EUR' ELSE amount END AS amount_text,
         CASE id % 50 WHEN 31 THEN '' WHEN 32 THEN 'otro, "raro"' ELSE trim(tipo) END AS kind_text,
         CASE id % 50 WHEN 31 THEN '' WHEN 32 THEN '"otro, ""raro""' || '"' ELSE '"' || tipo || '"' END AS kind_raw
  FROM texts),
records AS (
  SELECT id, CASE WHEN k <> 11 THEN fecha END AS fecha, amount,
         CASE WHEN k <> 21 THEN CAST(monto AS DECIMAL(32,16)) END AS monto,
         CASE WHEN k <> 41 THEN nullif(kind_text, '') END AS tipo,
         CASE WHEN k IN (41, 42) THEN 'UNREADABLE_LINE' WHEN k = 11 THEN 'UNREADABLE_FECHA'
              WHEN k = 21 THEN 'UNREADABLE_MONTO' END AS read_error,
         CASE k WHEN 41 THEN concat_ws(',', id, day_text, amount_text)
                WHEN 42 THEN concat_ws(',', id, day_text, amount_text, kind_raw, 'x') END AS broken_line
  FROM fields),
ruled AS (
  SELECT *, lower(tipo) AS kind,
         CASE WHEN read_error IS NOT NULL THEN read_error WHEN tipo IS NULL THEN 'INCOMPLETE'
              WHEN lower(tipo) NOT IN ('debito', 'credito') THEN 'BAD_TYPE' END AS rule
  FROM records),
placed AS (
  SELECT *, min(id) OVER (PARTITION BY rule IS NULL, fecha, amount, kind) AS first_id FROM ruled),
verdicts AS (
  SELECT *, CASE WHEN rule IS NULL AND id > first_id THEN 'DUPLICATE' ELSE rule END AS reason FROM placed)
"""

DATES = """WITH texts AS (
  SELECT event_id, CAST(ts AS DATE) AS d, event_id % 8 AS k FROM events),
spelled AS (
  SELECT event_id, CASE k WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%Y/%m/%d')
         WHEN 2 THEN strftime(d, '%Y/%m-%d')
         WHEN 3 THEN CAST(year(d) AS VARCHAR) || '-' || CAST(month(d) AS VARCHAR) || '-' || CAST(day(d) AS VARCHAR)
         WHEN 4 THEN '  ' || strftime(d, '%Y-%m-%d') || chr(9) WHEN 5 THEN strftime(d, '%Y-02-30')
         WHEN 6 THEN strftime(d, '%Y-%m') ELSE ' ' END AS t
  FROM texts),
cleaned AS (SELECT event_id, replace(trim(t, ' ' || chr(9)), '/', '-') AS t FROM spelled)
SELECT event_id, CASE WHEN regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN TRY_CAST(t AS DATE) END AS fecha
FROM cleaned"""

MESSY = """WITH base AS (
  SELECT c_custkey, c_custkey % 10 AS k, CAST(c_custkey AS VARCHAR) AS key_text,
         CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS VARCHAR) AS bal,
         CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS whole, c_mktsegment AS seg
  FROM customer),
texts AS (
  SELECT c_custkey,
         CASE k WHEN 1 THEN '+' || key_text WHEN 2 THEN key_text || '.0' WHEN 3 THEN ' ' || key_text || chr(9)
                WHEN 4 THEN key_text || 'x' WHEN 5 THEN '' WHEN 6 THEN '00' || key_text
                WHEN 7 THEN key_text || '000000000000000000000' ELSE key_text END AS num,
         CASE k WHEN 1 THEN bal || '0000000' WHEN 2 THEN whole || 'E1' WHEN 3 THEN ' ' || bal || ' '
                WHEN 4 THEN bal || '000000' WHEN 5 THEN '  ' WHEN 6 THEN whole || '.' WHEN 7 THEN whole || 'e-2'
                WHEN 8 THEN replace(bal, '.', ',') ELSE bal END AS amt,
         CASE k WHEN 1 THEN chr(9) || ' ' || upper(seg) || ' ' || chr(13)
                WHEN 2 THEN '  ' || upper(left(seg, 1)) || lower(substr(seg, 2))
                WHEN 3 THEN ' ' || chr(9) || ' ' WHEN 4 THEN NULL WHEN 5 THEN seg || ' X' ELSE seg END AS tipo
  FROM base),
trimmed AS (
  SELECT c_custkey, trim(num, ' ' || chr(9)) AS num, lower(trim(amt)) AS amt,
         trim(tipo, ' ' || chr(9) || chr(13)) AS tipo
  FROM texts),
parts AS (
  SELECT *, split_part(amt, 'e', 1) AS mantissa,
         CASE WHEN contains(amt, 'e') THEN TRY_CAST(split_part(amt, 'e', 2) AS INTEGER) ELSE 0 END AS exponent,
         regexp_full_match(amt, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)(e[+-]?[0-9]+)?') AS is_number
  FROM trimmed),
pieces AS (
  SELECT *, CASE WHEN contains(mantissa, '.') THEN length(split_part(mantissa, '.', 2)) ELSE 0 END - exponent AS places
  FROM parts),
valued AS (
  SELECT *, is_number AS fits,
         CASE WHEN is_number
              THEN CAST(TRY_CAST(mantissa AS DECIMAL(30,10)) * CASE exponent WHEN 1 THEN 10 WHEN -2 THEN 0.01 ELSE 1 END
                        AS DECIMAL(32,16)) END AS as_amount
  FROM pieces)
"""

ORACLES: dict[str, str] = {
    "tx_report": f"{TX} SELECT * FROM accepted ORDER BY id",
    "tx_rejects": _rejects(TX, TX_DETAIL),
    "tx_outcome_counts": f"{TX} {OUTCOME_COUNTS}",
    "tx_summary": f"{TX} SELECT count(*) AS total, count(*) FILTER (WHERE anomalia) AS anomalias FROM accepted",
    "tx_dedup_first": f"{TX} SELECT id, fecha, monto, tipo FROM accepted",
    "tx_dedup_bitmap": f"{TX} SELECT id, fecha, monto, tipo FROM accepted",
    "tx_dedup_skew_safe": f"{TX} SELECT id, fecha, monto, tipo FROM accepted",
    "tx_hot_key_repeats": f"""{TX}, by_kind AS (
  SELECT id, kind AS tipo, min(id) OVER (PARTITION BY kind) AS first_ord FROM ruled WHERE rule IS NULL)
SELECT * FROM by_kind WHERE id > first_ord""",
    "tx_literal_key_dedup": TX_LITERAL,
    "acct_interest": f"{ACCT} SELECT * FROM accepted",
    "acct_interest_cents": f"{ACCT_CENTS} SELECT * FROM accepted",
    "acct_interest_rate_table": f"{ACCT_CENTS} SELECT * FROM accepted",
    "acct_report": f"""{ACCT} SELECT cuenta_id, nombre, tipo, saldo_inicial, interes_calculado, saldo_final
FROM accepted ORDER BY cuenta_id""",
    "acct_rejects": _rejects(ACCT, ACCT_DETAIL),
    "acct_outcome_counts": f"{ACCT} {OUTCOME_COUNTS}",
    "acct_summary": f"{ACCT} SELECT count(*) AS total FROM accepted",
    "acct_not_eligible": f"""{ACCT} SELECT cuenta_id, kind AS tipo FROM verdicts v
WHERE reason IN ('NOT_ELIGIBLE') OR (reason IS NULL AND NOT EXISTS (SELECT 1 FROM rates WHERE rate_type = v.kind))""",
    "mov_statement": f"{MOV} SELECT * EXCLUDE (ord) FROM accepted",
    "mov_statement_ids": f"{MOV} SELECT row_number() OVER (ORDER BY ord) AS id, * EXCLUDE (ord) FROM accepted",
    "mov_rejects": _rejects(MOV, MOV_DETAIL),
    "mov_outcome_counts": f"{MOV} {OUTCOME_COUNTS}",
    "mov_total": f"{MOV} SELECT count(*) AS total FROM accepted",
    "mov_account_summary": f"""{MOV} SELECT cuenta_id, count(*) AS movimientos,
CAST(sum(monto) AS DECIMAL(38,2)) AS total FROM accepted GROUP BY cuenta_id ORDER BY cuenta_id""",
    "parse_dates": DATES,
    "parse_numbers": f"""{MESSY} SELECT c_custkey,
  CASE WHEN regexp_full_match(num, '[+-]?[0-9]+') THEN TRY_CAST(num AS BIGINT) END AS as_long,
  CASE WHEN regexp_full_match(num, '[+-]?[0-9]+') THEN TRY_CAST(num AS INTEGER) END AS as_int,
  as_amount,
  CASE WHEN fits THEN CAST(places AS INTEGER) END AS scale,
  amt IS NULL OR amt = '' AS blank
FROM valued""",
    "canon_text": f"{MESSY} SELECT c_custkey, lower(tipo) AS canon, tipo IS NULL OR tipo = '' AS blank FROM trimmed",
    "csv_scan": f"{CSV} SELECT id, fecha, monto, tipo, read_error, broken_line FROM records",
    "csv_tx_report": f"""{CSV} SELECT id, fecha, CAST(monto AS DECIMAL(15,2)) AS monto, kind AS tipo,
  monto <= 0 AS anomalia,
  CASE WHEN monto < 0 THEN 'Monto negativo detectado' WHEN monto = 0 THEN 'Monto cero detectado'
       ELSE 'OK' END AS observacion
FROM verdicts WHERE reason IS NULL ORDER BY id""",
    "csv_outcome_counts": f"{CSV} {OUTCOME_COUNTS}",
    "csv_default_key": """WITH rows AS (
  SELECT event_id AS id, CAST(date_trunc('month', ts) AS DATE) AS fecha,
         CAST(floor(CAST(value AS DOUBLE) / 50) AS DECIMAL(15,2)) AS monto,
         CASE WHEN event_id % 2 = 0 THEN 'debito' ELSE 'credito' END AS tipo FROM events),
firsts AS (SELECT *, min(id) OVER (PARTITION BY fecha, monto, tipo, id % 3 = 0) AS first_id FROM rows)
SELECT id, fecha, monto, tipo FROM firsts WHERE id = first_id""",
    "mov_dedup_nullable_key": f"""{MOV}, firsts AS (
  SELECT *, min(ord) OVER (PARTITION BY cuenta_id, kind, descripcion, reason IS NULL) AS first_ord FROM verdicts),
judged AS (
  SELECT * REPLACE (CASE WHEN reason IS NULL AND ord > first_ord THEN 'DUPLICATE' ELSE reason END AS reason) FROM firsts)
SELECT ord, {OUTCOME} AS outcome, reason,
  CASE WHEN reason = 'DUPLICATE' THEN 'repeats the record at ' || CAST(first_ord AS VARCHAR) ELSE {MOV_DETAIL} END AS detail
FROM judged""",
    "csv_wide_amounts": f"""WITH {TX_SOURCE},
ruled AS (
  SELECT id, id % 8 AS k, CASE WHEN lower(trim(tipo)) NOT IN ('debito', 'credito') THEN 'BAD_TYPE' END AS reason,
         CASE id % 8 WHEN 1 THEN 0.12 WHEN 2 THEN 0 WHEN 3 THEN 0.01 WHEN 4 THEN -0.01 WHEN 6 THEN -0.01 ELSE monto
         END AS stored
  FROM tx)
SELECT id, CASE WHEN reason IS NULL THEN 'ACCEPTED' ELSE 'SKIPPED' END AS outcome, reason,
  CASE WHEN reason IS NULL AND k <> 5 THEN CAST(stored AS DECIMAL(15,2)) END AS monto,
  CASE WHEN reason IS NULL AND k <> 5 THEN stored <= 0 AND k <> 2 WHEN reason IS NULL THEN FALSE END AS anomalia,
  CASE WHEN reason IS NULL AND k = 5 THEN 'OVERFLOW:monto' END AS violation
FROM ruled""",
    "csv_acct_interest": f"{ACCT_CSV} SELECT * FROM accepted",
    "csv_acct_outcome_counts": f"{ACCT_CSV} {OUTCOME_COUNTS}",
    "csv_mov_statement_ids": f"{MOV_CSV} SELECT row_number() OVER (ORDER BY ord) AS id, * EXCLUDE (ord) FROM accepted",
    "csv_mov_outcome_counts": f"{MOV_CSV} {OUTCOME_COUNTS}",
    "pk_violations": """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "contract_violations": """WITH counts AS (
  SELECT 'p_partkey' AS "column", 'NULL_VALUE' AS rule, count(*) AS violations FROM part WHERE p_partkey IS NULL
  UNION ALL SELECT 'p_name', 'NULL_VALUE', count(*) FROM part WHERE p_name IS NULL
  UNION ALL SELECT 'p_name', 'TOO_LONG', count(*) FROM part WHERE length(p_name) > 9
  UNION ALL SELECT 'p_brand', 'TOO_LONG', count(*) FROM part WHERE length(p_brand) > 7
  UNION ALL SELECT 'p_type', 'TOO_LONG', count(*) FROM part WHERE length(p_type) > 20
  UNION ALL SELECT 'p_retailprice', 'NULL_VALUE', count(*) FROM part WHERE p_retailprice IS NULL
  UNION ALL SELECT 'p_retailprice', 'OVERFLOW', count(*) FROM part WHERE abs(p_retailprice) > 999.99)
SELECT * FROM counts WHERE violations > 0""",
    "contract_violations_accounts": f"""{MESSY}, counts AS (
  SELECT 'saldo' AS "column", 'NULL_VALUE' AS rule, count(*) AS violations FROM valued WHERE as_amount IS NULL
  UNION ALL SELECT 'saldo', 'OVERFLOW', count(*) FROM valued WHERE abs(round(as_amount, 2)) > 999.99
  UNION ALL SELECT 'tipo', 'NULL_VALUE', count(*) FROM texts WHERE tipo IS NULL
  UNION ALL SELECT 'tipo', 'TOO_LONG', count(*) FROM texts WHERE length(tipo) > 9)
SELECT * FROM counts WHERE violations > 0""",
    "gate_skip_limit": f"""{TX}, skips AS (SELECT count(*) AS n FROM verdicts WHERE reason IS NOT NULL),
gates AS (
  SELECT 'default' AS gate, CAST(50 AS BIGINT) AS max_rejects, n FROM skips
  UNION ALL SELECT 'one below', n - 1, n FROM skips
  UNION ALL SELECT 'exact', n, n FROM skips
  UNION ALL SELECT 'none', NULL, n FROM skips)
SELECT gate, max_rejects, n AS skipped, CASE WHEN n > max_rejects THEN 'FAILED' ELSE 'COMPLETED' END AS status
FROM gates""",
    "tx_commit_prefix": f"""{TX}, skips AS (
  SELECT id, row_number() OVER (ORDER BY id) AS n FROM verdicts WHERE reason IS NOT NULL)
SELECT * FROM accepted WHERE id < coalesce((SELECT id FROM skips WHERE n = 51), 9223372036854775807)""",
    "csv_commit_prefix": f"""{TX_TEXT}
placed AS (
  SELECT *, lower(trim(tipo)) AS kind,
         min(id) OVER (PARTITION BY lower(trim(tipo)) IN ('debito', 'credito'), fecha, amount, lower(trim(tipo))) AS first_id
  FROM texts),
judged AS (SELECT *, coalesce(kind NOT IN ('debito', 'credito'), TRUE) OR id > first_id AS skipped FROM placed),
skips AS (SELECT id, row_number() OVER (ORDER BY id) AS n FROM judged WHERE skipped)
SELECT id, fecha, monto, kind AS tipo, monto <= 0 AS anomalia,
       CASE WHEN monto < 0 THEN 'Monto negativo detectado' WHEN monto = 0 THEN 'Monto cero detectado' ELSE 'OK' END AS observacion
FROM judged WHERE NOT skipped AND id < coalesce((SELECT id FROM skips WHERE n = 51), 9223372036854775807)""",
    "tx_caller_rules": f"""WITH {TX_SOURCE},
ruled AS (
  SELECT *, lower(trim(tipo)) AS kind,
         CASE WHEN id IS NULL OR fecha IS NULL OR monto IS NULL OR tipo IS NULL OR trim(tipo) = '' THEN 'INCOMPLETE'
              WHEN monto > 100 THEN 'TOO_LARGE'
              WHEN lower(trim(tipo)) NOT IN ('debito', 'credito') THEN 'BAD_TYPE'
              WHEN dayofweek(fecha) IN (0, 6) THEN 'WEEKEND' END AS rule
  FROM tx),
placed AS (SELECT *, min(id) OVER (PARTITION BY rule IS NULL, fecha, monto, kind) AS first_id FROM ruled),
verdicts AS (SELECT *, CASE WHEN rule IS NULL AND id > first_id THEN 'DUPLICATE' ELSE rule END AS reason FROM placed)
SELECT id AS ord, CASE WHEN reason IS NULL THEN 'ACCEPTED' WHEN reason = 'WEEKEND' THEN 'FILTERED' ELSE 'SKIPPED' END AS outcome,
       reason, CASE reason WHEN 'TOO_LARGE' THEN 'amount: ' || CAST(monto AS VARCHAR) ELSE {TX_DETAIL} END AS detail,
       CASE WHEN reason IS NULL THEN monto END AS monto
FROM verdicts""",
    "tx_default_flag": f"""{TX} SELECT id, fecha, monto, tipo, id % 3 <> 0 AND anomalia AS anomalia, observacion
FROM accepted""",
    "tx_refused_records": f"""WITH {TX_SOURCE},
given AS (
  SELECT id AS ord, id % 700 AS id, fecha, tipo, id % 100 = 77 AS large,
         CAST(monto AS DECIMAL(32,2)) + CASE WHEN id % 100 = 77 THEN 100000000000000 ELSE 0 END AS monto,
         CASE WHEN id IS NULL OR fecha IS NULL OR monto IS NULL OR tipo IS NULL OR trim(tipo) = '' THEN 'INCOMPLETE'
              WHEN lower(trim(tipo)) NOT IN ('debito', 'credito') THEN 'BAD_TYPE' END AS rule
  FROM tx),
firsts AS (SELECT *, min(ord) FILTER (rule IS NULL) OVER (PARTITION BY id) AS first_ord FROM given)
SELECT 'daily_transactions' AS job, ord, CASE WHEN rule IS NULL THEN 'write' ELSE 'process' END AS phase,
       CASE WHEN rule IS NULL THEN 'REFUSED' ELSE 'SKIPPED' END AS outcome,
       coalesce(rule, CASE WHEN large THEN 'OVERFLOW' ELSE 'REPEATED_KEY' END) AS reason,
       CASE WHEN rule = 'BAD_TYPE' THEN 'type: ' || tipo WHEN rule IS NULL AND large THEN 'column: monto'
            WHEN rule IS NULL THEN 'repeats the key of the record at ' || CAST(first_ord AS VARCHAR) END AS detail,
       id, CAST(fecha AS VARCHAR) AS fecha, CAST(monto AS DECIMAL(32,2)) AS monto
FROM firsts WHERE rule IS NOT NULL OR large OR ord > first_ord""",
    "run_all": f"""SELECT 'daily_transactions' AS job,
  CASE WHEN skipped > 50 THEN 'FAILED' ELSE 'COMPLETED' END AS status, records_read,
  CASE WHEN skipped > 50 THEN 0 ELSE good END AS records_written, CAST(0 AS BIGINT) AS records_filtered,
  skipped AS records_skipped, CASE WHEN skipped > 50 THEN 'RejectLimitExceeded' END AS failure
FROM ({TX} SELECT count(*) AS records_read, count(*) FILTER (WHERE reason IS NULL) AS good,
      count(*) FILTER (WHERE reason IS NOT NULL) AS skipped FROM verdicts)
UNION ALL
SELECT 'monthly_interest', 'COMPLETED', records_read, good, filtered, skipped, NULL
FROM ({ACCT} SELECT count(*) AS records_read, count(*) FILTER (WHERE reason IS NULL) AS good,
      count(*) FILTER (WHERE reason = 'NOT_ELIGIBLE') AS filtered,
      count(*) FILTER (WHERE reason <> 'NOT_ELIGIBLE') AS skipped FROM verdicts)
UNION ALL
SELECT 'annual_statements', 'COMPLETED', records_read, good, 0, skipped, NULL
FROM ({MOV} SELECT count(*) AS records_read, count(*) FILTER (WHERE reason IS NULL) AS good,
      count(*) FILTER (WHERE reason IS NOT NULL) AS skipped FROM verdicts)""",
    "run_all_with_missing_input": f"""SELECT 'daily_transactions' AS job, 'COMPLETED' AS status, records_read,
  good AS records_written, CAST(0 AS BIGINT) AS records_filtered, skipped AS records_skipped,
  CAST(NULL AS VARCHAR) AS failure
FROM ({TX} SELECT count(*) AS records_read, count(*) FILTER (WHERE reason IS NULL) AS good,
      count(*) FILTER (WHERE reason IS NOT NULL) AS skipped FROM verdicts)
UNION ALL SELECT 'monthly_interest', 'FAILED', 0, 0, 0, 0, 'AnalysisException'
UNION ALL
SELECT 'annual_statements', 'COMPLETED', records_read, good, 0, skipped, NULL
FROM ({MOV} SELECT count(*) AS records_read, count(*) FILTER (WHERE reason IS NULL) AS good,
      count(*) FILTER (WHERE reason IS NOT NULL) AS skipped FROM verdicts)""",
    "tx_published": f"{TX} SELECT * FROM accepted",
    "tx_published_rejects": f"""{TX} SELECT 'daily_transactions' AS job, ord, {OUTCOME} AS outcome, reason,
  {TX_DETAIL} AS detail, CAST(id AS VARCHAR) AS id, CAST(fecha AS VARCHAR) AS fecha, monto, tipo
FROM verdicts WHERE reason IS NOT NULL""",
    "tx_failed_run_rejects": f"""{TX} SELECT 'daily_transactions' AS job, ord, {OUTCOME} AS outcome, reason,
  {TX_DETAIL} AS detail FROM verdicts WHERE reason IS NOT NULL""",
    "acct_published": f"{ACCT} SELECT * FROM accepted",
    "mov_published": f"{MOV} SELECT row_number() OVER (ORDER BY ord) AS id, * EXCLUDE (ord) FROM accepted",
    "mov_republished_months": f"""{MOV} SELECT strftime(fecha, '%Y-%m') AS mes, clasificacion, count(*) AS movimientos,
  CAST(sum(monto + CASE WHEN fecha >= DATE '1995-07-01' THEN 1 ELSE 0 END) AS DECIMAL(38,2)) AS total
FROM accepted WHERE year(fecha) = 1995 GROUP BY ALL""",
    "mov_published_accounts": f"""{MOV} SELECT cuenta_id, count(*) AS movimientos,
CAST(sum(monto) AS DECIMAL(38,2)) AS total FROM accepted GROUP BY cuenta_id""",
    "acct_published_counters": f"""{ACCT_GAPS}, counters AS (
  SELECT 'read' AS counter, count(*) AS records FROM verdicts
  UNION ALL SELECT 'accepted', count(*) FILTER (WHERE reason IS NULL) FROM verdicts
  UNION ALL SELECT 'written', count(*) FROM accepted
  UNION ALL SELECT 'filtered', count(*) FILTER (WHERE reason = 'NOT_ELIGIBLE') FROM verdicts
  UNION ALL SELECT 'skipped', count(*) FILTER (WHERE reason <> 'NOT_ELIGIBLE') FROM verdicts
  UNION ALL SELECT 'unreadable', 0
  UNION ALL SELECT 'violations', 0
  UNION ALL SELECT 'skipped ' || reason, count(*) FROM verdicts WHERE reason <> 'NOT_ELIGIBLE' GROUP BY reason)
SELECT * FROM counters""",
    "gate_read_error": f"""{CSV}, stop AS (
  SELECT min(id) AS first_bad, count(*) AS bad FROM verdicts WHERE read_error IS NOT NULL)
SELECT 'UnreadableInput' AS failure, max(bad) AS unreadable, CAST(0 AS BIGINT) AS violations,
  count(*) FILTER (WHERE reason IS NULL AND id < first_bad) AS written
FROM verdicts, stop""",
    "gate_contract": f"""{TX}, stop AS (
  SELECT min(id) AS first_bad, count(*) AS bad FROM accepted WHERE id % 1000 = 77)
SELECT CASE WHEN max(bad) > 0 THEN 'ContractBroken' ELSE 'NoneType' END AS failure, CAST(0 AS BIGINT) AS unreadable,
  max(bad) AS violations, count(*) FILTER (WHERE first_bad IS NULL OR id < first_bad) AS written
FROM accepted, stop""",
    "gate_primary_key": f"""{TX}, good AS (SELECT id, id % 4000 AS pk FROM ruled WHERE rule IS NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY pk ORDER BY id) AS n, count(*) OVER (PARTITION BY pk) AS c FROM good),
stop AS (SELECT min(id) FILTER (WHERE n > 1) AS first_bad, count(DISTINCT pk) FILTER (WHERE c > 1) AS bad FROM ranked)
SELECT CASE WHEN max(bad) > 0 THEN 'ContractBroken' ELSE 'NoneType' END AS failure, CAST(0 AS BIGINT) AS unreadable,
  max(bad) AS violations, count(*) FILTER (WHERE first_bad IS NULL OR id < first_bad) AS written
FROM ranked, stop""",
    "acct_incomplete_rejects": f"""{ACCT_GAPS} SELECT ord, {OUTCOME} AS outcome, reason,
  CASE WHEN reason = 'INCOMPLETE' THEN 'missing: ' || concat_ws(', ', CASE WHEN edad IS NULL THEN 'edad' END,
    CASE WHEN trim(nombre) = '' THEN 'nombre' END, CASE WHEN tipo IS NULL THEN 'tipo' END)
  ELSE {ACCT_DETAIL} END AS detail
FROM verdicts WHERE reason IS NOT NULL""",
    "mov_incomplete_rejects": f"""{MOV_GAPS} SELECT ord, {OUTCOME} AS outcome, reason,
  CASE WHEN reason = 'INCOMPLETE' THEN 'missing: ' || concat_ws(', ', CASE WHEN cuenta_id IS NULL THEN 'cuenta_id' END,
    CASE WHEN fecha IS NULL THEN 'fecha' END, CASE WHEN transaccion IS NULL THEN 'transaccion' END)
  ELSE {MOV_DETAIL} END AS detail
FROM verdicts WHERE reason IS NOT NULL""",
}
