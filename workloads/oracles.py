"""The registered queries in plain SQL over the same views, written independently."""

from __future__ import annotations

import re

from workloads.views import VIEWS, with_views

_SOURCES = re.compile(r"\b(?:FROM|JOIN)\s+(\w+)")

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"

# Totals per item, each movement summed on its own.
MOVEMENTS = """
wh AS (SELECT ks, SUM(CAST(free_qty AS DECIMAL(18,4))) AS q FROM stock_qty
       WHERE free_qty <> 0 AND warehouse_id NOT IN (SELECT unnest([1, 3, 8, 9, 10])) GROUP BY ks),
settled AS (SELECT invoice_no FROM payment GROUP BY invoice_no HAVING SUM(CAST(amount AS DECIMAL(28,10))) > 0),
held AS (SELECT ks, SUM(CAST(reserved_qty AS DECIMAL(18,4))) AS q FROM reserve
         WHERE invoice_no IN (SELECT invoice_no FROM settled) AND released_at IS NULL AND reserve_status <> 3 GROUP BY ks),
promised AS (SELECT ks, SUM(CAST(reserved_qty AS DECIMAL(18,4))) AS q FROM incoming_reserve
             WHERE invoice_no IN (SELECT invoice_no FROM settled) AND released_at IS NULL GROUP BY ks),
running AS (SELECT order_no FROM purchase_order WHERE cancelled IS NOT TRUE AND done IS NOT TRUE AND supplier_code NOT IN (3, 7)),
coming AS (SELECT ks, SUM(CAST(qty AS DECIMAL(18,4))) AS q, MIN(expected_date) AS expected_date FROM purchase_order_line
           WHERE order_no IN (SELECT order_no FROM running)
             AND cancelled IS NOT TRUE AND done IS NOT TRUE AND invoice_no IS NULL AND received_at IS NULL
           GROUP BY ks)"""

STATUS = MOVEMENTS + """,
status AS (SELECT c.ks, CAST(COALESCE(c.stock_status, -1) AS INTEGER) AS cur,
                  CASE WHEN COALESCE(wh.q, 0) - COALESCE(held.q, 0) > 0 THEN 2
                       WHEN COALESCE(coming.q, 0) - COALESCE(promised.q, 0) > 0 THEN 1 ELSE 0 END AS clc,
                  coming.expected_date
           FROM content c LEFT JOIN wh ON wh.ks = c.ks LEFT JOIN held ON held.ks = c.ks
           LEFT JOIN coming ON coming.ks = c.ks LEFT JOIN promised ON promised.ks = c.ks)"""

CHANGE_RECORDS = STATUS + """,
asked AS (SELECT s.ks, NULLIF(s.cur, -1) AS old_status, s.clc AS new_status, s.expected_date FROM status s),
known AS (SELECT m.ks, m.mod_id, d.dev_name, m.mod_delivery_time, d.timedelivery
          FROM modification m JOIN device d ON d.dev_id = m.dev_id AND d.version_num = 1
          WHERE m.version_num = 1 AND d.ie_xml_id_dt IS NOT NULL AND m.ks IS NOT NULL),
judged AS (SELECT a.ks, a.old_status AS stock_status_old, a.new_status AS stock_status_new, k.mod_id,
                  k.dev_name || ': ' || k.mod_id AS mod_name,
                  CASE a.new_status
                    WHEN 0 THEN CASE WHEN k.mod_delivery_time IS NULL OR k.mod_delivery_time = '' THEN k.timedelivery ELSE k.mod_delivery_time END
                    WHEN 1 THEN 'Expected ' || COALESCE(strftime(a.expected_date, '%Y.%m.%d'), 'to stock')
                    ELSE 'In stock' END AS time_delivery,
                  CASE WHEN a.new_status = 2 THEN v.available_qty ELSE CAST(0 AS DECIMAL(18,2)) END AS qnt
           FROM asked a LEFT JOIN known k ON k.ks = a.ks LEFT JOIN availability v ON v.ks = a.ks)"""

# The movements after the changes, and the status that follows from those.
MOVED = """
stock_qty_now AS (SELECT * FROM stock_qty WHERE ks % 5 <> 1),
reserve_now AS (SELECT ks, CASE WHEN invoice_no % 7 = 2 THEN invoice_no + 1 ELSE invoice_no END AS invoice_no, reserved_qty, reserve_status, released_at FROM reserve),
incoming_reserve_now AS (SELECT * FROM incoming_reserve WHERE invoice_no % 7 <> 3),
payment_now AS (SELECT * FROM payment WHERE invoice_no % 6 <> 4),
purchase_order_now AS (SELECT order_no, supplier_code, cancelled, CASE WHEN order_no % 6 = 5 THEN done IS NOT TRUE ELSE done END AS done FROM purchase_order),
purchase_order_line_now AS (SELECT order_no, ks, qty, cancelled, done, invoice_no, received_at,
                                   CASE WHEN ks % 9 = 4 THEN expected_date + INTERVAL 30 DAY ELSE expected_date END AS expected_date FROM purchase_order_line)"""
MOVED_STATUS = re.sub(r"FROM (stock_qty|reserve|incoming_reserve|payment|purchase_order_line|purchase_order)\b", r"FROM \1_now", STATUS)

AFFECTED = """
hit AS (
  SELECT l.ks FROM invoice_line l WHERE l.invoice_no IN (
    SELECT CASE WHEN op = 'D' THEN old_invoice_no ELSE new_invoice_no END FROM payment_change
    UNION ALL SELECT old_invoice_no FROM payment_change WHERE op = 'U' AND new_invoice_no <> old_invoice_no)
  UNION SELECT CASE WHEN op = 'D' THEN old_ks ELSE new_ks END FROM reserve_change WHERE op <> 'U' OR touched
  UNION SELECT c.ks FROM order_line_change c JOIN purchase_order o ON o.order_no = c.order_no WHERE o.supplier_code NOT IN (3, 7))"""

CURRENT_MOD_ID = "(SELECT MAX(m.mod_id) FROM modification m WHERE m.ks = {0}.ks AND m.version_num = 1)"

HISTORY = """
latest AS (SELECT * FROM (SELECT s.*, ROW_NUMBER() OVER (PARTITION BY mod_id ORDER BY dt_sent DESC NULLS FIRST, id DESC) AS n
                          FROM stock_change s WHERE change_status = 1) WHERE n = 1),
candidate AS (SELECT DISTINCT mod_id, time_delivery, qnt FROM stock_change),
compared AS (SELECT c.mod_id, c.time_delivery, c.qnt, l.id AS sent_id,
                    CASE WHEN EXISTS (SELECT 1 FROM stock_change s WHERE s.mod_id = c.mod_id AND s.change_status = 0) THEN FALSE
                         WHEN l.id IS NULL THEN FALSE ELSE c.qnt = l.qnt AND c.time_delivery = l.time_delivery END AS equal
             FROM candidate c LEFT JOIN latest l ON l.mod_id = c.mod_id)"""

FOLDED = """
paired AS (SELECT id, mod_id, time_delivery, qnt, LAG(time_delivery) OVER w AS pt, LAG(qnt) OVER w AS pq
           FROM stock_change WINDOW w AS (PARTITION BY mod_id ORDER BY id)),
marked AS (SELECT *, NOT COALESCE(time_delivery = pt AND qnt = pq, FALSE) AS sent FROM paired),
runs AS (SELECT *, SUM(CASE WHEN sent THEN 1 ELSE 0 END) OVER (PARTITION BY mod_id ORDER BY id) AS run FROM marked)
SELECT id, mod_id, time_delivery, qnt, sent, ROW_NUMBER() OVER (PARTITION BY mod_id, run ORDER BY id) - 1 AS dbl_cnt FROM runs"""

ATTEMPT = """
attempt AS (SELECT id, retry_cnt, NULLIF(sent_result, 'ok updated') AS err FROM stock_change WHERE change_status = 0),
rated AS (SELECT *, COALESCE(
            strpos(err, 'client.') > 1 OR strpos(err, 'Error reading SSH protocol banner') > 1 OR strpos(err, 'Network is unreachable') > 1
            OR strpos(err, 'Unable to connect') > 1 OR strpos(err, 'timed out') > 1
            OR strpos(err, '503 Service Temporarily Unavailable') > 1 OR strpos(err, 'Connection re') > 1, FALSE) AS transient FROM attempt),
outcome AS (SELECT id, err,
                   CASE WHEN err IS NULL THEN 1 WHEN transient AND retry_cnt > 3 THEN 2 WHEN transient THEN id ELSE -1 END AS change_status,
                   CASE WHEN err IS NULL THEN retry_cnt WHEN transient THEN retry_cnt + 1 ELSE 0 END AS retry_cnt,
                   err IS NOT NULL AND transient AND retry_cnt <= 3 AS resend FROM rated)"""

RECORDS = """
width AS (SELECT exp_id, mod_csv, COUNT(DISTINCT bx_fld_name) AS n FROM export_field GROUP BY exp_id, mod_csv),
numbered AS (SELECT f.*, (ROW_NUMBER() OVER (PARTITION BY f.exp_id, f.mod_csv ORDER BY f.csv_id) - 1) // w.n AS rec
             FROM export_field f JOIN width w ON w.exp_id = f.exp_id AND w.mod_csv = f.mod_csv),
wide AS (SELECT exp_id, mod_csv, rec,
                MAX(CASE WHEN bx_fld_name = 'ip_prop109' THEN COALESCE(bx_fld_value, '') END) AS ip_prop109,
                MAX(bx_fld_value) FILTER (bx_fld_name = 'cv_price' AND regexp_full_match(bx_fld_value, '-?[0-9]+[.]?[0-9]*')) AS cv_price,
                MAX(CASE WHEN bx_fld_name = 'ip_prop110' THEN COALESCE(bx_fld_value, '') END) AS ip_prop110,
                MAX(CASE WHEN bx_fld_name = 'ic_code0' THEN COALESCE(bx_fld_value, '') END) AS ic_code0,
                MAX(CASE WHEN bx_fld_name = 'ic_group0' THEN COALESCE(bx_fld_value, '') END) AS ic_group0,
                TRY_CAST(MAX(CASE WHEN bx_fld_name = 'ie_sort' THEN COALESCE(bx_fld_value, '') END) AS INTEGER) AS ie_sort
         FROM numbered GROUP BY exp_id, mod_csv, rec)"""

STAGES = """
answer AS (
    SELECT l.exp_id, l.dev_id, l.exp_version_num, l.exp_creator, l.exp_site, l.exp_csv_status, l.exp_mod & 7 AS planned,
           d.dev_name, r.stage, r.returned_text, TRY_CAST(r.returned_text AS INTEGER) AS number, NULLIF(r.error, '') AS fault,
           CASE WHEN r.stage = 2 THEN d.ip_prop675 WHEN r.stage = 4 THEN d.ip_prop674 ELSE d.ie_xml_id END IS NULL AS fresh
    FROM export_log l
    JOIN device d ON d.dev_id = l.dev_id AND d.version_num = l.exp_version_num
    JOIN stage_result r ON r.exp_id = l.exp_id AND (l.exp_mod & r.stage) > 0
),
verdict AS (
    SELECT *, CASE WHEN fault IS NOT NULL THEN 'stage ' || stage || ' error=[' || fault || ']'
                   WHEN number IS NULL AND (fresh OR stage = 1 OR (stage = 4 AND planned IN (4, 6)))
                   THEN 'stage ' || stage || ' result=[' || COALESCE(returned_text, '') || ']' END AS complaint
    FROM answer
),
per_export AS (
    SELECT exp_id, any_value(dev_id) AS dev_id, any_value(exp_version_num) AS exp_version_num, any_value(exp_creator) AS exp_creator,
           any_value(exp_site) AS exp_site, any_value(exp_csv_status) AS exp_csv_status, any_value(dev_name) AS dev_name,
           any_value(planned) AS planned, SUM(DISTINCT stage) AS answered,
           arg_min(complaint, list_position([2, 4, 1], stage)) FILTER (complaint IS NOT NULL) AS complaint
    FROM verdict GROUP BY exp_id
),
judged AS (
    SELECT *, CASE WHEN complaint IS NOT NULL THEN FALSE WHEN answered = planned THEN TRUE END AS ok FROM per_export
),
export_outcome AS (
    SELECT exp_id, exp_creator, ok, CAST(IF(ok, COALESCE(exp_csv_status & 7, 0) | planned, exp_csv_status) AS INTEGER) AS exp_csv_status,
           IF(ok, 'Завершён экспорт модели ''' || dev_name || ''' на сайт ' || exp_site || ' (exp_id=' || exp_id || ')', complaint) AS exp_result,
           CASE WHEN ok THEN TIMESTAMP '2024-02-01 00:00:00' END AS exp_finish_dt
    FROM judged
)"""

BATCHES = """
judged_batch AS (SELECT batch_id AS id,
                   CASE WHEN price_info_err <> '' THEN -3 WHEN import_out <> '' THEN -2 WHEN import_err <> '' THEN -1 ELSE 1 END AS status,
                   import_err || CASE WHEN import_out <> '' THEN '/' || import_out ELSE '' END
                   || CASE WHEN price_info_err <> '' THEN '/' || price_info_err ELSE '' END AS problems FROM batch_result),
batch_outcome AS (SELECT b.id, b.who, j.status, j.problems = '' AS ok,
                    CASE WHEN j.problems = '' THEN 'Завершён пакетный экспорт' ELSE 'Ошибка пакетного экспорта' END AS exp_result,
                    CASE WHEN j.problems <> '' THEN 'Пакетный экспорт №' || CAST(b.id AS VARCHAR) || ' ''' || b.title || ''' от '
                         || strftime(b.dt_created, '%Y-%m-%d %H:%M:%S') || ' завершился с ошибкой:' || j.problems END AS article,
                    TIMESTAMP '2024-02-01 00:00:00' AS dt_finished
                  FROM judged_batch j JOIN export_batch b ON b.id = j.id)"""

PARAMETERS = """
used AS (SELECT dev_id, dev_param_id, BOOL_OR(version_num = 1) AS old, BOOL_OR(version_num = 2) AS new
         FROM mod_param WHERE version_num IN (1, 2) GROUP BY dev_id, dev_param_id)"""

MATCHES = PARAMETERS + """,
both_versions AS (SELECT dev_id, dev_param_id FROM used WHERE old AND new),
needed AS (SELECT dev_id, COUNT(*) AS n FROM both_versions GROUP BY dev_id),
old_mod AS (SELECT DISTINCT dev_id, mod_id FROM mod_param WHERE version_num = 1),
new_mod AS (SELECT DISTINCT dev_id, mod_id FROM mod_param WHERE version_num = 2),
agreeing AS (SELECT f.dev_id, f.mod_id AS old_id, t.mod_id AS new_id, COUNT(*) AS n
             FROM mod_param f JOIN both_versions s ON s.dev_id = f.dev_id AND s.dev_param_id = f.dev_param_id
             JOIN mod_param t ON t.dev_id = f.dev_id AND t.dev_param_id = f.dev_param_id AND t.version_num = 2 AND t.param_value = f.param_value
             WHERE f.version_num = 1 GROUP BY f.dev_id, f.mod_id, t.mod_id),
pair AS (SELECT o.dev_id, o.mod_id AS old_id, w.mod_id AS new_id
         FROM old_mod o JOIN new_mod w ON w.dev_id = o.dev_id
         LEFT JOIN needed k ON k.dev_id = o.dev_id
         LEFT JOIN agreeing a ON a.dev_id = o.dev_id AND a.old_id = o.mod_id AND a.new_id = w.mod_id
         WHERE COALESCE(a.n, 0) = COALESCE(k.n, 0)),
winner AS (SELECT MAX(old_id) AS mod_id_from, new_id AS mod_id_to FROM pair GROUP BY new_id)"""

OFF = """
on_shop AS (SELECT dev_id, dev_name, ie_xml_id, timedelivery FROM device WHERE version_num = 1 AND ie_xml_id IS NOT NULL),
off AS (SELECT o.dev_id, s.ie_xml_id, s.ie_name, s.ip_prop474, s.ip_prop657 FROM on_shop o JOIN site_device s USING (ie_xml_id) WHERE s.ie_active = FALSE),
listed AS (
    SELECT m.ks, m.mod_id, m.mod_price, concat(o.dev_name, ': ', m.mod_id) AS mod_name, o.ie_xml_id, ifnull(m.mod_delivery_time, o.timedelivery) AS own_term
    FROM on_shop o JOIN modification m USING (dev_id)
    WHERE m.version_num = 1 AND m.ks IS NOT NULL AND NOT EXISTS (FROM off WHERE off.dev_id = o.dev_id)
)"""

# The terms the shop may show for a stock status; the first one is the exact one.
TERMS = """CASE {0} WHEN 2 THEN ['In stock'] WHEN 1 THEN ['Expected ' || ifnull(strftime(expected_date, '%Y.%m.%d'), 'to stock'), 'Expected to stock'] ELSE [own_term] END"""

DELIVERY = STATUS + "," + OFF + """,
promise AS (SELECT ks, mod_name, """ + TERMS.format("clc") + """ AS terms FROM listed LEFT JOIN status USING (ks)),
delivery AS (
    SELECT ks, mod_name, terms[1] AS in_base, ip_prop110 AS on_site FROM promise JOIN site_price ON ie_name = mod_name
    WHERE terms[1] IS NOT NULL AND ip_prop110 IS NOT NULL AND NOT list_contains(terms, ip_prop110)
)"""

PRICES = """
quoted AS (
    SELECT ks, mod_name, price AS price_item, sell_price AS price_list, mod_price AS price_catalogue, cv_price AS price_site
    FROM listed JOIN content USING (ks) JOIN price_view USING (ks) LEFT JOIN site_price ON ie_name = mod_name
),
prices AS (SELECT * FROM quoted WHERE price_list <> price_item OR price_catalogue <> price_item OR price_site <> price_item)"""

SYNCED = """
synced AS (SELECT m.ks, d.dev_name, d.supplier_code, m.mod_id FROM modification m JOIN device d ON d.dev_id = m.dev_id AND d.version_num = m.version_num
           WHERE d.ie_xml_id IS NOT NULL AND d.ie_xml_id_dt IS NOT NULL AND m.ks IS NOT NULL AND m.version_num = 1)"""

ROUTED = """
parsed AS (SELECT seq, channel, payload, string_split(payload, '^') AS parts FROM notification),
routed AS (SELECT seq, channel, parts,
                  CASE WHEN channel IN ('do_compute_single', 'do_export') THEN TRY_CAST(payload AS BIGINT)
                       WHEN channel = 'do_expected' AND len(parts) = 3 THEN TRY_CAST(parts[3] AS BIGINT) END AS target_id FROM parsed)
SELECT seq, CASE WHEN target_id IS NULL THEN 'rejected' ELSE channel END AS route, target_id,
       CASE WHEN channel = 'do_expected' AND target_id IS NOT NULL THEN parts[1] END AS mod_id,
       CASE WHEN channel = 'do_expected' AND target_id IS NOT NULL THEN parts[2] END AS expected FROM routed"""

LAST_FIRM = """
last_firm AS (SELECT customer_code, firm FROM (
                SELECT customer_code, firm, ROW_NUMBER() OVER (PARTITION BY customer_code ORDER BY invoice_date DESC, invoice_no DESC) AS n
                FROM invoice WHERE invoice_date IS NOT NULL) WHERE n = 1)"""

COMPUTED = """
computed AS (SELECT id, ks, qnt FROM stock_change_update
             WHERE ks IS NOT NULL AND new_change_status = 0 AND old_dt_trans IS NULL AND new_dt_trans IS NOT NULL)"""


UNSYNCED = """WITH shop AS (SELECT DISTINCT ie_name AS dev_name, ie_active FROM site_device)
SELECT CASE WHEN s.ie_active IS NULL THEN 'Нет на сайте' WHEN d.ie_xml_id IS NULL THEN 'Не выгружен' ELSE 'Изменен, не выгружен' END AS export_state,
       d.dev_name_long, d.dev_name, d.arc_name, v.vendor_name AS site_vendor, c.company_name AS base_vendor,
       IF(d.mod_single, 'Да', 'Нет') AS single_mod, d.timedelivery, d.dm_discount_vendor, d.dm_discount_diler, d.basic_price_rur, d.dm_valuta
FROM site_vendor v JOIN device d USING (vendor_id) LEFT JOIN company c ON c.company_code = d.supplier_code LEFT JOIN shop s USING (dev_name)
WHERE d.version_num = 1 AND s.ie_active IS DISTINCT FROM FALSE AND (d.ie_xml_id IS NULL OR d.ie_xml_id_dt IS NULL)"""


def _wide(mode: int, columns: str) -> str:
    """The wide rows of one kind of export with the columns of its dictionary."""
    return f"""WITH {RECORDS},
about AS (SELECT l.exp_id, d.ie_xml_id, d.dev_name FROM device d JOIN export_log l ON (l.dev_id, l.exp_version_num) = (d.dev_id, d.version_num))
SELECT exp_id, rec, ie_xml_id, dev_name, {columns} FROM wide LEFT JOIN about USING (exp_id) WHERE mod_csv = {mode}"""


SQL: dict[str, str] = {
    "stock_status": f"WITH {STATUS} SELECT ks, cur, clc FROM status",
    "apply_status": f"""WITH {STATUS}
SELECT c.ks, CASE WHEN s.cur <> s.clc THEN CAST(s.clc AS BIGINT) ELSE c.stock_status END AS stock_status, c.price FROM content c JOIN status s ON s.ks = c.ks""",
    "transition_log": f"""WITH {STATUS}
SELECT CAST(ks AS VARCHAR) AS num, CAST(cur AS VARCHAR) || '->' || CAST(clc AS VARCHAR) AS operation, {AS_OF} AS dt FROM status""",
    "free_stock": f"WITH {MOVEMENTS} SELECT ks, CAST(q AS DECIMAL(18,4)) AS free_qty FROM wh",
    "paid_reserves": """SELECT r.ks, r.invoice_no, r.reserved_qty, r.reserve_status FROM reserve r
WHERE NOT r.reserve_status = 3 AND r.released_at IS NULL
  AND r.invoice_no IN (SELECT invoice_no FROM payment GROUP BY invoice_no HAVING SUM(CAST(amount AS DECIMAL(28,10))) > 0)""",
    "paid_incoming_reserves": """SELECT r.ks, r.invoice_no, r.reserved_qty FROM incoming_reserve r
WHERE r.released_at IS NULL
  AND r.invoice_no IN (SELECT invoice_no FROM payment GROUP BY invoice_no HAVING SUM(CAST(amount AS DECIMAL(28,10))) > 0)""",
    "open_purchase": f"WITH {MOVEMENTS} SELECT ks, CAST(q AS DECIMAL(18,4)) AS open_qty, expected_date FROM coming",
    "stock_totals": f"""WITH {MOVEMENTS},
keys AS (SELECT ks FROM wh UNION SELECT ks FROM held UNION SELECT ks FROM coming UNION SELECT ks FROM promised)
SELECT k.ks, CAST(COALESCE(wh.q, 0) - COALESCE(held.q, 0) AS DECIMAL(18,4)) AS on_hand,
       CAST(COALESCE(coming.q, 0) - COALESCE(promised.q, 0) AS DECIMAL(18,4)) AS on_order, coming.expected_date
FROM keys k LEFT JOIN wh ON wh.ks = k.ks LEFT JOIN held ON held.ks = k.ks LEFT JOIN coming ON coming.ks = k.ks LEFT JOIN promised ON promised.ks = k.ks""",
    "expected_date_label": f"""WITH {MOVEMENTS}
SELECT c.ks, 'Expected ' || COALESCE(strftime(o.expected_date, '%Y.%m.%d'), 'to stock') AS expected_label FROM content c LEFT JOIN coming o ON o.ks = c.ks""",
    "synced_modifications": f"WITH {SYNCED} SELECT ks, dev_name, supplier_code, mod_id FROM synced",
    "attach_item_code": """SELECT s.id, s.mod_id, (SELECT m.ks FROM modification m WHERE m.mod_id = s.mod_id AND m.version_num = 1) AS ks FROM stock_change s""",
    "attach_mod_id": f"SELECT s.id, s.ks, {CURRENT_MOD_ID.format('s')} AS mod_id FROM stock_change s",
    "default_delivery": """SELECT m.mod_id, CASE WHEN m.mod_delivery_time IS NULL OR m.mod_delivery_time = '' THEN
         CASE WHEN d.dev_id IS NULL THEN 'device not found' ELSE d.timedelivery END ELSE m.mod_delivery_time END AS time_delivery
FROM modification m LEFT JOIN device d ON d.dev_id = m.dev_id AND d.version_num = 1 WHERE m.version_num = 1""",
    "stock_change_records": f"""WITH {CHANGE_RECORDS}
SELECT ks, stock_status_old, stock_status_new, mod_id, mod_name, time_delivery, qnt, 0 AS change_status, 0 AS dbl_cnt, 0 AS retry_cnt, TRUE AS active
FROM judged WHERE mod_id IS NOT NULL AND time_delivery IS NOT NULL AND qnt IS NOT NULL""",
    "stock_change_rejects": f"""WITH {CHANGE_RECORDS}
SELECT ks, stock_status_new, CASE WHEN mod_id IS NULL THEN 'no exported modification' WHEN time_delivery IS NULL THEN 'no delivery term' ELSE 'no quantity' END AS reason
FROM judged WHERE mod_id IS NULL OR time_delivery IS NULL OR qnt IS NULL""",
    "site_update_messages": """SELECT id, mod_id, time_delivery, COALESCE(CAST(qnt AS VARCHAR), '') AS qnt, active IS NOT FALSE AS active, active IS FALSE AS deactivate
FROM stock_change WHERE change_status = 0""",
    "delivery_outcome": f"""WITH {ATTEMPT}
SELECT id, change_status, retry_cnt, COALESCE(err, 'prod.example updated') AS sent_result, {AS_OF} AS dt_sent, resend FROM outcome""",
    "expected_outcome": f"""WITH tried AS (
    SELECT id, retry_cnt, NULLIF(sent_result, 'ok updated') AS err,
           regexp_matches(substr(sent_result, 2), 'client[.]|Error reading SSH protocol banner|Network is unreachable|Unable to connect|timed out|503 Service Temporarily Unavailable|Connection re') AS passing
    FROM expected_shipment WHERE status = 0)
SELECT id, CASE WHEN err IS NULL THEN 1 WHEN NOT passing THEN -1 WHEN retry_cnt > 3 THEN 2 ELSE id END AS status,
       CASE WHEN err IS NULL THEN retry_cnt WHEN passing THEN retry_cnt + 1 ELSE 0 END AS retry_cnt,
       COALESCE(err, 'prod.example updated') AS sent_result, {AS_OF} AS dt_sent, err IS NOT NULL AND passing AND retry_cnt <= 3 AS resend
FROM tried""",
    "changed_rows": f"""WITH {COMPUTED}
SELECT 'stock_status' AS kind, ks AS key FROM content_change WHERE new_status <> old_status OR old_status IS NULL
UNION ALL SELECT 'computed', id FROM computed
UNION ALL SELECT 'batch_start', id FROM export_batch WHERE status = 10
UNION ALL SELECT 'export_start', exp_id FROM export_log_change WHERE old_exp_status <> new_exp_status AND new_exp_status = 1""",
    "last_sent": f"""WITH {HISTORY}
SELECT id, dt_change, change_status, dt_sent, sent_result, ks, mod_id, time_delivery, qnt, dt_trans, dbl_cnt, retry_cnt, active FROM latest""",
    "equals_last_sent": f"WITH {HISTORY} SELECT mod_id, time_delivery, qnt, equal FROM compared",
    "count_duplicates": f"""WITH {HISTORY}
SELECT s.id, s.mod_id, s.dbl_cnt + (SELECT COUNT(*) FROM compared c WHERE c.equal AND c.sent_id = s.id) AS dbl_cnt FROM stock_change s""",
    "supersede_pending": """SELECT s.id, s.mod_id, CASE WHEN s.change_status = 0 AND EXISTS (SELECT 1 FROM stock_change n WHERE n.mod_id = s.mod_id AND n.id > s.id)
       THEN -2 ELSE s.change_status END AS change_status FROM stock_change s""",
    "suppress_repeats": f"WITH {FOLDED}",
    "stream_dedupe": f"WITH {FOLDED}",
    "resend_changes": "SELECT id, 'do_compute_single' AS channel, CAST(id AS VARCHAR) AS payload FROM stock_change WHERE change_status = 5",
    "resend_changes_in_full": """SELECT id, 'do_single' AS channel,
       concat_ws('^', mod_id, time_delivery, CAST(id AS VARCHAR), COALESCE(CAST(qnt AS VARCHAR), '')) AS payload FROM stock_change WHERE change_status = 5""",
    "resend_expected": f"""WITH linked AS (SELECT e.*, {CURRENT_MOD_ID.format('e')} AS mod_id FROM expected_shipment e WHERE e.status = 2)
SELECT id, 'do_expected' AS channel, concat_ws('^', mod_id, expected, CAST(id AS VARCHAR)) AS payload FROM linked WHERE mod_id IS NOT NULL""",
    "new_change_messages": "SELECT id, 'do_compute_single' AS channel, CAST(id AS VARCHAR) AS payload FROM stock_change",
    "new_expected_messages": f"""WITH linked AS (SELECT e.*, {CURRENT_MOD_ID.format('e')} AS mod_id FROM expected_shipment e)
SELECT id, 'do_expected' AS channel, mod_id || '^' || expected || '^' || CAST(id AS VARCHAR) AS payload FROM linked""",
    "format_payloads": f"""WITH linked AS (SELECT e.*, {CURRENT_MOD_ID.format('e')} AS mod_id FROM expected_shipment e)
SELECT id, mod_id || '^' || expected || '^' || CAST(id AS VARCHAR) AS propagate, concat_ws('^', mod_id, expected, CAST(id AS VARCHAR)) AS skip,
       COALESCE(mod_id, '') || '^' || COALESCE(expected, '') || '^' || CAST(id AS VARCHAR) AS blank FROM linked""",
    "pack_list_changes": f"WITH {COMPUTED} SELECT c.id, c.ks, c.qnt FROM computed c WHERE EXISTS (SELECT 1 FROM pack_list p WHERE p.ks = c.ks)",
    "pack_change_events": f"""WITH {COMPUTED},
pushed AS (SELECT ks, dt_sent FROM (SELECT ks, dt_sent, ROW_NUMBER() OVER (PARTITION BY ks ORDER BY id DESC) AS n FROM pack_change WHERE change_status = 99) WHERE n = 1),
timed AS (SELECT c.id, c.ks, c.qnt, a.pack_qty, CAST(ROUND(epoch_us({AS_OF}) / 1000000.0 - epoch_us(p.dt_sent) / 1000000.0) AS BIGINT) AS elapsed
          FROM computed c JOIN pack_list l ON l.ks = c.ks LEFT JOIN availability a ON a.ks = c.ks LEFT JOIN pushed p ON p.ks = c.ks)
SELECT id, id AS ssc_id, ks, qnt AS qnt_ssc, pack_qty AS qnt_calc, elapsed,
       CAST(ks AS VARCHAR) || '^' || COALESCE(CAST(pack_qty AS VARCHAR), '') || '^' || CAST(id AS VARCHAR) || '^' || COALESCE(CAST(elapsed AS VARCHAR), '') AS payload
FROM timed""",
    "route_notifications": f"WITH {ROUTED}",
    "stream_change_feed": "SELECT op, COALESCE(new_invoice_no, old_invoice_no) AS seq, old_invoice_no, new_invoice_no FROM payment_change",
    "stream_route_notifications": f"WITH {ROUTED}",
    "snapshot_changes": """WITH paired AS (
    SELECT COALESCE(a.payment_id, b.payment_id) AS payment_id, b.payment_id IS NULL AS came, a.payment_id IS NULL AS went,
           b.invoice_no AS old_invoice_no, a.invoice_no AS new_invoice_no, b.amount AS old_amount, a.amount AS new_amount
    FROM payment_before b FULL JOIN payment_after a ON a.payment_id = b.payment_id)
SELECT CASE WHEN came THEN 'I' WHEN went THEN 'D' ELSE 'U' END AS op, CAST(1 AS BIGINT) AS seq, payment_id, old_invoice_no, new_invoice_no, old_amount, new_amount
FROM paired WHERE came OR went OR old_invoice_no IS DISTINCT FROM new_invoice_no OR old_amount IS DISTINCT FROM new_amount""",
    "snapshot_rejects": """WITH b AS (SELECT invoice_no, COUNT(*) AS n FROM payment_before GROUP BY invoice_no),
a AS (SELECT invoice_no, COUNT(*) AS n FROM payment_after GROUP BY invoice_no)
SELECT invoice_no, COALESCE(b.n, 0) AS rows_before, COALESCE(a.n, 0) AS rows_after, 'repeated key' AS reason
FROM b FULL JOIN a USING (invoice_no) WHERE a.n > 1 OR b.n > 1""",
    "affected_by_snapshots": """WITH differing AS (
    SELECT payment_id FROM (SELECT * FROM payment_before EXCEPT SELECT * FROM payment_after) UNION
    SELECT payment_id FROM (SELECT * FROM payment_after EXCEPT SELECT * FROM payment_before)),
invoices AS (SELECT invoice_no FROM payment_after WHERE payment_id IN (SELECT payment_id FROM differing) UNION
             SELECT invoice_no FROM payment_before WHERE payment_id IN (SELECT payment_id FROM differing))
SELECT DISTINCT ks FROM invoice_line WHERE invoice_no IN (SELECT invoice_no FROM invoices)""",
    "affected_by_payments": """SELECT DISTINCT l.ks FROM invoice_line l JOIN payment_change c
  ON l.invoice_no = CASE WHEN c.op = 'D' THEN c.old_invoice_no ELSE c.new_invoice_no END OR (c.op = 'U' AND c.new_invoice_no <> c.old_invoice_no AND l.invoice_no = c.old_invoice_no)""",
    "affected_by_payments_indexed": """SELECT DISTINCT l.ks FROM invoice_line l JOIN payment_change c
  ON l.invoice_no = CASE WHEN c.op = 'D' THEN c.old_invoice_no ELSE c.new_invoice_no END OR (c.op = 'U' AND c.new_invoice_no <> c.old_invoice_no AND l.invoice_no = c.old_invoice_no)""",
    "affected_by_reserves": """SELECT DISTINCT CASE WHEN op = 'D' THEN old_ks ELSE new_ks END AS ks FROM reserve_change WHERE op <> 'U' OR touched""",
    "affected_by_orders": """SELECT DISTINCT c.ks FROM order_line_change c JOIN purchase_order o ON o.order_no = c.order_no WHERE o.supplier_code NOT IN (3, 7)""",
    "maintained_totals": f"WITH {MOVED}, {MOVED_STATUS} SELECT ks, cur, clc, CAST(expected_date AS TIMESTAMP) AS expected_date FROM status",
    "recompute_status": f"WITH {STATUS}, {AFFECTED} SELECT h.ks, s.cur, s.clc FROM hit h LEFT JOIN status s ON s.ks = h.ks",
    "stream_recompute": f"WITH {STATUS}, {AFFECTED} SELECT h.ks, s.cur, s.clc FROM hit h LEFT JOIN status s ON s.ks = h.ks",
    "stream_recompute_changes": f"""WITH {CHANGE_RECORDS}, {AFFECTED}
SELECT ks, stock_status_old, stock_status_new, mod_id, time_delivery, qnt FROM judged
WHERE ks IN (SELECT ks FROM hit) AND stock_status_new <> COALESCE(stock_status_old, -1) AND mod_id || time_delivery || qnt IS NOT NULL""",
    "recompute_changes": f"""WITH {CHANGE_RECORDS}, {AFFECTED}
SELECT j.ks, j.stock_status_old, j.stock_status_new, j.mod_id, j.time_delivery, j.qnt FROM judged j JOIN hit h ON h.ks = j.ks
WHERE COALESCE(j.stock_status_old, -1) <> j.stock_status_new AND j.mod_id IS NOT NULL AND j.time_delivery IS NOT NULL AND j.qnt IS NOT NULL""",
    "field_counts": "SELECT exp_id, mod_csv, COUNT(DISTINCT bx_fld_name) AS field_count FROM export_field GROUP BY exp_id, mod_csv",
    "chunk_records": f"WITH {RECORDS} SELECT exp_id, mod_csv, csv_id, bx_fld_name, bx_fld_value, rec FROM numbered",
    "to_wide": f"WITH {RECORDS} SELECT exp_id, mod_csv, rec, ip_prop109, cv_price, ip_prop110, ic_code0, ic_group0, ie_sort FROM wide",
    "to_wide_rejects": f"""WITH {RECORDS},
given AS (SELECT exp_id, mod_csv, rec, MAX(bx_fld_value) AS value FROM numbered WHERE bx_fld_name = 'cv_price' GROUP BY exp_id, mod_csv, rec)
SELECT exp_id, mod_csv, rec, 'cv_price' AS field, value FROM given
WHERE TRIM(value) <> '' AND NOT regexp_full_match(value, '-?[0-9]+[.]?[0-9]*')""",
    "export_wide_device": _wide(1, "ic_group0, TRY_CAST(ip_prop109 AS BIGINT) AS ip_prop109, TRY_CAST(cv_price AS DECIMAL(18,2)) AS cv_price"),
    "export_wide_modificators": _wide(2, "ic_code0, ie_sort, ip_prop110"),
    "export_wide_prices": _wide(4, "ip_prop109, cv_price, ip_prop110, ic_code0, ic_group0, ie_sort"),
    "caret_csv_roundtrip": _wide(4, "ip_prop109, cv_price, ip_prop110, ic_code0, ic_group0, ie_sort"),
    "batch_prices": f"""WITH {RECORDS}
SELECT l.exp_batch_id, w.exp_id, w.rec, w.ip_prop109, w.cv_price, w.ip_prop110, w.ie_sort
FROM wide w JOIN export_log l ON l.exp_id = w.exp_id JOIN export_batch b ON b.id = l.exp_batch_id
WHERE w.mod_csv = 4 AND l.exp_status = 0 AND b.status = 10""",
    "export_plan": """WITH step AS (SELECT 0 AS ord, 2 AS stage UNION ALL SELECT 1, 4 UNION ALL SELECT 2, 1),
planned AS (SELECT l.exp_id, s.ord, s.stage, CASE s.stage WHEN 2 THEN d.ip_prop675 WHEN 4 THEN d.ip_prop674 ELSE d.ie_xml_id END IS NULL AS is_new
            FROM export_log l JOIN device d ON d.dev_id = l.dev_id AND d.version_num = l.exp_version_num JOIN step s ON ((l.exp_mod & 7) & s.stage) = s.stage)
SELECT p.exp_id, CAST(ROW_NUMBER() OVER (PARTITION BY p.exp_id ORDER BY p.ord) - 1 AS INTEGER) AS stage_pos, p.stage, p.is_new,
       (SELECT i.ie_param_value FROM import_param i WHERE i.ie_param_name = 'csv_file' AND i.brand_new = p.is_new AND i.imp_mode = p.stage) AS csv_file,
       (SELECT i.ie_param_value FROM import_param i WHERE i.ie_param_name = 'import_profile' AND i.brand_new = p.is_new AND i.imp_mode = p.stage) AS import_profile
FROM planned p""",
    "validate_exports": """SELECT l.exp_id, CASE WHEN l.exp_version_num <> 1 AND l.exp_site = 'prod.example' THEN 'production takes version 1 only'
       WHEN l.exp_version_num > 1 AND l.exp_site = 'dev.example' THEN 'development site takes no archive'
       WHEN NOT EXISTS (SELECT 1 FROM device d WHERE d.dev_id = l.dev_id AND d.version_num = l.exp_version_num) THEN 'no device' ELSE 'ok' END AS rule
FROM export_log l""",
    "guard_export_changes": """WITH looked AS (SELECT c.*, d.dev_id AS found, d.ie_xml_id,
    c.old_exp_mod = c.old_csv_status AND c.old_site = 'prod.example' AND c.old_exp_status >= 1 AS archived
  FROM export_log_change c LEFT JOIN device d ON d.dev_id = c.dev_id AND d.version_num = c.new_version_num),
ruled AS (SELECT *, CASE WHEN archived THEN CASE WHEN old_exp_status = 1 AND new_version_num > 1 THEN 'archiving allowed' ELSE 'archive locked' END
                         WHEN found IS NULL THEN 'no device'
                         WHEN ie_xml_id IS NULL AND new_exp_mod IN (1, 7) THEN 'ok' WHEN ie_xml_id IS NOT NULL AND new_exp_mod IN (1, 4, 6, 7) THEN 'ok'
                         ELSE 'mode not supported' END AS verdict FROM looked)
SELECT exp_id, verdict, verdict IN ('ok', 'archiving allowed') AND old_exp_status <> new_exp_status AND new_exp_status = 1 AS starts_export FROM ruled""",
    "guard_synced_fields": """SELECT dev_id, 'Попытка обновить версию не ''в разработке'' '
  || chr(10) || 'ie_xml_id(OLD/NEW)=' || COALESCE(CAST(old_ie_xml_id AS VARCHAR), 'NULL') || '/' || COALESCE(CAST(new_ie_xml_id AS VARCHAR), 'NULL')
  || chr(10) || 'ie_xml_id_dt(OLD/NEW)=' || COALESCE(old_ie_xml_id_dt, 'NULL') || '/' || COALESCE(new_ie_xml_id_dt, 'NULL')
  || chr(10) || 'ip_prop674(OLD/NEW)=' || COALESCE(CAST(old_ip_prop674 AS VARCHAR), 'NULL') || '/' || COALESCE(CAST(new_ip_prop674 AS VARCHAR), 'NULL')
  || chr(10) || 'ip_prop675(OLD/NEW)=' || COALESCE(CAST(old_ip_prop675 AS VARCHAR), 'NULL') || '/' || COALESCE(CAST(new_ip_prop675 AS VARCHAR), 'NULL') AS message
FROM device_change
WHERE old_version_num > 0 AND (old_ie_xml_id IS NOT NULL OR old_ip_prop674 IS NOT NULL OR old_ip_prop675 IS NOT NULL)
  AND (old_ie_xml_id IS DISTINCT FROM new_ie_xml_id OR old_ip_prop674 IS DISTINCT FROM new_ip_prop674 OR old_ip_prop675 IS DISTINCT FROM new_ip_prop675)""",
    "apply_export_outcome": f"WITH {STAGES} SELECT exp_id, exp_creator, ok, exp_csv_status, exp_result, exp_finish_dt FROM export_outcome",
    "unfinished_exports": f"""WITH {STAGES},
reply AS (SELECT exp_id, CAST(SUM(DISTINCT stage) AS INTEGER) AS answered, COUNT(complaint) > 0 AS failed FROM verdict GROUP BY exp_id)
SELECT l.exp_id, l.exp_creator, l.exp_site, l.exp_dt, COALESCE(r.answered, 0) AS answered,
       CAST((l.exp_mod & 7) - COALESCE(r.answered, 0) AS INTEGER) AS missing,
       COALESCE(l.exp_dt <= TIMESTAMP '1997-12-31 00:00:00', FALSE) AS expired
FROM export_log l LEFT JOIN reply r ON r.exp_id = l.exp_id
WHERE NOT COALESCE(r.failed, FALSE) AND (l.exp_mod & 7) <> COALESCE(r.answered, 0)""",
    "apply_export_outcome_devices": f"""WITH {STAGES},
written AS (SELECT v.* FROM verdict v WHERE v.exp_id IN (SELECT exp_id FROM export_outcome WHERE ok)),
changed AS (
    SELECT dev_id, exp_version_num AS version_num, list(DISTINCT stage) AS stages,
           arg_min(number, exp_id) FILTER (stage = 1 AND fresh AND number IS NOT NULL) AS n1,
           arg_min(number, exp_id) FILTER (stage = 2 AND fresh AND number IS NOT NULL) AS n2,
           arg_min(number, exp_id) FILTER (stage = 4 AND fresh AND number IS NOT NULL) AS n4
    FROM written GROUP BY dev_id, exp_version_num
)
SELECT dev_id, version_num, COALESCE(d.ie_xml_id, n1) AS ie_xml_id, COALESCE(d.ip_prop674, n4) AS ip_prop674, COALESCE(d.ip_prop675, n2) AS ip_prop675,
       IF(list_contains(stages, 1), {AS_OF}, d.ie_xml_id_dt) AS ie_xml_id_dt, IF(list_contains(stages, 4), {AS_OF}, d.ip_prop674_dt) AS ip_prop674_dt,
       IF(list_contains(stages, 2), {AS_OF}, d.ip_prop675_dt) AS ip_prop675_dt
FROM changed JOIN device d USING (dev_id, version_num)""",
    "apply_batch_outcome": f"WITH {BATCHES} SELECT id, who, status, ok, exp_result, article, dt_finished FROM batch_outcome",
    "apply_batch_outcome_exports": f"""WITH {BATCHES}
SELECT l.exp_id, l.exp_mod AS exp_csv_status, b.status AS exp_status,
       CASE WHEN b.ok THEN 'Завершён экспорт в составе пакета batch_id=' ELSE 'Ошибка экспорта в составе пакета batch_id=' END || CAST(b.id AS VARCHAR) AS exp_result,
       {AS_OF} AS exp_finish_dt
FROM export_log l JOIN batch_outcome b ON b.id = l.exp_batch_id""",
    "apply_batch_outcome_devices": f"""SELECT d.dev_id, d.version_num, {AS_OF} AS ie_xml_id_dt, {AS_OF} AS ip_prop674_dt FROM device d
WHERE EXISTS (SELECT 1 FROM export_log l JOIN batch_result b ON b.batch_id = l.exp_batch_id WHERE l.dev_id = d.dev_id AND l.exp_version_num = d.version_num)""",
    "outcome_notices": f"""WITH {STAGES}, {BATCHES}
SELECT 'export:' || CAST(exp_id AS VARCHAR) AS notice_id, exp_creator AS recipient,
       CASE WHEN ok THEN exp_result ELSE 'exp_id=' || CAST(exp_id AS VARCHAR) || '/' || exp_result END AS notice, ok AS is_read FROM export_outcome WHERE ok IS NOT NULL
UNION ALL SELECT 'batch:' || CAST(id AS VARCHAR), who, article, FALSE FROM batch_outcome WHERE NOT ok
UNION ALL SELECT 'batch:' || CAST(id AS VARCHAR), CAST(124 AS BIGINT), article, FALSE FROM batch_outcome WHERE NOT ok AND who <> 124""",
    "shared_parameters": f"""WITH {PARAMETERS}
SELECT dev_id, COALESCE(string_agg(CAST(dev_param_id AS VARCHAR), ',' ORDER BY dev_param_id) FILTER (WHERE old), '') AS params_from,
       COALESCE(string_agg(CAST(dev_param_id AS VARCHAR), ',' ORDER BY dev_param_id) FILTER (WHERE new), '') AS params_to,
       COALESCE(string_agg(CAST(dev_param_id AS VARCHAR), ',' ORDER BY dev_param_id) FILTER (WHERE old AND new), '') AS shared,
       CASE WHEN BOOL_AND(old AND new) THEN 1 WHEN BOOL_AND(new) OR BOOL_AND(old) THEN 3 ELSE 2 END AS relation
FROM used GROUP BY dev_id""",
    "match_groups": f"""WITH {PARAMETERS},
members AS (
    SELECT p.dev_id, p.version_num, p.mod_id, COUNT(*) FILTER (u.old AND u.new AND p.param_value IS NOT NULL) AS n,
           COALESCE(string_agg(p.dev_param_id || '=' || p.param_value, ';' ORDER BY p.dev_param_id) FILTER (u.old AND u.new), '') AS group_key
    FROM mod_param p JOIN used u USING (dev_id, dev_param_id) WHERE p.version_num IN (1, 2) GROUP BY 1, 2, 3
),
agreed AS (SELECT dev_id, COUNT(*) FILTER (old AND new) AS n FROM used GROUP BY dev_id),
keyed AS (SELECT m.dev_id, m.version_num, m.mod_id, CASE WHEN m.n = a.n THEN m.group_key END AS group_key FROM members m JOIN agreed a USING (dev_id))
SELECT dev_id, group_key, version_num, mod_id,
       group_key IS NOT NULL AND COUNT(DISTINCT version_num) OVER (PARTITION BY dev_id, group_key) = 2 AS matched FROM keyed""",
    "match_versions": f"""WITH {MATCHES}
SELECT o.dev_id, o.mod_id AS mod_id_from, p.new_id AS mod_id_to FROM old_mod o LEFT JOIN pair p ON p.dev_id = o.dev_id AND p.old_id = o.mod_id""",
    "winning_matches": f"WITH {MATCHES} SELECT mod_id_from, mod_id_to FROM winner",
    "carry_prices": f"""WITH {MATCHES}
SELECT t.mod_id, t.dev_id, t.version_num, t.ks, f.mod_price, f.mod_delivery_time, f.dm_valuta, f.dm_kurs, f.dm_koef, f.price_base, f.vendor_art_id, f.mod_id AS mod_id_prev
FROM modification t JOIN winner w ON w.mod_id_to = t.mod_id JOIN modification f ON f.mod_id = w.mod_id_from AND f.version_num = 1 WHERE t.version_num = 2""",
    "exclude_inactive": f"WITH {OFF} SELECT mod_id, dev_id FROM modification ANTI JOIN off USING (dev_id) WHERE version_num = 1",
    "inactive_synced": f"WITH {OFF} SELECT ie_xml_id AS id, ip_prop474 AS title, ie_name AS model, ip_prop657 AS changed FROM off",
    "compare_delivery_by_name": f"WITH {DELIVERY} SELECT ks, mod_name, in_base, on_site FROM delivery",
    "compare_delivery_by_key": f"""WITH {STATUS}, {OFF},
stored AS (
    SELECT ks, mod_id, mod_name, ie_xml_id, {TERMS.format('stock_status')} AS terms
    FROM listed JOIN content USING (ks) LEFT JOIN coming USING (ks)
),
shown AS (
    SELECT p.ip_prop109, p.ie_name, p.ip_prop110, s.ie_xml_id FROM site_price p JOIN site_device s ON s.ip_prop674 = p.ic_xml_id0
)
SELECT ks, mod_name, ie_name, terms[1] AS in_base, ip_prop110 AS on_site
FROM stored JOIN shown ON shown.ie_xml_id = stored.ie_xml_id AND ip_prop109 = TRY_CAST(mod_id AS HUGEINT)
WHERE terms[1] IS NOT NULL AND ip_prop110 IS NOT NULL AND NOT list_contains(terms, ip_prop110)""",
    "compare_price": f"WITH {OFF}, {PRICES} SELECT ks, mod_name, price_item, price_list, price_catalogue, price_site FROM prices",
    "distinct_site_devices": "SELECT ie_name, ie_active FROM site_device GROUP BY ie_name, ie_active",
    "unsynced_devices": UNSYNCED,
    "unsynced_devices_loaded": UNSYNCED.replace("d.dm_valuta", "CAST(d.dm_valuta AS INTEGER) AS dm_valuta"),
    "latest_invoice_firm": f"WITH {LAST_FIRM} SELECT customer_code, firm FROM last_firm",
    "issuing_firm": f"""WITH {LAST_FIRM},
chosen AS (SELECT f.customer_code, CASE WHEN f.customer_code = 5 THEN 'FIRM_S' WHEN EXISTS (SELECT 1 FROM dealer d WHERE d.customer_code = f.customer_code) THEN 'FIRM_D'
             WHEN f.vendor_flag THEN 'FIRM_V' ELSE COALESCE(l.firm, 'FIRM_E') END AS firm FROM customer_flag f LEFT JOIN last_firm l ON l.customer_code = f.customer_code)
SELECT customer_code, CASE firm WHEN 'FIRM_OLD' THEN 'FIRM_E' ELSE firm END AS firm FROM chosen""",
    "unbilled_order_items": f"""WITH {SYNCED},
items AS (SELECT i.order_no, i.dt_insert, split_part(i.item_name, ':', 1) AS model, NULLIF(regexp_extract(i.item_name, ': *?([0-9]+)$', 1), '') AS site_mod_id
          FROM site_order_item i WHERE i.order_no IN (SELECT o.order_no FROM site_order o WHERE o.billcreated = 2 AND o.dt_insert > TIMESTAMP '2001-07-02 00:00:00' - INTERVAL 1 DAY))
SELECT i.order_no, i.dt_insert, i.model, i.site_mod_id, s.mod_id FROM items i LEFT JOIN synced s ON s.mod_id = i.site_mod_id ORDER BY i.order_no""",
    "log_with_changes": """SELECT l.id AS log_id, l.descript, l.operation, l.dt AS log_dt, s.id, s.ks, s.dt_change, s.change_status, s.time_delivery, s.qnt
FROM log_entry l JOIN stock_change s ON TRY_CAST(l.num AS BIGINT) = s.ks WHERE l.descript LIKE '%TX-40%'""",
    "log_groups": """WITH log AS (SELECT TRY_CAST(num AS BIGINT) AS ks, id FROM log_entry WHERE descript LIKE '%TX-40%'),
both_sides AS (SELECT l.ks, l.n AS n_log, s.n AS n_changes FROM (SELECT ks, COUNT(*) AS n FROM log GROUP BY ks) l
               JOIN (SELECT ks, COUNT(*) AS n FROM stock_change GROUP BY ks) s ON s.ks = l.ks)
SELECT g.ks, 'log' AS kind, l.id, CAST(FLOOR(l.id / 64) AS BIGINT) AS slice, n_log, n_changes FROM both_sides g JOIN log l ON l.ks = g.ks
UNION ALL SELECT g.ks, 'change', s.id, CAST(FLOOR(s.id / 64) AS BIGINT), n_log, n_changes FROM both_sides g JOIN stock_change s ON s.ks = g.ks""",
    "log_with_newest_changes": """SELECT l.id AS log_id, l.descript, l.operation, l.dt AS log_dt, CAST(s.position AS INTEGER) AS position,
       s.id, s.ks, s.dt_change, s.change_status, s.time_delivery, s.qnt
FROM log_entry l JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY ks ORDER BY dt_change DESC NULLS LAST, id DESC) AS position FROM stock_change) s
  ON TRY_CAST(l.num AS BIGINT) = s.ks AND s.position <= 3 WHERE l.descript LIKE '%TX-40%'""",
    "sync_report": f"""WITH {DELIVERY}, {PRICES}
SELECT 'inactive' AS kind, CAST(ie_xml_id AS VARCHAR) AS key, 'active' AS expected, 'switched off' AS actual FROM off
UNION ALL SELECT 'delivery', CAST(ks AS VARCHAR), in_base, on_site FROM delivery
UNION ALL SELECT 'price', CAST(ks AS VARCHAR), CAST(price_item AS VARCHAR), CAST(price_site AS VARCHAR) FROM prices
UNION ALL SELECT 'send', CAST(id AS VARCHAR), time_delivery, sent_result FROM stock_change WHERE change_status = 2""",
    "check_constraints": """SELECT 'export_field.pk' AS rule, CAST(csv_id AS VARCHAR) AS key, CAST(COUNT(*) AS VARCHAR) || ' rows' AS detail FROM export_field GROUP BY csv_id HAVING COUNT(*) > 1
UNION ALL SELECT 'export_field.name', concat_ws('|', CAST(exp_id AS VARCHAR), CAST(mod_csv AS VARCHAR), bx_fld_name), CAST(COUNT(*) AS VARCHAR) || ' rows'
          FROM export_field WHERE mod_csv IN (1, 2) GROUP BY exp_id, mod_csv, bx_fld_name HAVING COUNT(*) > 1
UNION ALL SELECT 'export_field.exp_id', CAST(exp_id AS VARCHAR), CAST(COUNT(*) AS VARCHAR) || ' orphans' FROM export_field WHERE exp_id NOT IN (SELECT exp_id FROM export_log) GROUP BY exp_id
UNION ALL SELECT 'export_field.bx_fld_name', CAST(csv_id AS VARCHAR), 'bx_fld_name has ' || CAST(length(bx_fld_name) AS VARCHAR) || ' characters' FROM export_field WHERE length(bx_fld_name) > 15
UNION ALL SELECT 'export_field.bx_fld_value', CAST(csv_id AS VARCHAR), 'bx_fld_value has ' || CAST(length(bx_fld_value) AS VARCHAR) || ' characters' FROM export_field WHERE length(bx_fld_value) > 4096
UNION ALL SELECT 'export_field.dictionary', CAST(csv_id AS VARCHAR), 'unknown ' || bx_fld_name FROM export_field WHERE bx_fld_name NOT IN (SELECT dict_name FROM export_dict)
UNION ALL SELECT 'site_price.section', CAST(ic_xml_id0 AS VARCHAR), CAST(COUNT(*) AS VARCHAR) || ' orphans' FROM site_price WHERE ic_xml_id0 NOT IN (SELECT ip_prop674 FROM site_device) GROUP BY ic_xml_id0
UNION ALL SELECT 'stock_change.active', CAST(id AS VARCHAR), 'active is missing' FROM stock_change WHERE active IS NULL
UNION ALL SELECT 'stock_change.qnt', CAST(id AS VARCHAR), 'qnt is missing' FROM stock_change WHERE qnt IS NULL
UNION ALL SELECT 'stock_change.time_delivery', CAST(id AS VARCHAR), 'time_delivery is missing' FROM stock_change WHERE time_delivery IS NULL
UNION ALL SELECT 'stock_change.dbl_cnt', CAST(id AS VARCHAR), 'dbl_cnt is missing' FROM stock_change WHERE dbl_cnt IS NULL
UNION ALL SELECT 'stock_change.retry_cnt', CAST(id AS VARCHAR), 'retry_cnt is missing' FROM stock_change WHERE retry_cnt IS NULL
UNION ALL SELECT 'stock_change.pk', CAST(id AS VARCHAR), CAST(COUNT(*) AS VARCHAR) || ' rows' FROM stock_change GROUP BY id HAVING COUNT(*) > 1""",
    "cascade_delete": "SELECT f.exp_id, f.csv_id, f.mod_csv, f.bx_fld_name, f.bx_fld_value FROM export_field f WHERE NOT EXISTS (SELECT 1 FROM export_log l WHERE l.exp_id = f.exp_id AND l.exp_status = 2)",
    "stream_retry": f"""WITH {ATTEMPT}
SELECT id, 'outcome' AS event, change_status, retry_cnt, resend FROM outcome
UNION ALL SELECT id, 'resend', change_status, retry_cnt, resend FROM outcome WHERE resend""",
}


def oracles() -> dict[str, str]:
    """Each text with the views it reads in front."""
    return {name: with_views(text, *sorted(set(_SOURCES.findall(text)) & VIEWS.keys())) for name, text in SQL.items()}
