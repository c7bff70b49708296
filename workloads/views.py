"""Domain views over the driver's tables.

One SQL text per view, valid in Spark and in DuckDB; ``{table}`` names a base table, ``{*list}`` a
short list that every base row is repeated for. Every view reads its whole base table;
where a view keeps some of the rows, that is what makes them its members (returned lines, large
parts, the parameters that tell two versions apart), and not a way to make a query cheaper. The Spark side turns a text into a DataFrame, the SQL side into a CTE.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.sources.change_feed import MAX_BYTES_PER_TRIGGER

VIEWS: dict[str, str] = {
    "device": """
SELECT p.p_partkey AS dev_id, v.version_num, p.p_name || ' ' || CAST(p.p_partkey AS VARCHAR(20)) AS dev_name,
       p.p_type AS dev_name_long, p.p_brand AS arc_name, p.p_partkey % 10 AS vendor_id,
       CASE WHEN p.p_partkey % 9 = 0 THEN NULL ELSE p.p_partkey % 150 END AS supplier_code,
       CASE WHEN p.p_partkey % 5 = 0 THEN NULL ELSE CAST(p.p_size AS VARCHAR(20)) || ' days' END AS timedelivery,
       CASE WHEN p.p_partkey % 28 = 12 THEN NULL ELSE 100000 + p.p_partkey END AS ie_xml_id,
       CASE WHEN p.p_partkey % 44 = 20 THEN NULL ELSE TIMESTAMP '2024-01-01 00:00:00' END AS ie_xml_id_dt,
       CASE WHEN p.p_partkey % 12 = 0 THEN NULL ELSE 674000 + p.p_partkey END AS ip_prop674,
       CASE WHEN p.p_partkey % 12 = 0 THEN NULL ELSE TIMESTAMP '2024-01-02 00:00:00' END AS ip_prop674_dt,
       CASE WHEN p.p_partkey % 20 = 0 THEN NULL ELSE TIMESTAMP '2024-01-03 00:00:00' END AS ip_prop675_dt,
       CASE WHEN p.p_partkey % 20 = 0 THEN NULL ELSE 675000 + p.p_partkey END AS ip_prop675,
       p.p_size % 2 = 0 AS mod_single, CAST(p.p_size % 20 AS DECIMAL(18,4)) AS dm_discount_vendor,
       CASE WHEN p.p_size % 4 = 0 THEN NULL ELSE CAST(p.p_size % 15 AS DECIMAL(18,4)) END AS dm_discount_diler,
       CAST(p.p_retailprice AS DECIMAL(18,2)) AS basic_price_rur, CAST(p.p_size % 3 AS INT) AS dm_valuta
FROM {part} p {*versions}""",
    "modification": """
SELECT LPAD(CAST(p.p_partkey AS VARCHAR(20)), 12, '0') AS mod_id, 4 * CAST(FLOOR(p.p_partkey / 4) AS BIGINT) AS dev_id, v.version_num,
       CASE WHEN p.p_partkey % 13 = 7 THEN NULL ELSE p.p_partkey END AS ks,
       CAST(p.p_retailprice AS DECIMAL(18,2)) + v.version_num AS mod_price,
       CASE p.p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CAST(p.p_size AS VARCHAR(20)) || ' weeks' END AS mod_delivery_time,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE v.version_num * 10 END AS dm_valuta,
       CAST(p.p_size + v.version_num AS DECIMAL(18,4)) AS dm_kurs, CAST(p.p_size % 3 AS DECIMAL(18,4)) AS dm_koef,
       CAST(p.p_retailprice AS DECIMAL(18,2)) - v.version_num AS price_base, p.p_brand AS vendor_art_id, CAST(NULL AS VARCHAR(13)) AS mod_id_prev
FROM {part} p {*current_and_archive}""",
    "mod_param": """
SELECT 4 * CAST(FLOOR(p.p_partkey / 4) AS BIGINT) AS dev_id, q.version_num, LPAD(CAST(p.p_partkey AS VARCHAR(20)), 12, '0') AS mod_id, q.dev_param_id,
       CASE q.dev_param_id WHEN 1 THEN p.p_brand WHEN 2 THEN CASE WHEN p.p_partkey % 41 = 40 THEN NULL ELSE p.p_type END WHEN 3 THEN p.p_name ELSE CAST(p.p_size AS VARCHAR(20)) END AS param_value
FROM {part} p {*parameters}
WHERE q.dev_param_id <= 2 OR CAST(FLOOR(p.p_partkey / 4) AS BIGINT) % 3 = 2 OR (CAST(FLOOR(p.p_partkey / 4) AS BIGINT) % 3 = 1 AND q.dev_param_id = 3)""",
    "content": """
SELECT p_partkey AS ks, CASE p_partkey % 4 WHEN 3 THEN NULL ELSE p_partkey % 4 END AS stock_status, CAST(p_retailprice AS DECIMAL(18,2)) AS price FROM {part}""",
    "price_view": """
SELECT p_partkey AS ks, CAST(p_retailprice AS DECIMAL(18,2)) + CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END AS sell_price FROM {part}""",
    "stock_qty": """
SELECT l_partkey AS ks, l_suppkey % 12 AS warehouse_id, CASE WHEN l_quantity > 49 THEN l_quantity - 49 ELSE 0.0 END AS free_qty
FROM {lineitem} WHERE l_returnflag = 'R'""",
    "reserve": """
SELECT l_partkey AS ks, l_orderkey AS invoice_no, l_quantity AS reserved_qty, l_linenumber % 4 AS reserve_status,
       CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS released_at
FROM {lineitem} WHERE l_returnflag = 'A' AND l_linenumber <= 3""",
    "incoming_reserve": """
SELECT l_partkey AS ks, l_orderkey AS invoice_no, l_quantity AS reserved_qty, CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS released_at
FROM {lineitem} WHERE l_returnflag = 'A' AND l_linenumber > 3""",
    "payment": """
SELECT o_orderkey AS invoice_no, CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END AS amount FROM {orders} WHERE o_orderstatus <> 'O'""",
    "purchase_order": """
SELECT o_orderkey AS order_no, o_custkey AS supplier_code, CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'P' THEN o_orderkey % 3 = 0 ELSE FALSE END AS cancelled,
       CASE WHEN o_orderkey % 4 = 0 THEN TRUE WHEN o_orderkey % 4 = 1 THEN NULL ELSE FALSE END AS done
FROM {orders}""",
    "purchase_order_line": """
SELECT l_orderkey AS order_no, l_partkey AS ks, l_quantity AS qty, l_linenumber = 7 AS cancelled,
       CASE WHEN l_linenumber = 6 THEN TRUE WHEN l_linenumber = 5 THEN NULL ELSE FALSE END AS done,
       CASE WHEN l_linenumber = 1 THEN l_orderkey END AS invoice_no,
       CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS received_at,
       CASE WHEN l_linenumber = 2 THEN NULL ELSE l_shipdate END AS expected_date
FROM {lineitem} WHERE l_returnflag = 'N'""",
    "invoice": """
SELECT o_orderkey AS invoice_no, o_custkey AS customer_code, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS invoice_date,
       CASE o_orderkey % 3 WHEN 0 THEN 'FIRM_OLD' WHEN 1 THEN 'FIRM_D' ELSE 'FIRM_V' END AS firm
FROM {orders}""",
    "invoice_line": "SELECT DISTINCT l_orderkey AS invoice_no, l_partkey AS ks FROM {lineitem}",
    "dealer": "SELECT c_custkey AS customer_code FROM {customer} WHERE c_mktsegment = 'MACHINERY'",
    "customer_flag": "SELECT c_custkey AS customer_code, c_custkey % 7 = 0 AS vendor_flag FROM {customer}",
    "company": "SELECT c_custkey AS company_code, c_name AS company_name FROM {customer}",
    "site_device": """
SELECT 100000 + p_partkey AS ie_xml_id, p_name || ' ' || CAST(p_partkey AS VARCHAR(20)) AS ie_name,
       p_partkey % 32 <> 0 AS ie_active, p_brand AS ip_prop474, 'u' || CAST(p_size AS VARCHAR(20)) AS ip_prop657, 674000 + p_partkey AS ip_prop674
FROM {part} WHERE p_size > 2""",
    "site_price": """
SELECT d.p_name || ' ' || CAST(d.p_partkey AS VARCHAR(20)) || ': ' || LPAD(CAST(p.p_partkey AS VARCHAR(20)), 12, '0') AS ie_name,
       CAST(p.p_partkey AS DECIMAL(12,0)) AS ip_prop109, 674000 + d.p_partkey AS ic_xml_id0,
       CASE WHEN p.p_partkey % 8 = 0 THEN NULL WHEN p.p_partkey % 3 = 0 THEN 'In stock' ELSE CAST(p.p_size AS VARCHAR(20)) || ' weeks' END AS ip_prop110,
       CAST(p.p_retailprice AS DECIMAL(18,2)) + CASE WHEN p.p_partkey % 7 = 0 THEN 5 ELSE 0 END AS cv_price
FROM {part} p JOIN {part} d ON d.p_partkey = 4 * CAST(FLOOR(p.p_partkey / 4) AS BIGINT) WHERE p.p_size < 48""",
    "site_vendor": "SELECT s_suppkey AS vendor_id, s_name AS vendor_name FROM {supplier}",
    "stock_change": """
SELECT event_id AS id, ts AS dt_change,
       CASE event_type WHEN 'click' THEN CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END WHEN 'purchase' THEN 1 WHEN 'error' THEN 2 WHEN 'signup' THEN -1 ELSE 5 END AS change_status,
       CASE WHEN event_type = 'click' OR event_id % 50 = 0 THEN NULL ELSE ts END AS dt_sent,
       CASE event_id % 4 WHEN 0 THEN 'ok updated' WHEN 1 THEN 'run: timed out' WHEN 2 THEN 'timed out' ELSE 'ERROR: bad mod' END AS sent_result,
       user_id AS ks, LPAD(CAST(user_id AS VARCHAR(20)), 12, '0') AS mod_id,
       CASE WHEN value > 50 THEN 'In stock' ELSE '3 weeks' END AS time_delivery, CAST(FLOOR(value / 20) AS DECIMAL(18,0)) AS qnt,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END AS dt_trans, event_id % 3 AS dbl_cnt, event_id % 6 AS retry_cnt,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 2 = 0 END AS active
FROM {events}""",
    "expected_shipment": """
SELECT event_id AS id, ts AS dt_insert, CASE event_type WHEN 'error' THEN 2 WHEN 'view' THEN 1 ELSE 0 END AS status, user_id AS ks,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE '2024-02-01:' || CAST(event_id % 30 AS VARCHAR(20)) || ';' END AS expected, event_id % 6 AS retry_cnt,
       CASE event_id % 5 WHEN 0 THEN 'ok updated' WHEN 1 THEN 'x: Unable to connect' WHEN 2 THEN 'Unable to connect' WHEN 3 THEN 'run: timed out' ELSE 'no such item' END AS sent_result
FROM {events}""",
    "pack_list": "SELECT p_partkey AS ks FROM {part} WHERE p_size >= 20",
    "export_log": """
SELECT o_orderkey AS exp_id, o_orderkey % 3 AS exp_version_num, CAST(FLOOR(o_orderkey / 7) AS BIGINT) AS dev_id,
       CASE o_orderkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 2 THEN 6 WHEN 3 THEN 7 ELSE 2 END AS exp_mod,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 8 END AS exp_csv_status, o_orderdate AS exp_dt, o_custkey AS exp_creator,
       o_orderkey % 3 AS exp_status, CASE WHEN o_orderstatus = 'F' THEN 'prod.example' ELSE 'dev.example' END AS exp_site,
       CAST(FLOOR(o_orderkey / 20) AS BIGINT) AS exp_batch_id
FROM {orders}""",
    "export_batch": """
SELECT DISTINCT CAST(FLOOR(o_orderkey / 20) AS BIGINT) AS id, CAST(FLOOR(o_orderkey / 20) AS BIGINT) % 130 AS who, 'batch ' || CAST(CAST(FLOOR(o_orderkey / 20) AS BIGINT) AS VARCHAR(20)) AS title,
       TIMESTAMP '2024-01-01 00:00:00' AS dt_created, CASE WHEN CAST(FLOOR(o_orderkey / 20) AS BIGINT) % 2 = 0 THEN 10 ELSE 0 END AS status
FROM {orders}""",
    "export_field": """
SELECT o.o_orderkey * 5 + f.n AS csv_id, CAST(FLOOR(o.o_orderkey / 10) AS BIGINT) AS exp_id,
       CASE WHEN o.o_orderkey % 10 = 0 THEN 1 WHEN o.o_orderkey % 10 = 1 OR o.o_orderkey % 700 = 2 THEN 2 ELSE 4 END AS mod_csv, f.bx_fld_name,
       CASE f.n WHEN 0 THEN LPAD(CAST(o.o_orderkey AS VARCHAR(20)), 12, '0') WHEN 1 THEN CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS VARCHAR(30)) || CASE o.o_orderkey % 4 WHEN 0 THEN '5' WHEN 1 THEN '00000000000000001' WHEN 2 THEN 'x' ELSE '' END
                WHEN 2 THEN CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE o.o_orderpriority END WHEN 3 THEN 'c^' || CAST(o.o_custkey AS VARCHAR(20)) ELSE 'g' END AS bx_fld_value
FROM {orders} o {*fields}""",
    "export_dict": """
SELECT dict_name, dict_order, data_type
FROM (VALUES ('cv_price', 2, 'numeric'), ('ip_prop109', 1, 'varchar'), ('ip_prop110', 3, 'varchar'), ('ic_code0', 4, 'varchar'), ('ic_group0', 5, 'varchar'),
             ('ie_sort', 6, 'integer')) v(dict_name, dict_order, data_type)""",
    "export_dict_device": """
SELECT dict_name, dict_order, data_type
FROM (VALUES ('ic_group0', 1, 'varchar'), ('ip_prop109', 2, 'bigint'), ('cv_price', 3, 'numeric(18,2)')) v(dict_name, dict_order, data_type)""",
    "export_dict_modificators": """
SELECT dict_name, dict_order, data_type
FROM (VALUES ('ie_sort', 2, 'integer'), ('ic_code0', 1, 'varchar'), ('ip_prop110', 3, 'varchar')) v(dict_name, dict_order, data_type)""",
    "import_param": """
SELECT n AS ie_param_name, f AS brand_new, m AS imp_mode, n || '-' || CASE WHEN f THEN 'new' ELSE 'upd' END || '-' || CAST(m AS VARCHAR(5)) AS ie_param_value
FROM (VALUES ('csv_file', TRUE, 1), ('csv_file', TRUE, 2), ('csv_file', TRUE, 4), ('csv_file', FALSE, 1), ('csv_file', FALSE, 2), ('csv_file', FALSE, 4),
             ('import_profile', TRUE, 1), ('import_profile', TRUE, 2), ('import_profile', TRUE, 4), ('import_profile', FALSE, 1),
             ('import_profile', FALSE, 2), ('import_profile', FALSE, 4)) v(n, f, m)""",
    "site_order": """
SELECT o_orderkey AS order_no, CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS billcreated, o_orderdate AS dt_insert FROM {orders}""",
    "site_order_item": """
SELECT l_orderkey AS order_no, CASE WHEN l_linenumber = 1 THEN 'no code' ELSE 'dev' || CAST(l_suppkey AS VARCHAR(20)) || ': ' || LPAD(CAST(l_partkey AS VARCHAR(20)), 12, '0') END AS item_name,
       l_shipdate AS dt_insert FROM {lineitem}""",
    "log_entry": """
SELECT event_id AS id, CASE WHEN event_type = 'error' THEN 'model TX-40' ELSE 'other' END AS descript, 'op' AS operation, ts AS dt,
       CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(user_id AS VARCHAR(20)) END AS num
FROM {events}""",
    "availability": """
SELECT p_partkey AS ks, CAST(p_size AS DECIMAL(18,2)) AS available_qty, CAST(FLOOR(p_size / 5) AS DECIMAL(18,2)) AS pack_qty FROM {part}""",
    "pack_change": """
SELECT event_id AS id, user_id AS ks, CASE WHEN event_type = 'purchase' AND user_id % 4 <> 0 THEN 99 ELSE 0 END AS change_status, ts AS dt_sent FROM {events}""",
    "stock_change_update": """
SELECT event_id AS id, CASE WHEN event_id % 25 = 0 THEN NULL ELSE user_id END AS ks, CASE WHEN event_type = 'click' THEN 0 ELSE 1 END AS new_change_status, CAST(FLOOR(value) AS DECIMAL(18,0)) AS qnt,
       CASE WHEN event_id % 3 = 0 THEN ts END AS old_dt_trans, CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS new_dt_trans FROM {events}""",
    "content_change": """
SELECT p_partkey AS ks, CASE p_partkey % 4 WHEN 3 THEN NULL ELSE p_partkey % 4 END AS old_status, CASE WHEN p_partkey % 50 = 49 THEN NULL ELSE p_partkey % 3 END AS new_status FROM {part}""",
    "payment_change": """
SELECT o_orderkey AS seq, CASE o_orderkey % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'D' ELSE 'U' END AS op, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey END AS old_invoice_no,
       CASE WHEN o_orderkey % 3 = 1 THEN NULL WHEN o_orderkey % 3 = 2 AND o_orderkey % 4 = 0 THEN o_orderkey + 1 ELSE o_orderkey END AS new_invoice_no
FROM {orders}""",
    "payment_before": """
SELECT o_orderkey AS payment_id, o_orderkey AS invoice_no, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amount
FROM {orders} WHERE o_orderpriority <> '1-URGENT'""",
    "payment_after": """
SELECT o_orderkey AS payment_id, CASE WHEN o_orderpriority = '2-HIGH' AND o_orderkey % 4 = 0 THEN o_orderkey + 1 ELSE o_orderkey END AS invoice_no,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority <> '4-NOT SPECIFIED' THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amount
FROM {orders} WHERE o_orderpriority <> '5-LOW'""",
    "reserve_change": """
SELECT l_orderkey * 10 + l_linenumber AS seq, CASE l_linenumber % 3 WHEN 0 THEN 'I' WHEN 1 THEN 'D' ELSE 'U' END AS op, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_partkey END AS old_ks,
       CASE WHEN l_linenumber % 3 = 1 THEN NULL ELSE l_partkey END AS new_ks, l_linenumber <> 5 AS touched
FROM {lineitem} WHERE l_returnflag = 'A'""",
    "order_line_change": """
SELECT l_orderkey * 10 + l_linenumber AS seq, l_orderkey AS order_no, l_partkey AS ks FROM {lineitem} WHERE l_returnflag = 'N'""",
    "export_log_change": """
SELECT o_orderkey AS exp_id, CAST(FLOOR(o_orderkey / 7) AS BIGINT) AS dev_id, CASE o_orderkey % 4 WHEN 0 THEN 7 WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 1 END AS new_exp_mod,
       7 AS old_exp_mod, CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 7 ELSE 0 END AS old_csv_status, CASE WHEN o_orderstatus = 'F' THEN 'prod.example' ELSE 'dev.example' END AS old_site,
       o_orderkey % 3 AS old_exp_status, CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE o_orderkey % 3 END AS new_exp_status, 1 + CAST(FLOOR(o_orderkey / 2) AS BIGINT) % 2 AS new_version_num FROM {orders}""",
    "device_change": """
SELECT p_partkey AS dev_id, p_partkey % 3 AS old_version_num, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_partkey END AS old_ie_xml_id, CASE WHEN p_partkey % 2 = 0 THEN p_partkey + 1 ELSE p_partkey END AS new_ie_xml_id,
       CASE WHEN p_partkey % 10 < 5 THEN NULL ELSE p_size END AS old_ip_prop674, p_size AS new_ip_prop674,
       CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size + 1 END AS old_ip_prop675, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_size + 1 END AS new_ip_prop675,
       CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE '2024-01-01' END AS old_ie_xml_id_dt, '2024-02-01' AS new_ie_xml_id_dt FROM {part}""",
    "stage_result": """
SELECT o_orderkey AS exp_id, s.stage, CASE WHEN o_orderkey % 11 = 0 AND s.stage = 1 THEN 'not a number' WHEN o_orderkey % 13 = 0 AND s.stage = 4 THEN '' ELSE CAST(o_orderkey + s.stage AS VARCHAR(20)) END AS returned_text,
       CASE WHEN o_orderkey % 17 = 0 AND s.stage = 2 THEN 'import failed' WHEN o_orderkey % 23 = 0 AND s.stage = 4 THEN 'copy failed' WHEN o_orderkey % 2 = 0 THEN '' END AS error
FROM {orders} {*stages} WHERE NOT (o_orderkey % 19 = 0 AND s.stage = 4) AND NOT (o_orderkey % 29 = 0 AND s.stage = 1)""",
    "batch_result": """
SELECT DISTINCT CAST(FLOOR(o_orderkey / 20) AS BIGINT) AS batch_id, CASE WHEN CAST(FLOOR(o_orderkey / 20) AS BIGINT) % 5 = 1 THEN 'e1' ELSE '' END AS import_err,
       CASE WHEN CAST(FLOOR(o_orderkey / 20) AS BIGINT) % 5 = 2 THEN 'o1' ELSE '' END AS import_out, CASE WHEN CAST(FLOOR(o_orderkey / 20) AS BIGINT) % 5 >= 3 AND CAST(FLOOR(o_orderkey / 20) AS BIGINT) % 2 = 0 THEN 'e2' ELSE '' END AS price_info_err FROM {orders}""",
    "notification": """
SELECT event_id AS seq, ts, CASE event_type WHEN 'click' THEN 'do_compute_single' WHEN 'purchase' THEN 'do_expected' WHEN 'view' THEN 'do_export' ELSE 'filler' END AS channel,
       CASE event_type WHEN 'purchase' THEN CASE WHEN event_id % 9 = 0 THEN 'broken' ELSE LPAD(CAST(user_id AS VARCHAR(20)), 12, '0') || '^2024-02-01:3;^' || CAST(event_id AS VARCHAR(20)) END ELSE CAST(event_id AS VARCHAR(20)) END AS payload FROM {events}""",
}

# Short lists that a view repeats every base row for: alias, columns, rows. ``{*name}`` in a view.
LISTS: dict[str, tuple[str, tuple[str, ...], tuple[tuple, ...]]] = {
    "versions": ("v", ("version_num",), ((0,), (1,), (2,))),
    "current_and_archive": ("v", ("version_num",), ((1,), (2,))),
    "parameters": ("q", ("version_num", "dev_param_id"), ((1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 4))),
    "stages": ("s", ("stage",), ((1,), (2,), (4,))),
    "fields": (
        "f",
        ("n", "bx_fld_name"),
        ((0, "ip_prop109"), (1, "cv_price"), (2, "ip_prop110"), (3, "ic_code0"), (4, "ic_group0")),
    ),
}

_LIST = re.compile(r"\{\*(\w+)\}")
_REFERENCE = re.compile(r"\{(\w+)\}")
_SCHEMAS: dict[tuple[str, str], T.StructType] = {}
_DOMAINS: dict[tuple, "Domain"] = {}


def _generated(name: str) -> str:
    """The list as a generator, so that no join is planned for it."""
    alias, columns, rows = LISTS[name]
    structs = ", ".join("struct(" + ", ".join(f"{v!r} AS {c}" for c, v in zip(columns, row)) + ")" for row in rows)
    return f"LATERAL VIEW inline(array({structs})) {alias} AS {', '.join(columns)}"


def _values(name: str) -> str:
    alias, columns, rows = LISTS[name]
    tuples = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)
    return f", (VALUES {tuples}) {alias}({', '.join(columns)})"


class Domain:
    """Lazy DataFrames of the views over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}

    def schema(self, table: str) -> T.StructType:
        """A base table's schema, taken from its files once."""
        key = (self.sf_dir, table)
        if key not in _SCHEMAS:
            _SCHEMAS[key] = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet").schema
        return _SCHEMAS[key]

    def base(self, table: str) -> DataFrame:
        return self.spark.read.schema(self.schema(table)).parquet(f"{self.sf_dir}/{table}.parquet")

    def stream(self, table: str) -> DataFrame:
        """A base table as a file stream, with the schema of its batch form."""
        return (
            self.spark.readStream.schema(self.schema(table))
            .option("pathGlobFilter", f"{table}.parquet")
            .option("maxBytesPerTrigger", MAX_BYTES_PER_TRIGGER)
            .parquet(self.sf_dir)
        )

    def view(self, name: str, **frames: DataFrame) -> DataFrame:
        """A view over the given base frames instead of the stored tables."""
        text = _LIST.sub(lambda m: _generated(m.group(1)), VIEWS[name])
        inputs = {t: frames[t] if t in frames else self.base(t) for t in sorted(set(_REFERENCE.findall(text)))}
        df = self.spark.sql(text, **inputs)
        zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in VIEWS:
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self.view(name)
        return self._frames[name]


def domain(spark: SparkSession, sf_dir: str) -> Domain:
    """The domain of a folder, its views parsed once per session."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if key not in _DOMAINS:
        _DOMAINS[key] = Domain(spark, sf_dir)
    return _DOMAINS[key]


def with_views(body: str, *names: str) -> str:
    """SQL for the other engine: the named views as CTEs in front of ``body``."""
    def text(name: str) -> str:
        listed = _LIST.sub(lambda m: _values(m.group(1)), VIEWS[name])
        return _REFERENCE.sub(lambda m: m.group(1), listed).strip()

    ctes = [f"{n} AS ({text(n)})" for n in names]
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body
