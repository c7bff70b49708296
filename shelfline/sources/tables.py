"""Typed scans of the domain tables.

``SCHEMAS`` declares every table once, with English names. ``SOURCE_NAMES`` says what columns are
called in the operational database where that differs, so that a dump or a JDBC scan of it can be
brought into the declared form with :func:`from_source`.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMAS: dict[str, str] = {
    "content": "ks LONG, stock_status INT, price DECIMAL(18,2)",
    "stock_qty": "ks LONG, warehouse_id INT, free_qty DOUBLE",
    "reserve": "ks LONG, invoice_no LONG, reserved_qty DOUBLE, reserve_status INT, released_at TIMESTAMP_NTZ",
    "incoming_reserve": "ks LONG, invoice_no LONG, reserved_qty DOUBLE, released_at TIMESTAMP_NTZ",
    "payment": "invoice_no LONG, amount DECIMAL(18,2)",
    "purchase_order": "order_no LONG, supplier_code LONG, cancelled BOOLEAN, done BOOLEAN",
    "purchase_order_line": "order_no LONG, ks LONG, qty DECIMAL(18,4), cancelled BOOLEAN, done BOOLEAN, invoice_no LONG, "
    "received_at TIMESTAMP_NTZ, expected_date TIMESTAMP_NTZ",
    "invoice": "invoice_no LONG, customer_code LONG, firm STRING, invoice_date TIMESTAMP_NTZ",
    "invoice_line": "invoice_no LONG, ks LONG",
    "dealer": "customer_code LONG",
    "company": "company_code LONG, company_name STRING",
    "price_view": "ks LONG, sell_price DECIMAL(18,2)",
    "device": "dev_id LONG, version_num INT, dev_name STRING, dev_name_long STRING, arc_name STRING, vendor_id LONG, "
    "supplier_code LONG, timedelivery STRING, ie_xml_id LONG, ie_xml_id_dt TIMESTAMP_NTZ, ip_prop674 INT, "
    "ip_prop674_dt TIMESTAMP_NTZ, ip_prop675 INT, ip_prop675_dt TIMESTAMP_NTZ, mod_single BOOLEAN, "
    "dm_discount_vendor DECIMAL(18,4), dm_discount_diler DECIMAL(18,4), basic_price_rur DECIMAL(18,2), dm_valuta INT",
    "modification": "mod_id STRING, dev_id LONG, version_num INT, ks LONG, mod_price DECIMAL(18,2), mod_delivery_time STRING, "
    "dm_valuta INT, dm_kurs DECIMAL(18,4), dm_koef DECIMAL(18,4), price_base DECIMAL(18,2), vendor_art_id STRING, mod_id_prev STRING",
    "mod_param": "dev_id LONG, version_num INT, mod_id STRING, dev_param_id INT, param_value STRING",
    "export_field": "csv_id LONG, exp_id LONG, mod_csv INT, bx_fld_name STRING, bx_fld_value STRING",
    "export_log": "exp_id LONG, exp_version_num INT, dev_id LONG, exp_mod INT, exp_csv_status INT, exp_dt TIMESTAMP_NTZ, "
    "exp_finish_dt TIMESTAMP_NTZ, exp_creator INT, exp_status INT, exp_site STRING, exp_result STRING, exp_batch_id LONG",
    "export_batch": "id LONG, who INT, title STRING, dt_created TIMESTAMP_NTZ, dt_finished TIMESTAMP_NTZ, status INT, exp_result STRING",
    "export_dict": "dict_name STRING, dict_comment STRING, dict_order INT, data_type STRING",
    "import_param": "ie_param_name STRING, brand_new BOOLEAN, imp_mode INT, ie_param_value STRING",
    "stock_change": "id LONG, dt_change TIMESTAMP_NTZ, change_status INT, dt_sent TIMESTAMP_NTZ, sent_result STRING, ks LONG, "
    "mod_id STRING, mod_name STRING, time_delivery STRING, qnt DECIMAL(18,2), dt_trans TIMESTAMP_NTZ, dbl_cnt INT, "
    "retry_cnt INT, operations STRING, active BOOLEAN",
    "expected_shipment": "id LONG, dt_insert TIMESTAMP_NTZ, ks LONG, mod_id STRING, expected STRING, status INT, retry_cnt INT, "
    "sent_result STRING, dt_sent TIMESTAMP_NTZ",
    "pack_list": "ks LONG",
    "pack_change": "id LONG, ssc_id LONG, ks LONG, qnt_ssc DECIMAL(18,2), qnt_calc DECIMAL(18,2), change_status INT, dt_sent TIMESTAMP_NTZ",
    "site_device": "ie_xml_id LONG, ie_name STRING, ie_active BOOLEAN, ip_prop474 STRING, ip_prop657 STRING, ip_prop674 STRING",
    "site_price": "ie_name STRING, cv_price DECIMAL(18,2), ip_prop109 DECIMAL(12,0), ip_prop110 STRING, ic_xml_id0 LONG",
    "site_vendor": "vendor_id LONG, vendor_name STRING",
    "site_order": "order_no LONG, billcreated INT, dt_insert TIMESTAMP_NTZ",
    "site_order_item": "order_no LONG, item_name STRING, dt_insert TIMESTAMP_NTZ",
    "audit_log": "id LONG, num STRING, descript STRING, operation STRING, dt TIMESTAMP_NTZ",
}

# Column names in the operational database, where they are not the ones above.
SOURCE_NAMES: dict[str, dict[str, str]] = {
    "content": {"ks": "КодСодержания", "price": "Цена"},
    "stock_qty": {"ks": "КодСодержания", "warehouse_id": "КодСклада", "free_qty": "Свободно"},
    "reserve": {
        "ks": "КодСодержания", "invoice_no": "Счет", "reserved_qty": "Резерв", "reserve_status": "СтатусРезерва", "released_at": "КогдаСнял",
    },
    "incoming_reserve": {"ks": "КодСодержания", "invoice_no": "Счет", "reserved_qty": "Резерв", "released_at": "КогдаСнял"},
    "payment": {"invoice_no": "Счет", "amount": "Сумма"},
    "purchase_order": {"order_no": "Заказ", "supplier_code": "Код", "cancelled": "Отменен", "done": "Выполнен"},
    "purchase_order_line": {
        "order_no": "Заказ", "ks": "КодСодержания", "qty": "Количество", "cancelled": "Отменен", "done": "Выполнен",
        "invoice_no": "Счет", "received_at": "Получен", "expected_date": "ДатаОжидания",
    },
    "invoice": {"invoice_no": "№ счета", "customer_code": "Код", "firm": "фирма", "invoice_date": "Дата счета"},
    "invoice_line": {"invoice_no": "№ счета", "ks": "КодСодержания"},
    "dealer": {"customer_code": "Код"},
    "company": {"company_code": "Код", "company_name": "Предприятие"},
    "price_view": {"ks": "КодСодержания", "sell_price": "ОтпускнаяЦена"},
    "device": {"supplier_code": "Поставщик"},
    "modification": {"ks": "КодСодержания"},
    "site_vendor": {"vendor_id": "ie_xml_id", "vendor_name": "ie_name"},
    "site_order": {"order_no": "Номер"},
    "site_order_item": {"order_no": "bx_order_Номер", "item_name": "Наименование"},
    "audit_log": {"descript": "desript", "dt": "Дата"},
}


#: Columns that name a row or are looked up in another table.
KEYS = {"ks", "invoice_no", "order_no", "exp_id", "csv_id", "id"}


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[table])


class DomainTables(Mapping):
    """Tables of one folder, each scanned when it is asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")

    def __getitem__(self, table: str) -> DataFrame:
        return self._spark.read.schema(schema(table)).parquet(f"{self._folder}/{table}")

    def __contains__(self, table: object) -> bool:
        return table in SCHEMAS

    def __iter__(self) -> Iterator[str]:
        return iter(SCHEMAS)

    def __len__(self) -> int:
        return len(SCHEMAS)


def load_domain(spark: SparkSession, folder: str) -> DomainTables:
    """All domain tables below ``folder``, one parquet folder each, with the declared schemas."""
    return DomainTables(spark, folder)


def _source_column(field: T.StructField, table: str, present: set[str]) -> Column:
    name = SOURCE_NAMES.get(table, {}).get(field.name, field.name)
    return F.col(f"`{name}`") if name in present else F.lit(None)


def _key_columns(df: DataFrame, table: str) -> list[str]:
    """The columns that name or join rows of a table: whole numbers of the first place on. A scan that
    lacks one is an error, not a table of NULLs."""
    keys = [f.name for f in schema(table) if isinstance(f.dataType, T.LongType) and (f.name in KEYS or f is schema(table)[0])]
    names, present = SOURCE_NAMES.get(table, {}), set(df.columns)
    lacking = [names.get(k, k) for k in keys if names.get(k, k) not in present]
    if lacking:
        raise ValueError(f"the scan of {table} lacks {', '.join(lacking)}")
    return keys


def from_source(df: DataFrame, table: str) -> DataFrame:
    """A scan of the operational table as the declared one: English names, declared types. Ids are
    64-bit. Other columns the scan lacks are NULL, and so are values that do not fit their type, which
    :func:`from_source_rejects` returns; a scan without the key columns is an error."""
    _key_columns(df, table)
    present = set(df.columns)
    return df.select(*[_source_column(f, table, present).try_cast(f.dataType).alias(f.name) for f in schema(table)])


def from_source_rejects(df: DataFrame, table: str) -> DataFrame:
    """Values that :func:`from_source` could not bring into the declared type: ``key, column, value`` as
    text, ``key`` being the row's key columns."""
    keys, present = _key_columns(df, table), set(df.columns)
    names = SOURCE_NAMES.get(table, {})
    key = F.concat_ws("|", *[F.coalesce(_source_column(f, table, present).cast("string"), F.lit("NULL")) for f in schema(table) if f.name in keys])
    found = []
    for f in schema(table):
        value = _source_column(f, table, present)
        if names.get(f.name, f.name) in present and not isinstance(f.dataType, T.StringType):
            bad = value.isNotNull() & value.try_cast(f.dataType).isNull()
            found.append(F.when(bad, F.struct(F.lit(f.name).alias("column"), value.cast("string").alias("value"))))
    return df.select(key.alias("key"), F.explode(F.array_compact(F.array(*found))).alias("_r")).select("key", "_r.*")


def read_jdbc(
    spark: SparkSession,
    table: str,
    url: str,
    source_table: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str],
) -> DataFrame:
    """Scan an operational table in ``partitions`` parallel ranges of a numeric column."""
    scan = spark.read.jdbc(
        url, source_table, column=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions, properties=properties
    )
    return from_source(scan, table)
