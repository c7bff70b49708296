"""Fixed values.

Everything in this file is data that has to equal the values used in production for the
results to be right: codes, labels, text fragments. They are defaults of keyword parameters,
never used directly inside an operator's logic.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: codes -------------------------------------------------------------
# Warehouses that do not count as available stock.
UNCOUNTED_WAREHOUSES = (1, 3, 8, 9, 10)
# Suppliers whose purchase orders never count as incoming stock.
UNCOUNTED_SUPPLIERS = (210463, 225073)
# Suppliers whose order lines never trigger a recompute (differs from the list above).
UNTRIGGERED_SUPPLIERS = (203463, 225073)
# Reserve status that means the reserve no longer holds stock.
CLOSED_RESERVE_STATUS = 3
# Stock status codes.
STATUS_NONE, STATUS_ON_ORDER, STATUS_IN_STOCK = 0, 1, 2
# Change status codes: pending, sent, error, blocked, superseded.
PENDING, SENT, FAILED, BLOCKED, SUPERSEDED = 0, 1, 2, -1, -2
# Export stage bits, in the order the stages run: modifiers, prices, device.
STAGE_DEVICE, STAGE_MODIFIERS, STAGE_PRICES = 1, 2, 4
STAGE_ORDER = (STAGE_MODIFIERS, STAGE_PRICES, STAGE_DEVICE)
# Export modes a device without / with a shop id may use.
MODES_FOR_NEW_DEVICE = (1, 7)
MODES_FOR_KNOWN_DEVICE = (1, 4, 6, 7)
# Batch status that starts a batch export.
BATCH_START = 10
# Push status that confirms a pack-quantity push.
PACK_CONFIRMED = 99
# A transient failure stops being resent when the stored count is above this.
RETRY_LIMIT = 3
# User who is told about every failed batch.
BATCH_OBSERVER = 124
# Customer with its own issuing firm.
SPECIAL_CUSTOMER = 223719
# Price-export columns a batch leaves out.
BATCH_DROPPED_COLUMNS = ("ic_code0", "ic_group0")

# --- fixed values: notification channels ---------------------------------------------
CHANNEL_COMPUTE = "do_compute_single"
CHANNEL_SINGLE = "do_single"
CHANNEL_EXPECTED = "do_expected"
CHANNEL_EXPORT = "do_export"

# --- fixed values: fragments of a transient failure (never at the start of the text) ---
TRANSIENT_FRAGMENTS = (
    "client.",
    "Error reading SSH protocol banner",
    "Network is unreachable",
    "Unable to connect",
    "timed out",
    "503 Service Temporarily Unavailable",
    "Connection re",
)

# --- fixed values: patterns ------------------------------------------------------------
# Number that ends an item's name.
TRAILING_NUMBER = r": *?([0-9]+)\z"

# --- fixed values: lookup failures -----------------------------------------------------
MODIFICATION_NOT_FOUND = "modification not found"
DEVICE_NOT_FOUND = "device not found"


@dataclass(frozen=True)
class Labels:
    """Delivery texts shown to shop visitors (fixed values)."""

    in_stock: str = "Со склада"
    in_stock_report: str = "Со Склада"
    expected: str = "Ожидается "
    undated: str = "на склад"


@dataclass(frozen=True)
class ExportTexts:
    """Result and notice texts of exports (fixed values)."""

    done_model: str = "Завершён экспорт модели "
    done_on_site: str = " на сайт "
    batch_member_done: str = "Завершён экспорт в составе пакета batch_id="
    batch_member_failed: str = "Ошибка экспорта в составе пакета batch_id="
    batch_done: str = "Завершён пакетный экспорт"
    batch_failed: str = "Ошибка пакетного экспорта"
    batch_notice: tuple[str, str, str] = ("Пакетный экспорт №", " от ", " завершился с ошибкой:")
    guarded_update: str = "Попытка обновить версию не 'в разработке' "


@dataclass(frozen=True)
class ReportTexts:
    """Texts of the unsynced-device report (fixed values)."""

    not_exported: str = "Не выгружен"
    changed: str = "Изменен, не выгружен"
    absent: str = "Нет на сайте"
    yes: str = "Да"
    no: str = "Нет"


@dataclass(frozen=True)
class FirmRules:
    """Codes of the issuing firms; company data, so the caller supplies them."""

    special: str
    dealer: str
    flagged: str
    default: str
    renamed: str
    special_customer: int = SPECIAL_CUSTOMER

# The price columns a new catalogue version takes over.
CARRIED_COLUMNS = ("mod_price", "mod_delivery_time", "dm_valuta", "dm_kurs", "dm_koef", "price_base", "vendor_art_id")
