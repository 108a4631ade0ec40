"""Row filters on the change log and the page view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the shop's database.
BOOTSTRAP_MARKERS = ["bootstrap-start", "bootstrap-complete"]
BOOTSTRAP_ALL = ["bootstrap-start", "bootstrap-insert", "bootstrap-complete"]
ORDER_CANCELLED = "1003"
ORDER_REFUND_REQUESTED = "1005"
ORDER_REFUNDED = "1006"
PAYMENT_SUCCEEDED = "1602"

# Name of the partition column of a landed change log.
LANDED_BY = "src_table"


def fields(names: str, payload: str = "data") -> list[Column]:
    """Projection of map entries; a missing key gives null."""
    return [F.col(payload)[name].alias(name) for name in names.split()]


def table_events(log: DataFrame, table: str, *types: str, database: str | None = None) -> DataFrame:
    """Changes of one table.

    When the log is landed by table, the same test also prunes its partitions.
    """
    keep = F.col("table") == table
    if LANDED_BY in log.columns:
        keep = (F.col(LANDED_BY) == table) & keep
    if types:
        keep = keep & F.col("type").isin(*types)
    if database is not None:
        keep = keep & (F.col("database") == database)
    return log.where(keep)


def without_bootstrap_markers(log: DataFrame) -> DataFrame:
    """Dimension path: the rows of a bootstrap stay, its two markers go."""
    return log.where(F.col("type").isNull() | ~F.col("type").isin(BOOTSTRAP_MARKERS))


def without_bootstrap(log: DataFrame) -> DataFrame:
    """Fact path: nothing of a bootstrap stays, nor does a change without type."""
    return log.where(~F.col("type").isin(BOOTSTRAP_ALL))


def status_changed_to(log: DataFrame, table: str, column: str, code: str,
                      database: str | None = None) -> DataFrame:
    """Updates in which ``column`` has just become ``code``."""
    return table_events(log, table, "update", database=database).where(
        F.col("old")[column].isNotNull() & (F.col("data")[column] == code))


def payments(log: DataFrame, require_success: bool = True) -> DataFrame:
    updates = table_events(log, "payment_info", "update")
    if require_success:
        updates = updates.where(F.col("data")["payment_status"] == PAYMENT_SUCCEEDED)
    return updates


def cart_additions(log: DataFrame, database: str | None = None) -> DataFrame:
    """Cart inserts, and updates that raise the quantity."""
    now = F.col("data")["sku_num"].try_cast("int")
    before = F.col("old")["sku_num"].try_cast("int")
    return table_events(log, "cart_info", "insert", "update", database=database).where(
        (F.col("type") == "insert") | (now > before))


def searches(page_view: DataFrame) -> DataFrame:
    """Page views that follow a keyword search."""
    page = F.col("page")
    return page_view.where(
        page["item"].isNotNull()
        & (page["last_page_id"] == "search")
        & (page["item_type"] == "keyword"))
