"""The three extracts made from the netting report, ready to compare."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.functions.columns import as_text, blank_nulls
from tablecheck.model import ExtractRules, RunInfo, TableRules
from tablecheck.operators.align import occurrence_number
from tablecheck.operators.windows import numbered
from tablecheck.plans.netting import REPORT_CONSTANTS
from tablecheck.plans.reconcile import run_table

OCCURRENCE = "rnm"

POSITION_KEY = ("bor_client_id", "symbol", "option_type", "expiry_maturity_date")
POSITION_ORDER = ("strkpx", "occ_qty_reported")
# Column order of the three files.
POSITION_COLUMNS = (
    "process_date", "bor_client_id", "symbol", "option_type", "expiry_maturity_date", "occ_qty_reported",
    "txntyp", "actn", "id_clr", "id_acct", "typ", "strkpx",
)
CLEARING_COLUMNS = (
    "type", "symbol", "strike", "p_c", "series_contract_date", "cusip", "net_quantity", "settlement_date",
    "net_cash", "occ_qty_reported",
)
MESSAGE_KEY = ("instrmt_sym", "instrmt_mmy")
# Constant fields of the message file.
MESSAGE_CONSTANTS = {
    "fixml_r": "20030618",
    "fixml_s": "20040109",
    "fixml_v": "4.4",
    "fixml_xr": "FIA",
    "fixml_xv": "1.1",
    "pty_r": "4",
}
MESSAGE_COLUMNS = (
    "fixml_r", "fixml_s", "fixml_v", "fixml_xr", "fixml_xv", "fixml_text", "batch_bizdt", "batch_totmsg",
    "batch_text", "posmntreq_txntyp", "posmntreq_actn", "posmntreq_bizdt", "posmntreq_txt", "posmntreq_text",
    "pty_id", "pty_r", "pty_text", "sub_id", "sub_typ", "sub_text", "instrmt_sym", "instrmt_cfi", "instrmt_mmy",
    "instrmt_strkpx", "instrmt_text", "qty_typ", "qty_long", "qty_text",
)


def position_extract(report: DataFrame) -> DataFrame:
    return report.withColumnRenamed("occ_strkprice_report", "strkpx").select(*POSITION_COLUMNS)


def clearing_extract(report: DataFrame) -> DataFrame:
    blank = F.lit("")
    fields = {
        "type": F.lit("O"),
        "strike": F.col("occ_strkprice_report"),
        "cusip": blank,
        "settlement_date": blank,
        "net_cash": blank,
        "net_quantity": F.col("occ_qty_reported"),
    }
    return report.withColumns(fields).select(*CLEARING_COLUMNS)


def message_extract(report: DataFrame) -> DataFrame:
    """Every row carries the number of rows as its batch total."""
    total = report.agg(F.count(F.lit(1))).scalar()
    fields = {name: F.lit(value) for name, value in MESSAGE_CONSTANTS.items()}
    fields |= {name: F.lit("") for name in MESSAGE_COLUMNS if name.endswith("_text")}
    fields |= {
        "batch_bizdt": F.col("run_date"),
        "batch_totmsg": total,
        "posmntreq_txntyp": F.lit(REPORT_CONSTANTS["txntyp"]),
        "posmntreq_actn": F.lit(REPORT_CONSTANTS["actn"]),
        "posmntreq_bizdt": F.col("run_date"),
        "posmntreq_txt": F.lit(REPORT_CONSTANTS["txt"]),
        "pty_id": F.lit(REPORT_CONSTANTS["id_clr"]),
        "sub_id": F.lit(REPORT_CONSTANTS["id_acct"]),
        "sub_typ": F.lit(REPORT_CONSTANTS["typ"]),
        "instrmt_sym": F.col("symbol"),
        "instrmt_cfi": F.col("cfi"),
        "instrmt_mmy": F.col("mmy"),
        "instrmt_strkpx": F.col("occ_strkprice_report").cast("decimal(30,2)").cast("string"),
        "qty_typ": F.lit(REPORT_CONSTANTS["typ_ias"]),
        "qty_long": F.col("occ_qty_reported"),
    }
    return report.select([fields[name].alias(name) for name in MESSAGE_COLUMNS])


def number_positions(rows: DataFrame) -> DataFrame:
    return occurrence_number(rows, POSITION_KEY, POSITION_ORDER, OCCURRENCE)


def number_clearing(rows: DataFrame) -> DataFrame:
    """Numbered through the whole file, by all its columns."""
    return numbered(rows, [], CLEARING_COLUMNS, OCCURRENCE)


def number_messages(rows: DataFrame) -> DataFrame:
    return occurrence_number(rows, MESSAGE_KEY, MESSAGE_COLUMNS, OCCURRENCE)


MAKERS = {
    "1": (position_extract, number_positions, (*POSITION_KEY, OCCURRENCE)),
    "2": (clearing_extract, number_clearing, (OCCURRENCE,)),
    "3": (message_extract, number_messages, (*MESSAGE_KEY, OCCURRENCE)),
}


def reconcile_extract(
    which: str, report: DataFrame, delivered: DataFrame, rules: ExtractRules, run: RunInfo
) -> DataFrame:
    """An extract made from the report against the delivered file, both as text.

    The key in use, that of the rules or else the file's own, must not be NULL, except in the
    message file. Only the clearing file is blanked: it is numbered through by all its columns."""
    make, number, own_key = MAKERS[which]
    key = tuple(c.lower() for c in rules.primary_key) or own_key
    wanted = TableRules(rules.table_name, key, () if which == "3" else key)
    shaped = blank_nulls if which == "2" else as_text
    src, tgt = number(shaped(make(report))), number(shaped(delivered))
    return run_table(src, tgt, wanted, run, unique=True, compare="text")
