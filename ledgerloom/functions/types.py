"""The stated types of money columns; sums never inherit a derived type."""

from pyspark.sql import types as T

AMOUNT = T.DecimalType(22, 3)  # one decoded ledger amount
FEED_AMOUNT = T.DecimalType(28, 8)  # one decoded trailing-sign amount
TOTAL = T.DecimalType(38, 3)  # any sum of AMOUNT
FEED_TOTAL = T.DecimalType(38, 8)  # any sum of FEED_AMOUNT
DIFFERENCE = T.DecimalType(20, 4)  # difference of two balances

LEDGER_KEYS = ["BRANCH_CODE", "CURRENCY", "CGL"]

GL_TRANSACTION_COLUMNS = [
    "BATCH_ID",
    "JOURNAL_ID",
    "POST_DATE",
    "BRANCH_CODE",
    "CURRENCY",
    "CGL",
    "NARRATION",
    "DEBIT_AMOUNT",
    "CREDIT_AMOUNT",
    "TRANSACTION_COUNT",
    "SOURCE_FLAG",
]

DIFFERENCE_COLUMNS = [
    "RECON_RUN_DATE",
    "BRANCH_CODE",
    "CURRENCY",
    "CGL",
    "CBS_BALANCE",
    "GL_BALANCE",
    "DIFFERENCE_AMOUNT",
    "DIFF_BW_YESTERDAY",
    "TYPE",
    "HEAD",
]
