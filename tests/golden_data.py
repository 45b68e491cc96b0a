"""The worked examples with known results."""

from datetime import datetime
from decimal import Decimal

_DAY = datetime(2025, 11, 25)

SCHEMA = (
    "BATCH_ID string, JOURNAL_ID string, POST_DATE timestamp, BRANCH_CODE string, "
    "CURRENCY string, CGL string, NARRATION string, DEBIT_AMOUNT decimal(20,2), "
    "CREDIT_AMOUNT decimal(20,2), TRANSACTION_COUNT bigint, SOURCE_FLAG string"
)


def _transactions(batch, rows):
    return [
        (batch, None, _DAY, branch, "INR", cgl, "CBS consolidated txns", Decimal(d), Decimal(c), n, "C")
        for branch, cgl, d, c, n in rows
    ]


TEN = _transactions(
    "252",
    [
        ("15779", "5106505001", "4633292.34", "-2304292.55", 2293),
        ("06851", "1106505001", "4708426.21", "-2789806.95", 2810),
        ("04545", "1106505001", "405.00", "-10731.06", 11),
        ("32291", "2028070603", "55651.00", "-426620.92", 83),
        ("16000", "1106505001", "100.00", "-34136.00", 6),
        ("06659", "2014070602", "90694.20", "-70364.20", 192),
        ("11223", "5001234567", "12345.67", "-23456.78", 45),
        ("99887", "6200123456", "74620.50", "-12800.30", 210),
        ("44556", "1204500001", "998.00", "-1200.45", 17),
        ("88771", "6363123456", "25000.75", "-46000.00", 92),
    ],
)
TEN_CODES = ["2028070603", "2014070602", "5001234567", "6200123456", "1204500001"]
TEN_TOTALS = {
    "1111111111": ("4733931.96", "-2880674.01", 2919),
    "1204500001": ("998.00", "-1200.45", 17),
    "2014070602": ("90694.20", "-70364.20", 192),
    "2028070603": ("55651.00", "-426620.92", 83),
    "5000000000": ("4633292.34", "-2304292.55", 2293),
    "5001234567": ("12345.67", "-23456.78", 45),
    "6200123456": ("74620.50", "-12800.30", 210),
}
TEN_DESCRIBED = {
    "mean": (3.222730048571429e9, 1371647.667143, -817058.458571, 822.7142857142857),
    "stddev": (2.1058210677401948e9, 2262912.303230421, 1233060.3711987433, 1233.5967350645446),
}

TWENTY = _transactions(
    "250",
    [
        ("15779", "5106505001", "4633292.34", "0.00", 2293),
        ("06851", "1106505001", "4708426.21", "0.00", 2810),
        ("04545", "1106505001", "405.00", "-10731.06", 11),
        ("32291", "2028070603", "55651.00", "-426620.92", 83),
        ("16000", "1106505001", "100.00", "-34136.00", 6),
        ("06659", "2014070602", "90694.20", "-70364.20", 192),
        ("11223", "5001234567", "12345.67", "-23456.78", 45),
        ("99887", "6200123456", "74620.50", "-12800.30", 210),
        ("44556", "1204500001", "998.00", "-1200.45", 17),
        ("88771", "6363123456", "25000.75", "-46000.00", 92),
        ("22111", "5106505001", "100000.00", "0.00", 52),
        ("22111", "6200123456", "0.00", "-15000.50", 19),
        ("55331", "5001234567", "821.11", "-127.90", 8),
        ("55331", "1106505001", "5500.00", "0.00", 33),
        ("77551", "1204500001", "0.00", "-7000.00", 12),
        ("77551", "2028070603", "35000.00", "0.00", 28),
        ("88990", "2014070602", "0.00", "-900.00", 5),
        ("88990", "6363123456", "12500.00", "0.00", 33),
        ("77411", "5001234567", "2300.00", "-100.00", 9),
        ("77411", "6200123456", "0.00", "-2600.00", 13),
    ],
)
TWENTY_CODES = [
    "2028070603", "2014070602", "5001234567", "6200123456", "1204500001",
    "6363123456", "1106505001", "5106505001", "1106505002", "6200123499",
]
# Totals, then the balancing entry (which counts no transactions).
TWENTY_RESULT = {
    "1106505001": ("4714431.21", "-44867.06", 2860, "0.00", "-4669564.15"),
    "5106505001": ("4733292.34", "0.00", 2345, "0.00", "-4733292.34"),
    "2028070603": ("90651.00", "-426620.92", 111, "335969.92", "0.00"),
    "2014070602": ("90694.20", "-71264.20", 197, "0.00", "-19430.00"),
    "6200123456": ("74620.50", "-30400.80", 242, "0.00", "-44219.70"),
    "5001234567": ("15466.78", "-23684.68", 62, "8217.90", "0.00"),
    "1204500001": ("998.00", "-8200.45", 29, "7202.45", "0.00"),
    "6363123456": ("37500.75", "-46000.00", 125, "8499.25", "0.00"),
}
