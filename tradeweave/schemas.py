"""Declared schemas and fixed values; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# The 32 instruction columns in file order.
INSTRUCTION_COLUMNS = [
    "BuySellIndicator", "TransactionType", "Sender", "Receiver", "SendersRef", "Function", "TradeRef",
    "PreviousRef", "TradeDate", "SettlementDate", "DealCcy", "DealPrice", "SGXSecurityCode", "ISIN",
    "SecurityDescription", "Quantity", "BuyerSeller", "ClientAccount", "CDPSafeKeepingAccount",
    "PlaceofTrade", "PlaceofSettlement", "SettlementCcy", "SettlementAmt", "AccruedInterestCcy",
    "AccruedInterestAmt", "Blocktrade", "PaymentIndicator", "LocalorForeignIndicator", "StatusID",
    "Status", "PSMSMatchedReference", "TransferType",
]

_TYPES = {
    "Sender": T.IntegerType(),
    "SettlementDate": T.IntegerType(),
    "TradeDate": T.IntegerType(),
    "DealPrice": T.DoubleType(),
    "Quantity": T.DoubleType(),
    "SettlementAmt": T.DoubleType(),
    "AccruedInterestAmt": T.DoubleType(),
}

INSTRUCTION = T.StructType(
    [T.StructField(c, _TYPES.get(c, T.StringType())) for c in INSTRUCTION_COLUMNS]
)

EXCHANGE_RATE = T.StructType([
    T.StructField("SettlementDate", T.IntegerType()),
    T.StructField("Currency", T.StringType()),
    T.StructField("Rate", T.DoubleType()),
])

CLOSING_PRICE = T.StructType([
    T.StructField("SettlementDate", T.IntegerType()),
    T.StructField("Code", T.StringType()),
    T.StructField("SecurityDescription", T.StringType()),
    T.StructField("Price", T.DoubleType()),
    T.StructField("Currency", T.StringType()),
    T.StructField("ISIN", T.StringType()),
])

DEPOSITORY_AGENT = T.StructType([
    T.StructField("Sender", T.IntegerType()),
    T.StructField("DaName", T.StringType()),
])

SUB_ACCOUNT = T.StructType([
    T.StructField("CDPSafeKeepingAccount", T.StringType()),
    T.StructField("CDPAccountName", T.StringType()),
    T.StructField("Location", T.StringType()),
])

# Codes with a meaning in the business rules.
SETTLED = "SETTLED"
OTC_BOND = "DCSS"
MARKET_TRANSFER = "SBLT"
SUBSEQUENT_TYPES = ["FDVP", "OFOP"]
CDIS_FEE_SENDERS = [561, 635, 690]
DEFAULT_CURRENCY = "THB"
DEFAULT_RATE = 0.0415861
HOME_CURRENCY = "SGD"
ON_EXCHANGE = "On-Exchange"
OFF_EXCHANGE = "Off-Exchange"

# Side codes and the labels shown in the outputs (spelling as published).
SIDE_LABELS = {
    "0.S": "Sell in First SI",
    "0.B": "Buy in First SI",
    "1.S": "Sell in Subseqent SI",
    "1.B": "Buy in Subseqent SI",
}

# Explanations stored with each linked instruction.
NOT_LOOKED_AT = "null"
NOT_LINKED = "NULL"
TOTAL_LINK = "Total amount linking"
INDIVIDUAL_LINK = "Individual linking"
REFERENCE_LINK = "PSMS reference matching"

# Columns left out of the off-exchange extract.
OFF_EXCHANGE_DROPS = ["subsequent", "Code_CDP", "SubsequentBuySell", "comments", "Currency"]

# Days kept, names of a top list, turnarounds before the run is stopped.
RETENTION_DAYS = 62
TOP_K = 20
MAX_ROUNDS = 10000
