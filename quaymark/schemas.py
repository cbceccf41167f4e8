"""Registries and stored schemas of the data model.

Names and values here are part of the contract with the stored data: they are fixed
values, stated as the data has them.
"""

from __future__ import annotations

from pyspark.sql import types as T

#: Asset types in the order in which their catalogs take precedence.
ASSET_TYPES = ("stocks", "etfs", "forex", "indices", "cryptocurrencies", "commodities", "economic")
#: Asset types that the plan does not entitle to.
DISABLED = frozenset({"indices"})
#: Endpoints that apply to each asset type; ``direct`` is the type's own series.
ENDPOINTS = {
    "stocks": ("prices", "prices_daily", "income_statement", "balance_sheet", "cash_flow", "earnings", "earnings_estimates", "insider", "sentiment"),
    "etfs": ("prices", "prices_daily", "etf_profile"),
    "forex": ("direct",),
    "indices": ("direct",),
    "cryptocurrencies": ("direct",),
    "commodities": ("direct",),
    "economic": ("direct",),
}
FUNDAMENTALS = ("income_statement", "balance_sheet", "cash_flow", "earnings", "earnings_estimates")
YIELD_COLUMNS = ("prices", "prices_daily", "income_statement", "balance_sheet", "cash_flow", "earnings", "earnings_estimates", "insider", "sentiment", "etf_profile", "direct")
#: Kinds of issue; the first two make a cell of the coverage matrix false.
HARD_ISSUES = ("structure_error", "av_throttle")
ISSUE_TYPES = (*HARD_ISSUES, "empty_content", "cast_failure", "timezone_mismatch")
STATUSES = ("Active", "Corrupted", "Delisted")
#: Sectors by the names that vendors send.
SECTORS = {
    "BASIC MATERIALS": "Basic Materials",
    "COMMUNICATION SERVICES": "Communication Services",
    "CONSUMER CYCLICAL": "Consumer Cyclical",
    "CONSUMER DEFENSIVE": "Consumer Defensive",
    "CONSUMER STAPLES": "Consumer Defensive",
    "ENERGY": "Energy",
    "FINANCIAL SERVICES": "Financial Services",
    "FINANCIALS": "Financial Services",
    "HEALTHCARE": "Healthcare",
    "INDUSTRIALS": "Industrials",
    "REAL ESTATE": "Real Estate",
    "TECHNOLOGY": "Technology",
    "UTILITIES": "Utilities",
}
#: The canonical names map to themselves.
SECTORS |= {v: v for v in SECTORS.values()}
#: Columns of fund sector weights by the names that vendors send.
FUND_SECTORS = {
    "INFORMATION TECHNOLOGY": "information_technology",
    "COMMUNICATION SERVICES": "communication_services",
    "CONSUMER DISCRETIONARY": "consumer_discretionary",
    "CONSUMER STAPLES": "consumer_staples",
    "HEALTHCARE": "healthcare",
    "INDUSTRIALS": "industrials",
    "UTILITIES": "utilities",
    "MATERIALS": "materials",
    "ENERGY": "energy",
    "FINANCIALS": "financials",
    "REAL ESTATE": "real_estate",
}
#: Commodities with their names and the class that says how they are fetched.
COMMODITIES = (
    ("XAU", "Gold", "gold_silver"),
    ("XAG", "Silver", "gold_silver"),
    ("WTI", "West Texas Intermediate Crude Oil", "daily"),
    ("BRENT", "Brent Crude Oil", "daily"),
    ("NATURAL_GAS", "Natural Gas", "daily"),
    ("COPPER", "Copper", "monthly"),
    ("ALUMINUM", "Aluminum", "monthly"),
    ("WHEAT", "Wheat", "monthly"),
    ("CORN", "Corn", "monthly"),
    ("COTTON", "Cotton", "monthly"),
    ("SUGAR", "Sugar", "monthly"),
    ("COFFEE", "Coffee", "monthly"),
    ("ALL_COMMODITIES", "All Commodities", "monthly"),
)
#: Indicators with name, vendor function, interval and maturity.
INDICATORS = (
    ("REAL_GDP", "Real GDP", "REAL_GDP", "quarterly", None),
    ("REAL_GDP_PER_CAPITA", "Real GDP Per Capita", "REAL_GDP_PER_CAPITA", None, None),
    ("TREASURY_YIELD_30Y", "Treasury Yield 30 Years", "TREASURY_YIELD", "daily", "30year"),
    ("TREASURY_YIELD_10Y", "Treasury Yield 10 Years", "TREASURY_YIELD", "daily", "10year"),
    ("TREASURY_YIELD_7Y", "Treasury Yield 7 Years", "TREASURY_YIELD", "daily", "7year"),
    ("TREASURY_YIELD_5Y", "Treasury Yield 5 Years", "TREASURY_YIELD", "daily", "5year"),
    ("TREASURY_YIELD_2Y", "Treasury Yield 2 Years", "TREASURY_YIELD", "daily", "2year"),
    ("TREASURY_YIELD_3M", "Treasury Yield 3 Months", "TREASURY_YIELD", "daily", "3month"),
    ("FEDERAL_FUNDS_RATE", "Federal Funds Rate", "FEDERAL_FUNDS_RATE", "daily", None),
    ("CPI", "Consumer Price Index", "CPI", "monthly", None),
    ("INFLATION", "Inflation", "INFLATION", None, None),
    ("RETAIL_SALES", "Retail Sales", "RETAIL_SALES", None, None),
    ("DURABLES", "Durables", "DURABLES", None, None),
    ("UNEMPLOYMENT", "Unemployment", "UNEMPLOYMENT", None, None),
    ("NONFARM_PAYROLL", "Nonfarm Payroll", "NONFARM_PAYROLL", None, None),
)
#: News topics, each a column of the news table.
TOPICS = (
    "blockchain", "earnings", "ipo", "mergers_and_acquisitions", "financial_markets", "economy_fiscal", "economy_monetary", "economy_macro",
    "energy_transportation", "finance", "life_sciences", "manufacturing", "real_estate", "retail_wholesale", "technology",
)

_S, _D, _F = T.StringType(), T.DateType(), T.FloatType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


CATALOG = struct(symbol=_S, name=_S, ipoDate=_D, delistingDate=_D, status=_S)
STOCKS = struct(symbol=_S, name=_S, sector=_S, ipoDate=_D, delistingDate=_D, status=_S)
ISSUES = struct(symbol=_S, asset_type=_S, endpoint=_S, issue_type=_S, detail=_S, timestamp=T.TimestampNTZType())
PRICES = struct(symbol=_S, Date=T.TimestampNTZType(), Open=_F, High=_F, Low=_F, Close=_F, Volume=_F)
PRICES_DAILY = struct(symbol=_S, Date=_D, Open=_F, High=_F, Low=_F, Close=_F, Volume=_F, DividendAmount=_F, SplitCoefficient=_F)
LISTING_CSV = struct(symbol=_S, name=_S, exchange=_S, assetType=_S, ipoDate=_S, delistingDate=_S, status=_S)
CALENDAR_CSV = struct(symbol=_S, name=_S, reportDate=_S, fiscalDateEnding=_S, estimate=_S, currency=_S, timeOfTheDay=_S)
HOLDINGS = T.ArrayType(struct(symbol=_S, weight=_F))
