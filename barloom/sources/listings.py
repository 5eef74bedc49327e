"""Exchange lists and the default lists of the correlation matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Tickers by exchange, in order; the first exchange that lists a ticker wins.
US_LISTINGS = {
    "NYSE": [
        "JNJ", "LLY", "MA", "MCD", "WMT", "LMT", "JPM", "UNH", "XOM", "MCK", "GE", "BRK-B", "GM",
        "T", "K", "F", "DAL", "GS", "MSI", "V", "CAT", "SHW", "IBM", "HD", "BA", "MMM", "DIS", "PG",
        "CVX", "MRK", "VZ", "KO", "AXP", "TRV", "NKE", "BB", "TOST", "FUBO", "CHPT", "SNAP", "PLTR",
        "LMND", "CRM", "ORCL", "NOW", "SHOP",
    ],
    "NASDAQ": [
        "AAPL", "MSFT", "AMZN", "GOOGL", "GOOG", "META", "NVDA", "TSLA", "AVGO", "AMD", "INTC",
        "AMAT", "LRCX", "QCOM", "ADBE", "INTU", "NFLX", "PEP", "SBUX", "COST", "PYPL", "AMGN",
        "GILD", "REGN", "CSX", "ADP", "MAR", "QQQ", "IEI", "HON",
    ],
    "ARCX": [
        "SPY", "IWM", "DIA", "XLB", "XLC", "XLE", "XLF", "XLI", "XLK", "XLP", "XLRE", "XLU", "XLV",
        "XLY", "XHB", "GLD", "SLV", "UNG", "DBA", "DBC", "USO", "CPER", "SGOV", "SHY", "IEF", "TLT",
    ],
    "CBOE": ["^VIX"],
}
INTL_LISTINGS = {
    "NASDAQ COPENHAGEN": ["NOVO-B.CO", "DANSKE.CO", "CARL-B.CO", "VWS.CO"],
    "NASDAQ HELSINKI": ["NOKIA.HE", "KNEBV.HE", "UPM.HE", "OUT1V.HE", "FORTUM.HE"],
    "NASDAQ ICELAND": [],
    "OSLO BØRS": ["EQNR.OL", "NHY.OL", "TEL.OL", "ORK.OL", "DNB.OL"],
    "NASDAQ STOCKHOLM": ["VOLV-B.ST", "ERIC-B.ST", "ATCO-A.ST", "SAND.ST"],
    "XETRA": ["SAP.DE", "SIE.DE", "VOW.DE", "ALV.DE", "DTE.DE"],
    "EURONEXT PARIS": ["MC.PA", "OR.PA"],
    "SIX SWISS": ["NESN.SW", "ROG.SW"],
    "TSE (JP)": ["7203.T", "6758.T", "9432.T"],
    "KRX": ["005930.KS"],
    "ASX": ["BHP.AX"],
    "HKEX": ["0700.HK"],
    "NSE INDIA": ["RELIANCE.NS"],
}

# Words of which a vendor's exchange name must contain one, by list.
EXCHANGE_KEYWORDS = {
    "NYSE": ["NYSE", "NYQ", "NEW YORK STOCK EXCHANGE"],
    "NASDAQ": ["NASDAQ", "NMS", "NASDAQGS", "NASDAQGM", "NASDAQCM"],
    "ARCX": ["ARCA", "NYSE ARCA", "NYSEARCA", "PCX", "NASDAQGM"],
    "CBOE": ["CBOE", "CHICAGO OPTIONS", "CHICAGO BOARD OPTIONS EXCHANGE"],
    "NASDAQ COPENHAGEN": ["COPENHAGEN", "CSE"],
    "NASDAQ HELSINKI": ["HELSINKI", "HEL"],
    "NASDAQ ICELAND": ["ICELAND"],
    "OSLO BØRS": ["OSLO", "OSE", "EURONEXT OSLO", "OSLO BORS", "OSL"],
    "NASDAQ STOCKHOLM": ["STOCKHOLM", "STO"],
    "XETRA": ["XETRA"],
    "EURONEXT PARIS": ["PARIS", "EURONEXT PARIS", "PAR"],
    "SIX SWISS": ["SWISS", "SIX", "SWX"],
    "TSE (JP)": ["TOKYO", "TSE"],
    "KRX": ["KOREA", "KRX", "KOE", "KSE", "KSC"],
    "ASX": ["ASX", "AUSTRALIAN"],
    "HKEX": ["HONG KONG", "HKEX", "HKG", "HKSE"],
    "NSE INDIA": ["NSE", "NSEI", "NSI", "INDIA"],
}

# Listings the vendor reports under another exchange: ticker -> (list, vendor text).
KNOWN_EXCEPTIONS = {
    "PLTR": ("NYSE", "NASDAQGS"),
    "SHOP": ("NYSE", "NASDAQGS"),
}

# Rows, compared tickers and shown columns of the correlation matrix.
CORRELATION_FOCAL = [
    "AAPL", "MSFT", "NVDA", "GOOGL", "AMZN", "META", "TSLA", "PLTR", "SOFI", "NFLX", "COST",
    "BRK-B", "PEP", "JNJ", "MA", "MCD", "WMT", "LMT", "INTU", "JPM", "UNH", "XOM", "MCK", "GE",
    "IBM", "CRM",
]
CORRELATION_UNIVERSE = [
    "AAPL", "AMD", "AMZN", "GOOG", "META", "MSFT", "NVDA", "SOFI", "TSLA", "JNJ", "MA", "MCD",
    "WMT", "LMT", "INTU", "JPM", "UNH", "XOM", "MCK", "GE", "COST", "BRK-B", "DBX", "GM", "T", "K",
    "AAL", "F", "DAL", "GS", "MSI", "PYPL", "PLTR", "AVGO", "GOOGL", "PEP", "V", "CAT", "SHW",
    "IBM", "CRM", "HD", "BA", "MMM", "DIS", "PG", "CVX", "MRK", "CSCO", "VZ", "KO", "HON", "AXP",
    "AMGN", "TRV", "NFLX", "NKE", "BB", "RIVN", "LCID", "TOST", "FUBO", "CHPT", "SNAP", "CHYM",
    "LYFT", "CLOV", "LMND",
]
CORRELATION_COLUMNS = [
    "AAPL", "AMD", "AMZN", "GOOG", "META", "MSFT", "NVDA", "SOFI", "TSLA", "JNJ", "MA", "MCD",
    "WMT", "LMT", "INTU", "JPM", "UNH", "XOM", "MCK", "GE", "COST", "BRK-B", "PEP", "IBM", "CRM",
]


def listing_rows(spark: SparkSession, lists: dict[str, list[str]] | None = None) -> DataFrame:
    """(exchange, priority, pos, ticker) rows of the given lists (default: all of them)."""
    lists = lists if lists is not None else {**US_LISTINGS, **INTL_LISTINGS}
    rows, pos = [], 0
    for priority, (exchange, tickers) in enumerate(lists.items()):
        for ticker in tickers:
            rows.append((exchange, priority, pos, ticker))
            pos += 1
    return spark.createDataFrame(rows, "exchange string, priority int, pos int, ticker string")
