"""Markets, stock codes, company aliases and forum addresses."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.functions.text import WS, collapse, compact_cjk, nonempty, strip, text
from tidemill.runtime import ship_active

# Fixed values of the source rules.
CORPORATE_SUFFIXES = ["股份有限公司", "控股有限公司", "集团有限公司", "有限责任公司", "有限公司"]
BUSINESS_SUFFIXES = ["控股", "集团", "股份", "科技"]
_MARKET_SUFFIX = r"(?:-W|\.HK|\.SZ|\.SH|\.SS)"
#: Markets that records are collected for, and the first digits of tickers by exchange; other tickers are of ``sz``.
MARKETS = {"cn": True, "hk": True}
EXCHANGES = {"sh": ("6", "9"), "bj": ("4", "8")}
#: Columns in which lists of companies hold each field, the first that says something wins.
ENTITY_COLUMNS = {
    "ticker": ["证券代码", "A股代码", "代码", "symbol", "品种代码", "Code"],
    "company_name": ["公司全称", "公司名称", "中文名称", "名称", "证券简称"],
    "short_name": ["证券简称", "中文名称", "名称", "简称"],
    "english_name": ["英文名称", "英文简称", "英文名"],
    "exchange": ["交易所", "交易所/板块", "市场", "交易类型"],
}


def market(column: Column) -> Column:
    """``cn`` or ``hk``; anything else is ``cn``."""
    m = F.lower(strip(column))
    return F.when(m.isin("cn", "hk"), m).otherwise(F.lit("cn"))


def ticker(column: Column, of_market: Column) -> Column:
    """Upper case without white space at the ends; null when it isn't six digits (cn) or four or five (hk)."""
    t = F.upper(strip(column))
    good = F.when(of_market == "hk", t.rlike("^[0-9]{4,5}$")).otherwise(t.rlike("^[0-9]{6}$"))
    return F.when(good, t)


def checked_ticker(column: Column, of_market: Column) -> Column:
    """A struct (ticker, error): the ticker, or what is wrong with it, so that bad rows can be set aside."""
    good = ticker(column, of_market)
    wrong = F.when(good.isNull(), F.concat(F.lit("invalid_ticker:"), of_market, F.lit(":"), strip(column)))
    return F.struct(good.alias("ticker"), wrong.alias("error"))


def market_enabled(column: Column) -> Column:
    """Whether records of a market are collected; the markets are a map of constants, so nothing is joined."""
    known = F.create_map(*(F.lit(x) for kv in MARKETS.items() for x in kv))
    return F.coalesce(F.element_at(known, market(column)), F.lit(False))


def exchange_symbol(column: Column) -> Column:
    """A mainland ticker with its exchange in front, by its first digit."""
    first = F.substring(column, 1, 1)
    prefix = F.lit("sz")
    for name, digits in EXCHANGES.items():
        prefix = F.when(first.isin(*digits), name).otherwise(prefix)
    return F.concat(prefix, column)


def forum_list_url(column: Column, of_market: Column, page: Column, base: str) -> Column:
    """The address of a page of a ticker's forum; hk codes get five digits."""
    hk = F.concat(F.lit("hk"), padded_ticker(column, F.lit("hk")), F.lit("_"))
    return F.concat(F.lit(base.rstrip("/") + "/list,"), F.when(of_market == "hk", hk).otherwise(F.concat(column, F.lit(",f_"))), page.cast("string"), F.lit(".html"))


def stock_news_url(column: Column, of_market: Column, page: Column, bases: dict[str, str]) -> Column:
    """The address of a page of a ticker's news by the market's pattern with {symbol} and {page}; null for bad tickers."""
    good = ticker(column, of_market)
    symbol = F.when(of_market == "hk", padded_ticker(good, F.lit("hk"))).otherwise(exchange_symbol(good))
    pattern = F.element_at(F.create_map(*(F.lit(x) for kv in bases.items() for x in kv)), of_market)
    return F.replace(F.replace(pattern, F.lit("{symbol}"), symbol), F.lit("{page}"), page.cast("string"))


def first_said(columns: list[str], have: list[str]) -> Column:
    """The first value that isn't blank of those columns that a table has; empty where none says anything."""
    return F.coalesce(*(nonempty(strip(F.col(f"`{c}`"))) for c in columns if c in have), F.lit(""))


def search_terms(of_ticker: Column, *names: Column) -> Column:
    """All terms by which a company is searched: the forms of its ticker and names, also of the names in form NFKC."""
    return aliases(F.array(of_ticker, *names))


def without_market_suffix(column: Column) -> Column:
    return strip(F.regexp_replace(strip(column), f"(?i)(?:{WS}*{_MARKET_SUFFIX})+{WS}*$", ""))


def code(column: Column) -> Column:
    """A stock code for comparison: letters and digits, no market, no leading zeros."""
    c = F.upper(F.regexp_replace(text(column), "[^0-9A-Za-z]", ""))
    c = F.regexp_replace(F.regexp_replace(c, "HK$", ""), "(?:SH|SZ|SS)$", "")
    return F.when(c.rlike("^[0-9]+$"), F.coalesce(nonempty(F.ltrim(c, F.lit("0"))), F.lit("0"))).otherwise(c)


def _variants(value: str) -> list[str]:
    base = re.sub(r"(?<=[一-鿿])\s+(?=[一-鿿])", "", " ".join(value.split()))
    base = unicodedata.normalize("NFKC", base)
    base = re.sub(rf"(?:\s*{_MARKET_SUFFIX})+\s*$", "", base, flags=re.I).strip()
    company = lambda s: len(re.findall("[一-鿿]", s)) >= 2
    found = [base] if base else []
    for suffixes in (CORPORATE_SUFFIXES, BUSINESS_SUFFIXES):
        for name in list(found):
            ending = next((s for s in suffixes if name.endswith(s)), None)
            if ending and company(rest := name[: -len(ending)].strip()):
                found.append(rest)
    return list(dict.fromkeys(found))


def _code(value: str) -> str:
    c = re.sub("(?:SH|SZ|SS)$", "", re.sub("HK$", "", re.sub("[^0-9A-Za-z]", "", value).upper()))
    return (c.lstrip("0") or "0") if c.isdigit() else c


def aliases(names: Column) -> Column:
    """All forms of a company's ticker and names by which a text can mention it, in order and distinct.

    Runs in Arrow batches, because Unicode forms have no built-in; meant for the small dimension of companies,
    once for each, never for the facts.
    """

    ship_active()

    @F.arrow_udf("array<string>")
    def expand(rows: pa.Array) -> pa.Array:
        out = []
        for row in rows.to_pylist():
            forms = []
            for name in row or []:
                for v in _variants(name) if name and name.strip() else []:
                    c = _code(v)
                    forms += [v, *([c] if c and c != v else []), *([c.zfill(4), c.zfill(5)] if c.isdigit() and len(c) <= 5 else [])]
            out.append(list(dict.fromkeys(forms)))
        return pa.array(out, pa.list_(pa.string()))

    return expand(names)


def mentions(column: Column, forms: Column) -> Column:
    """How often a text mentions the aliases in an array column, summed over aliases.

    ASCII aliases count as whole words whatever their case, others as substrings; of the text as it stands and
    without white space between Han characters, the larger count holds.
    """
    plain, compact = collapse(column), compact_cjk(column)

    def of(alias: Column) -> Column:
        word = F.concat(F.lit(r"(?i)(?<![A-Za-z0-9])\Q"), alias, F.lit(r"\E(?![A-Za-z0-9])"))
        inside = lambda t: ((F.length(t) - F.length(F.replace(t, alias, F.lit("")))) / F.length(alias)).cast("int")
        return F.when(alias == "", 0).when(alias.rlike("^[A-Za-z0-9.:-]+$"), F.greatest(F.regexp_count(plain, word), F.regexp_count(compact, word))).otherwise(F.greatest(inside(plain), inside(compact)))

    return F.aggregate(F.coalesce(forms, F.array().cast("array<string>")), F.lit(0), lambda total, a: total + of(a))


def stock_codes(column: Column) -> Column:
    """All stock codes in a text, without leading zeros, repetitions kept; four digits like a year are none."""
    t = text(column)
    six = F.regexp_extract_all(t, F.lit(r"(?<!\p{Nd})([03468]\p{Nd}{5})(?!\p{Nd})"), F.lit(1))
    hk = [r"(?i)(?:HK|港股|代码|股份代号|股票代码)" + WS + r"*[:：]?" + WS + r"*(\p{Nd}{4,5})(?!\p{Nd})", r"(?i)(?<!\p{Nd})(\p{Nd}{4,5})" + WS + r"*\.HK(?![\p{L}\p{N}_])", r"[（(](\p{Nd}{4,5})[）)]"]
    rest = F.filter(F.concat(*(F.regexp_extract_all(t, F.lit(p), F.lit(1)) for p in hk)), lambda c: ~c.rlike("^(?:19|20)[0-9]{2}$"))
    return F.transform(F.concat(six, rest), lambda c: F.coalesce(nonempty(F.ltrim(c, F.lit("0"))), F.lit("0")))


def forum_ticker(url: Column) -> Column:
    """The ticker in a forum address; hk codes with five digits; null when there is none."""
    hk = nonempty(F.regexp_extract(text(url), r"(?i)list,hk(\d{4,5})_", 1))
    other = nonempty(F.regexp_extract(text(url), r"(?:news|list),([A-Za-z]{0,2}\d{4,6}),", 1))
    return F.coalesce(F.lpad(hk, 5, "0"), F.upper(F.regexp_replace(other, "^[A-Za-z]+", "")))


def forum_post(url: Column) -> Column:
    """The post's number in a forum address: a path, a parameter or a page name, in this order."""
    patterns = (r"(?i)/article/\d+/(\d+)", r"(?i)[?&]postid=(\d+)", r"(?i)news,[^,]+,(\d+)\.html")
    return F.coalesce(*(nonempty(F.regexp_extract(text(url), p, 1)) for p in patterns))


def padded_ticker(column: Column, of_market: Column) -> Column:
    """A bad ticker made up to its market's length with zeros; never cut."""
    width = F.when(of_market == "hk", 5).otherwise(6)
    return F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(0), width - F.length(column))), column)
