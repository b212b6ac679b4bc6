from decimal import Decimal

from sheaf.operators import screener
from tests.conftest import lines_df

HEADER = '"Symbol","Name","LastSale","MarketCap","IPOyear","Sector","industry","Summary Quote",'
# FIXTURES.md 2, "listings"
LISTINGS = [
    HEADER,
    '"AAA","A, Inc.","1","$10.5M","n/a","Tech","x","u",',
    '"BBB","B, Inc.","1","$2B","n/a","Tech","x","u",',
    '"CCC","C","1","n/a","n/a","Tech","x","u",',
    '"DDD","D","1","$1500","n/a","Tech","x","u",',
    '"EEE     ","E","1","$1M","n/a","n/a","x","u",',
    '"FFF","F","1","$3M","n/a","Tech","x",',
    '"GGG","G","1","$x","n/a","Tech","x","u",',
]


def records(spark):
    return screener.listing_records(lines_df(spark, LISTINGS))


def test_quote_aware_scan_drops_header_and_counts_fields(spark):
    rows = {r.symbol: r for r in records(spark).collect()}
    assert "Symbol" not in rows
    assert rows["AAA"].name == "A, Inc." and rows["AAA"].field_count == 9
    assert rows["FFF"].field_count == 8
    assert rows["EEE     "].sector == "n/a"


def test_market_cap_parse_and_both_filters(spark):
    got = {r.symbol: r for r in screener.market_cap_flags(records(spark)).collect()}
    assert got["AAA"].cap_value == Decimal("10500000.00")
    assert got["DDD"].cap_value == Decimal("1500.00")
    assert got["BBB"].cap_value is None and got["CCC"].cap_value is None and got["GGG"].cap_value is None
    assert (got["BBB"].keep_substring, got["BBB"].keep_suffix) == (False, False)
    assert (got["CCC"].keep_substring, got["CCC"].keep_suffix) == (False, False)
    assert (got["AAA"].keep_substring, got["AAA"].keep_suffix) == (True, True)


def test_sector_rollup_exact_sums_and_unparsed_count(spark):
    screened = screener.screen(records(spark))
    got = {r.sector: r for r in screener.sector_rollup(screened).collect()}
    # Tech keeps AAA, DDD and GGG (bad cap: counted, not summed); FFF has 8 fields.
    assert got["Tech"].ticker_count == 3
    assert got["Tech"].total_cap == Decimal("10501500.00")
    assert got["Tech"].unparsed_caps == 1
    assert got["n/a"].ticker_count == 1  # the n/a sector is a group (D11)


def test_truncated_rollup_goes_through_float(spark):
    lines = [HEADER, '"A","A","1","$16777217","n/a","S","x","u",', '"B","B","1","$1.9","n/a","S","x","u",']
    got = screener.sector_rollup_truncated(screener.screen(screener.listing_records(lines_df(spark, lines)))).first()
    # 16777217 is not a float; it becomes 16777216. 1.9 truncates to 1.
    assert got.total_cap_truncated == 16777216 + 1


def test_sector_tickers_sorted_with_padding_kept(spark):
    got = [(r.sector, r.ticker) for r in screener.sector_tickers(screener.screen(records(spark))).collect()]
    assert got == [("Tech", "AAA"), ("Tech", "DDD"), ("Tech", "GGG"), ("n/a", "EEE     ")]


def test_sector_report_lines(spark):
    got = {r.sector: r for r in screener.sector_report(screener.screen(records(spark))).collect()}
    assert got["n/a"].capital_line == "(n/a,(Sector capital = 1000000.00,Ticker count = 1))"
    assert got["n/a"].totals_line == "Total tickers for n/a = 1; Total capitalization for n/a= $1000000"


def test_substring_rule_without_width_check(spark):
    lines = LISTINGS + ['"HHH","H","1","$4Bn/a","n/a","Tech","x","u",', '"III","I","1","$5.0MB?","n/a","Tech","x","u",']
    recs = screener.listing_records(lines_df(spark, lines))
    canonical = {r.ticker for r in screener.screen(recs).collect()}
    rdd_rule = {r.ticker for r in screener.screen(recs, rule="substring", check_width=False).collect()}
    assert canonical == {"AAA", "DDD", "GGG", "EEE     ", "HHH", "III"}
    # the substring rule drops HHH and III (both hold a B) and keeps the 8-field FFF
    assert rdd_rule == {"AAA", "DDD", "GGG", "EEE     ", "FFF"}
