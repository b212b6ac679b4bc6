from sheaf.operators import fundamentals
from tests.conftest import lines_df

HEADER = (
    "Symbol,Name,Sector,Price,Dividend Yield,Price/Earnings,Earnings/Share,Book Value,"
    "52 week low,52 week high,Market Cap,EBITDA,Price/Sales,Price/Book,SEC Filings"
)


def line(symbol, dividend, pe, name="N"):
    return ",".join([symbol, name, "S", "10.00", dividend, pe] + ["1"] * 9)


# FIXTURES.md 2, "fundamentals"
LINES = [
    HEADER,
    line("OK", "1.50", "20.10"),
    line("NODIV", "", "3.10"),
    line("NOPE", "2.00", ""),
    line("NA", "n/a", "1.00"),
    line("INT", "12", "1.00"),
    line("NEG", "1.00", "-1.0"),
    line("SHIFT", "4.00", "5.00", name='"Name, Inc."'),
    "SHORT,a,b,c",
]


def test_extract_rules(spark):
    got = {r.symbol: r for r in fundamentals.extract(lines_df(spark, LINES)).collect()}
    # SHIFT's quoted comma leaves its fields in place
    assert set(got) == {"OK", "NODIV", "NOPE", "SHIFT"}
    assert (got["NODIV"].dividend, got["NODIV"].pe) == ("0.0", "3.10")
    assert got["NOPE"].pe == "-Infinity" and got["NOPE"].pe_value == float("-inf")
    assert (got["SHIFT"].dividend, got["SHIFT"].pe) == ("4.00", "5.00")


def test_quality_counts_events(spark):
    q = fundamentals.quality(lines_df(spark, LINES)).first()
    assert q.total_lines == 9
    assert q.valid == 4
    assert q.no_dividend == 1
    # wrong width or blank field: NODIV, NOPE, SHORT -> 3 events;
    # filtered: header, NA, INT, NEG, SHORT -> 5 more events (D3).
    assert q.invalid_events == 8
    assert q.invalid_rows == 7


def test_naive_scan_flags_shifted_rows(spark):
    got = {r.symbol: r for r in fundamentals.naive_scan(lines_df(spark, LINES)).collect()}
    assert got["SHIFT"].field_count == 16 and got["SHIFT"].quoted_field_count == 15 and got["SHIFT"].shifted
    assert (got["SHIFT"].dividend_field, got["SHIFT"].pe_field) == ("10.00", "4.00")
    assert not got["OK"].shifted and got["OK"].field_count == 15
    assert got["SHORT"].dividend_field is None
