"""Property tests: Spark results against plain-Python models on random inputs."""

from __future__ import annotations

import csv
import io
import os
import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sheaf.operators import wordcount
from sheaf.sources.delimited import parse_quoted

# PROPERTY_EXAMPLES raises the number of random cases per property (25 by default).
SETTINGS = settings(
    max_examples=int(os.environ.get("PROPERTY_EXAMPLES", "25")),
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)

ASCII_NON_WORD = re.compile(r"[^A-Za-z0-9_]+")


def model_lines(text: str) -> list[str]:
    """A line reader: terminators \\r\\n, \\r, \\n; no line after a final terminator."""
    if text == "":
        return []
    pieces = re.split(r"\r\n|\r|\n", text)
    if pieces[-1] == "":
        pieces.pop()
    return pieces


def model_java_split(line: str) -> list[str]:
    """Java's String.split("\\\\W+"): [""] for "", trailing empty pieces removed."""
    if line == "":
        return [""]
    parts = ASCII_NON_WORD.split(line)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


tokens = st.sampled_from(list("ab Z9_.,é\t") + ["\n", "\r\n", "\r"])
texts = st.lists(st.lists(tokens, max_size=40).map("".join), min_size=1, max_size=6)


@SETTINGS
@given(texts)
def test_raw_word_count_equals_model(spark, docs):
    df = spark.createDataFrame([(t,) for t in docs], "text STRING")
    got = {r.word: r.occurrences for r in wordcount.word_count_raw(df, "text").collect()}
    want = Counter(w for t in docs for line in model_lines(t) for w in model_java_split(line))
    assert got == dict(want)
    plain = {r.word: r.occurrences for r in wordcount.word_count(df, "text").collect()}
    assert plain == {w: c for w, c in want.items() if w}


fields = st.text(alphabet=st.sampled_from(list('ab ,$M1."\\')), max_size=8)


@SETTINGS
@given(st.lists(st.lists(fields, min_size=3, max_size=3), min_size=1, max_size=8))
def test_quoted_parse_equals_csv_module(spark, records):
    lines = []
    for rec in records:
        buf = io.StringIO()
        csv.writer(buf, quoting=csv.QUOTE_ALL, lineterminator="").writerow(rec)
        lines.append(buf.getvalue())
    df = spark.createDataFrame([(x,) for x in lines], "value STRING")
    got = parse_quoted(df, "a STRING, b STRING, c STRING").collect()
    # every quote is deleted, also those inside a field
    want = [tuple(x.replace('"', "") for x in rec) + (3,) for rec in records]
    assert sorted((r.a, r.b, r.c, r.field_count) for r in got) == sorted(want)


PLAIN_DECIMAL = re.compile(r"[0-9]*\.[0-9]*")


def model_fundamentals(line: str):
    """The extract rules on one line: (valid, symbol, dividend, pe, short_or_blank, no_div)."""
    t = [x.replace('"', "") for x in next(csv.reader([line]), None) or [""]]
    div = t[4] if len(t) > 4 else None
    pe = t[5] if len(t) > 5 else None
    no_div, no_pe = div == "", pe == ""
    short_or_blank = len(t) != 15 or no_div or no_pe
    div = "0.0" if no_div else div
    pe = "-Infinity" if no_pe else pe
    div_ok = div is not None and PLAIN_DECIMAL.fullmatch(div) is not None
    pe_ok = pe is not None and (pe == "-Infinity" or PLAIN_DECIMAL.fullmatch(pe) is not None)
    valid = div_ok and pe_ok and t[0] != "Symbol"
    return valid, t[0], div, pe, short_or_blank, no_div


cells = st.sampled_from(["", "1.5", "12", ".", "3.", "-1.0", "n/a", "x", "Symbol", '"A,B"', '"x""1.5"'])


@SETTINGS
@given(st.lists(st.lists(cells, min_size=1, max_size=17).map(",".join), min_size=1, max_size=12))
def test_fundamentals_rules_equal_model(spark, lines):
    from sheaf.operators import fundamentals

    df = spark.createDataFrame([(x,) for x in lines], "value STRING")
    models = [model_fundamentals(x) for x in lines]
    got = sorted((r.symbol, r.dividend, r.pe) for r in fundamentals.extract(df).collect())
    assert got == sorted((s, d, p) for v, s, d, p, _, _ in models if v)
    q = fundamentals.quality(df).first()
    valid = sum(m[0] for m in models)
    blank = sum(m[4] for m in models)
    assert (q.total_lines, q.valid, q.no_dividend) == (len(lines), valid, sum(m[5] for m in models))
    assert q.invalid_events == blank + (len(lines) - valid)
    assert q.invalid_rows == sum(1 for m in models if m[4] or not m[0])


def model_money(text: str):
    """P5 on exact decimals: drop $, a text holding M is in millions; else unparsable."""
    from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

    digits = text.replace("$", "")
    millions = "M" in digits
    if millions:
        digits = digits.replace("M", "")
    if not re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)", digits.strip()):
        return None
    try:
        value = Decimal(digits.strip()) * (1000000 if millions else 1)
        return value.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)  # once, after the multiplication
    except InvalidOperation:
        return None


money_texts = st.builds(
    lambda pre, num, suf: pre + num + suf,
    st.sampled_from(["$", "", "$$"]),
    st.sampled_from(["1", "10.5", "0.01", "-3.25", "12.345", "x", "", "n/a", "7."]),
    st.sampled_from(["", "M", "B", "MB"]),
)


@SETTINGS
@given(st.lists(money_texts, min_size=1, max_size=10))
def test_money_rules_equal_model(spark, caps):
    from sheaf.functions.money import keep_cap_by_substring, keep_cap_by_suffix, money_value
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, c) for i, c in enumerate(caps)], "i INT, cap STRING")
    got = {
        r.i: (r.v, r.sub, r.suf)
        for r in df.select(
            "i",
            money_value(F.col("cap")).alias("v"),
            keep_cap_by_substring(F.col("cap")).alias("sub"),
            keep_cap_by_suffix(F.col("cap")).alias("suf"),
        ).collect()
    }
    for i, c in enumerate(caps):
        v, sub, suf = got[i]
        assert v == model_money(c), c
        assert sub == ("B" not in c and "n/a" not in c)
        assert suf == (c != "n/a" and not c.endswith("B"))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("ABCDE"), st.one_of(st.none(), st.sampled_from([0.0, 1.5, 2.0, 50.0]))),
                min_size=1, max_size=15))
def test_top_k_equals_sorted_model(spark, rows):
    from sheaf.operators import growth

    df = spark.createDataFrame(rows, "symbol STRING, growth DOUBLE")
    got = [(r.symbol, r.growth) for r in growth.top_k(df, "growth", 4).collect()]
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0.0), r[0]))[:4]
    assert got == want


date_texts = st.builds(
    lambda d, hh, mm, bare: f"2014-05-{d:02d}" if bare else f"2014-05-{d:02d} {hh:02d}:{mm:02d}:00",
    st.integers(15, 19), st.integers(0, 23), st.integers(0, 59), st.booleans(),
)


@SETTINGS
@given(st.lists(st.tuples(date_texts, st.sampled_from(["COMPLETE", "PENDING"])), min_size=1, max_size=20))
def test_date_readings_equal_model(spark, rows):
    from sheaf.operators import retail

    df = spark.createDataFrame([(i, d, s) for i, (d, s) in enumerate(rows)], "order_id INT, order_datestr STRING, order_status STRING")
    day = "2014-05-17"
    done = [d for d, s in rows if s == "COMPLETE"]
    assert retail.count_until_lexical(df, "COMPLETE", day).first().n_orders == sum(d <= day for d in done)
    assert retail.count_until(df, "COMPLETE", day).first().n_orders == sum(d[:10] <= day for d in done)
    assert retail.count_on(df, "COMPLETE", day).first().n_orders == sum(d[:10] == day for d in done)


number_texts = st.sampled_from(["n/a", "", "0", "0.0", "1.5", "10", "12.25", "x"])


def model_growth(dividend: str, low: str, high: str):
    def num(t, blank_too):
        if t == "n/a" or (blank_too and t == ""):
            t = "0.0"
        try:
            return float(t)
        except ValueError:
            return None

    d, lo, hi = num(dividend, True), num(low, False), num(high, False)
    growth = None if lo is None or hi is None or lo == 0 else (hi - lo) / lo * 100.0
    return d, growth


@SETTINGS
@given(st.lists(st.tuples(number_texts, number_texts, number_texts), min_size=1, max_size=12))
def test_growth_rules_equal_model(spark, rows):
    from sheaf.operators import growth

    df = spark.createDataFrame(
        [(f"S{i}", d, lo, hi) for i, (d, lo, hi) in enumerate(rows)],
        "symbol STRING, dividend STRING, week52_low STRING, week52_high STRING",
    )
    got = {r.symbol: (r.dividend, r.growth) for r in growth.growth_table(df).collect()}
    assert got == {f"S{i}": model_growth(*row) for i, row in enumerate(rows)}


facts_rows = st.lists(st.tuples(st.integers(0, 5), st.integers(1, 9)), min_size=1, max_size=25)
dims_rows = st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["a", "b", "c"])), min_size=1, max_size=8)


@SETTINGS
@given(facts_rows, dims_rows)
def test_aggregate_then_join_equals_join_then_group(spark, facts, dims):
    from sheaf.operators import retail

    f = spark.createDataFrame(facts, "k INT, v INT")
    d = spark.createDataFrame(dims, "dk INT, name STRING")
    sums, counts = Counter(), Counter()
    for k, v in facts:
        for dk, name in dims:
            if k == dk:
                sums[(k, name)] += v
                counts[name] += 1
    got_sums = {(r.k, r.name): r.total for r in retail.top_sum_named(f, d, "k", "dk", "name", "v", 1000, "total").collect()}
    assert got_sums == dict(sums)
    got_counts = {r.name: r.n for r in retail.group_count_ranked_named(f, d, "k", "dk", "name", "v").collect()}
    assert got_counts == dict(counts)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["a", "ab", ""])),
                          st.one_of(st.none(), st.sampled_from(["b", "", "c"]))), min_size=1, max_size=15))
def test_distinct_concat_equals_model(spark, rows):
    from sheaf.operators import retail

    df = spark.createDataFrame(rows, "x STRING, y STRING")
    want = len({x + y for x, y in rows if x is not None and y is not None})
    assert retail.count_distinct_concat(df, ["x", "y"], "n").first().n == want
