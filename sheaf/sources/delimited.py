"""Delimited text: plain comma split (S2), quote-aware CSV (S3), header drop (S4),
tab-delimited typed tables (S5).

Lines may come from files (``read_*``, the scalable path: the CSV reader splits files
across tasks and prunes columns) or from a string column (``parse_*``, same parser
through ``from_csv``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

QUOTED_SPAN = r'"[^"]*"'

# A quote inside a quoted field is doubled; a backslash is a plain character.
QUOTED_OPTIONS = {"mode": "PERMISSIVE", "quote": '"', "escape": '"'}


def naive_fields(line: Column) -> Column:
    """Split on every comma, keep trailing empty fields, quotes not honoured."""
    return F.split(line, ",", -1)


def quoted_field_count(line: Column) -> Column:
    """Number of fields when commas inside double quotes do not separate."""
    outside = F.regexp_replace(line, QUOTED_SPAN, "")
    return F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1


def project_once(df: DataFrame, keep: tuple[str, ...] = (), **columns: Column) -> DataFrame:
    """``df.select(*keep, **columns)``, with the new columns produced by a generator
    (``inline`` of a one-element array of one struct).

    Later filters on these columns cannot be pushed below a generator, so the optimizer
    does not rewrite them into copies of the expressions (a parser call, a split, or the
    expression that built the line): each row computes them once."""
    packed = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.inline(F.array(packed)))


def parse_quoted(df: DataFrame, schema: str, line_col: str = "value", *keep: str) -> DataFrame:
    """S3 on a column of lines: quote-aware fields, typed by ``schema`` (a DDL string).

    Commas inside quotes do not separate, and every quote is then deleted (P4), doubled
    ones too. An empty text field is an empty text, one past the end of a short line is
    NULL; cells that do not fit their type become NULL.
    """
    texts = [f.name for f in StructType.fromDDL(schema).fields if f.dataType == StringType()]
    names = StructType.fromDDL(schema).fieldNames()
    options = ", ".join(f"'{k}', '{v}'" for k, v in QUOTED_OPTIONS.items())
    outside = f"regexp_replace(`{line_col}`, '{QUOTED_SPAN}', '')"
    # one generator, so that each row is parsed once (project_once)
    parsed = df.selectExpr(*keep, f"""inline(array(named_struct(
        '_rec', from_csv(`{line_col}`, '{schema}', map({options})),
        'field_count', length({outside}) - length(replace({outside}, ',', '')) + 1)))""")
    return parsed.selectExpr(*keep, *[
        f"CASE WHEN field_count > {i} THEN coalesce(replace(_rec.`{n}`, '\"', ''), '') END AS `{n}`" if n in texts else f"_rec.`{n}`"
        for i, n in enumerate(names)
    ], "field_count")


def _unquoted(name: str) -> Column:
    return F.replace(F.col(name), F.lit('"'), F.lit(""))


def read_quoted(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """S3 on files, quotes deleted; an empty field is NULL here. No header option: files may
    be concatenated, so drop headers by value."""
    rows = spark.read.schema(schema).options(**QUOTED_OPTIONS).csv(path)
    texts = [f.name for f in rows.schema.fields if f.dataType == StringType()]
    return rows.withColumns({n: _unquoted(n) for n in texts})


def drop_header(df: DataFrame, column: str, sentinel: str) -> DataFrame:
    """Drop rows whose ``column`` equals the header text (NULL rows stay)."""
    return df.filter(~F.col(column).eqNullSafe(sentinel))


# A Hive ``ROW FORMAT DELIMITED FIELDS TERMINATED BY '\t'`` table has no
# quoting; time stamps are ``yyyy-MM-dd HH:mm:ss`` with an optional fraction.
TAB_OPTIONS = {
    "sep": "\t",
    "quote": "",
    "mode": "PERMISSIVE",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
}


def parse_tab(df: DataFrame, schema: str, line_col: str = "value") -> DataFrame:
    """S5 on a column of lines: typed fields; a bad cell (text in an INT, a TINYINT
    overflow, a bad time stamp) becomes NULL, the rest of the row stays."""
    return df.select(F.from_csv(F.col(line_col), schema, TAB_OPTIONS).alias("_rec")).select("_rec.*")


def read_tab(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """S5 on files."""
    return spark.read.schema(schema).options(**TAB_OPTIONS).csv(path)
