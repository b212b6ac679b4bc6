"""Delimited text with nested columns: maps, arrays and structs of plain values inside the
fields of a line (rows S6, T1; the shape of the loyalty file).

Fields, items and map keys each have their own delimiter. Parsing and rendering are column
expressions, so files split over tasks and nothing leaves the JVM.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from sheaf.sources.delimited import project_once

# Private code points that stand for escaped characters while a line is split.
HIDDEN = "\ue000\ue001\ue002\ue003"


@dataclass(frozen=True)
class NestedFormat:
    """The delimiters (one character each), the text of a NULL and, if set, the character
    that takes the next delimiter (or itself) literally."""

    field: str = "|"
    item: str = ","
    key: str = ":"
    null: str = r"\N"
    escape: str | None = None

    def __post_init__(self):
        marks = [self.field, self.item, self.key, *([self.escape] if self.escape else [])]
        if any(len(m) != 1 for m in marks) or len(set(marks)) != len(marks):
            raise ValueError(f"delimiters must be single, different characters: {marks}")


# The control characters of a delimited table that names no delimiters.
DEFAULT_DELIMITED = NestedFormat("\x01", "\x02", "\x03")


def _shown(text: Column, fmt: NestedFormat) -> Column:
    return F.translate(text, HIDDEN, fmt.escape + fmt.field + fmt.item + fmt.key) if fmt.escape else text


def _hidden(line: Column, fmt: NestedFormat) -> Column:
    if fmt.escape:
        for mark, hidden in zip((fmt.escape, fmt.field, fmt.item, fmt.key), HIDDEN, strict=True):
            line = F.replace(line, F.lit(fmt.escape + mark), F.lit(hidden))
    return line


def _split(text: Column, mark: str, limit: int = -1) -> Column:
    return F.split(text, re.escape(mark), limit)


def _plain(text: Column, kind: DataType, fmt: NestedFormat) -> Column:
    """One value: NULL for the NULL text and for text that does not fit its type."""
    if isinstance(kind, (ArrayType, MapType, StructType)):
        raise ValueError(f"a nested column holds plain values, not {kind.simpleString()}")
    shown = _shown(text, fmt)
    return F.when(text != fmt.null, shown if isinstance(kind, StringType) else shown.try_cast(kind))


def _items(text: Column, fmt: NestedFormat) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(_split(text, fmt.item))


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _map(text: Column, kind: MapType, fmt: NestedFormat) -> Column:
    def entry(item: Column) -> Column:
        return _once(_split(item, fmt.key, 2), lambda parts: F.struct(
            _plain(F.get(parts, 0), kind.keyType, fmt).alias("key"), _plain(F.get(parts, 1), kind.valueType, fmt).alias("value")))

    def first_of_each_key(entries: Column) -> Column:
        keys = F.transform(entries, lambda e: e["key"])
        return F.filter(entries, lambda e, i: F.array_position(keys, e["key"]) == i + 1)

    return F.map_from_entries(_once(F.transform(_items(text, fmt), entry), first_of_each_key))


def _cell(text: Column, kind: DataType, fmt: NestedFormat) -> Column:
    if isinstance(kind, MapType):
        value = _map(text, kind, fmt)
    elif isinstance(kind, ArrayType):
        value = F.transform(_items(text, fmt), lambda x: _plain(x, kind.elementType, fmt))
    elif isinstance(kind, StructType):
        value = _once(_split(text, fmt.item), lambda parts: F.struct(
            *[_plain(F.get(parts, i), f.dataType, fmt).alias(f.name) for i, f in enumerate(kind.fields)]))
    else:
        return _plain(text, kind, fmt)
    return F.when(text != fmt.null, value)


def parse_nested(
    lines: DataFrame, schema: str, fmt: NestedFormat = NestedFormat(), line_col: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """The columns of ``schema`` (a DDL string) from a column of lines, after ``keep``.

    A field past the end of a short line is NULL, fields past the schema are ignored. An
    empty field is an empty text, array or map. An array or struct may be short (what is
    missing is NULL, a struct's further items are ignored); a map entry without a key mark has
    a NULL value, of equal keys the first counts, and an entry whose key is NULL is left out.
    A value that does not fit its type is NULL and the rest of the line stays."""
    kinds = StructType.fromDDL(schema)
    split = project_once(lines, keep, _cells=_split(_hidden(F.col(line_col), fmt), fmt.field))
    return split.select(*keep, *[_cell(F.get("_cells", i), f.dataType, fmt).alias(f.name) for i, f in enumerate(kinds.fields)])


def read_nested(
    spark: SparkSession, path: str | list[str], schema: str, fmt: NestedFormat = NestedFormat()
) -> DataFrame:
    """``parse_nested`` of text files."""
    return parse_nested(spark.read.text(path), schema, fmt)


def _marked(value: Column, fmt: NestedFormat) -> Column:
    text = value.cast("string")
    if fmt.escape:
        for mark in (fmt.escape, fmt.field, fmt.item, fmt.key):
            text = F.replace(text, F.lit(mark), F.lit(fmt.escape + mark))
    return F.coalesce(text, F.lit(fmt.null))


def nested_line(df: DataFrame, fmt: NestedFormat = NestedFormat()) -> Column:
    """A line of all columns of ``df``, which ``parse_nested`` reads back. Without an escape
    character, texts must not hold a delimiter; an array of one empty text reads back empty,
    one of one NULL as NULL."""
    def cell(name: str, kind: DataType) -> Column:
        c = F.col(name)
        if isinstance(kind, MapType):
            text = F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(
                _marked(e["key"], fmt), F.lit(fmt.key), _marked(e["value"], fmt))), fmt.item)
        elif isinstance(kind, ArrayType):
            text = F.array_join(F.transform(c, lambda x: _marked(x, fmt)), fmt.item)
        elif isinstance(kind, StructType):
            text = F.when(c.isNotNull(), F.concat_ws(fmt.item, *[_marked(c.getField(f.name), fmt) for f in kind.fields]))
        else:
            return _marked(c, fmt)
        return F.coalesce(text, F.lit(fmt.null))

    return F.concat_ws(fmt.field, *[cell(f.name, f.dataType) for f in df.schema.fields])
