"""Secret scans: every rule in one minimal byte automaton, one pass over each text.

The automaton reports, after each byte, which rules a match may end with there. A match
ends where a rule stops accepting; an automaton of the mirrored rule, run back from that
end (not past the rule's previous match), gives the leftmost start. That equals leftmost
non-overlapping greedy matching for rules that end in a repeated class no earlier part of
the rule can cross, as all of these do. Matches that fail a rule's least length are dropped
after they have consumed their text. A private key's span runs from its first line to its last
one, or to the end of the text where that is missing, so its body goes with it.

Cases: a null text counts as empty; a null doc_id is kept; every row gives one row, also
repeated ones; an empty table gives no rows; extra columns are not read. Offsets are code
points, ends exclusive. Time and memory of a text are linear in its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from operator import length_hint

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm import automaton
from sheaf.llm.arrays import blocks


@dataclass(frozen=True)
class Rule:
    """A match needs ``least`` characters; ``value_only`` counts those behind the
    separator, its spaces and its quote. A count in the pattern would multiply the states
    of the joint automaton, so only hex, which matches almost anywhere, has one."""

    kind: str
    pattern: str
    least: int = 0
    ignore_case: bool = False
    value_only: bool = False
    until: str = ""  # the kind of the rule that closes a span; such a rule gives none itself


# The base kinds, in the order they are listed, and further token formats.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=12,
        ignore_case=True,
        value_only=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", until="key_end"),
    Rule("key_end", r"-----END ([A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
)
RULES = BASE + MORE


@cache
def _compiled(rules: tuple[Rule, ...]):
    trees = [automaton.parse(r.pattern, r.ignore_case) for r in rules]
    forward = automaton.compile_rules(trees, anywhere=True).linked()[0]
    back = [automaton.compile_rules([automaton.reverse(t)], anywhere=False).linked() for t in trees]
    return forward, back


def _start(data: bytes, rows: list, floor: int, end: int) -> int:
    """The leftmost start at or after ``floor`` of a match that ends at ``end``, or -1."""
    found, i, row = -1, end, rows[0]
    while i > floor:
        i -= 1
        row = row[data[i]]
        if row[256]:
            found = i
        elif row[257]:
            break
    return found


def find(data: bytes, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, int]]:
    """(start byte, rule index, end byte) of all spans, in that order."""
    start_row, back = _compiled(rules)
    spans: list[tuple[int, int, int]] = []
    floor = [0] * len(rules)

    def close(ended: int, end: int) -> None:
        k = 0
        while ended >> k:
            if ended >> k & 1:
                s = _start(data, back[k], floor[k], end)
                if s >= 0:
                    floor[k] = end
                    body = data[s:end].decode()
                    if (_value_length(body) if rules[k].value_only else len(body)) >= rules[k].least:
                        spans.append((s, k, end))
            k += 1

    row = start_row
    steps, size = iter(data), len(data)
    for b in steps:
        row = row[b]
        if row[256]:  # seldom: follow until no rule accepts any more
            before = row[256]
            for c in steps:
                row = row[c]
                mask = row[256]
                if mask != before:
                    close(before & ~mask, size - length_hint(steps) - 1)
                    before = mask
                    if not mask:
                        break
            else:
                close(before, size)
    spans.sort()
    return _closed(spans, rules, size)


def _closed(spans: list[tuple[int, int, int]], rules: tuple[Rule, ...], size: int) -> list[tuple[int, int, int]]:
    """Spans of rules with an ``until`` run to the end of the next span of that kind, or of
    the text; what opens inside one is part of it. The closing spans themselves go."""
    kinds = [r.kind for r in rules]
    closing = {k: kinds.index(r.until) for k, r in enumerate(rules) if r.until in kinds}
    if not any(k in closing for _, k, _ in spans):
        return [x for x in spans if x[1] not in closing.values()] if closing else spans
    out, at = [], dict.fromkeys(closing, 0)
    for s, k, e in spans:
        if k in closing:
            if s < at[k]:
                continue
            e = next((y for x, c, y in spans if c == closing[k] and x >= e), size)
            at[k] = e
        if k not in closing.values():
            out.append((s, k, e))
    return out


def _value_length(body: str) -> int:
    """Length of what follows an assignment's separator, its spaces and its quote."""
    at = min(x for x in (body.find(":"), body.find("=")) if x >= 0)
    value = body[at + 1:].lstrip(" ")
    return len(value) - (value[:1] in ("'", '"'))


def _code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans with byte offsets turned into code points."""
    if not spans or data.isascii():
        return spans
    starts = np.frombuffer(data, np.uint8) & 0xC0 != 0x80
    before = np.concatenate([[0], np.cumsum(starts)])
    return [(int(before[s]), k, int(before[e])) for s, k, e in spans]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and ``spans``: array of (kind, start, end) by start, then rule."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for block in blocks(batches, "doc_id", "text"):
            out = []
            for i in range(len(block)):
                data = block.text(i)
                out.append([
                    {"kind": rules[k].kind, "start": s, "end": e} for s, k, e in _code_points(data, find(data, rules))
                ])
            yield pa.record_batch({"doc_id": block.key, "spans": pa.array(out, kind)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        task, "doc_id long, spans array<struct<kind:string,start:long,end:long>>"
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents' columns, with every span's text replaced by ``[kind]`` (overlapping
    spans become one, named by the first). Texts without spans, null ones too, stay as
    they are; n_chars follows the text where that has changed."""
    names = docs.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "doc_id", "text"):
            texts = block.rows.column("text").to_pylist()
            sizes = block.rows.column("n_chars").to_pylist() if "n_chars" in names else None
            for i in range(len(block)):
                data = block.text(i)
                if not (spans := find(data, rules)):
                    continue
                parts, at = [], 0
                for s, k, e in spans:
                    if s >= at:
                        parts += [data[at:s], f"[{rules[k].kind}]".encode()]
                    at = max(at, e)
                texts[i] = b"".join([*parts, data[at:]]).decode()
                if sizes is not None:
                    sizes[i] = len(texts[i])
            columns = {n: block.rows.column(n) for n in names}
            columns["text"] = pa.array(texts, pa.string())
            if sizes is not None:
                columns["n_chars"] = pa.array(sizes, pa.int64())
            yield pa.record_batch(columns)

    return docs.mapInArrow(task, docs.schema)


def digest(scanned: DataFrame, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """Counts of the base kinds, the digest of their spans and all spans as text."""
    kinds = [r.kind for r in base]

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    of_base = F.filter("spans", lambda x: x["kind"].isin(kinds))
    return scanned.select(
        "doc_id",
        *[count(k) for k in kinds],
        F.sha2(joined(of_base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
