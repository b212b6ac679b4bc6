"""Compare word counts over a text corpus with a stored word-count output.

    python tools/golden_words.py CORPUS_DIR STORED_FILE [--raw] [--recursive]

``word<TAB>count`` lines (one hash part of a MapReduce output): every stored row must equal
our count. ``(word,count)`` lines (one part of a range-sorted output): our rows whose word
lies between the first and last stored word must equal the stored rows exactly. ``--raw``
counts the empty word (the RDD job's rule); otherwise empty words are dropped.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sheaf.operators import wordcount  # noqa: E402
from sheaf.session import get_session  # noqa: E402
from sheaf.sources.text import read_lines  # noqa: E402


def stored_rows(path: str) -> tuple[str, list[tuple[str, int]]]:
    rows, form = [], "tab"
    with open(path, encoding="utf-8") as f:
        for line in f:
            line = line.rstrip("\n")
            if line.startswith("(") and line.endswith(")"):
                form = "tuple"
                word, count = line[1:-1].rsplit(",", 1)
            else:
                word, count = line.split("\t")
            rows.append((word, int(count)))
    return form, rows


def main() -> int:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    raw = "--raw" in sys.argv
    corpus, stored = args
    spark = get_session("local[8]", shuffle_partitions=8)
    lines = read_lines(spark, corpus, recursive="--recursive" in sys.argv)
    counts = wordcount.word_count_raw(lines, by_lines=False) if raw else wordcount.word_count(lines)
    ours = {r.word: r.occurrences for r in counts.collect()}
    form, rows = stored_rows(stored)
    if form == "tab":
        bad = [(w, c, ours.get(w)) for w, c in rows if ours.get(w) != c]
    else:
        lo, hi = rows[0][0], rows[-1][0]
        mine = sorted((w, c) for w, c in ours.items() if lo <= w <= hi)
        bad = sorted(set(mine) ^ set(rows))
    print(f"stored rows {len(rows)}, distinct words {len(ours)}, total {sum(ours.values())}, "
          f"empty word {ours.get('', 0)}, mismatches {len(bad)} {bad[:5]}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
