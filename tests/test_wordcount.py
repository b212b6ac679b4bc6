from sheaf.operators import wordcount
from sheaf.sources.text import lines_of
from tests.conftest import lines_df

# FIXTURES.md 2, "lines"
LINES = ["a b a", "", "  lead", " , ", "tail. ", "A a 4d", "é x"]


def counts(df):
    return {r.word: r.occurrences for r in df.collect()}


def test_word_count_drops_empty_words_keeps_case_and_digits(spark):
    got = counts(wordcount.word_count(lines_df(spark, LINES)))
    assert got == {"a": 3, "b": 1, "lead": 1, "tail": 1, "A": 1, "4d": 1, "x": 1}


def test_word_count_raw_counts_empty_word_like_java_split(spark):
    got = counts(wordcount.word_count_raw(lines_df(spark, LINES), by_lines=False))
    # '' from the empty line, from '  lead' and from 'é x' (é is not an ASCII word
    # character); ' , ' yields nothing, 'tail. ' has no leading piece.
    assert got[""] == 3
    assert {k: v for k, v in got.items() if k} == counts(wordcount.word_count(lines_df(spark, LINES)))


def test_raw_count_on_whole_texts_equals_count_on_their_lines(spark):
    text = "\n".join(LINES) + "\n"
    docs = spark.createDataFrame([(text,), ("",)], "text STRING")
    assert counts(wordcount.word_count_raw(docs, "text")) == counts(
        wordcount.word_count_raw(lines_df(spark, LINES), by_lines=False)
    )


def test_lines_of_follows_line_reader(spark):
    docs = spark.createDataFrame(
        [(1, "a\nb\n"), (2, ""), (3, "\n"), (4, "a\r\n\r\nb"), (5, "x\n\n"), (6, "y\r")], "id INT, text STRING"
    )
    got = sorted((r.id, r.line) for r in lines_of(docs, "text", "id").collect())
    assert got == [(1, "a"), (1, "b"), (3, ""), (4, ""), (4, "a"), (4, "b"), (5, ""), (5, "x"), (6, "y")]


def test_sorted_output_is_byte_order(spark):
    df = wordcount.sorted_by_word(wordcount.word_count(lines_df(spark, ["b B a A _ 9"])))
    assert [r.word for r in df.collect()] == ["9", "A", "B", "_", "a", "b"]


def test_word_count_plan_aggregates_before_shuffle(spark):
    df = wordcount.word_count(lines_df(spark, LINES))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
