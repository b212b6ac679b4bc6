from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_df(spark, rows, extra=True):
    """(doc_id, text) rows as documents, with extra columns named like results."""
    full = [(i, t, "en", "src0", None if t is None else len(t), "x", 7) for i, t in rows]
    df = spark.createDataFrame(full, DOCS + ", kept string, n_words int")
    return df if extra else df.select("doc_id", "text")


def odd_texts(long_words=30_000):
    """Null, empty, blank, unusual separators, a repeated row and one very long text."""
    long_text = " ".join(f"w{k % 997}" for k in range(long_words))
    return [
        (1, None), (2, ""), (3, "   \t\n"), (4, "one"), (5, "café\x0bnaïve x \U0001f600 日本"),
        (6, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, "a b c d e f g"), (8, long_text), (9, "1234 !! ??"),
    ]


def random_texts(seed, n, vocabulary, longest, copies=0.3):
    """Texts over few words, with pieces of earlier ones in them."""
    rng = random.Random(seed)
    texts: list[list[str]] = []
    for _ in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, longest))]
        while texts and rng.random() < copies:
            other = rng.choice(texts)
            if other:
                a = rng.randrange(len(other))
                at = rng.randint(0, len(words))
                words[at:at] = other[a:a + rng.randint(1, len(other))]
        texts.append(words)
    return [" ".join(w) for w in texts]


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
