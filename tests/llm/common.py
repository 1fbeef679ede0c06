"""Small tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau".split()


def sentence(seed: int, n: int) -> str:
    """Words in an order of their own for every seed."""
    state, out = seed * 7919 + 17, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(state >> 16) % len(WORDS)] + str((state >> 8) % 40))
    return " ".join(out)


def documents(spark, texts, langs=None, sources=None):
    rows = [
        (i, t, langs[i] if langs else "en", sources[i] if sources else f"src{i % 3}", len(t or ""))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def awkward(spark):
    """Rows that no operator may trip over."""
    rows = [
        (None, None, None, None, None),
        (1, "", "en", "a", 0),
        (2, " \t\n\r\x0b\x0c ", "en", None, 7),
        (3, "one", None, "a", 3),
        (3, "one", None, "a", 3),
        (4, "x" * 20000, "en", "a", 20000),
        (5, sentence(5, 4000), "en", "b", 1),
        (None, sentence(6, 80), "en", "b", 1),
        (7, "tab\tseparated\r\nlines\n\n\nÉÈ ß İ 漢字 😀 　 end", "xx", "c", 1),
        (8, "<|endoftext|> *** ||| <b> 'tis we'll", "en", "c", 1),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def clashing(df):
    """``df`` with further columns named like those that operators make for themselves."""
    names = ["kept", "_row", "_id", "_hash", "fp", "line", "pos", "words", "hash", "n_words", "_t", "text_hash", "doc"]
    return df.select("*", *(F.lit("x").alias(n) for n in names))


def empty(spark, schema=DOCUMENTS):
    return spark.createDataFrame([], schema)
