"""Small tables with the odd cases that every operator has to stand."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, row string, id string"
LONG = " ".join(f"word{i} of a long text." for i in range(3000))


def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns named like inner ones."""
    base = "the quick brown fox jumps over the lazy dog and runs away from all of the other animals"
    rows = [
        (1, base, "en", "a"),
        (2, base + " today", "en", "a"),
        (3, base, None, None),
        (4, "", "en", "b"),
        (5, None, "en", "b"),
        (6, " \t\n ", "de", None),
        (7, LONG, "en", "a"),
        (8, LONG.replace("word5 ", "other "), "en", "c"),
        (9, "der die das und ein haus am see mit einem boot", "de", "b"),
        (9, "der die das und ein haus am see mit einem boot", "de", "b"),
        (None, "ganz allein und ohne eine nummer", "de", "a"),
        (10, "12 34 --- !!", None, "c"),
    ]
    return spark.createDataFrame([(i, t, x, s, None, 1, "r", "i") for i, t, x, s in rows], DOCS)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)
