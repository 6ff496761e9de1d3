"""Small tables for these tests."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Extra columns named like the operators' own.
CLASH = "doc_id bigint, text string, source string, id string, row int, n int, words int, spans int, fp int, `a.b` string"

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    """n words that follow from the seed."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 50))
    return " ".join(out)


EDGE = [
    (1, None, "en", "s", 0), (2, "", None, "s", 0), (3, " \t\n ", "en", None, None), (None, prose(3, 60), "en", "s", 9),
    (4, prose(4, 5000), "en", "s", 9), (5, "Ünï çødé 日本語 ▁x\x00 　y 😀", "en", "s", 9), (6, prose(6, 80), "en", "s", 9),
    (6, prose(6, 80), "en", "s", 9), (7, prose(6, 80), "en", "t", 9), (8, "one\ntwo\n\nthree ", "en", "s", 9),
    (9, "x" * 3000, "en", "s", 9), (10, "  lead <|endoftext|> and  trail  \r\n", "en", "s", 9),
]


def edge(spark):
    return spark.createDataFrame(EDGE, DOCS).repartition(3)


def clashing(spark):
    return spark.createDataFrame([(1, prose(1, 60), "s", "i", 1, 2, 3, 4, 5, "x"), (2, None, None, None, None, None, None, None, None, None)], CLASH)


def none(spark):
    return spark.createDataFrame([], DOCS)


def texts_of(table) -> list:
    return [(r["doc_id"], r["text"] or "") for r in table.collect()]
