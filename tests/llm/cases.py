"""Small tables the operators' tests share."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part string, n_tokens string"


def odd_rows():
    """Nulls, empty and blank texts, unusual characters, ties, repeated rows, a long text and clashing columns."""
    rng = random.Random(7)
    vocabulary = ["alpha", "Beta", "gamma,", "delta.", "naïve", "ñandú", "l'été", "it's", "x1", "42", "don't", "日本語", "été", "ǅ", "=>", "##", "ſ"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = say(120)
    texts = [
        (1, base), (2, base), (3, base.replace("alpha", "Alpha", 1)), (4, say(60) + " " + " ".join(base.split()[10:80]) + " " + say(30)),
        (5, None), (6, ""), (7, " \n\t "), (8, "one"), (9, "one two"), (10, "one two three"), (11, "word " * 200), (12, "a b " * 90),
        (13, "tab\tand\x0bvertical\x0cfeed\xa0space wide  double   triple\n\nlines \r\n end "), (14, "<|endoftext|> inside<|startoftext|>text <|endoftext|>"),
        (15, say(4000)), (16, "line one is here\nline one is here\n" + say(70)), (17, "x" * 5000), (18, "\x85 　\x1c odd space"),
        (18, say(80)), (19, base), (19, base), (None, say(55)), (None, None), (-5, say(90)), (20, "ΑΣ ΣΑΣ' İstanbul ß ǆ"), (21, "home | about | contact | login\n" + say(60)),
    ]
    return [(i, t, "en", "s", 1, "clash", "clash") for i, t in texts]


def frame(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)


def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
