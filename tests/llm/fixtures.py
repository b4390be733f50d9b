"""Small tables with the awkward cases: nulls, empty and long texts, ties,
repeated rows, extra columns with clashing names."""

import random

SPACE = " \t\n\x0b\x0c\r"
EXTRA = ", lang string, source string, n_chars long, text_key long, positions string, n long, cls long, fingerprint string, label string, hash long, item_id string"
SCHEMA = "doc_id long, text string" + EXTRA


def frame(spark, rows, schema=SCHEMA, parts=3):
    """Rows (doc_id, text); the extra columns only clash."""
    more = ("en", "src0", 1, 2, "x", 3, 4, "f", "1", 5, "i")
    return spark.createDataFrame([(*r, *more) if len(r) == 2 else r for r in rows], schema).repartition(parts) if rows else spark.createDataFrame([], schema)


def odd_rows():
    """Null id, null and empty texts, blanks, a long text, exact repeats of rows."""
    long = " ".join(f"w{i % 997}x{i % 31}" for i in range(30_000))
    shared = "this passage of more than thirteen words stands in several documents of the table, word for word, and more"
    return [(None, "a text without an id " + shared), (1, None), (2, ""), (3, " \t \n "), (4, long), (5, long), (5, long), (6, shared), (7, "x " + shared), (7, "another text of the same id"),
            (8, "é" * 50 + "\n" + shared), (9, "É" * 50 + "\n" + shared), (10, "a b c"), (11, "A b\tc"), (12, "one"), (13, "one")]


def random_rows(seed, n=60, vocab=30, length=80):
    """Texts of few words, with copies, near copies, runs and shared passages."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(vocab)]
    rows = []
    for i in range(n):
        kind = r.random()
        if rows and kind < 0.2:
            text = r.choice(rows)[1]
        elif rows and kind < 0.45:
            text = r.choice(rows)[1].split(" ")
            for _ in range(r.randint(1, 3)):
                if text:
                    text[r.randrange(len(text))] = r.choice(words)
            text = " ".join(text)
        elif rows and kind < 0.6:
            other = r.choice(rows)[1].split(" ")
            a = r.randrange(max(1, len(other)))
            text = " ".join([*r.choices(words, k=r.randint(0, 20)), *other[a:a + r.randint(5, 40)], *r.choices(words, k=r.randint(0, 20))])
        elif kind < 0.7:
            text = " ".join([r.choice(words)] * r.randint(1, 40) + r.choices(words, k=5))
        else:
            text = " ".join(r.choices(words, k=r.randint(0, length)))
        rows.append((i, text))
    return rows
