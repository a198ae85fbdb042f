"""Small hard tables: nulls, empty and long texts, ties, repeated rows, clashing extra columns, copies and passages."""

import random

from pyspark.sql import functions as F

EXTRA = ["norm", "row", "id", "size", "sid", "bucket", "_bit", "_bucket", "_possible", "block", "lost", "key", "features"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def words(n, seed, vocabulary=400):
    pick = random.Random(seed)
    return [f"w{pick.randrange(vocabulary)}" if pick.random() < 0.8 else pick.choice(["The", "of", "and", "Ünder", "été"]) for _ in range(n)]


def corpus(seed=0, n=120):
    """(doc_id, text) rows with near copies, shared passages, exact copies and odd rows."""
    pick = random.Random(seed)
    passage = words(40, 9_999)
    rows = []
    for i in range(n):
        w = words(pick.choice([3, 8, 20, 60, 150, 400]), seed * 1000 + i)
        kind = i % 6
        if kind == 1 and len(rows) > 3:  # a near copy
            w = list(pick.choice([r for r in rows if r[1]])[1].split())
            for _ in range(pick.choice([0, 1, 1, 2, 5])):
                if w:
                    w[pick.randrange(len(w))] = f"x{pick.randrange(50)}"
        elif kind == 2:  # a shared passage
            w[len(w) // 2 : len(w) // 2] = passage[pick.randrange(10) : pick.randrange(25, 41)]
        elif kind == 3:  # repeats itself
            w = w + w[: len(w) // 2] + w
        rows.append((i * 3 + 1, pick.choice([" ", "  ", "\n", "\t "]).join(w)))
    rows += [(5000, None), (5001, ""), (5002, " \n\t "), (5003, "one"), (5004, "one two three"), (5005, "one two three"),
             (5006, "  one two\nthree "), (5007, "\x1cone\x85two three   four​"), (None, "null id here " * 9), (None, "null id here " * 9),
             (None, None), (rows[2][0], rows[2][1]), (rows[5][0], rows[5][1]), (5010, " ".join(words(9000, 77, 9000))), (5011, " ".join(words(9000, 77, 9000)))]
    return rows


def frame(spark, rows, parts=5):
    """The rows as a documents table with extra columns whose names clash with the operators' own."""
    pick = random.Random(1)
    full = [(i, t, pick.choice(["en", "fr", None]), "s", None if t is None else len(t), *("x" for _ in EXTRA)) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts, F.xxhash64("doc_id", "text"))


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
