"""Documents with every kind of trouble: nulls in any column, empty and very long texts, ties, repeated rows, and extra
columns whose names clash with those that operators make."""

import random

WORDS = "the of and tion ering ndly haus straße été señor über queue lich ment".split()
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, fingerprint string, found int, base string, added int, k1 int, row string, range int, "
    "bucket string, words int, region int, island int, lang_pred string, score string, held_out int, text_hash string, kept_text string, `a b` string"
)
EXTRA = 18


def rows(n=120, seed=1):
    rng = random.Random(seed)
    text = lambda k: " ".join(rng.choice(WORDS) + rng.choice(["", "", ".", ","]) for _ in range(k))
    out = []
    for i in range(n):
        out.append([i, text(rng.randrange(1, 80)), rng.choice(["en", "de", "fr", None]), rng.choice(["a", "b", "c", None, "é", "Z"])])
    copy = text(60)
    out += [[1000 + i, copy, "en", "a"] for i in range(40)]  # a large group of copies
    out += [[2000, None, None, None], [2001, "", "en", None], [2002, " \t\n", None, "b"], [2003, "12 34 !!", "de", "a"], [None, "no id here at all", "en", "b"], [None, None, None, None]]
    out += [[2004, text(20000), "fr", "c"], [2005, "x" * 50000, "en", "b"]]
    out += [out[3], out[3], out[-1]]  # repeated rows
    return [(*r, None if r[1] is None else len(r[1]), *([7, "s", "f", 1, "b", 2, 3, "r", 4, "k", 5, 6, 8, "p", "q", 9, "h", "t"]), "z") for r in out]


def table(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def empty(spark):
    return table(spark, [])
