"""Small documents with every odd case: nulls, empty and long texts, ties, repeated rows,
and extra columns whose names the operators use themselves."""

import random
import re

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key long, n int, h string, "
          "size double, part int, `__row` string, `__chunk` int")
EXTRA = (7, 8, "h", 0.5, 9, "r", 3)
WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall(text or "")


def odd_rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(120)) for _ in range(6)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(45))
    edited = base[0].split()
    edited[60] = "changed"
    texts = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one two"), (6, "One TWO three"), (7, "one two three"),
        (8, base[0]), (9, base[0]), (10, " ".join(edited)), (11, base[1] + " " + passage), (12, passage + "\n" + base[2]),
        (13, "é ß Ä x 日本語 \U0001f926 the der la"), (14, " ".join(rng.choice(vocabulary) for _ in range(5000))),
        (15, "a " * 200), (16, "x\n\nx\nx\ny |&| ### !!"), (17, base[3].upper()), (17, base[3]), (18, base[4]), (18, base[4]),
        (None, base[5]), (None, None), (21, "tail  two   spaces \n end "),
    ]
    sources = ["a", "b", None, "é", "b"]
    return [(i, t, "en", sources[k % 5], len(t or ""), *EXTRA) for k, (i, t) in enumerate(texts)]


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
