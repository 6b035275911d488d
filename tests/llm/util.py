"""Small document frames shared by the operator tests."""

import random

LONG = "lorem ipsum dolor " * 20_000

EXTRA = "row_hash string, ids string, score string, node string, size string, text_ string, row string, spans string"


def docs(spark, rows, extra=True):
    """(doc_id, text) rows; with further columns whose names operators use inside."""
    schema = "doc_id long, text string" + (", " + EXTRA if extra else "")
    return spark.createDataFrame([(i, t, *(["x"] * EXTRA.count("string") if extra else [])) for i, t in rows], schema)


def prose(seed, n):
    rnd = random.Random(seed)
    syllables = "ta ri mo len sha dro vik une pra sol gen tor".split()
    return " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(n))


EDGE_ROWS = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (None, "null id"), (5, "twice the same"), (5, "twice the same"),
             (6, "équipe naïve ß 漢字 😀 é"), (7, LONG)]
