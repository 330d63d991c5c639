"""Small tables for the tests: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

WORDS = ("the of and river stone light over under house green walk slow table paper quiet morning "
         "window garden letter answer bridge carry simple market number yellow").split()


def prose(rng: random.Random, n: int) -> str:
    words = [rng.choice(WORDS) + rng.choice(["", "", "ly", "s", "ing"]) for _ in range(n)]
    lines = []
    while words:
        k = rng.randint(6, 14)
        lines.append(" ".join(words[:k]).capitalize() + ".")
        words = words[k:]
    return "\n".join(lines)


def corpus(seed: int = 7) -> list[tuple]:
    """(doc_id, text, source, spare) rows."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(30, 160)) for _ in range(24)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100 + i, texts[i]) for i in range(6)]  # exact copies
    rows += [(120 + i, texts[3]) for i in range(12)]  # a large group of copies
    for i in range(8):  # near copies: one word in thirty changed
        words = texts[8].split(" ")
        words[(5 * i + 3) % len(words)] = f"edit{i}"
        rows.append((140 + i, " ".join(words)))
    passage = prose(rng, 60)
    rows += [(160 + i, prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 40)) for i in range(5)]
    rows += [(200, None), (201, ""), (202, "   \n\t "), (203, "one"), (204, "One"), (205, "two words"),
             (206, "ha " * 900), (207, "\n".join(["Same line here."] * 40)), (208, "é" * 70), (209, prose(rng, 4000)),
             (210, "x" * 5000), (None, texts[1]), (None, None), (None, "a null id of its own " + texts[2])]
    rows += [(5, texts[5]), (5, prose(rng, 50))]  # a repeated row, and an id used twice
    rng.shuffle(rows)
    return [(i, t, f"host{(i or 0) % 3}", "spare") for i, t in rows]


def frame(spark, rows, parts: int = 3):
    """The rows as a table whose extra columns have names that operators use inside."""
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, names string")
    return df.withColumnRenamed("names", "row_id").selectExpr("*", "'x' as lines", "'y' as doc", "1 as class").repartition(parts)


def empty(spark):
    return frame(spark, [], 1)
