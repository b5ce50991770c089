import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make_texts(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    stems = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(220)]
    passage = [r.choice(stems) for _ in range(60)]
    texts = []
    for i in range(n):
        words = [r.choice(stems) for _ in range(r.randint(1, 160))]
        if i % 7 == 0:
            at = r.randint(0, len(words))
            words[at:at] = passage[: r.randint(10, 60)]
        if i % 11 == 0:
            words += ["so"] * r.randint(2, 30)
        texts.append(r.choice([" ", "\n", "\t "]).join(words))
    for i in range(0, n, 9):
        texts[i] = texts[(i * 5) % n]
    for i in range(3, n, 13):
        base = texts[(i * 3) % n].split()
        base[len(base) // 2] = "edited"
        texts[i] = " ".join(base)
    return texts


def odd_rows() -> list[tuple]:
    """Nulls everywhere, empty and long texts, ties, repeated rows, odd characters."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    return [
        (9001, None, None, None, None),
        (9002, "", "en", "s1", 0),
        (9003, " \t\n\x0b\x0c\r ", "en", "s1", 7),
        (9004, "one", "en", None, 3),
        (9005, "one", "fr", "s2", 3),
        (9006, "a b c d", "fr", "s2", 7),
        (9007, long, "en", "s1", len(long)),
        (9008, long, "en", "s1", len(long)),
        (9008, long, "en", "s1", len(long)),
        (9009, "Ünïcödé ÀÉ ß ÿ 東京 \U0001f600 don't <|endoftext|> x y 12 ３", "de", "s3", 40),
        (9010, "123 456 !!", "de", "s3", 10),
        (None, "row without an id " * 6, "en", "s1", None),
        (9011, "A! " * 40, "en", "s1", 120),
    ]


@pytest.fixture(scope="session")
def rows():
    texts = make_texts(3, 150)
    return [(i * 3 % 149 + (1000 if i == 149 else 0), t, ["en", "fr", None][i % 3], f"s{min(i % 5, 2)}", len(t)) for i, t in enumerate(texts)] + odd_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({"size": F.lit("x"), "name": F.lit(1), "slot": F.lit(2), "start": F.lit(0), "range": F.lit(None).cast("int"), "key": F.lit("k"), "label": F.lit("z"), "length": F.lit(7)})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
