"""Hand-made inputs with every awkward case."""

from pyspark.sql import functions as F

WORDS = "the old river runs slowly past the quiet mill and under seven stone bridges before it meets the sea".split()


def prose(n: int, seed: int = 0) -> str:
    return " ".join(WORDS[(i * 7 + seed * i * i + seed) % len(WORDS)] + ("." if i % 9 == 8 else "") for i in range(n))


PASSAGE = "This passage of more than one hundred bytes stands in several documents and must be found wherever it starts again, é."
ROWS = [
    (1, prose(80, 1) + PASSAGE + prose(20, 2), "a"),
    (2, prose(40, 3) + "\n" + PASSAGE + "\n\n" + prose(60, 4), "b"),
    (3, "", "a"),
    (4, None, None),
    (5, "one two", "b"),
    (6, prose(80, 1) + PASSAGE + prose(20, 2), None),
    (6, prose(30, 6), "c"),
    (6, prose(30, 6), "c"),
    (None, prose(25, 7), "c"),
    (8, "ab" * 400, "a"),
    (9, "x" * 1000 + " \t\n" + "日本語" * 60, "b"),
    (10, " ".join(prose(50, s) for s in range(60)), "a"),
    (11, "word▁with mark  and   blanks \n", "b"),
]
SCHEMA = "doc_id long, text string, source string"


def documents(spark):
    """Rows with nulls, repeats and columns whose names the operators use themselves."""
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    clash = (
        "size row chunk rid fp h ord word votes target key place text_key row.x page cls token n lang_ shard "
        "_place _id _key _text_key _trusted _copy _at _part _n _block _source _shard _end"
    ).split()
    return df.select("*", *[F.lit("x").alias(c) for c in clash])


def empty(spark):
    return documents(spark).limit(0)


LABELS = "doc_id long, quality int, toxic int"
