import pytest

#: Texts with the awkward cases of every operator: null, empty, blank, ties, repeats, long.
TEXTS = [None, "", " \t\n", "one", "one two three four", "a b c d e f g h i j", "A b  c d e\tf g h i j", "word " * 3000, "ünï çödé ñ " * 40, "x" * 2500]


@pytest.fixture
def awkward(spark):
    """Documents with awkward texts, a null id, repeated rows, null columns, and extra columns with names that operators use."""
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS)]
    rows += [(None, "no id here at all", None, None), (5, TEXTS[5], "en", "s"), (5, TEXTS[5], "en", "s"), (20, TEXTS[7], None, "t")]
    schema = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame(rows, schema)
    for extra in ("id", "n", "kind", "bucket", "words", "part", "label", "copies", "h", "k", "row", "cls"):
        df = df.selectExpr("*", f"'x' as {extra}")
    return df


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


@pytest.fixture
def small(spark):
    """Varied documents with copies, near copies and shared passages."""
    import random

    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    docs = [" ".join(rng.choices(words, k=rng.choice([3, 5, 20, 80, 200]))) for _ in range(60)]
    for i in range(20):
        near = docs[i].split()
        near[rng.randrange(len(near))] = "changed"
        docs.append(" ".join(near))
    docs += docs[:10] + [d.replace(" ", "  ") for d in docs[:5]] + ["PASSAGE " + " ".join(words[:120]) + " " + d for d in docs[20:30]]
    return spark.createDataFrame([(i, t, rng.choice(["en", "de"]), rng.choice(["a", "b", None])) for i, t in enumerate(docs)], "doc_id long, text string, lang string, source string")
