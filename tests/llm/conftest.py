import pytest

LONG = " ".join(f"Word{i % 977} the{i % 13}" for i in range(9000))
TEXTS = [
    (0, None, "en"),
    (1, "", "en"),
    (2, "  \n\t ", None),
    (3, "The house on the hill is old and the road to it is long.", "en"),
    (4, "the HOUSE on the hill is old and the road to it is long.", "en"),
    (5, "The house on the hill is old and the road to it is long.", "de"),
    (6, LONG, "en"),
    (7, LONG + " end", "en"),
    (8, "Der alte Mann und das Meer sind nicht weit von hier.", "de"),
    (9, "One", "en"),
    (10, "one", "en"),
    (11, "!!! ### $$$ ???", None),
    (12, "don't can't we'll 'tis it's naïve İstanbul ΣΊΣΥΦΟΣ 日本語 текст 12 345", None),
    (13, "a<|endoftext|>b <|startoftext|> c", "fr"),
    (None, "The house on the hill is old and the road to it is long.", "en"),
    (15, "Le vieux homme et la mer sont loin d'ici.", "fr"),
    (15, "Le vieux homme et la mer sont loin d'ici.", "fr"),
]
#: Names that the operators use inside.
CLASHES = "component string, kept string, slot string, code string, bands string, score string, size string, rank string, bucket string, _order string, id string, label string, row string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    n = CLASHES.count(" string")
    rows = [(*t, "src", len(t[1]) if t[1] else None, *["x"] * n) for t in TEXTS]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
