"""Small inputs that hold every awkward case."""

import pyarrow.dataset as ds

FOLDER = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor sit amet " * 8000
AWKWARD = [
    (1, "Write to jo.smith@mail.example.org now", "en", "a", 38),
    (1, "Write to jo.smith@mail.example.org now", "en", "a", 38),  # repeated row
    (1, "the same id with another text", "en", "a", 29),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (None, "a row without an id", "en", "b", 19),
    (None, None, None, None, None),
    (4, LONG, "en", "c", len(LONG)),
    (5, "x" * 150_000, "en", "c", 150_000),
    (6, "Ünï \U0001f600 ​ \x00 \x1c end", "fr", "", 14),
    (7, "  \t\n ", "fr", "a", 5),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators might use themselves.
CLASHING = ["size", "copies", "fp", "root", "found", "toxicity", "text_key", "target", "sample", "score", "word", "row", "at"]


def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


def clashing(spark):
    df = awkward(spark)
    for name in CLASHING:
        df = df.selectExpr("*", f"'mine' AS {name}")
    return df


def large_ids(n=500):
    """Ids beyond what doubles hold, in one batch with rows without an id."""
    import xxhash

    even = [2**60 + 7 * i for i in range(n)]
    hashed = [xxhash.xxh64_intdigest(str(i)) - 2**63 for i in range(n)]
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    texts = {i: " ".join(words[(n * k + n // 3) % 5] + str((n * 31 + k) % 997) for k in range(12)) for n, i in enumerate([*even, *hashed])}
    return [(i, t, "en", "a", len(t)) for i, t in texts.items()] + [(None, "no id one two three", "en", "a", 19), (None, "another one", "en", "a", 11)]


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def table(name, folder=FOLDER):
    return ds.dataset(f"{folder}/{name}.parquet").to_table().to_pylist()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
