import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; as extra columns of the input they must not disturb.
CLASHES = (
    "w", "h", "lines", "packed", "places", "chunk", "bucket", "segment", "part", "length", "rank", "at", "fp", "root",
    "component_id", "score", "n_words", "bin", "shard", "slot", "sequence_id", "whole_row", "row_of_table", "key_of_row",
    "text_", "hits", "items", "posterior", "k1", "size", "spans",
)


def words(rng, n):
    return [rng.choice(["the", "of", "an", "in"]) if rng.random() < 0.3 else "".join(rng.choice(["th", "er", "on", "ä", "ß", "re"]) for _ in range(rng.randint(1, 5))) for _ in range(n)]


def prose(rng, n):
    w, out = words(rng, n), []
    for k, x in enumerate(w):
        out.append(x.capitalize() if k % 9 == 0 else x)
        out.append(".\n" if k % 27 == 26 else ". " if k % 9 == 8 else " ")
    return "".join(out).strip()


@pytest.fixture(scope="session")
def awkward():
    """Rows with everything that tables should not have and do: nulls, empties, blanks, copies, one very long text."""
    rng = random.Random(5)
    shared = prose(rng, 60)
    texts = [None, "", " ", "\n\t", "a", "é", "😀 x", shared, shared, shared + " tail", "Intro " + shared, prose(rng, 30000), "<|endoftext|> x <s>", " x y", "nul\x00 byte", "A" * 3000, "a b c a b c a b c"]
    texts += [prose(rng, rng.randint(1, 300)) for _ in range(40)]
    rows = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]
    rows += [(None, shared, None, None, None), (None, None, None, None, None), rows[8], rows[8], (-7, texts[20], "en", "s", 1)]
    return rows


@pytest.fixture(scope="session")
def awkward_docs(spark, awkward):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(awkward, DOCS)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
