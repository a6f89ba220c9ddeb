import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start int, row string, bucket long, grp int"


def _rows():
    rng = random.Random(7)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    out = []
    add = lambda t, lang="en", source="s0", i=None: out.append(
        (len(out) if i is None else i, t, lang, source, 0, 1, "r", 5, 6))
    add(None)
    add("")
    add(" \t\n")
    add("7 8 9")
    add("one")
    add("One")
    base = prose(120)
    for k in range(6):  # exact copies but for white space and repeated rows
        add(base.replace(" ", "  " if k % 2 else " "), source="hot")
    out.append(out[-1])
    near = prose(300).split()
    for k in range(30):  # near copies: a word changed here and there
        w = list(near)
        for _ in range(k % 5):
            w[rng.randrange(len(w))] = "changed" + str(k)
        add(" ".join(w), source="hot")
    for k in range(40):
        add(prose(rng.randint(1, 200)), lang=["de", "fr", None][k % 3], source=["a", "b", None][k % 3])
    add(prose(9000), lang="de")       # a long text
    add("é😀 " * 300, lang="fr")
    add("same id, other text", i=3)
    add("no id here", i=None)
    out[-1] = (None, *out[-1][1:])
    return out


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty, long and repeated texts, ties, and columns with clashing names."""
    return spark.createDataFrame(_rows(), SCHEMA).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
