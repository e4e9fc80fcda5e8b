"""A small corpus with every awkward case, as fixtures of the operators' tests."""

import pytest

STORY = (
    "the river ran past the old mill and under the bridge where two boys were fishing with lines of string while "
    "their sister read to them from a book about ships that had sailed to the far side of the world and had come "
    "home again with spices and silk and stories that nobody on the quay believed but everybody liked to hear"
).split()


def words(seed, n):
    """n made-up words, the same for the same seed."""
    import random

    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def corpus():
    """(doc_id, text, lang, source): copies, near copies, shared passages, nulls, empties, junk, one long text."""
    rows = []

    def add(text, source="a", lang="en"):
        rows.append((len(rows), text, lang, source))

    base = words(1, 120)
    add(" ".join(base))
    add(" ".join(base))
    near = list(base)
    near[60] = "changed"
    add(" ".join(near), "b")
    near[61] = "twice"
    add("  ".join(near), "b")
    add(" ".join(words(2, 40) + STORY + words(3, 30)), "c")
    add("\n".join(words(4, 20) + STORY + words(5, 50)), "c")
    add(None, None)
    add("", "a")
    add(" \t\n ", "a")
    add("one", "b")
    add("one", "b")
    add("Four words are here", "c")
    add("four WORDS are here", None)
    add("same " * 90, "a")
    add("same " * 60 + "end", "a")
    add("ä ß é " * 30 + "\x1c\x85 nbsp\xa0x", "b", None)
    add(" ".join(words(6, 5000)), "a")
    add(" ".join(STORY), "b")
    add("x\n" + "Released under the MIT License.\n" + " ".join(words(7, 60)), "c")
    for i in range(12):
        add(" ".join(words(100 + i, 30 + 7 * i)), "abc"[i % 3], "de")
    add(" ".join(base), "hot")
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    """The corpus as a stored table, with extra columns whose names the operators use inside."""
    path = str(tmp_path_factory.mktemp("llm") / "documents")
    full = [(i, t, lang, s, None if t is None else len(t), i * 10, "x", f"{i}", 1.5, [i]) for i, t, lang, s in rows]
    schema = (
        "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, _row LONG, _size STRING, _kept STRING,"
        " target DOUBLE, marks ARRAY<INT>"
    )
    spark.createDataFrame(full, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "empty")
    docs.limit(0).write.parquet(path)
    return spark.read.parquet(path)
