import random

import pytest

SMALL_SF = "/root/testdata/sf0.001"
SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe ri so tu va we xi yo zu".split()


def prose(seed: int, words: int, syllables=SYLLABLES) -> str:
    rs = random.Random(seed)
    out = ["".join(rs.choice(syllables) for _ in range(rs.randint(1, 3))) for _ in range(words)]
    return " ".join(out) + "."


# extra columns whose names the operators use themselves
CLASHES = "size bucket rank row gone found class_id id text_ lang_pred score target copies".split()
DOCS_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


@pytest.fixture(scope="session")
def edge_rows():
    long_text = prose(1, 40_000)
    base = prose(2, 80)
    near = base.replace(base.split()[40], "changed")
    rows = [
        (1, base, "aa", "s1"),
        (2, base, "aa", "s1"),
        (3, near, "aa", "s2"),
        (4, None, None, None),
        (5, "", "aa", "s1"),
        (6, " \t\n", "bb", "s2"),
        (None, prose(3, 30), "bb", "s2"),
        (8, long_text, "bb", "s3"),
        (9, prose(4, 60), None, "s3"),
        (9, prose(4, 60), None, "s3"),
        (10, "!!! ??? 12 34", "aa", None),
        (11, "one two", "bb", "s1"),
        (12, "one two", "bb", "s1"),
    ]
    return rows + [(20 + i, prose(100 + i, 50 + i), "aa" if i % 2 else "bb", f"s{i % 4}") for i in range(20)]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    full = [(*r, None if r[1] is None else len(r[1]), *["x"] * len(CLASHES)) for r in edge_rows]
    return spark.createDataFrame(full, DOCS_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS_SCHEMA)
