from __future__ import annotations

import random

import pytest

WORDS = ["alder", "birch", "cedar", "dahlia", "elder", "fern", "gorse", "hazel", "iris", "juniper", "kale", "larch",
         "maple", "nettle", "olive", "pine", "quince", "rowan", "sorrel", "thyme", "umber", "violet", "willow", "yarrow"]
SCHEMA = ("doc_id long, text string, lang string, source string, score double, shard int, node long, size long, "
          "bucket long, component string, label string, _place int, words string")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank and very long texts, ties, repeated rows, a repeated id."""
    rows = [(n, prose(n, 20 + n)) for n in range(1, 40)]
    rows += [(n, prose(7, 60)) for n in range(100, 130)]  # a hot group of copies
    rows += [(50, None), (51, ""), (52, " \n\t "), (None, prose(3, 30)), (None, None), (53, prose(53, 9000)), (54, "x" * 70_000),
             (55, "élève über 日本 İstanbul"), (56, "one two"), (20, prose(20, 40)), (57, prose(57, 30)), (57, prose(57, 30))]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    extra = ("en", "s", 0.5, 3, 4, 5, 6, "c", "l", 7, "w")
    return spark.createDataFrame([(*r, *extra) for r in odd_rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
