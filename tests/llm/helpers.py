"""Small tables with everything that can be odd about a row."""

import random

EXTRA = "shard int, slot string, chunk string, key string, id string, body string, score double"
WORDS = "ab cd ef gh ij kl mn op qr st uv wx yz ba dc fe hg ji lk nm".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def odd_documents(spark, rows):
    """``(doc_id, text)`` rows with extra columns whose names clash with those the operators use."""
    return spark.createDataFrame(
        [(d, t, 7, "s", None, "k", "i", "b", 0.5) for d, t in rows], f"doc_id long, text string, {EXTRA}")


def odd_rows(seed: int = 1):
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(20, 60)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i]) for i in range(3)]                        # copies
    rows += [(200 + i, base[i] + " tail end") for i in range(3)]           # near copies
    rows += [(300, None), (301, ""), (302, "   "), (303, "x"), (None, base[4]), (None, None), (5, base[5]),
             (304, prose(rng, 4000)), (305, "é" * 70), (306, "é" * 70), (307, "a" * 300), (308, "b" + "a" * 300)]
    return rows
