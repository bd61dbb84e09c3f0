from __future__ import annotations

import os
import random
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def documents(spark, rows, extra="", value=()):
    """A table of (doc_id, text); ``extra``: further columns, all of which hold ``value``."""
    schema = "doc_id long, text string" + (f", {extra}" if extra else "")
    return spark.createDataFrame([(*r, *value) for r in rows], schema)


def random_texts(seed, number, words=40, vocabulary=30, passages=3):
    """Texts over a small vocabulary that share passages, at the edges of texts as well."""
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcdeé ") for _ in range(rng.randrange(1, 6))).strip() or "x" for _ in range(vocabulary)]
    shared = [" ".join(rng.choice(pool) for _ in range(rng.randrange(6, 25))) for _ in range(passages)]
    out = []
    for _ in range(number):
        parts = [" ".join(rng.choice(pool) for _ in range(rng.randrange(0, words))) for _ in range(2)]
        parts.insert(rng.randrange(3), rng.choice([*shared, ""]))
        out.append(rng.choice([" ", "\n", "\t "]).join(parts))
    return out


def edited_copies(seed, number, groups=4, words=60):
    """Groups of texts that differ by a few words, so that some pairs are just alike or just not."""
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(2000)]
    out = []
    for _ in range(groups):
        base = [rng.choice(pool) for _ in range(words)]
        for _ in range(number):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(pool)
            out.append(" ".join(copy))
    rng.shuffle(out)
    return out
