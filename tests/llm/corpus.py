"""Small fixtures that hold what large corpora hold: copies, near copies, nulls, empties, long texts."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _id long, words string"

INSULTS = ("idiot", "scum", "moron")


def words(rng: random.Random, n: int, pool: int = 400) -> list[str]:
    return [f"{'abcdefgh'[rng.randrange(8)]}{rng.randrange(pool):x}é"[: rng.randint(2, 6)] for _ in range(n)]


def prose(rng: random.Random, n: int) -> str:
    out = words(rng, n)
    for i in range(7, n, 8):
        out[i] += ".\n" if i % 3 == 0 else "."
    return " ".join(out)


def documents(seed: int = 1, n: int = 40) -> list[tuple]:
    """Rows of ``SCHEMA``; the extra columns bear names that operators use inside."""
    rng = random.Random(seed)
    texts: list[str | None] = [prose(rng, rng.randint(3, 160)) for _ in range(n)]
    shared = prose(rng, 40)
    texts += [texts[0]] * 3  # exact copies
    texts += [prose(rng, 9) + " " + shared + " " + prose(rng, 9) for _ in range(4)]  # a common passage
    near = texts[1] + " " + prose(rng, 120)
    texts += [near, near.replace(" ", "  "), near + " tail"]
    texts += [None, "", " \n\t", "x", "ab" * 400, prose(rng, 3000), "Ünï çödé " * 30]
    rows = [(i, t, "en", f"src{i % 3}" if i % 7 else None, len(t or ""), 0.5, 9 - i, "w") for i, t in enumerate(texts)]
    rows.append(rows[0])  # a repeated row
    rows.append((5, "other text under a known id " + shared, "en", "src1", 1, 0.5, 1, "w"))
    rows.append((None, shared + " without an id", "en", "src2", 1, None, None, None))
    return rows


def frame(spark, rows, schema: str = SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(3)
