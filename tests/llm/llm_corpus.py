"""Small corpora for the operators' tests."""

from __future__ import annotations

import random

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "fp bigint, _row string, _size bigint, _spans string, _part string")

WORDS = "the and of onen heer tion ering éaux ßch niño reer blehe anst thou".split()


def text(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    out = []
    for i, w in enumerate(words):
        out.append(w)
        if i < n - 1:
            out.append(rng.choice([" "] * 12 + ["\n", ", ", ". ", "  ", "\t"]))
    return "".join(out)


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    """Plain texts, exact copies, null and empty texts, a long one, a repeated
    row, a null id, and columns named like the operators' own."""
    rng = random.Random(seed)
    texts = [text(rng, rng.randint(1, 60)) for _ in range(n)]
    texts += [texts[0], texts[0], texts[3], "", None, None, " \n\t ", "word", text(rng, 6000), "x" * 5000]
    out = [(i * 3 + 1, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "b", "c", None]), len(t or ""),
            i, "h", 5, "s", "t") for i, t in enumerate(texts)]
    out.append(out[2])
    out.append((None, "null id " + texts[5], "en", "a", 1, 1, "h", 5, "s", "t"))
    return out


def frame(spark, data=None, parts: int = 3):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(parts)
