"""Small tables with the awkward rows: nulls, empty and long texts, repeated rows, columns of clashing names."""

from __future__ import annotations

import random

CLASHING = ["row", "mix", "doc_key", "content", "class", "band", "gone", "topic", "tokens", "covered_lines", "a", "b"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)

_SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def prose(rng: random.Random, n: int) -> str:
    out = []
    while n > 0:
        k = min(n, rng.randint(6, 14))
        out.append(" ".join(words(rng, k)).capitalize() + ".")
        n -= k
    lines = [" ".join(out[i : i + 3]) for i in range(0, len(out), 3)]
    return "\n".join(lines)


def rows(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(30, 200)) for _ in range(12)]
    near = base[0].split(" ")
    near[5] = "changed"
    texts = [
        *enumerate(base),
        (20, base[1]),
        (21, " ".join(near)),
        (22, ""),
        (23, None),
        (24, " \t\n "),
        (25, "one two"),
        (25, "one two"),
        (26, prose(rng, 30_000)),
        (None, base[2]),
        (None, None),
        (27, base[3] + "\n" + base[4]),
        (28, "x " * 50),
        (29, "É é ́ ß \U0001f600 " + base[5]),
    ]
    out = []
    for i, (doc_id, text) in enumerate(texts):
        out.append((doc_id, text, (None, "en", "fr")[i % 3], (None, "hot", "hot", "cold")[i % 4], len(text or "")) + ("x",) * len(CLASHING))
    return out


def edge_docs(spark, more: list[tuple] = ()):
    return spark.createDataFrame(rows() + list(more), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
