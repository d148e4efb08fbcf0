"""A small table of documents with every oddity, and the same tables without rows."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, key string, class long, bucket string, digest string, row long, total int, part int, held boolean, block string, score string, vector string"
EXTRA = ("x", "y", 1, "b", "d", 2, 3, 4, True, "e", "f", "g")
WORDS = {"en": "the of and to in is that for it was on are as with his they at be this from have or".split(), "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split()}


def text(seed: int, words: int, lang: str = "en") -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "s", "ing", "er"]) for _ in range(words))


def varied(seed: int, words: int) -> str:
    """Words that hardly repeat."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 8))) for _ in range(words))


def edited(base: str, seed: int, edits: int) -> str:
    words, rng = base.split(" "), random.Random(seed)
    for k in rng.sample(range(len(words)), edits):
        words[k] = f"changed{seed}x{k}"
    return " ".join(words)


def rows() -> list[tuple]:
    """(doc_id, text, lang, source): null and repeated ids, null, empty, short, long and repeated texts."""
    base = text(1, 300)
    out = [(k, text(100 + k, 20 + k % 50, "en" if k % 2 else "de"), "en" if k % 2 else "de", f"s{k % 3}") for k in range(40)]
    out += [
        (100, base, "en", "s0"), (101, base, "en", "s0"), (102, edited(base, 5, 4), "en", "s1"), (103, text(2, 300), "en", None), (104, None, "en", "s0"), (105, "", None, "s0"), (106, "   \n\t ", "de", "s1"),
        (107, "eins", "de", "s2"), (108, text(3, 30_000), "en", "s0"), (109, "12 34 !! ??", "en", "s0"), (110, "Δ 漢字 🎈 é", None, None), (None, base, "en", "s0"), (None, None, None, None), (111, "same row", "en", "s2"), (111, "same row", "en", "s2"),
        (112, "A\x00b <|endoftext|> Ⅷ ǅ ΣΑΣ", "en", "s1"),
    ]
    return out


def documents(spark, some: list[tuple] | None = None):
    some = rows() if some is None else some
    return spark.createDataFrame([(i, t, g, s, None if t is None else len(t), *EXTRA) for i, t, g, s in some], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
