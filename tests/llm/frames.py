"""Small tables with the awkward rows that every operator has to take."""

import random
import re

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside; extra input columns may have them.
CLASHES = ("id", "key", "row", "size", "class", "text_key", "copies", "bucket", "component", "_hash", "n")

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau".split()


def prose(rng: random.Random, count: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(count))


def edited(rng: random.Random, text: str, share: float) -> str:
    words = text.split(" ")
    for _ in range(max(1, int(share * len(words)))):
        words[rng.randrange(len(words))] = "edit" + str(rng.randrange(10**6))
    return " ".join(words)


def awkward_texts() -> list:
    rng = random.Random(7)
    long = prose(rng, 30_000)
    return [
        None,
        "",
        " \t\r\n \x0b\x0c",
        "one",
        "One  two\tthree\nfour",
        "a b c d e",
        "A B C D E",
        "é ü ß 語 🙂 " * 4,
        "line\nline\n\nline\r\nother line",
        long,
        long,
        "x" * 50_000,
        "a b c d e",
    ]


def documents(spark, texts, ids=None, source=None, extra=True):
    """A table of documents; with ``extra``, columns whose names clash with inner ones."""
    texts = list(texts)
    ids = list(range(len(texts))) if ids is None else list(ids)
    source = source or (lambda i: [None, "s1", "s2", "s1"][i % 4])
    rows = [
        (ids[i], text, ["en", "fr", None][i % 3], source(i), len(text) if text is not None else None)
        for i, text in enumerate(texts)
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    if extra:
        frame = frame.select("*", *[F.lit(name).alias(name) for name in CLASHES])
    return frame


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, size=5):
    own = words(lower(text))
    if len(own) < size:
        return frozenset([tuple(own)]) if own else frozenset()
    return frozenset(tuple(own[i : i + size]) for i in range(len(own) - size + 1))


def joined(nodes, linked):
    """The smallest node of each node's component."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}
