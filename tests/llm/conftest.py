import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "ka lo mi ter ban du shi ro ven pax il or na te gu".split()


def words(draw, n):
    return ["".join(draw.choices(SYLLABLES, k=draw.randint(1, 4))) for _ in range(n)]


def prose(draw, n):
    out = words(draw, n)
    return "".join(w + ("\n" if draw.random() < 0.08 else " ") for w in out).strip()


def corpus(seed=5, n=120):
    """Prose with copies, near copies, shared lines and passages, and odd rows."""
    draw = random.Random(seed)
    shared = " ".join(words(draw, 30))
    passage = " ".join(words(draw, 60))
    texts = []
    for k in range(n):
        text = prose(draw, draw.randint(3, 150))
        if k % 9 == 0 and texts:
            text = texts[draw.randrange(len(texts))]
        elif k % 9 == 1 and texts:
            own = texts[draw.randrange(len(texts))].split(" ")
            own[len(own) // 2] = "changed"
            text = " ".join(own)
        elif k % 9 == 2:
            text = text + "\n  " + shared.upper() + " \n" + text[: len(text) // 3]
        elif k % 9 == 3:
            text = text + " " + passage + " " + prose(draw, 20)
        texts.append(text)
    rows = [(k, t) for k, t in enumerate(texts)]
    odd = ["", " \n\t ", "a", "Ä" * 60, "x " * 400, "\n".join(["same line of some length"] * 5), prose(draw, 4000)]
    rows += [(1000 + k, t) for k, t in enumerate(odd)]
    return rows


@pytest.fixture(scope="session")
def documents(spark):
    """Distinct ids, no null ids."""
    rows = [(i, t, "en", "s", len(t)) for i, t in corpus()] + [(2000, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Null ids, repeated ids and rows, and columns named like those the operators add."""
    own = [
        (1, "same text here"), (1, "same text here"), (1, "another text"), (None, None),
        (None, ""), (None, "words without an id"), (2, None), (2, None), (3, "same text here"),
    ]
    names = "shard slot score record bucket key node fp0 _row _n n_lines flags copies row".split()
    schema = "doc_id long, text string, lang string, n_chars long, " + ", ".join(f"{n} int" for n in names)
    rows = [(i, t, "en", 7, *range(len(names))) for i, t in own]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i // 2) % 2) for i in range(120)]
    rows += [(None, 1, 1), (5, None, None), (5, 0, 1), (99999, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
