from __future__ import annotations

import random

import pytest


def prose(draw: random.Random, words: int) -> str:
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 8))) for _ in range(words))


@pytest.fixture(scope="session")
def texts():
    """Texts by id: nulls, empty and very long ones, copies, near copies, shared passages, and no words."""
    draw = random.Random(11)
    passage = prose(draw, 70)
    long = prose(draw, 9000)
    found = {i: prose(draw, draw.randint(1, 160)) for i in range(40)}
    found |= {40: None, 41: "", 42: " \n\t ", 43: found[3], 44: found[3], 45: found[3].upper(), 46: None, 47: ""}
    found |= {48: long, 49: long + " tail", 50: "İß é 日本語 🙂 <|endoftext|> a  b\n c"}
    found |= {60 + i: f"{prose(draw, 30 + i)} {passage} {prose(draw, 20)}" for i in range(6)}
    changed = passage.split()
    changed[35] = "other"
    return found | {70: f"{prose(draw, 25)} {' '.join(changed)} {prose(draw, 10)}"}


@pytest.fixture(scope="session")
def documents(spark, texts):
    """The texts as documents, one row repeated, one id null, and columns whose names clash with the operators' own."""
    rows = [(i, t, "x", "id", 1.5, "run") for i, t in texts.items()]
    rows += [(5, texts[5], "x", "id", 1.5, "run"), (None, texts[6], None, None, None, None)]
    kind = "doc_id long, text string, kept string, id string, n double, Row string"
    return spark.createDataFrame(rows, kind).repartition(5)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)
