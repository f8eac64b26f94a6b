"""Documents that every corpus operator must handle, and plain readings of the word rules."""

import random
import re

import pytest

SF = "/root/testdata/sf0.001"
CLASH = "part INT, node STRING, rid LONG, size LONG, h LONG, x STRING, _id STRING, comp STRING, copies LONG, score STRING"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, ties and repeated rows, and columns named like internals."""
    draw = random.Random(3)
    vocabulary = ["".join(draw.choice("abcdeéñ") for _ in range(draw.randint(1, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    shared, near = prose(40), prose(120).split()
    texts = [None, "", "   \n\t", "one", "two words", "Ünï\x00cödé \x0b mixed\x1cup", prose(400_000), "x" * 200_000 + " tail",
             prose(60), prose(60) + " " + shared, shared + "\n" + prose(30), " ".join(["same"] * 200)]
    texts += [prose(draw.randint(1, 90)) for _ in range(20)]
    for i in range(4):
        copy = list(near)
        copy[20 * i + 5] = f"changed{i}"
        texts.append(" ".join(copy))
    rows = [(i, t, draw.choice(["a", "b", None, "", "Z"])) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, texts[9], None), (None, None, None), (900, texts[3], "a"), (901, "", "b"), (901, "", "b")]
    clash = [(1, "n", 2, 3, 4, "x", "i", "c", 5, "s")]
    full = spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "en", *clash[0]) for r in rows],
                                 f"doc_id LONG, text STRING, source STRING, n_chars LONG, lang STRING, {CLASH}")
    return full.repartition(3), rows


@pytest.fixture(scope="session")
def nothing(odd):
    return odd[0].limit(0)
