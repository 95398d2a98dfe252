"""Documents with everything that can be odd about them."""

import random

import pytest

#: Names that the operators use inside.
CLASHES = "size block digest unit shard slot row_key text_key set_key root node kept ids decoded n_words target epoch bucket".split()


def prose(seed, words, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"w{min(draw.randrange(vocabulary), draw.randrange(vocabulary))}" for _ in range(words))


def odd_texts():
    base = prose(1, 120).split()
    near = list(base)
    near[50] = "other"
    long = prose(2, 4000)
    return [
        None, "", "   \t\n ", "one", "two words", "ONE", "Ünïcode ÄÖ  wörds\x0bwith\x0codd blanks\r\n",
        " ".join(base), " ".join(base).upper(), " ".join(base), " ".join(near), " ".join(base[:40]), "  ".join(base),
        long, long + " tail", prose(3, 30) + "\n" + prose(3, 30), "x" * 5000, "a a a a " * 40, "line one\nline one\n\nline two\n",
        "ends with special <|endoftext|> token<|endoftext|>", "emoji 🙂🙂 and ​ zero", prose(4, 60), prose(4, 60) + " " + prose(5, 60),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, clashing names."""
    rows, number = [], 0
    for text in odd_texts():
        lang = ["en", "de", None][number % 3]
        source = ["a", "b", None, "hot", "hot"][number % 5]
        rows.append((number, text, lang, source, None if text is None else len(text)))
        number += 1
    rows.append((None, prose(1, 120), "en", "hot", 1))
    rows.append((None, None, None, None, None))
    rows += [rows[7], rows[7], (7, prose(9, 80), "en", "a", 3)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema).selectExpr("*", *[f"'clash' AS `{name}`" for name in CLASHES])
    return docs.repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def some_docs(spark):
    """Many short documents: copies, near copies and passages in common."""
    draw = random.Random(11)
    passage = prose(100, 40)
    texts = []
    for number in range(260):
        kind = number % 5
        if kind == 0 and texts:
            texts.append(draw.choice(texts))
        elif kind == 1 and texts:
            words = draw.choice(texts).split()
            for _ in range(max(1, len(words) // 60)):
                if words:
                    words[draw.randrange(len(words))] = f"new{number}"
            texts.append(" ".join(words))
        elif kind == 2:
            texts.append(prose(number, 25) + " " + passage + " " + prose(number + 1000, 25))
        else:
            texts.append(prose(number, draw.randrange(1, 150)))
    rows = [(number, text, ["en", "fr"][number % 2], f"s{number % 7 if number % 3 else 0}", len(text)) for number, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
