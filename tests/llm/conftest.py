import random

import pytest

WORDS = "the of and stone river light under about copper window garden letter seven morning paper silver".split()


@pytest.fixture(scope="session")
def texts():
    """Ids and texts: prose, copies, near copies, nulls, empty, very long, repeated rows, odd characters."""
    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(90)) for _ in range(n))
    out = [(i, prose(rng.randrange(1, 120))) for i in range(60)]
    out += [(100 + i, out[i][1]) for i in range(10)]
    out += [(200 + i, out[30 + i][1] + " changed") for i in range(10)]
    out += [(300, None), (301, ""), (302, " \n\t "), (303, "x" * 20_000), (304, prose(9_000)), (305, "a"), (306, "a")]
    out += [(307, "It's l'été, DON'T 'tis 日本 <|endoftext|> 12,5    z\x1c!")]
    out += [(308, "Mail ann.b@mail.example.com, +1 (555) 123-4567, 10.0.0.255, 10.0.0.256, 4539578763621486")]
    out += [(309, "Licensed under the Apache License, Version 2.0. Released under the MIT License. GNU General Public License")]
    out += [(309, "same id"), (305, "a"), (None, "no id at all but some words that stand here for five")]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    from bankops.llm.registry import ship

    ship(spark)
    rows = [(i, t, rng_lang(k), f"src{k % 3}" if k % 7 else None, None, 1) for k, (i, t) in enumerate(texts)]
    # start, row, shard and n are names that the operators use themselves
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, start string, shard int").repartition(3)


def rng_lang(k):
    return [None, "en", "fr"][k % 3]
