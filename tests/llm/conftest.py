import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def make(spark):
    """Build a documents-like table from (doc_id, text, source) tuples, with columns that clash with outputs."""
    def build(rows, extra=True):
        data = [(i, t, "en", s, len(t) if t is not None else None) + ((7, "x") if extra else ()) for i, t, s in rows]
        names = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(data, names + (", size int, kept string" if extra else "")).repartition(3)

    return build


@pytest.fixture(scope="session")
def prose():
    """A generator of English-looking text: prose(seed, words)."""
    import random

    common = "the of and to in a is that it was for on are with as be".split()
    parts = "re an th on er in ti es st en at ou ha ed nd".split()

    def text(seed, n):
        r = random.Random(seed)
        words = [r.choice(common) if r.random() < 0.35 else "".join(r.choice(parts) for _ in range(r.randint(2, 5)))
                 for _ in range(n)]
        out = []
        for i in range(0, n, 12):
            s = " ".join(words[i:i + 12])
            out.append(s[:1].upper() + s[1:] + ".")
        return "\n".join(out)

    return text
