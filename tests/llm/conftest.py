import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, n_words int, "
          "posterior double, n_tokens int, label string, key long, a long, b long, node long, topic string, tokens long, start int")
EXTRA = (9.9, False, -1, 9.9, -1, "x", 5, 6, 7, 8, "t", 3, 4)


@pytest.fixture
def documents(spark):
    """Build a documents table from (id, text) or (id, text, lang, source) rows, with clashing extra columns."""
    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s1", len(r[1] or "") or None, *EXTRA) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)
    return build


WORDS = [f"w{i}" for i in range(400)]


@pytest.fixture
def messy_rows():
    """Nulls, empty, blank and very long texts, ties and repeated rows."""
    base = " ".join(WORDS[:120])
    near = " ".join(WORDS[:60] + ["changed"] + WORDS[61:120])
    other = " ".join(reversed(WORDS[:120]))
    return [(1, base), (2, base), (2, base), (3, near), (4, other), (5, None), (6, ""), (7, " \n\t "), (None, base), (None, None),
            (8, "w1 w2 w3"), (9, "W1 w2\tw3"), (10, " ".join(WORDS * 60)), (11, " ".join(WORDS * 60) + " end"),
            (12, base.replace("w5 ", "w5  \n"), None, None), (13, "w1 w2 w3 w4"), (14, "É K mit license")]
