"""Randomised differential and invariant tests."""
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusflow.operators.chunking import DEFAULT_SEPARATORS, recursive_split
from corpusflow.operators.masking import mask_text_df
from tests.test_masking import _py_mask

ALPHABET = "ab cd.\n\tééß!?,;xyz 0123456789"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=600), st.integers(20, 120), st.integers(0, 19))
def test_recursive_split_invariants(text, size, overlap):
    chunks = recursive_split(text, size, overlap, DEFAULT_SEPARATORS)
    assert all(0 < len(c) <= size for c in chunks)
    # every non-space character appears, in order
    flat = iter(re.sub(r"\s", "", "".join(chunks)))
    assert all(ch in flat for ch in re.sub(r"\s", "", text))
    # chunks are trimmed pieces of the text
    assert all(c == c.strip() and c in text for c in chunks)


def _random_text(rng):
    parts = []
    for _ in range(rng.randint(1, 12)):
        kind = rng.randint(0, 7)
        if kind == 0:
            parts.append(f"{rng.choice(['j.doe', 'x_y', 'Ann'])}@{rng.choice(['ex', 'a-b'])}.{rng.choice(['com', 'org', 'io'])}")
        elif kind == 1:
            parts.append(rng.choice(["", "+1-", "1."]) + f"{rng.randint(200, 999)}{rng.choice(['-', '.', ''])}"
                         f"{rng.randint(100, 999)}{rng.choice(['-', '.', ''])}{rng.randint(1000, 9999)}")
        elif kind == 2:
            parts.append(f"{rng.choice(['000', '666', '900', '123', '078'])}-{rng.choice(['00', '45', '12'])}-"
                         f"{rng.choice(['0000', '6789', '1120'])}")
        elif kind == 3:
            parts.append(rng.choice(["4", "51", "34", "6011"]) + "".join(rng.choice("0123456789") for _ in range(14)))
        elif kind == 4:
            parts.append("DE" + "".join(rng.choice("0123456789") for _ in range(20)))
        elif kind == 5:
            parts.append("".join(rng.choice("0123456789") for _ in range(rng.randint(1, 20))))
        else:
            parts.append(rng.choice(["Straße", "été", "ok", "x", "Überweisung", "—"]))
        parts.append(rng.choice([" ", ", ", "\n", "; ", "é", ""]))
    return "".join(parts)


def test_masking_matches_python_on_random_texts(spark):
    rng = random.Random(7)
    texts = [(i, _random_text(rng)) for i in range(300)]
    df = spark.createDataFrame(texts, "id long, text string")
    got = {r.id: (r.masked_text, [(f["type"], f["start"], f["end"]) for f in r.entities_found])
           for r in mask_text_df(df).collect()}
    for i, t in texts:
        assert got[i] == _py_mask(t), t
