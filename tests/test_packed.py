import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marquetry.operators.packed import unpack, unpack_rows

CASES = {
    "A B|C D": ["A B", "C D"],
    "A B||C D|": ["A B", "C D"],
    "A B | N/A | AND C D": ["A B", "C D"],
    "B, A|C D;E F; G H": ["B, A", "C D", "E F", "G H"],
    "A B, C D, and E F": ["A B", "C D", "E F"],
    "A B, C D & E F": ["A B", "C D", "E F"],
    "A B and C D": ["A B", "C D"],
    'A B,"D, C",E F': ["A B", "D, C", "E F"],
    '"A ""B"" C","D E"': ['A "B" C', "D E"],
    'A "B" C|D E': ['A "B" C', "D E"],
    'A 5" B|C D': ['A 5" B', "C D"],
    '["A B", "D, C", ""]': ["A B", "D, C"],
    '["Fran\\u00e7ois X", null]': ["François X"],
    "['A B', \"O'N C\"]": ["A B", "O'N C"],
    "A B / N/A / C D": ["A B", "C D"],
    "N/A": [],
    "• A B • C D": ["A B", "C D"],
    "A B\r\nD, C\r\n": ["A B", "D, C"],
    "A  B\tC D": ["A B", "C D"],
    "Tarcenura, Jasper": ["Tarcenura, Jasper"],
    "": [],
    "  ": [],
    "[]": [],
    "|;,": [],
}


@pytest.mark.parametrize("text,expected", CASES.items())
def test_manners_of_writing(text, expected):
    values, _, places = unpack(pa.array([text]))
    assert values.to_pylist() == expected
    assert places.tolist() == list(range(1, len(expected) + 1))


def test_texts_do_not_touch_each_other():
    texts = [None, *CASES, "X" * 50_000 + "|Y Z", None]
    values, parents, _ = unpack(pa.array(texts))
    for i, t in enumerate(texts):
        own = [v for v, p in zip(values.to_pylist(), parents) if p == i]
        assert own == unpack(pa.array([t]))[0].to_pylist()


names = st.lists(st.text("abcdeé ", min_size=2, max_size=8).map(lambda s: " ".join(("Q" + s).split())), max_size=6)


@settings(max_examples=60, deadline=None)
@given(names, st.sampled_from(["|", ";", " | ", "\n", "\t"]))
def test_round_trip(items, separator):
    assert unpack(pa.array([separator.join(items)]))[0].to_pylist() == [x for x in items if x]


def test_rows(spark):
    df = spark.createDataFrame([(1, "A B|C D", 9), (1, "A B|C D", 9), (2, None, 9), (None, "E F", 9)], "id bigint, names string, pos int")
    rows = sorted(map(tuple, unpack_rows(df, "id", "names", "actor").collect()), key=str)
    assert rows == sorted([(1, 1, "A B"), (1, 2, "C D")] * 2 + [(None, 1, "E F")], key=str)
    assert unpack_rows(df.filter("id > 5"), "id", "names").count() == 0
