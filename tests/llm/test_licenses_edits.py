import numpy as np

from pagelens.llm import licenses
from pagelens.llm import text as X


def matches(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return licenses.Scanner(licenses.compile_notices(), {})(X.Texts(data, np.array([0, len(data)]), 0))[0][2]


def test_edits_of_several_bytes():
    for c in ("­", "​", "🙂"):
        for text in (f"relea{c}sed un{c}der the mit license", f"some words relea{c}sed un{c}der the mit license and more"):
            first = 2 if text.startswith("some") else 0
            assert ("mit", first, first + 5, 2) in [m[:4] for m in matches(text)], text


def test_matches_are_whole_words():
    assert not matches("xxxxxxxxxall rights reserved") and not matches("all rights reservedxxxxxxxxx")


def test_weaker_matches_before_a_better_one_are_kept():
    notice, weak = "all rights reserved", "all rights reservd"
    for text, edits in ((f"{weak} {notice}", [1, 0]), (f"{notice} {weak} {notice} {weak}", [0, 1, 0, 1]), (f"{weak} {weak} x {notice}", [1, 1, 0])):
        assert [m[3] for m in matches(text) if m[0] == "all-rights-reserved"] == edits, text
