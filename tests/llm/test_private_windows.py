"""Windows of the search for personal data."""

import pytest

from postlens.llm.private_data import plausible, windows


@pytest.mark.parametrize("span", ["joan.smith at example.com", "joan AT example.com", "joan (at) example dot com"])
def test_a_plausible_address_stands_in_a_window(span):
    text = "w " * 200 + span + " w" * 200
    lo = text.index(span)
    assert plausible(0, span)
    assert any(a <= lo and lo + len(span) <= b for a, b in windows(text))
