"""Spans that the tagger adds: whole, valid values that the base rules lose."""

import random

import numpy as np
import pytest
from helpers import frame, prose

from relsync.llm import pii

from test_text_operators import _card, _private_documents


@pytest.mark.parametrize("kind, value, good", [
    ("card", "4111 1111 1111 1111", True), ("card", "4111 1111 1111 1112", False), ("card", "4111 1111 1111 1111 ", False),
    ("ip", "10.0.0.255", True), ("ip", "10.0.0.256", False), ("ip", "10.0.0", False), ("phone", "+1 (569) 555-6633", True),
    ("phone", "+1 55", False), ("phone", "569 555-6633 11", False), ("email", "a.b@x.org", True), ("email", "a.b@x", False),
])
def test_valid_values(kind, value, good):
    assert pii.valid(kind, value) == good


def test_settling_moves_edges_out_of_digit_runs_and_drops_invalid_spans():
    card = _card(random.Random(3))
    text = f"see {card} {card} and +1 (569) 555-6633 {card}, mail a.b@x.org."
    at = text.index(card)
    for a, b in ((0, 0), (3, 0), (0, -2), (5, -5), (-1, 1)):
        assert pii.settle("card", at + a, at + len(card) + b, text) == ("card", at, at + len(card))
    second = text.index(card, at + 1)
    assert pii.settle("card", second + 1, second + 9, text) == ("card", second, second + len(card))
    assert pii.settle("card", at, second + len(card), text) is None  # both at once are no value
    phone = text.index("+1")
    for a in (0, 1, 2):
        found = pii.settle("phone", phone + a, phone + 16, text)
        assert found == (("phone", phone, phone + 17) if a < 2 else None)
    mail = text.index("a.b@")
    assert pii.settle("email", mail + 2, mail + 8, text) == ("email", mail, mail + 9)
    wrong = card[:-1] + str((int(card[-1]) + 1) % 10)
    assert pii.settle("card", 0, 16, wrong) is None and pii.settle("card", 4, 12, "1" * 5000) is None
    assert pii.settle("ip", 0, 0, "") is None


def test_paired_windows_hold_two_labelled_values():
    rows = []
    for _, text, *_ in _private_documents(40, 3):
        spans = pii.base_spans(text)
        for s in pii.window_starts(text):
            rows.append((text[s:s + pii.WINDOW], pii.tag_window(s, pii.WINDOW, spans)))
    made = pii.paired_windows(rows, 200)
    assert len(made) == 200 and pii.paired_windows(rows, 200)[7][0] == made[7][0]
    assert all(len(w) <= pii.WINDOW and len(t) == pii.WINDOW for w, t in made)
    both = 0
    for w, tags in made:
        assert not tags[len(w):].any()
        found = [(pii.KINDS[k], w[a:b]) for k, a, b in pii._tag_spans(tags[:len(w)])]
        both += sum(pii.valid(k, v) for k, v in found) >= 2
    assert both > 100
    assert pii.paired_windows([("plain", np.zeros(pii.WINDOW, np.int64))]) == []


def test_added_spans_are_right_and_most_lost_ones_are_found(spark):
    """Precision and recall of what is added, on held-out texts with planted neighbours."""
    tagger = pii.fit(frame(spark, _private_documents(400, 6)))
    r = random.Random(9)
    lost = found = added = right = 0
    for n in range(200):
        phone = f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}"
        first, second = r.choice([_card(r), phone]), _card(r)
        wrong = second[:-1] + str((int(second[-1]) + 5) % 10)
        head, gap = prose(r.randint(1, 20), n) + " ", r.choice([" ", " - "])
        text = f"{head}{first}{gap}{second} {prose(9, n + 1)} {wrong} {prose(3, n)} {r.randint(10**10, 10**11)}"
        a = len(head)
        want = {("phone" if first[0] == "+" else "card", a, a + len(first)), ("card", a + len(first) + len(gap), a + len(first) + len(gap) + len(second))}
        (base, spans), = pii.all_spans([text], tagger)
        more = set(spans) - set(base)
        lost += len(want - set(base))
        found += len(more & want)
        added += len(more)
        right += len(more & want)
    assert lost > 200 and right >= 0.95 * added and found >= 0.8 * lost
