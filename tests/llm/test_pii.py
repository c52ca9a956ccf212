"""Patterns against a direct search; the field against its definition."""

import random
import re

import numpy as np
from itertools import product

from flowlake.llm import pii
from tests.llm.helpers import awkward_texts, documents


def brute(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for kind, pattern, lo, hi in (("card", r"[0-9]([\x20-]?[0-9])+", 16, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 8, 15)):
        for m in re.finditer(pattern, t):
            digits = re.sub(r"[^0-9]", "", m.group())
            if lo <= len(digits) <= hi and (kind == "phone" or pii.luhn(digits)):
                out.append((kind, *m.span()))
    return out


CARD = "4485275742308327"      # passes the checksum
SAMPLE = f"mail joe.p@x-y.example.com now, host 10.0.200.3, call +1 (212) 555-7713 or pay {CARD}."


def test_patterns_equal_a_direct_search():
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("ab@.@1234567890+- ().-é") for _ in range(rnd.randint(1, 50))) for _ in range(4000)]
    for t in [x or "" for x in awkward_texts()] + [SAMPLE] + texts:
        assert pii.base_spans(t) == brute(t)
    assert [k for k, _, _ in pii.base_spans(SAMPLE)] == ["email", "ip", "card", "phone"]


def test_very_long_runs_take_linear_time():
    for t in ("1" * 200_000, "1." * 100_000, "a@" * 100_000, "&" * 200_000 + "1", "+1" * 100_000):
        pii.base_spans(t)
        pii.Nodes(t)


def test_message_passing_equals_enumeration_on_a_chain():
    model = pii.Model([(-1, c, y, 5 + y) for c in range(0, pii.CELLS, 7) for y in range(5)] + [(0, 1, 1, 40), (0, 0, 0, 30), (1, 4, 4, 9)])
    nodes = pii.Nodes("11 22 33 10.0.0.1")
    labels = [0, 0, 0, 2]
    got = model.marginals(nodes, labels)
    own = model.unary[nodes.cell]
    want = np.zeros((4, 5))
    for y in product(range(5), repeat=4):
        if y[3] != 2:
            continue
        p = sum(own[i, y[i]] for i in range(3)) + sum(model.pairs[k][y[a], y[b]] for a, b, k in nodes.links)
        for i in range(4):
            want[i, y[i]] += np.exp(p)
    assert np.allclose(got, want / want.sum(1, keepdims=True), atol=1e-3)


def test_a_repeated_token_takes_the_label_of_its_pattern_match():
    # inside a longer digit run the pattern fails; the same token elsewhere matches
    text = f"card {CARD} noted. later {CARD} 12 34"
    base = pii.base_spans(text)
    rows = [(-1, c, y, n) for c in set(pii.Nodes(text).cell) for y, n in ((0, 3), (3, 40))] + [(1, 3, 3, 50)]
    _, added = pii.Model(rows).spans(text)
    assert len(base) == 1
    assert ("card", text.rindex(CARD), text.rindex(CARD) + 16) in added


def test_rows_of_all_kinds(spark):
    texts = awkward_texts() + [SAMPLE, SAMPLE]
    docs = documents(spark, texts)
    rows = {r["doc_id"]: r for r in pii.find_personal_data(docs).collect()}
    assert len(rows) == len(texts)
    last = rows[len(texts) - 1]
    assert (last["n_email"], last["n_ip"], last["n_card"], last["n_phone"]) == (1, 1, 1, 1)
    assert rows[0]["spans"] == "" and rows[0]["n_added"] == 0
    masked = {r["doc_id"]: r for r in pii.mask_personal_data(docs).collect()}
    assert masked[0]["text"] is None and masked[4]["text"] == "Two words"
    assert masked[len(texts) - 1]["text"] == "mail [EMAIL] now, host [IP], call [PHONE] or pay [CARD]."
    assert pii.find_personal_data(docs.limit(0)).count() == 0
