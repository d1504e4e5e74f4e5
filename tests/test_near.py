"""Searching a fixed set of keys by start and slip, against comparing all of them."""

import random

from caudalix.functions.pytext import NearKeys, edit_distance
from caudalix.operators.vocabulary import Lookup


def test_near_keys_like_brute_force():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 20)))
    edits = lambda k: 0 if len(k) < 4 else 1 if len(k) < 8 else 2
    keys = {word() for _ in range(400)}
    index = NearKeys(keys, edits)
    for text in [word() for _ in range(300)] + ["a" * 50] + [k[1] + k[0] + k[2:-2] + k[-1] + k[-2] for k in keys if len(k) > 8][:60]:
        want = {(k, d) for k in keys if (d := edit_distance(text, k, edits(k))) <= edits(k)}
        assert set(index.near(text)) == want
        assert set(index.begun_by(text)) == {k for k in keys if k.startswith(text)}
    assert set(index.near("")) == {(k, len(k)) for k in keys if len(k) <= edits(k)} and set(index.begun_by("")) == keys


def test_lookup_of_a_long_list():
    rng = random.Random(6)
    name = lambda: " ".join("".join(rng.choice("aeioubcdlmnprst") for _ in range(8)) for _ in range(3))
    names = [(i, name()) for i in range(50_000)]
    lookup = Lookup(names)
    for i, n in names[::5_000]:
        slip = n[:5] + n[6] + n[5] + n[7:]
        assert lookup(n) == lookup(slip) == i
        assert lookup(" ".join(w[:5] for w in n.split())) == i
    assert lookup("zzzzzzzzzz") is None and lookup(None) is None and lookup("") is None
    assert Lookup([])("abc") is None
