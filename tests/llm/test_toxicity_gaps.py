"""Insults cut in pieces, and the kernel against a naive one."""

import itertools
import random

import numpy as np

from geospan.llm import toxicity
from geospan.llm.toxicity import DECAY, SPAN, Landmarks, Scorer, ToxicityModel


def naive_kernel(a, b):
    """Common subsequences of three characters, by listing them."""
    def weights(w):
        w, out = "\x01" + w + "\x02", {}
        for i, j, k in itertools.combinations(range(len(w)), 3):
            if k - i < SPAN:
                key = w[i] + w[j] + w[k]
                out[key] = out.get(key, 0) + DECAY ** (k - i + 1)
        return out
    x, y = weights(a), weights(b)
    dot = lambda p, q: sum(v * q.get(s, 0) for s, v in p.items())
    return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5


def test_kernel_equals_a_naive_one():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randrange(3, 12))) for _ in range(40)]
    marks = Landmarks(words[:12])
    got = marks.kernel(words)
    assert np.allclose(got, [[naive_kernel(w, m) for m in words[:12]] for w in words])
    floored = marks.kernel(words, 0.3)
    for g, f in zip(got, floored):  # below the floor a word may be left out
        assert np.allclose(g, f) or (g.max() < 0.3 and not f.any())


def model(words):
    n = len(words)
    return Scorer(ToxicityModel(words, [], np.full(n, 8.0), -4.0, 1.0, 0.0))


def test_pieces_over_gaps_are_joined():
    s = model(["gromblak", "idiot", "stupid"])
    for text in ("you grom blak there", "so st upid", "i-d i-o-t", "you i_d i_o_t you", "STU PID!", "st... upid", "a text with st\nupid in it", "s t u p i d", "idi ot."):
        assert s.score([text])[0] > 0.5, text
    clean = ["a study on cups", "the best upon it", "first, up in the air", "radio talks", "from bread", "", "i do it", "st", "grom", "his tumult up idle"]
    assert (s.score(clean) < 0.5).all()
    # a text's result doesn't hang on the others, and long texts are gone through whole
    mixed = ["x " * 50_000 + "st upid", "plain", "st", "upid"]
    assert [v > 0.5 for v in s.score(mixed)] == [True, False, False, model(["gromblak", "idiot", "stupid"]).score(["upid"])[0] > 0.5]
    assert s.joined(["", "a", "ab c", "radio talks"]) == [set()] * 4
