"""The BPE transducer over many streams, stretches of long texts, and its memory."""

import hashlib
import random
import subprocess
import sys

import pytest
import tokenizers

from geospan.llm import bpe
from geospan.llm.queries import vocabulary


def expected(lib, text):
    ids = lib.encode(text, add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())


TEXTS = ["", " ", "a", "\x1c", "a\x1cb c", "<|endoftext|>", "x <|startoftext|>y<|endoftext|> z", "it's WE'LL don't", "é ́x ́ y", "½²ⅷ 日本語",
         "😀👍🏽 ok", "Σίσυφος ΟΔΟΣ", "one\ntwo three　four", "a" * 700, "the " * 500, "​­ soft", "12345 6,789.00"]


@pytest.mark.parametrize("chunk,remembered", [(1 << 22, 100_000), (64, 3)])
def test_digests_equal_the_library_for_any_stretch_and_memory(monkeypatch, chunk, remembered):
    monkeypatch.setattr(bpe, "CHUNK", chunk)
    t = bpe.Transducer(vocabulary("word_bpe_49k.json"))
    lib = tokenizers.Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    rng = random.Random(chunk)
    texts = TEXTS + ["".join(rng.choice("abcdeinorst  éñß.,!'<|\n") for _ in range(rng.randrange(400))) for _ in range(150)]
    got = bpe._digests(t, bpe.Remembered(t, remembered), texts)
    assert got == [expected(lib, x) for x in texts]


def test_every_id_comes_from_the_transducer():
    t = bpe.Transducer(vocabulary("word_bpe_49k.json"))
    rng = random.Random(7)
    words = ["".join(rng.choice("etaoinshrdlué") for _ in range(rng.randrange(1, 90))) for _ in range(3000)] + ["x", "zq" * 400]
    ids, at = t.transduce_many(words)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [list(t.transduce(t.symbols(w))) for w in words]
    assert [list(t.transduce(t.symbols(w))) for w in words[:300]] == [[t.ids[x] for x in t.merge(t.symbols(w))] for w in words[:300]]
    assert t.transduce_many([])[1].tolist() == [0]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_by_token_equals_the_library(name):
    t, lib = bpe.Transducer(vocabulary(name)), tokenizers.Tokenizer.from_file(vocabulary(name))
    for text in TEXTS:
        ids = list(t.stream_ids(text))
        assert ids == lib.encode(text, add_special_tokens=False).ids and "".join(t.stream_text(ids)) == lib.decode(ids, skip_special_tokens=False)


def test_text_machine_holds_unfinished_characters():
    m = bpe.TextMachine()
    assert [m.feed(bytes([b])) for b in "é😀".encode()] == ["", "é", "", "", "", "😀"]
    assert m.feed(b"\xf0\x9f") == "" and m.feed(b"", True) == "�"


def test_a_long_text_takes_bounded_memory():
    code = """
import random, resource, sys
sys.path.insert(0, {root!r})
from geospan.llm import bpe
from geospan.llm.queries import vocabulary
t = bpe.Transducer(vocabulary("word_bpe_49k.json"))
rng = random.Random(1)
words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 12))) for _ in range(50000)]
one = " ".join(rng.choice(words) for _ in range(int(sys.argv[1]) // 7))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
bpe._digests(t, bpe.Remembered(t), [one])
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    root = __file__.rsplit("/tests/", 1)[0]

    def used(size):
        return int(subprocess.run([sys.executable, "-c", code.format(root=root), str(size)], capture_output=True, text=True, check=True, timeout=300).stdout)
    assert used(50_000_000) < 400_000  # KB: five times the text would be 250,000; all its parts and ids are over a million
