"""BPE encoding and decoding as a streaming transducer with bounded lookahead.

A vocabulary file of the tokenizers library (JSON) gives the merge list.  Encoding reads symbols
from left to right, keeps a window of them, and emits a token as soon as no later symbol can
change it: at once where two neighbours stand side by side in no token of the vocabulary, at the
end of a word, and otherwise ``sufficient_lookahead`` symbols later.  Decoding turns tokens into text with an
incremental machine.

For tables the windows of many words are merged at once (``Transducer.transduce_many``), and Arrow splits the
texts, finds the distinct words and puts their tokens back together.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from geospan.llm.common import Memo, keyed_text, map_batches, process_state, slices


#: White space to str.split and Arrow, and not to the vocabulary.
SEPARATORS = "\x1c\x1d\x1e\x1f"
#: Characters of a text that are held, with all that is made from them, at a time.
CHUNK = 4 << 20
#: Windows of more symbols are merged one by one.
LOCKSTEP = 64
#: Parts of texts that a Python worker remembers, in each of two generations.
REMEMBERED = 150_000


def byte_alphabet() -> dict[int, str]:
    """byte -> the printable character that stands for it in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in set(printable) else chr(next(spare)) for b in range(256)}


def sufficient_lookahead(merges: list[tuple[str, str]], suffix: str = "") -> int:
    """Symbols after a token's end that suffice to make it final.

    Compare merging a window with merging the window and what follows.  Up to some place both have
    the same boundaries; a merge (u, v) that only one of them makes moves this place left by the
    length of u.  The next such merge (u', v') comes later in the list, and v' starts with u, as
    it covers the place where u starts.  So the place moves by at most the longest such chain,
    which one pass over the list finds: for every left part the longest chain that ends with it.
    It needs each token to be made by one merge only, which is checked.
    """
    if len({a + b for a, b in merges}) < len(merges):
        raise ValueError("a token is made by two merges; the lookahead bound does not hold")
    longest: dict[str, int] = {}
    bound = 0
    size = lambda t: len(t.removesuffix(suffix)) if suffix and t.endswith(suffix) and t != suffix else len(t)
    for u, v in merges:
        chain = max((longest.get(v[:i], 0) for i in range(1, len(v) + 1)), default=0) + size(u)
        longest[u] = max(longest.get(u, 0), chain)
        bound = max(bound, chain)
    return bound + max((size(a + b) for a, b in merges), default=1)


class Transducer:
    """Encoder and decoder of one vocabulary file.

    rules: the merge ranks by (left, right) token; lookahead: see ``sufficient_lookahead``.
    """

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.rules = {m: k for k, m in enumerate(merges)}
        self.lookahead = sufficient_lookahead(merges, self.suffix)
        self.bytes = byte_alphabet()  # also a translation of Latin-1 text
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.decoder = (spec.get("decoder") or {}).get("type")
        steps = spec.get("normalizer") or {}
        steps = steps.get("normalizers", [steps]) if steps else []
        self.nfc = any(s.get("type") == "NFC" for s in steps)
        self.lower = any(s.get("type") == "Lowercase" for s in steps)
        pre = spec["pre_tokenizer"]
        split = [p for p in pre.get("pretokenizers", [pre]) if p["type"] == "Split"]
        self.drops_space = bool(split)
        self.words = regex.compile(split[0]["pattern"]["Regex"] if split else
                                   r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.specials = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")") if self.special else None
        self.space = regex.compile(r"\s+")
        self.odd_text = regex.compile("|".join([f"[{SEPARATORS}]", *map(regex.escape, self.special)]))  # not for Arrow's split
        self.word = Memo(self.encode_word)
        self.chunk = Memo(self.encode_chunk)
        self._tables(merges)

    def _tables(self, merges: list[tuple[str, str]]) -> None:
        """The same rules for arrays of ids: merge keys in order, and which symbols are neighbours inside a token."""
        first = [self.bytes[b] for b in range(256)]
        rows = first + ([c + self.suffix for c in first] if self.suffix else [])
        self.symbol_ids = np.array([self.ids[c] for c in rows], np.int64)
        at = {c: k for k, c in enumerate(rows)}
        self.neighbours = np.zeros((len(rows), len(rows)), bool)
        self.inside: set[tuple[str, str]] = set()
        for a, b in merges:
            token = list((a + b).removesuffix(self.suffix)) if self.suffix else list(a + b)
            if self.suffix and (a + b).endswith(self.suffix):
                token[-1] += self.suffix
            self.inside.update(zip(token, token[1:]))
        for a, b in self.inside:
            if a in at and b in at:
                self.neighbours[at[a], at[b]] = True
        n = self.size = max(self.tokens) + 1
        key = np.array([self.ids[a] * n + self.ids[b] for a, b in merges], np.int64)
        order = np.argsort(key)
        self.keys, self.ranks = key[order], order
        self.made = np.array([self.ids[a + b] for a, b in merges], np.int64)
        self.id_text = pa.array([str(i) for i in range(n)], pa.binary())
        raw = self.token_bytes
        self.token_text = pa.array([raw(self.tokens[i]) if i in self.tokens else b"" for i in range(n)], pa.binary())

    # encoding

    def symbols(self, word: str) -> list[str]:
        """The word's starting symbols; the end-of-word suffix is part of the last."""
        row = list(word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.bytes))
        row[-1] += self.suffix
        return row

    def merge(self, row: list[str]) -> list[str]:
        """Merge neighbours, the earliest rule first and from the left, until no rule applies."""
        if len(row) > 48:
            return self.merge_long(row)
        get, none = self.rules.get, len(self.rules)
        ranks = [get(pair, none) for pair in zip(row, row[1:])]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            row[i:i + 2] = [row[i] + row[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((row[i - 1], row[i]), none)
            if i < len(ranks):
                ranks[i] = get((row[i], row[i + 1]), none)
        return row

    def merge_long(self, row: list[str]) -> list[str]:
        """The same with a heap of applicable rules, for windows in which scanning costs more."""
        n, rules = len(row), self.rules
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = [(r, i, row[i], row[i + 1]) for i in range(n - 1) if (r := rules.get((row[i], row[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if row[i] != a or j >= n or row[j] != b:
                continue
            row[i], row[j] = a + b, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rules.get((row[i], row[k]))) is not None:
                    heapq.heappush(heap, (r, i, row[i], row[k]))
            if (h := before[i]) >= 0 and (r := rules.get((row[h], row[i]))) is not None:
                heapq.heappush(heap, (r, h, row[h], row[i]))
        return [t for t in row if t]

    def transduce(self, symbols: Iterable[str]) -> Iterator[int]:
        """ids of one word, as its symbols come in; holds five lookaheads of symbols at most.

        What stands before two neighbours that no token has side by side is final.  Else a token of the merged
        window is final when it ends at least ``lookahead`` symbols before the window does; the
        window goes on after the last final token, where merging may start anew because no
        merge crosses a final boundary.
        """
        window: list[str] = []
        full = 5 * self.lookahead
        for s in symbols:
            if window and (window[-1], s) not in self.inside:
                for token in self.merge(window):
                    yield self.ids[token]
                window = []
            window.append(s)
            if len(window) < full:
                continue
            at = 0
            for token in self.merge(window.copy()):
                size = len(token)  # before the word's end every symbol is one character
                if at + size > full - self.lookahead:
                    break
                yield self.ids[token]
                at += size
            window = window[at:]
        for token in self.merge(window) if window else ():
            yield self.ids[token]

    def encode_word(self, word: str) -> tuple[int, ...]:
        return tuple(self.transduce(self.symbols(word)))

    def transduce_many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words end to end, where each word's begin and the last one's end).

        The transducer over many streams: symbols are cut into windows at final boundaries, windows of
        up to LOCKSTEP symbols are merged side by side, one merge of each at a time, and longer
        ones stream by themselves.
        """
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        symbol = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        end = np.cumsum(size)
        if self.suffix:
            symbol[end[size > 0] - 1] += 256
        final = np.ones(len(symbol) + 1, bool)
        if len(symbol) > 1:
            final[1:-1] = ~self.neighbours[symbol[:-1], symbol[1:]]
        final[end] = True
        cut = np.flatnonzero(final)
        begin, length = cut[:-1], np.diff(cut)
        ids = self.symbol_ids[symbol]
        out = np.full(len(symbol), -1, np.int64)  # a window's tokens, at its first places
        order = np.argsort(length, kind="stable")
        order = order[np.searchsorted(length[order], 2):]
        short = order[:np.searchsorted(length[order], LOCKSTEP, side="right")]
        one = begin[length == 1]
        out[one] = ids[one]
        for a in range(0, len(short), 8192):
            some = short[a:a + 8192]
            width = int(length[some[-1]])
            place = begin[some][:, None] + np.arange(width)
            there = np.arange(width) < length[some][:, None]
            merged = self._lockstep(np.where(there, ids[np.minimum(place, len(ids) - 1)], -1))
            got = merged >= 0
            out[place[got]] = merged[got]
        for k in order[len(short):].tolist():
            b, n = begin[k], length[k]
            row = list(symbol[b:b + n].astype(np.uint8).tobytes().decode("latin-1").translate(self.bytes)) if n else []
            if self.suffix and symbol[b + n - 1] >= 256:
                row[-1] += self.suffix
            found = list(self.transduce(row))
            out[b:b + len(found)] = found
        kept = out >= 0
        return out[kept], np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], end])]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], len(self.keys))

    def _lockstep(self, rows: np.ndarray) -> np.ndarray:
        """Rows of ids (-1 after the end), merged: in every row the earliest rule, the leftmost place, until none applies."""
        none, width = len(self.keys), rows.shape[1]
        out = np.full_like(rows, -1)
        at = np.arange(len(rows))
        rank = self._rank(rows[:, :-1], rows[:, 1:])
        column = np.arange(width)
        while len(at):
            best = rank.argmin(axis=1)
            least = rank[np.arange(len(at)), best]
            done = least == none
            if done.any():
                out[at[done], :rows.shape[1]] = rows[done]
                at, rows, rank, best, least = at[~done], rows[~done], rank[~done], best[~done], least[~done]
                if not len(at):
                    break
            lane = np.arange(len(at))
            rows = np.concatenate([rows, np.full((len(at), 1), -1)], axis=1)
            rows[lane, best] = self.made[least]
            rows = np.take_along_axis(rows, column[None, :] + (column[None, :] > best[:, None]), 1)
            rank = np.concatenate([rank, np.full((len(at), 1), none)], axis=1)
            rank = np.take_along_axis(rank, column[None, :-1] + (column[None, :-1] > best[:, None]), 1)
            rank[lane, best] = self._rank(rows[lane, best], rows[lane, best + 1])
            left = np.flatnonzero(best > 0)
            rank[left, best[left] - 1] = self._rank(rows[left, best[left] - 1], rows[left, best[left]])
        return out

    def normalized(self, text: str) -> str:
        if self.nfc and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if self.lower:
            # letter by letter, so that a final sigma is lowered like any other
            text = text.lower() if "Σ" not in text else "".join(map(str.lower, text))
        return text

    def encode_chunk(self, text: str) -> tuple[int, ...]:
        return tuple(i for w in self.words.findall(self.normalized(text)) for i in self.word[w])

    def parts(self, text: str) -> list[str]:
        """Special tokens and the pieces of text between them that can be encoded by themselves:
        for vocabularies that drop white space, what stands between white space."""
        pieces = self.specials.split(text) if self.specials and any(s in text for s in self.special) else [text]
        if not self.drops_space:
            return pieces
        if not any(c in text for c in SEPARATORS):  # these alone are white space to str.split and not to the vocabulary
            return [x for p in pieces for x in ([p] if p in self.special else p.split())]
        return [x for p in pieces for x in ([p] if p in self.special else filter(None, self.space.split(p)))]

    def encode(self, text: str) -> list[int]:
        """ids of a whole text; special tokens in it keep their ids and none are added."""
        out: list[int] = []
        for part in self.parts(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out.extend(self.chunk[part])
        return out

    def stream_ids(self, text: str) -> Iterator[int]:
        """The same ids one after the other, none of them held."""
        pieces = self.specials.splititer(text) if self.specials else [text]
        for part in pieces:
            if part in self.special:
                yield self.special[part]
                continue
            for word in self.words.finditer(self.normalized(part)):
                if word.end() - word.start() <= LOCKSTEP:
                    yield from self.word[word.group()]
                else:
                    yield from self.transduce(self.stream_symbols(word.group()))

    def stream_symbols(self, word: str) -> Iterator[str]:
        for a in range(0, len(word), CHUNK):
            row = word[a:a + CHUNK].encode("utf-8", "surrogatepass").decode("latin-1").translate(self.bytes)
            last = a + CHUNK >= len(word)
            yield from row[:-1] if last else row
            if last:
                yield row[-1] + self.suffix

    # decoding

    def pieces(self, ids: Iterable[int]) -> Iterator[str]:
        """The stored form of each token; unknown ids give nothing."""
        return (t for i in ids if (t := self.tokens.get(i)) is not None)

    def decode(self, ids: Iterable[int]) -> str:
        """As the vocabulary's own decoder does."""
        return "".join(self.stream_text(ids))

    def token_bytes(self, token: str) -> bytes:
        """A token's share of the decoded bytes; without a decoder its stored form."""
        if self.decoder is None or token in self.special:
            return token.encode("utf-8", "surrogatepass")
        body = token.removesuffix(self.suffix) if self.suffix else token
        back = self.__dict__.setdefault("back", {c: b for b, c in self.bytes.items()})
        return bytes(back[c] for c in body) + (b" " if body != token else b"")

    def stream_text(self, ids: Iterable[int]) -> Iterator[str]:
        """Text of tokens as they come."""
        machine = TextMachine(b" " if self.decoder is None else b"")
        for token in self.pieces(ids):
            if text := machine.feed(self.token_bytes(token)):
                yield text
        if text := machine.feed(b"", True):
            yield text


class TextMachine:
    """Bytes of tokens to text, step by step: at most three bytes of an unfinished character are held, broken ones
    become U+FFFD; ``joint`` stands between two steps (a vocabulary without a decoder joins its tokens by a space)."""

    def __init__(self, joint: bytes = b""):
        self.joint, self.begun = joint, False
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, raw: bytes, last: bool = False) -> str:
        if last:
            return self.machine.decode(raw, True)
        if self.begun and self.joint:
            raw = self.joint + raw
        self.begun = True
        return self.machine.decode(raw)


class Digest:
    """sha256 of the ids and of the decoded text, fed stretch by stretch."""

    def __init__(self, joint: bytes):
        self.n, self.ids, self.text, self.machine = 0, hashlib.sha256(), hashlib.sha256(), TextMachine(joint)

    def feed(self, n: int, ids: bytes, raw: bytes) -> None:
        """n tokens, their decimal ids joined by a space, and their bytes."""
        if n:
            self.ids.update(b" " + ids if self.n else ids)
            self.text.update(self.machine.feed(raw).encode("utf-8", "surrogatepass"))
            self.n += n

    def told(self) -> tuple[int, str, str]:
        self.text.update(self.machine.feed(b"", True).encode())
        return self.n, self.ids.hexdigest(), self.text.hexdigest()


class Remembered:
    """part -> (tokens, their ids joined, their bytes joined) in two generations: the older one is dropped when the
    younger one is full, and what is asked for again moves to the younger."""

    def __init__(self, t: Transducer, most: int = REMEMBERED):
        self.t, self.most = t, most
        self.young: dict = {}
        self.old: dict = {}

    def tell(self, parts: list[str]) -> list[tuple[int, bytes, bytes]]:
        young, old = self.young, self.old
        out = [young.get(p) or old.get(p) for p in parts]
        new = [k for k, x in enumerate(out) if x is None]
        if new:
            for k, x in zip(new, self.made([parts[k] for k in new])):
                out[k] = x
        for p, x in zip(parts, out):
            if len(p) <= 64:
                young[p] = x
        if len(young) > self.most:
            self.old, self.young = young, {}
        return out

    def made(self, parts: list[str]) -> list[tuple[int, bytes, bytes]]:
        t = self.t
        found = [[] if p in t.special else t.words.findall(t.normalized(p)) for p in parts]
        place: dict[str, int] = {}
        index = np.array([place.setdefault(w, len(place)) for ws in found for w in ws], np.int64)
        ids, at = t.transduce_many(list(place))
        joint = b" " if t.decoder is None else b""
        lists, at = pa.ListArray.from_arrays, at.astype(np.int32)
        told = pc.binary_join(lists(at, t.id_text.take(pa.array(ids))), b" "), pc.binary_join(lists(at, t.token_text.take(pa.array(ids))), joint)
        ends = np.concatenate([[0], np.cumsum([len(ws) for ws in found])])
        n = np.concatenate([[0], np.cumsum(np.diff(at)[index])])[ends]
        told = [pc.binary_join(lists(ends.astype(np.int32), x.take(pa.array(index))), j).to_pylist() for x, j in zip(told, (b" ", joint))]
        out = list(zip(np.diff(n).tolist(), *told))
        for k, p in enumerate(parts):
            if p in t.special:
                out[k] = (1, str(t.special[p]).encode(), t.token_bytes(p))
        return out


def transducer(path: str) -> Transducer:
    return process_state(f"bpe {path}", lambda: Transducer(path))


def _stretches(t: Transducer, text: str) -> Iterator[str]:
    """A text in stretches of about CHUNK characters, cut at white space."""
    at = 0
    while len(text) - at > CHUNK:
        space = t.space.search(text, at + CHUNK)
        if not space:
            break
        yield text[at:space.end()]
        at = space.end()
    yield text[at:] if at else text


def _digests(t: Transducer, memo: Remembered, texts: list[str]) -> list[tuple[int, str, str]]:
    """The digests of some texts, a stretch of about CHUNK characters of them at a time."""
    joint = b" " if t.decoder is None else b""
    digests = [Digest(joint) for _ in texts]
    odd = t.odd_text
    held: list[tuple[int, str]] = []
    size = 0

    def settle():
        plain = [(k, s) for k, s in held if not odd.search(s)]
        split = pc.utf8_split_whitespace(pa.array([s for _, s in plain], pa.string()))
        rest = [(k, t.parts(s)) for k, s in held if odd.search(s)]
        for owners, lists in (([k for k, _ in plain], split), ([k for k, _ in rest], pa.array([p for _, p in rest], pa.list_(pa.string())))):
            if not owners:
                continue
            coded = lists.values.dictionary_encode()
            told = memo.tell(coded.dictionary.to_pylist())
            n = np.array([x[0] for x in told], np.int64)
            # parts without a token (nothing that the words' pattern takes) leave no joint
            some = n[coded.indices.to_numpy()] > 0
            index = coded.indices.filter(pa.array(some))
            ends = np.concatenate([[0], np.cumsum(some)])[lists.offsets.to_numpy()]
            sums = np.concatenate([[0], np.cumsum(n[index.to_numpy()])])[ends]
            ids, raw = (pc.binary_join(pa.ListArray.from_arrays(ends.astype(np.int32), pa.array([x[j] for x in told], pa.binary()).take(index)), mark)
                        for j, mark in ((1, b" "), (2, joint)))
            for k, m, i, r in zip(owners, np.diff(sums).tolist(), ids, raw):
                digests[k].feed(m, i.as_buffer(), r.as_py())
        held.clear()
    for k, text in enumerate(texts):
        for s in _stretches(t, text):
            if len(s) > 2 * CHUNK:  # one part alone is that long: token by token
                settle()
                size = 0
                for i in t.stream_ids(s):
                    digests[k].feed(1, str(i).encode(), t.token_bytes(t.tokens[i]))
                continue
            held.append((k, s))
            size += len(s)
            if size >= CHUNK:
                settle()
                size = 0
    if held:
        settle()
    return [d.told() for d in digests]


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text (null: empty).

    Rows of any id, repeated ones too, give a row each; an empty table gives none.  A vocabulary that drops white
    space is applied to stretches of about CHUNK characters, cut at white space, and the digests are fed
    stretch by stretch; a stretch without any white space that is longer than two of these, and every text of other
    vocabularies, goes token by token.  So besides the text itself a task holds what belongs to one stretch.  Parts that come
    again are remembered (``REMEMBERED``); that changes no result.
    """
    def run(batches):
        t = transducer(path)
        memo = process_state(f"bpe remembered {path}", lambda: Remembered(t))
        for batch, texts in slices(batches, "text", max_bytes=CHUNK):
            if t.drops_space:
                told = _digests(t, memo, texts)
            else:
                told = []
                for text in texts:
                    d = Digest(b" " if t.decoder is None else b"")
                    for i in t.stream_ids(text):
                        d.feed(1, str(i).encode(), t.token_bytes(t.tokens[i]))
                    told.append(d.told())
            n, ids, decoded = zip(*told)
            yield {"doc_id": batch.column(0), "n_tokens": list(n), "ids_sha256": list(ids), "decoded_sha256": list(decoded)}
    return map_batches(keyed_text(docs, id_col, text_col), run,
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
