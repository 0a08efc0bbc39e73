"""BPE encoding and decoding by dynamic programming over prefixes.

Every prefix of a word has exactly one last token in its BPE encoding. A suffix automaton of all tokens finds the longest
end of each prefix that stands in some token, and by it the tokens that end there; the one that is compatible with the last token
of the prefix before it is kept, and following the kept tokens back from the end of the word gives the ids. A pair is compatible if
merging the two tokens' texts would leave just these two tokens. Words end with a marked symbol, so the
alphabet has 512 symbols: a byte inside a word or a byte that ends one.
"""

from __future__ import annotations

import json
import struct
from functools import cached_property, lru_cache

import numpy as np
from pyspark.sql import DataFrame

from .common import add_columns, laid_out, split_runs, trimmed

#: Fixed values of the tokenizer's file format: its word pattern and the number of symbols before the merges.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SYMBOLS = 512
#: Bits of the number of pairs whose test a worker remembers; runs and words that it remembers each; bytes of text taken at once.
FIT_BITS, KEPT, AT_ONCE = 20, 170_000, 4 << 20
#: Words that are worked on side by side; those of more bytes than LONG are worked on one by one.
STEP, LONG = 16_384, 64


@lru_cache(maxsize=1)
def _patterns():
    """Tests for texts of letters that are as normalisation leaves them, and one for one in lower case; the words of a text."""
    import regex

    return regex.compile(r"[!-~\xa1-\u012f\u0131-\u017e]+").fullmatch, regex.compile(WORD).findall


def pattern_words(runs: list[str]) -> tuple[list[str], list, list[str]]:
    """Runs of settled letters without special tokens, each one's words (a string where it is one word), and the other runs.

    Tables of letters, numbers, cases and compositions differ with the version of Unicode: other runs are left
    to the library's own.
    """
    settled, find = _patterns()
    joined, others = " ".join(runs), []
    if not settled(joined.replace(" ", "")) or "<|" in joined:
        others = [r for r in runs if "<|" in r or not settled(r)]
        runs = [r for r in runs if "<|" not in r and settled(r)]
        joined = " ".join(runs)
    lows = joined.lower().split(" ") if runs else []
    return runs, [low if low.isalpha() else (low[:-1], low[-1]) if low[-1] in ",." and low[:-1].isalpha() else find(low) for low in lows], others


def distinct_words(split: list) -> set[str]:
    return {x for x in split if type(x) is str} | {w for x in split if type(x) is not str for w in x}


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


class _Table:
    """A fixed map of integers to integers that is asked for many keys at once; -1 for others."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = (3 * len(keys) + 1).bit_length()
        self.keys, self.values = np.full((1 << self.bits) + len(keys), -1), np.full((1 << self.bits) + len(keys), -1, np.int32)
        slots = _slots(keys, self.bits)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] < 0)
            placed = free[np.unique(slots[free], return_index=True)[1]]
            self.keys[slots[placed]], self.values[slots[placed]] = keys[placed], values[placed]
            rest = np.ones(len(keys), bool)
            rest[placed] = False
            keys, values, slots = keys[rest], values[rest], slots[rest] + 1

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        slots = _slots(keys, self.bits)
        there = self.keys[slots]
        out = np.where(there == keys, self.values[slots], -1).astype(np.int64)
        todo = np.flatnonzero((there != keys) & (there >= 0))
        while len(todo):
            slots[todo] += 1
            there = self.keys[slots[todo]]
            found = there == keys[todo]
            out[todo[found]] = self.values[slots[todo[found]]]
            todo = todo[~found & (there >= 0)]
        return out


class SuffixAutomaton:
    """All substrings of the tokens' texts, which are strings of symbols below 512.

    A state stands for substrings that end at the same places of all texts; size is the length of its longest, link the state of the longest of
    its ends that is no longer one of them. A token is the longest of its state. full is the longest token that ends a match of
    a state's longest string, part the longest that ends a shorter match.
    """

    def __init__(self, texts: dict[int, str]):
        follow, link, size, token = [{}], [-1], [0], [-1]

        def new(length: int, to: dict, back: int) -> int:
            follow.append(to)
            link.append(back)
            size.append(length)
            token.append(-1)
            return len(link) - 1

        def split(p: int, q: int, c: int) -> int:
            """A state of its own for those strings of q that are one symbol longer than p's."""
            copy = new(size[p] + 1, dict(follow[q]), link[q])
            link[q] = copy
            while p >= 0 and follow[p].get(c) == q:
                follow[p][c] = copy
                p = link[p]
            return copy

        def longer(last: int, c: int) -> int:
            q = follow[last].get(c)
            if q is not None:
                return q if size[q] == size[last] + 1 else split(last, q, c)
            at, p = new(size[last] + 1, {}, 0), last
            while p >= 0 and c not in follow[p]:
                follow[p][c] = at
                p = link[p]
            if p >= 0:
                q = follow[p][c]
                link[at] = q if size[q] == size[p] + 1 else split(p, q, c)
            return at

        # texts by length, so that what a prefix of them leads to is there before what follows it
        ends, prefixes = {}, {"": 0}
        for text, t in sorted((x, t) for t, x in texts.items()):
            known = len(text)
            while text[:known] not in prefixes:
                known -= 1
            at = prefixes[text[:known]]
            for k in range(known, len(text)):
                at = prefixes[text[: k + 1]] = longer(at, ord(text[k]))
            ends[t] = text
        for t, text in ends.items():
            at = 0
            for c in map(ord, text):
                at = follow[at][c]
            token[at] = t
        keys = [state << 9 | c for state, to in enumerate(follow) for c in to]
        self.keys, self.values = np.array(keys, np.int64), np.array([x for to in follow for x in to.values()], np.int32)
        self.link, self.size = np.maximum(np.array(link, np.int32), 0), np.array(size, np.int32)
        full = token[:]
        part = [-1] * len(full)
        for state in np.argsort(self.size, kind="stable").tolist()[1:]:  # links lead to shorter ones
            part[state] = full[link[state]]
            if full[state] < 0:
                full[state] = part[state]
        self.full, self.part = np.array(full, np.int32), np.array(part, np.int32)
        self.state_of = np.zeros(len(texts), np.int32)
        for state, t in enumerate(token):
            if t >= 0:
                self.state_of[t] = state


@lru_cache(maxsize=2)
def automaton(path: str) -> SuffixAutomaton:
    with open(path, encoding="utf-8") as f:
        return SuffixAutomaton(_texts(json.load(f))[0])


def _texts(spec: dict) -> tuple[dict[int, str], dict[int, tuple[int, int]]]:
    """Each token's symbols as a string, and the two that each merge joins."""
    vocab = spec["model"]["vocab"]
    texts, merges = {}, {}
    for c, b in _bytes_of_chars().items():
        texts |= {vocab[c]: chr(b), vocab[c + "</w>"]: chr(256 + b)}
    for m in spec["model"]["merges"]:
        a, b = m.split(" ") if isinstance(m, str) else m
        left, right, whole = vocab[a], vocab[b], vocab[a + b]
        merges[whole], texts[whole] = (left, right), texts[left] + texts[right]
    return texts, merges


class WordBpe:
    """A tokenizer file of kind "BPE with word ends", with normalisation NFC, white space to space, lower case."""

    def __init__(self, path: str, of_tokens: SuffixAutomaton | None = None):
        import regex
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        of_char = _bytes_of_chars()
        texts, merges = _texts(spec)
        self.split = np.zeros((SYMBOLS + len(merges), 2), np.int64)
        for whole, both in merges.items():
            self.split[whole] = both
        if sorted(texts) != list(range(SYMBOLS + len(merges))):
            raise ValueError(f"{path}: ids must be the symbols and then the merges in order of rank")
        self.sizes = np.array([len(texts[i]) for i in range(len(texts))])
        self.states = of_tokens or automaton(path)
        self.step_of = _Table(self.states.keys, self.states.values)
        self.shorter = self.states.part[self.states.state_of].astype(np.int64)
        wholes = np.fromiter(merges, np.int64, len(merges))
        self.merge_of = _Table(self.split[wholes, 0] << 16 | self.split[wholes, 1], wholes)
        self.tested, self.fit = np.full(1 << FIT_BITS, -1), np.zeros(1 << FIT_BITS, bool)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.bytes_of = str.maketrans({c: chr(b) for c, b in of_char.items()})
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")")
        self.special_ids = {t: struct.pack("<I", i) for t, i in special.items()}
        self.clear()

    def clear(self) -> None:
        """Forgets what it knows of the texts so far."""
        self.known, self.words = {}, {}

    def _step(self, state: np.ndarray, length: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States and lengths of the longest matches that end with a symbol more."""
        to, length = self.step_of[state << 9 | symbol], length + 1
        todo = np.flatnonzero(to < 0)
        state = state[todo]
        while len(todo):
            state = self.states.link[state].astype(np.int64)
            to[todo] = found = self.step_of[state << 9 | symbol[todo]]
            length[todo] = self.states.size[state] + 1
            todo, state = todo[found < 0], state[found < 0]
        return to, length

    def _ending(self, state: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The longest token that ends a match."""
        return np.where(length == self.states.size[state], self.states.full[state], self.states.part[state]).astype(np.int64)

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether no merge across the boundary of each pair comes before those that form the two tokens.

        Walks from the two tokens towards their symbols next to the boundary, undoing the latest merge first;
        a merge of the two pieces at the boundary that has a lower rank would have happened.
        """
        out, todo, limit = np.ones(len(left), bool), np.arange(len(left)), np.full(len(left), len(self.sizes))
        while len(todo):
            whole = self.merge_of[left << 16 | right]
            merges = (whole >= 0) & (whole < limit)
            out[todo[merges]] = False
            on = ~merges & (np.maximum(left, right) >= SYMBOLS)
            todo, left, right = todo[on], left[on], right[on]
            first = left > right
            limit = np.where(first, left, right + 1)
            left, right = np.where(first, self.split[left, 1], left), np.where(first, right, self.split[right, 0])
        return out

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The same by a table of pairs tested before, where a new pair takes the place of an older one."""
        pair = left << 16 | right
        slot = _slots(pair, FIT_BITS)
        out, new = self.fit[slot], np.flatnonzero(self.tested[slot] != pair)
        if len(new):
            pairs, where = np.unique(pair[new], return_inverse=True)
            fit = self.fits(pairs >> 16, pairs & 0xFFFF)
            out[new] = fit[where]
            slot, first = np.unique(_slots(pairs, FIT_BITS), return_index=True)
            self.tested[slot], self.fit[slot] = pairs[first], fit[first]
        return out

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each word of the pattern, given in UTF-8, begin and end, and all ids.

        Words are worked on side by side, a prefix of each in every step; the longest come first, so those
        that a step is for stand together.
        """
        sizes = np.array([len(w) for w in words])
        n, most = len(words), int(sizes.max(initial=0))
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        symbols = np.zeros((most, n), np.int64)
        starts = np.cumsum(sizes) - sizes
        row = np.repeat(np.arange(n), sizes)
        symbols[np.arange(len(row)) - np.repeat(starts, sizes), row] = np.frombuffer(b"".join([words[k] for k in order]), np.uint8)
        symbols[sizes - 1, np.arange(n)] |= 256
        last, state, length = np.zeros((most + 1, n), np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        alive = np.searchsorted(-sizes, -np.arange(1, most + 1), "right")  # words with a prefix of this length
        for end, k in enumerate(alive.tolist(), 1):
            state, length = self._step(state[:k], length[:k], symbols[end - 1, :k])
            token = self._ending(state, length)
            todo = np.flatnonzero(self.sizes[token] < end)
            while len(todo):
                tried = token[todo]
                todo = todo[~self._fits(last[end - self.sizes[tried], todo], tried)]
                token[todo] = self.shorter[token[todo]]
                todo = todo[self.sizes[token[todo]] < end]
            last[end, :k] = token
        back, rows, end, count = [], np.arange(n), sizes.copy(), np.zeros(n, np.int64)
        while len(rows):
            token = last[end[rows], rows]
            back.append((rows, token))
            count[rows] += 1
            end[rows] -= self.sizes[token]
            rows = rows[end[rows] > 0]
        ends = np.zeros(n + 1, np.int64)
        ends[1 + order] = count
        ends = np.cumsum(ends)
        ids = np.zeros(ends[-1], "<u4")
        for k, (rows, token) in enumerate(back, 1):
            ids[ends[1 + order[rows]] - k] = token
        return ends, ids

    def encode_long_word(self, word: bytes) -> np.ndarray:
        """The ids of one long word, a prefix after the other."""
        sizes, fits, steps, link, most, full, part, shorter = self.lists
        last, state, length, symbols = [0], 0, 0, [*word]
        symbols[-1] |= 256
        for end, c in enumerate(symbols, 1):
            while (to := steps.get(state << 9 | c)) is None:
                state = link[state]
                length = most[state]
            state, length = to, length + 1
            token = full[to] if length == most[to] else part[to]
            while sizes[token] < end and not fits(last[end - sizes[token]], token):
                token = shorter[token]
            last.append(token)
        ids, end = [], len(word)
        while end:
            ids.append(last[end])
            end -= sizes[last[end]]
        return np.array(ids[::-1], "<u4")

    @cached_property
    def lists(self):
        one = lru_cache(maxsize=100_000)(lambda left, right: bool(self.fits(np.array([left]), np.array([right]))[0]))
        steps = dict(zip(self.states.keys.tolist(), self.states.values.tolist(), strict=True))
        return self.sizes.tolist(), one, steps, *(x.tolist() for x in (self.states.link, self.states.size, self.states.full, self.states.part, self.shorter))

    def _encode(self, words: list[str]) -> None:
        """Puts the packed ids of words of the pattern into self.words."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        long = [k for k, w in enumerate(data) if len(w) > LONG]
        for k in long:
            self.words[words[k]] = self.encode_long_word(data[k]).tobytes()
        if long:
            words, data = ([x[k] for k, w in enumerate(data) if len(w) <= LONG] for x in (words, data))
        for at in range(0, len(words), STEP):
            ends, ids = self.encode_words(data[at : at + STEP])
            packed, cut = ids.tobytes(), (ends * 4).tolist()
            self.words.update((w, packed[a:b]) for w, a, b in zip(words[at : at + STEP], cut[:-1], cut[1:], strict=True))

    def _split(self, run: str) -> list[str]:
        """The words of a run by the library's normalisation and pattern; special tokens are words here."""
        parts = self.special.split(run) if "<|" in run else [run]
        words = []
        for p in parts:
            if p in self.special_ids:
                words.append(p)
            elif p:
                pieces = self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(p))
                words += [w.translate(self.bytes_of).encode("latin-1").decode("utf-8", "surrogatepass") for w, _ in pieces]
        return words

    def _learn(self, runs: list[str]) -> None:
        runs, split, others = pattern_words(runs)
        runs, split = runs + others, split + [*map(self._split, others)]
        self.words = self.special_ids | self.words  # no word of the pattern is a special one
        new = distinct_words(split).difference(self.words)
        self._encode([*new])
        word = self.words.__getitem__
        self.known.update((r, word(x) if type(x) is str else b"".join(map(word, x))) for r, x in zip(runs, split, strict=True))
        self.words = trimmed(self.words, new, KEPT)

    def encode_all(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's ids begin and end, and all ids; texts is an Arrow array, null is as empty.

        The pattern never joins what white space parts, nor does normalisation, so texts are taken as runs
        between ASCII white space, and each distinct run is encoded once.
        """
        ends, codes, runs = split_runs(texts)
        if missing := [r for r in runs if r not in self.known]:
            self._learn(missing)
        out = laid_out([self.known[r] for r in runs], np.dtype("<u4"), codes, ends)
        self.known = trimmed(self.known, runs, KEPT)
        return out

    def encode(self, text: str | None) -> bytes:
        """One text's ids as little-endian unsigned 32-bit integers."""
        import pyarrow as pa

        return self.encode_all(pa.array([text or ""], pa.string()))[1].tobytes()


@lru_cache(maxsize=2)
def _vocabulary(path: str):
    """The tokens' own strings by id, as an Arrow array."""
    import pyarrow as pa

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    tokens = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return pa.array([tokens.get(i) for i in range(max(tokens) + 1)], pa.string())


def decode_all(ends: np.ndarray, ids: np.ndarray, path: str):
    """Texts as an Arrow array: the tokens' own strings, joined by a space, as a tokenizer without a decoder does."""
    import pyarrow as pa
    import pyarrow.compute as pc

    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _vocabulary(path).take(pa.array(ids))), " ")


def _bytes_of_chars() -> dict[str, int]:
    """Byte-level alphabets show printable Latin-1 bytes as themselves and number the others from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


_TOKENIZERS: dict[str, WordBpe] = {}


def tokenizer(path: str, of_tokens=None) -> WordBpe:
    """A process's tokenizer of a file; of_tokens is a broadcast automaton, where there is one."""
    if path not in _TOKENIZERS:
        while len(_TOKENIZERS) > 1:
            _TOKENIZERS.pop(next(iter(_TOKENIZERS)))
        _TOKENIZERS[path] = WordBpe(path, of_tokens and of_tokens.value)
    return _TOKENIZERS[path]


def _packed(ends: np.ndarray, ids: np.ndarray):
    """An Arrow array of binaries that hold 4 bytes an id."""
    import pyarrow as pa

    return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))])


def encode(docs: DataFrame, path: str, text: str = "text", and_decode: bool = False) -> DataFrame:
    """Adds token_ids (binary, little-endian unsigned 32-bit) and n_tokens (long) to docs; no shuffle.

    With and_decode, decoded (string) is added too, from the same pass. Null and empty texts have no tokens
    and are kept, so are repeated rows and all other columns; columns of these names are replaced. An empty
    table gives an empty table. Texts of any length are encoded whole. The automaton, as large as the vocabulary, is broadcast.
    """
    of_tokens = docs.sparkSession.sparkContext.broadcast(automaton(path))

    def make(texts):
        import pyarrow as pa

        ends, ids = tokenizer(path, of_tokens).encode_all(texts)
        return [_packed(ends, ids), pa.array(np.diff(ends), pa.int64())] + ([decode_all(ends, ids, path)] if and_decode else [])

    return add_columns(docs, text, "token_ids binary, n_tokens long" + ", decoded string" * and_decode, make, lambda: tokenizer(path, of_tokens).clear(), most=AT_ONCE)


def decode(docs: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """Adds decoded (string), the text of the packed ids, null as empty; replaces a column of this name."""

    def make(packed):
        import pyarrow.compute as pc

        packed = pc.fill_null(packed, b"")
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(packed).to_numpy(), dtype=np.int64)]) // 4
        return [decode_all(ends, np.frombuffer(b"".join(packed.to_pylist()), "<u4"), path)]

    return add_columns(docs, ids, "decoded string", make)
