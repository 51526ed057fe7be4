"""Token ids and prefix counts of texts, put together from words encoded once.

The tokenizer file used here drops white space, cuts the rest into words and
encodes each word on its own. The ids of a text are therefore those of its
words one after the other. A worker keeps what its words give in a table that
stops growing at ``TABLE_SIZE`` entries; words beyond it are encoded whenever
they come, so results never depend on the size.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import regex
from tokenizers import Tokenizer

#: Words a worker keeps (about 150 bytes each); no limit on what is encoded.
TABLE_SIZE = 400_000

#: Control characters that Python takes for white space and the tokenizer does not.
_ODD = regex.compile(r"[\x1c-\x1f]")
_GAPS = regex.compile(r"(\s+)")
#: The word pattern known to mean, for lower-case text of ASCII and Latin letters, the
#: faster one below; another file's pattern is used as it stands.
_KNOWN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LATIN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\u024f]+|[0-9]|[^\sa-z0-9\xdf-\xf6\xf8-\u024f]+"
_BEYOND = re.compile(r"[^\x00-\x7f\xdf-\xf6\xf8-\u024f]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTable(dict):
    """What each word gives, as bytes (``_make`` says what that is)."""

    #: Whether white space gives something, too.
    gaps = False

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        words = next(
            p["pattern"]["Regex"] for p in self.spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        )
        self._find_any = regex.compile(words + r"|\s+" * self.gaps).findall
        self._find_latin = re.compile(_LATIN + r"|\s+" * self.gaps).findall if words == _KNOWN else None
        self._special = tuple(t["content"] for t in self.spec["added_tokens"])
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        symbol = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self._symbols = [symbol[b] for b in range(256)]

    def __missing__(self, word: str) -> bytes:
        made = self._make(word)
        if len(self) < TABLE_SIZE:
            self[word] = made
        return made

    def of_text(self, text: str) -> bytes:
        """What the words of ``text`` give, one after the other."""
        lowered = self._lowered(text)
        if lowered is not None:
            return b"".join(map(self.__getitem__, self._find(lowered)))
        out = []
        for piece in _GAPS.split(text):
            if piece and not (lowered := self._lowered(piece)):
                out.append(self._odd(piece))
            elif piece:
                out += map(self.__getitem__, self._find(lowered))
        return b"".join(out)

    def _find(self, lowered: str) -> list[str]:
        if self._find_latin and (lowered.isascii() or not _BEYOND.search(lowered)):
            return self._find_latin(lowered)
        return self._find_any(lowered)

    def _lowered(self, text: str) -> str | None:
        """The text in lower case if the words of its prefixes can be read off it."""
        if not text.isascii() and ("Σ" in text or not unicodedata.is_normalized("NFC", text)):
            return None
        if "<|" in text and any(s in text for s in self._special) or _ODD.search(text):
            return None
        lowered = text.lower()
        return lowered if len(lowered) == len(text) else None

    def _level(self, word: str) -> str:
        """The word's bytes as the tokenizer's symbols."""
        return word if word.isascii() else "".join([self._symbols[b] for b in word.encode()])

    def _make(self, word: str) -> bytes:
        raise NotImplementedError

    def _odd(self, piece: str) -> bytes:
        raise NotImplementedError


class TokenIds(WordTable):
    """Ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        super().__init__(path)
        self._encode = self.tokenizer.model.tokenize

    def _make(self, word: str) -> bytes:
        return np.array([t.id for t in self._encode(self._level(word))], "<u4").tobytes()

    def _odd(self, piece: str) -> bytes:
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()


def _differences(counts: list[int]) -> bytes:
    """The steps of running counts (of any size) as 16-bit integers, checked to hold them."""
    steps = np.diff(np.array(counts, np.int64))
    narrow = steps.astype("<i2")
    if (narrow != steps).any():
        raise OverflowError("one code point changes a token count by more than 16 bits hold")
    return narrow.tobytes()


class PrefixCounts(WordTable):
    """For each code point, how many tokens the prefix that ends with it has more
    than the one before, as little-endian signed 16-bit integers.

    The counts come from dynamic programming over prefixes. In byte-pair
    encoding, the last token of a prefix is the only one that ends there and
    is compatible with the last token of what precedes it (two tokens are
    compatible if their concatenation encodes to just these two), so
    ``count[j] = count[j - len(token)] + 1``. A prefix that ends inside a word
    ends that word there, so its last token is one with the word-end mark.
    Words share prefixes, so the table of prefixes is shared, too.

    Pieces (between white space) that are not in the normal form NFC, or that lower case makes longer, are
    normalised in clusters (a code point and those after it that can combine with it). The prefixes of what
    comes out are counted as above; a prefix that ends inside a cluster goes on from the
    state before the cluster with what its own few code points give (``_clustered``). Pieces with special strings or
    apostrophes beside such text are encoded prefix by prefix: exact, but the work grows with the
    square of such a piece's length.
    """

    gaps = True

    def __init__(self, path: str):
        super().__init__(path)
        model = self.spec["model"]
        self._end = model["end_of_word_suffix"]
        self._inner = {t: t for t in model["vocab"] if not t.endswith(self._end)}
        self._last = {(u := t.removesuffix(self._end)): u for t in model["vocab"] if t.endswith(self._end)}
        self._longest = max(map(len, [*self._inner, *self._last]))
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        sizes = [2, 3, 1, *range(4, self._longest + 1)]
        self._orders = [sorted(sizes, key=lambda s, g=g: (s != g, sizes.index(s))) for g in range(self._longest + 1)]
        self._rank = {p: i for i, p in enumerate(pairs)}
        self._pairs: dict[tuple[str, str], bool] = {}
        self._end_pairs: dict[tuple[str, str], bool] = {}
        self._prefixes: dict[str, tuple[int, str, int]] = {}

    def _merged(self, symbols: list[str]) -> list[str]:
        rank, none = self._rank.get, len(self._rank)
        while len(symbols) > 1:
            ranks = [rank(p, none) for p in zip(symbols, symbols[1:])]
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _step(self, word: str, n: int, before: list[tuple[int, str, int]], ends: bool, guess: int) -> tuple[int, str]:
        """Count and last token of the first ``n`` symbols, given those of the shorter prefixes."""
        vocabulary, pairs = (self._last, self._end_pairs) if ends else (self._inner, self._pairs)
        # only one token fits, so the order in which sizes are tried is free: likely ones first
        for size in self._orders[min(guess, self._longest)]:
            if size > n or (token := vocabulary.get(word[n - size : n])) is None:
                continue
            count, left, _ = before[n - size]
            if size == n:
                return 1, token
            if not left:
                continue
            fits = pairs.get((left, token))
            if fits is None:
                body = [*left, *token]
                body[-1] += self._end * ends
                fits = self._merged(body) == [left, token + self._end * ends]
                if len(pairs) < TABLE_SIZE:
                    pairs[left, token] = fits
            if fits:
                return count + 1, token
        return 0, ""

    def _make(self, word: str) -> bytes:
        if word.isspace():
            return b"\0\0" * len(word)
        if word[0] == "'" and len(word) > 1 and word[1].isalpha():  # its shorter prefixes are two words
            return self._odd(word)
        states, ends = self._states(word)
        return _differences([0, *(states[j][2] for j in ends)])

    def _states(self, word: str) -> tuple[list[tuple[int, str, int]], list[int]]:
        """Per prefix of the word's symbols: count, last token, count if the word ended there (else 0);
        and the symbols up to each code point."""
        symbols, prefixes = self._level(word), self._prefixes
        ends = list(range(1, len(word) + 1)) if word is symbols else np.cumsum([len(c.encode()) for c in word]).tolist()
        room = len(prefixes) < TABLE_SIZE
        states: list[tuple[int, str, int]] = [(0, "", 0)]
        for j in ends:
            for at in range(len(states), j + 1):
                text = symbols[:at] if at <= 24 else ""  # longer ones are hardly shared
                state = prefixes.get(text)
                if state is None:
                    count, last = self._step(symbols, at, states, False, len(states[-1][1]) + 1)
                    whole = self._step(symbols, at, states, True, len(last))[0] if at == j else 0
                    state = (count, last, whole)
                    if text and room:
                        prefixes[text] = state
                states.append(state)
        return states, ends

    def _odd(self, piece: str) -> bytes:
        known = self._find_latin is not None and not _ODD.search(piece) and "'" not in piece
        if known and not piece.isspace() and not any(s in piece for s in self._special):
            counts = self._clustered(piece)
        else:
            counts = [len(self.tokenizer.encode(piece[:i], add_special_tokens=False).ids) for i in range(1, len(piece) + 1)]
        return _differences([0, *counts])

    def _clustered(self, piece: str) -> list[int]:
        """The count of every prefix of a piece without white space, special strings and apostrophes."""
        starts = [i for i, c in enumerate(piece) if not i or _stands_alone(c)]
        clusters = [piece[i:j] for i, j in zip(starts, [*starts[1:], len(piece)])]
        normal = [_normal(c) for c in clusters]
        text = "".join(normal)
        if "'" in text or re.search(r"\s", text):
            return [len(self.tokenizer.encode(piece[:i], add_special_tokens=False).ids) for i in range(1, len(piece) + 1)]
        words = self._find(text)
        total = np.cumsum(np.frombuffer(b"".join(map(self.__getitem__, words)), "<i2"), dtype=np.int64).tolist()
        ends = np.cumsum([len(w) for w in words]).tolist()
        counts, at, k, held = [], 0, 0, None
        for cluster, made in zip(clusters, normal):
            while k < len(ends) and ends[k] < at:
                k += 1  # the word that the code point before the cluster is in
            for i in range(1, len(cluster) + 1):
                part = made if i == len(cluster) else _normal(cluster[:i])
                if made.startswith(part):
                    counts.append(total[at + len(part) - 1])
                    continue
                # words of what precedes the cluster, with this part after it
                low = ends[k - 1] if k else 0
                before = total[low - 1] if low else 0
                first, *rest = self._find(text[at - 1 : at] + part)
                if at and len(first) > 1:  # the word goes on
                    if held is None or held[0] != k:
                        held = (k, *self._states(words[k]), self._level(words[k]))
                    _, states, symbols, level = held
                    n = symbols[at - low - 1]
                    near = max(0, n - self._longest - 1)  # no token reaches further back
                    before += self._goes_on(states[near : n + 1], level[near:n], self._level(first[1:]))
                elif at:
                    before = total[at - 1]
                else:
                    rest = [first, *rest]
                for word in rest:
                    before += int(np.frombuffer(self[word], "<i2").sum(dtype=np.int64))
                counts.append(before)
            at += len(made)
        return counts

    def _goes_on(self, states: list[tuple[int, str, int]], word: str, more: str) -> int:
        """The count of the word that has ``more`` symbols after ``word``, whose states are given."""
        longer = word + more
        for at in range(len(word) + 1, len(longer) + 1):
            states.append((*self._step(longer, at, states, False, len(states[-1][1]) + 1), 0))
        states.pop()
        return self._step(longer, len(longer), states, True, 1)[0]


def _stands_alone(c: str) -> bool:
    """Whether nothing before a code point can change with it in the normal form: no mark, and no Hangul vowel or
    final (nor a vowel of a script added to Unicode since)."""
    if c < "\u0300":
        return True
    if unicodedata.category(c) in ("Mn", "Mc", "Me", "Cn") or unicodedata.combining(c):
        return False
    return not ("\u1160" <= c <= "\u11ff" or "\U00016d40" <= c <= "\U00016d7f")


def _normal(text: str) -> str:
    """As the tokenizer's normaliser makes it: NFC, then lower case code point by code point."""
    return "".join(map(str.lower, unicodedata.normalize("NFC", text)))


_TABLES: dict[tuple[type, str], WordTable] = {}


def worker_table(kind: type, path: str) -> WordTable:
    """The worker's own table; workers are reused, so later tasks find it filled."""
    if (kind, path) not in _TABLES:
        _TABLES[kind, path] = kind(path)
    return _TABLES[kind, path]


def id_arrays(path: str, texts: list[str | None]) -> Iterator[np.ndarray]:
    """The ids of each text (NULL: none)."""
    table = worker_table(TokenIds, path)
    for text in texts:
        yield np.frombuffer(table.of_text(text or ""), "<u4")
