"""Word-wise use of a word-end BPE tokenizer inside tasks.

The tokenizer drops white space before it splits a text, so the ids of a text are those of its runs
of other characters, one after the other. Runs repeat, so their ids are kept per worker, up to a
bound. Runs that need care (special strings, characters that normalisation may change) go to the
library itself.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from array import array
from collections.abc import Sequence

import regex
from tokenizers import Tokenizer, models

WORDS_KEPT = 250_000
STATES_KEPT = 700_000
PAIRS_KEPT = 800_000
MEMO_CHARS = 24
INNER, FINAL = 1, 2  # a token inside a word, at its end
TOKEN = ""  # the key of the token that ends at a node
NOTHING = (None, 0, b"")  # the state of the empty prefix
PLAIN_BELOW = "\u0130"  # below: one lower-case character each, and nothing that NFC changes

# The splitting rule and the word-end mark of the public vocabulary file.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
ENDINGS = frozenset(".,;:!?")
CONTRACTIONS = frozenset(("'s", "'t", "'re", "'ve", "'m", "'ll", "'d"))

_WHITE = regex.compile(r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_SEPARATORS = regex.compile("[\x1c-\x1f]")  # str.split cuts at these, the tokenizer does not


def runs(text: str) -> list[str]:
    """The maximal runs of characters that are not Unicode white space."""
    return _WHITE.findall(text) if _SEPARATORS.search(text) else text.split()


def _byte_symbols() -> dict[int, str]:
    """Byte to printable character: printable Latin-1 stays, the rest moves past U+0100 in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(moved)}


class WordTokenizer:
    """A tokenizer file of the word-end BPE kind, opened once per worker."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, split = content["model"], content["pre_tokenizer"]["pretokenizers"][0]
        if model["end_of_word_suffix"] != WORD_END or split["pattern"]["Regex"] != SPLIT:
            raise ValueError(f"{path} is not a word-end BPE tokenizer with the expected splitting rule")
        self.path = path
        self.library = Tokenizer.from_file(path)
        self.ended = self.library.model
        self.special = [t["content"] for t in content["added_tokens"]]
        self.split = regex.compile(SPLIT)
        self.symbols = _byte_symbols()
        self.word_ids: dict[str, bytes] = {}
        self.run_ids = RunIds(self)
        self.run_counts = RunCounts(self)
        self.apart: tuple[dict, dict] = ({}, {})  # inside a word, at its end
        self.pairs = 0
        self.states: dict[str, tuple] = {}

    @functools.cached_property
    def unended(self) -> models.BPE:
        """The model without the word-end mark, which only counting prefixes needs."""
        with open(self.path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        return models.BPE(model["vocab"], merges)

    @functools.cached_property
    def endings(self) -> dict:
        """Tokens by their symbols from the last to the first."""
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        inner = {t for t in vocabulary if not t.endswith(WORD_END)}
        final = {t.removesuffix(WORD_END) for t in vocabulary if t.endswith(WORD_END)}
        root: dict = {}
        for token in inner | final:
            node = root
            for symbol in reversed(token):
                node = node.setdefault(symbol, {})
            node[TOKEN] = (token, INNER * (token in inner) + FINAL * (token in final))
        return root

    def encode(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def words_of(self, lowered: str) -> list[str]:
        """The words that the splitting rule finds; the two commonest forms need no expression."""
        if lowered.isalpha():
            return [lowered]
        if lowered[-1] in ENDINGS and lowered[:-1].isalpha():
            return [lowered[:-1], lowered[-1]]
        return self.split.findall(lowered)

    def to_symbols(self, word: str) -> str:
        if word.isascii() and word.isprintable():
            return word
        return word.encode().decode("latin-1").translate(self.symbols)

    def plain(self, run: str) -> bool:
        return max(run) < PLAIN_BELOW and "<|" not in run

    def ids_of_word(self, word: str) -> bytes:
        ids = self.word_ids.get(word)
        if ids is None:
            if len(self.word_ids) >= WORDS_KEPT:
                self.word_ids.clear()
            ids = array("I", [t.id for t in self.ended.tokenize(self.to_symbols(word))]).tobytes()
            if len(word) <= MEMO_CHARS:
                self.word_ids[word] = ids
        return ids

    # ---- token counts of prefixes -----------------------------------------------------------------

    def _stays(self, left: str | None, right: str, end: bool) -> bool:
        """Do two adjacent tokens stay apart when their characters are encoded together?"""
        known = self.apart[end].get(left)
        if known is None:
            known = self.apart[end][left] = {}
        if right not in known:
            model = self.ended if end else self.unended
            found = [t.value for t in model.tokenize((left or "") + right)]
            known[right] = found == [*([left] if left else []), right + WORD_END if end else right]
            self.pairs += 1
        return known[right]

    def _extend(self, symbols: str, i: int, path: list[tuple]) -> tuple[str | None, int, int]:
        """The state of the prefix of length i from ``path``, the states of all shorter ones.

        A prefix has exactly one last token whose neighbour on the left, the last token of what
        remains, stays apart from it. (last token, tokens) hold while the word goes on; the third
        value counts the tokens if the word ends here, as its last symbol then carries the end mark.
        """
        node, found = self.endings, []
        for j in range(i - 1, -1, -1):
            node = node.get(symbols[j])
            if node is None:
                break
            if TOKEN in node:
                found.append((j, *node[TOKEN]))
        token, count, ended = None, 0, 0
        while found:  # the longest first, as it is the last token more often than not
            j, piece, kind = found.pop()
            left, before = path[j][:2]
            if kind & INNER and not count and self._stays(left, piece, False):
                token, count = piece, before + 1
            if kind & FINAL and not ended and self._stays(left, piece, True):
                ended = before + 1
            if count and ended:
                break
        return token, count, ended

    def prefix_counts(self, word: str) -> Sequence[int]:
        """Tokens of each code point prefix of one lower-case word, by dynamic programming."""
        symbols = self.to_symbols(word)
        states, size = self.states, len(symbols)
        state = states.get(symbols)
        if state is None:
            path = [NOTHING]
            for i in range(1, size + 1):
                short = i <= MEMO_CHARS
                state = states.get(symbols[:i]) if short else None
                if state is None:
                    token, count, own = self._extend(symbols, i, path)
                    # Short prefixes keep the counts of all their prefixes, for words that share them.
                    state = (token, count, path[-1][2] + bytes([own])) if short else (token, count, own)
                    if short:
                        states[symbols[:i]] = state
                path.append(state)
            ended = state[2] if size <= MEMO_CHARS else [*path[MEMO_CHARS][2], *[s[2] for s in path[MEMO_CHARS + 1 :]]]
            if len(states) >= STATES_KEPT:
                states.clear()
            if self.pairs >= PAIRS_KEPT:
                self.apart, self.pairs = ({}, {}), 0
        else:
            ended = state[2]
        if size == len(word):
            return ended
        ends, at = [], -1
        for character in word:
            at += len(character.encode())
            ends.append(ended[at])
        return ends

    def counts_of_run(self, run: str) -> Sequence[int]:
        """Tokens of each code point prefix of a run that holds no special string."""
        if max(run) < PLAIN_BELOW:
            lowered, text = run, run.lower()
        else:
            lowered = [c.lower() for c in run]
            text = "".join(lowered)
        words = self.words_of(text)
        counts = self._counts_of_word(words[0])
        for word in words[1:]:
            base = counts[-1]
            if len(word) == 1 and type(counts) is bytes and base < 250 and word in ENDINGS:
                counts += bytes([base + self.prefix_counts(word)[0]])
            else:
                counts = [*counts, *[base + c for c in self._counts_of_word(word)]]
        if len(text) == len(run):
            return counts
        ends, at = [], -1
        for piece in lowered:
            at += len(piece)
            ends.append(counts[at])
        return ends

    def _counts_of_word(self, word: str) -> Sequence[int]:
        if word not in CONTRACTIONS:
            return self.prefix_counts(word)
        # Before its last letter a contraction still reads as a quote and a letter.
        quote = self.prefix_counts("'")[0]
        letters = self.prefix_counts(word[1:])[:-1]
        return [quote, *[quote + c for c in letters], self.prefix_counts(word)[-1]]


class RunIds(dict):
    """Run to its ids, as little-endian unsigned 32-bit integers."""

    def __init__(self, owner: WordTokenizer) -> None:
        super().__init__()
        self.owner = owner

    def __missing__(self, run: str) -> bytes:
        owner = self.owner
        if owner.plain(run):
            ids = b"".join(map(owner.ids_of_word, owner.words_of(run.lower())))
        else:
            ids = array("I", owner.encode(run)).tobytes()
        if len(run) <= MEMO_CHARS:
            if len(self) >= WORDS_KEPT:
                self.clear()
            self[run] = ids
        return ids


class RunCounts(dict):
    """Run to the token counts of its code point prefixes, as 32-bit integers."""

    def __init__(self, owner: WordTokenizer) -> None:
        super().__init__()
        self.owner = owner

    def __missing__(self, run: str) -> bytes:
        counts = array("i", [*self._counts(run)]).tobytes()
        if len(run) <= MEMO_CHARS:
            if len(self) >= WORDS_KEPT:
                self.clear()
            self[run] = counts
        return counts

    def _counts(self, run: str) -> list[int]:
        owner = self.owner
        if owner.plain(run):
            return owner.counts_of_run(run)
        counts: list[int] = []
        rest, base = run, 0
        while rest:
            found = [(rest.find(s), -len(s), s) for s in owner.special if s in rest]
            if not found:
                counts.extend(base + c for c in self._part(rest))
                break
            at, _, special = min(found)
            # Until its last character has come, a special string reads as ordinary text.
            counts.extend(base + c for c in self._part(rest[: at + len(special) - 1]))
            base += len(owner.encode(rest[:at])) + 1
            counts.append(base)
            rest = rest[at + len(special) :]
        return counts

    def _part(self, part: str) -> list[int]:
        owner = self.owner
        # What is composed already stays so in every prefix, whatever marks it has.
        stable = unicodedata.is_normalized("NFC", part)
        counts = owner.counts_of_run(part) if stable else []
        if len(counts) == len(part) and counts and counts[-1] == len(owner.encode(part)):
            return counts
        # Characters yet to be composed: each prefix is normalised and encoded by itself.
        return [len(owner.encode(part[:k])) for k in range(1, len(part) + 1)]


@functools.cache
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def text_ids(path: str, text: str) -> bytes:
    """The ids of a text as little-endian unsigned 32-bit integers."""
    return b"".join(map(word_tokenizer(path).run_ids.__getitem__, runs(text)))
