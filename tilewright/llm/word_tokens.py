"""Token ids of whole texts under a public word-level BPE, with each distinct word encoded once per worker.

The vocabulary's tokenizer drops white space and never joins across it, so the
ids of a text are those of its white-space-separated words in turn. Texts of
ASCII and Latin letters are cut by array operations and encoded whole. In other
texts each distinct word is encoded once per worker, in a table of bounded size.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterable, Sequence
from functools import cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Kinds of bytes: other marks, white space, digits, letters, and those that the array path leaves to the tokenizer.
_MARK, _BLANK, _DIGIT, _LETTER, _ODD = range(5)
#: Lower-case letters up to U+024F are letters byte by byte; what U+00A0 to U+00BF are, and all beyond, the tokenizer says.
_KIND = np.array(
    [_BLANK if b in b"\t\n\r " else _DIGIT if b in b"0123456789" else _LETTER if chr(b).isalpha() and b < 128 or 0x80 <= b <= 0xBF or 0xC3 <= b <= 0xC9 else _MARK if 32 < b < 127 else _ODD for b in range(256)],
    np.uint8,
)
#: A multiplication and a division sign, a capital that becomes two characters, and how the special ids are written.
_UNSURE = (b"\xc3\x97", b"\xc3\xb7", b"\xc4\xb0", b"<|")
#: Bytes of text that the array path takes at once, and of one word that it encodes.
_PART, _LONGEST = 1 << 20, 2000

#: Marks that the tokenizer never joins with letters before them.
_TRAILING = re.compile(rb"[.,;:!?]+(?= |$)")
_SPACE = re.compile(rb"[\t\n\r ]")


def _all_letters(word: bytes) -> bool:
    """Whether the word is letters and stays so in lower case."""
    if word.isascii():
        return word.isalpha()
    text = word.decode("utf-8", "replace")
    return text.isalpha() and "Σ" not in text and text.lower().isalpha()  # that letter's lower case depends on its place


def byte_names() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones for themselves, the rest from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def letters_encoding(vocabulary: str) -> tiktoken.Encoding:
    """The same vocabulary for normalised words of letters, each with a space behind it, several times faster.

    Here the space makes the byte before it the one that ends a word. This
    encoder joins any neighbours whose union is a piece, the tokenizer only pairs
    that its rules list. The results are equal if every piece's own bytes come
    out as the piece under the rules: neighbours whose union is a piece have been
    joined like that piece alone, so they are the pair by which the rules make it.
    Pieces that fail this can't come out of the rules, and are left out.
    """
    with open(vocabulary, encoding="utf-8") as f:
        model = json.load(f)["model"]
    rules = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    order, names = {pair: i for i, pair in enumerate(rules)}, byte_names()
    vocab, ranks = model["vocab"], {}
    made = [vocab[a + b] for a, b in rules]
    if any(x >= y for x, y in zip(made, made[1:])) or made[0] < 512:
        raise ValueError("ids don't rise with the rules")
    for piece, i in vocab.items():
        chars = piece.removesuffix("</w>")
        if not chars or any(c not in names for c in chars):
            continue
        parts = [*chars[:-1], chars[-1] + piece[len(chars) :]]
        while len(parts) > 1:
            rank, at = min((order.get(pair, len(rules)), k) for k, pair in enumerate(zip(parts, parts[1:])))
            if rank == len(rules):
                break
            parts[at : at + 2] = ["".join(parts[at : at + 2])]
        if len(parts) == 1 and names.get(chars) != 32:
            ranks[bytes(names[c] for c in chars) + b" " * (piece != chars)] = i
    ranks[b" "] = 100_000  # always joined to the byte before it
    return tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})


class WordTokenizer:
    def __init__(self, vocabulary: str, most_words: int = 700_000):
        if "/" not in vocabulary:
            import public_tokenizers

            vocabulary = public_tokenizers.path(vocabulary)
        self.tokenizer = Tokenizer.from_file(vocabulary)
        if self.tokenizer.get_vocab_size() > 65_536:
            raise ValueError("ids beyond 65,535 do not fit in 16 bits")
        self.letters = letters_encoding(vocabulary)
        self.most_words = most_words
        self.ends_word = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(self.tokenizer.get_vocab_size())])
        self.known: dict[bytes, bytes] = {}

    def learn(self, words: Iterable[bytes]) -> None:
        """Encode the words that are not known yet; letters with a mark behind them, as the letters and then the mark."""
        words = words if isinstance(words, set) else set(words)
        new = words.difference(self.known)
        if not new:
            return
        if len(self.known) + len(new) > self.most_words:
            self.known = {}
            new = words
        known, words = self.known, list(new)
        bare = _TRAILING.sub(b"", b" ".join(words).lower()).split(b" ")
        letters = [len(x) <= _LONGEST and (x.isalpha() or _all_letters(x)) for x in bare]
        plain = {x for x, yes in zip(bare, letters) if yes and x not in known}
        self._learn_letters(list(plain))
        self._learn_each([w for w, yes in zip(words, letters) if not yes])
        other = [(w, x) for w, x, yes in zip(words, bare, letters) if yes and w != x]
        self._learn_each({w[len(x) :] for w, x in other} - {b""})
        for w, x in other:
            known[w] = known[x] + known[w[len(x) :]] if len(x) < len(w) else known[x]

    def _learn_letters(self, words: list[bytes]) -> None:
        """Encode runs of letters many at once; each ends where a piece ends a word."""
        for i in range(0, len(words), 4096):
            part = words[i : i + 4096]
            text = b" ".join([*part, b""]).decode()
            ids = np.array(self.letters.encode_ordinary(text if text.isascii() else unicodedata.normalize("NFC", text).lower()), "<u2")
            stops = np.flatnonzero(self.ends_word[ids]) + 1
            data, start = ids.tobytes(), 0
            for w, stop in zip(part, (2 * stops).tolist(), strict=True):
                self.known[w] = data[start:stop]
                start = stop

    def _learn_each(self, words: Iterable[bytes]) -> None:
        words = list(words)
        for i in range(0, len(words), 4096):
            part = words[i : i + 4096]
            for w, e in zip(part, self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in part], add_special_tokens=False)):
                self.known[w] = np.array(e.ids, "<u2").tobytes()

    def ids_of_all(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of several texts."""
        return [self.ids(t) for t in texts]

    def _cut(self, data: bytes) -> str | None:
        """The tokenizer's words, lower-cased, each with a space behind it; None where the bytes alone don't tell them."""
        if any(x in data for x in _UNSURE):
            return None
        if not data.isascii():
            data = data.decode("utf-8", "replace").lower().encode()
        b = np.frombuffer(data.lower() + b" ", np.uint8)
        kind = _KIND[b]
        if (kind == _ODD).any():
            return None
        ends = (kind[1:] != kind[:-1]) | (kind[:-1] == _DIGIT)
        if b"'" in data:
            self._contractions(b, kind, ends)
        kept = kind[:-1] != _BLANK
        ends &= kept
        place = np.cumsum(kept, dtype=np.int32)
        place[1:] += np.cumsum(ends[:-1], dtype=np.int32)
        n_ends = int(ends.sum())
        out = np.full(int(kept.sum()) + n_ends, 32, np.uint8)
        out[place[kept] - 1] = b[:-1][kept]
        stops = place[ends]
        if n_ends and int(np.diff(stops, prepend=0).max()) > _LONGEST:
            return None
        return out.tobytes().decode()

    @staticmethod
    def _contractions(b: np.ndarray, kind: np.ndarray, ends: np.ndarray) -> None:
        """An apostrophe that no mark stands before makes a word with s, t, m, d, re, ve or ll behind it."""
        at = np.flatnonzero(b == 39)
        at = at[(at == 0) | (kind[at - 1] != _MARK)]
        one, two = b[at + 1], b[np.minimum(at + 2, len(b) - 1)]
        single = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        double = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        ends[at[single | double]] = False
        ends[at[single] + 1] = True
        ends[at[double] + 2] = True

    def ids(self, text: str | None) -> bytes:
        """The text's ids as little-endian 16-bit numbers; null and empty texts have none."""
        data, out, first = (text or "").encode("utf-8", "replace"), [], 0
        while first < len(data):
            last = first + _PART
            if last < len(data):  # the next white space after that ends the part
                space = _SPACE.search(data, last)
                last = space.start() if space else len(data)
            part = data[first:last] if first or last < len(data) else data
            words = self._cut(part)
            out.append(self._of_words(part.split()) if words is None else np.array(self.letters.encode_ordinary(words), "<u2").tobytes())
            first = last
        return b"".join(out)

    def _of_words(self, words: list[bytes]) -> bytes:
        self.learn(words)
        return b"".join(map(self.known.__getitem__, words))


@cache
def word_tokenizer(vocabulary: str) -> WordTokenizer:
    """One per worker process, so that later tasks know the words of earlier ones."""
    return WordTokenizer(vocabulary)
