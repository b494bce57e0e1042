"""Token ids of whole texts, as the tokenizers library gives them, with a cache of pieces.

A byte-pair encoder works on each pre-token by itself, so a text is the concatenation of its words'
ids. Words repeat; each worker keeps two bounded caches, of blank-separated words and of pre-tokens,
and asks the library's model only for pre-tokens it has not met. Texts with any character outside a
plain Latin set, or with a special-token string, go through the library as a whole.

Many texts at once (`ids_of_texts`) have their words looked up as one Arrow column in a table of words
that keeps the most used ones when it is full. New words go through the model in blocks.
"""

from __future__ import annotations

import codecs
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Entries, not texts: a full cache starts over, which costs time and changes no result.
WORD_ENTRIES = 400_000
PIECE_ENTRIES = 300_000
# A full table of words keeps its most used ones, up to half of its entries and ids.
TABLE_ENTRIES = 400_000
TABLE_IDS = 8_000_000
# Words that one call of the model gets.
BLOCK_WORDS = 20_000
# Texts of fewer letters in all are encoded one by one: a search in the table has to hash the table first.
COLUMN_LETTERS = 1 << 20

_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ňŊ-ž"
_PLAIN = re.compile(f"[\n -~{_LETTERS}]*").fullmatch
# The pre-token patterns of the two vocabularies, written for the plain set.
_BYTE_PIECES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+"
).findall
# A full stop or comma behind a letter or digit is a pre-token if it ends the word. It is looked up apart
# from the word, under a control character that no plain text has.
_TAILS = {"\1": ".", "\2": ","}
_TAIL_BYTES = np.zeros(256, np.uint8)
_TAIL_BYTES[[ord(t) for t in _TAILS.values()]] = [ord(t) for t in _TAILS]
_WORD_BYTES = np.array([b > 127 or chr(b).isalnum() for b in range(256)])  # beyond ASCII the plain set has letters only
_WORD_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+").findall


def _byte_letters() -> dict[int, str]:
    """The visible character that stands for each byte: itself where it is one, else from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in visible}
    hidden = [b for b in range(256) if b not in table]
    return table | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Pieces(dict):
    """Pre-token -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, model):
        self.tokenize, self.letters = model.tokenize, _byte_letters()

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= PIECE_ENTRIES:
            self.clear()
        spelled = piece.encode().decode("latin-1").translate(self.letters)
        ids = array("I", [t.id for t in self.tokenize(spelled)]).tobytes()
        self[piece] = ids
        return ids


class _Words(dict):
    """Blank-separated word -> ids. `lead` is the blank that belongs to the word, if it does."""

    def __init__(self, pieces: _Pieces, find, lead: str, lower: bool):
        self.pieces, self.find, self.lead, self.lower = pieces, find, lead, lower

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORD_ENTRIES:
            self.clear()
        self[word] = ids = self.encode(word)
        return ids

    def encode(self, word: str) -> bytes:
        """Its ids, not kept."""
        if word in _TAILS:
            return self.pieces[_TAILS[word]]
        text = self.lead + (word.lower() if self.lower else word)
        if word.isalpha():
            return self.pieces[text]
        if word[:-1].isalpha() and word[-1] in ".,":
            return self.pieces[text[:-1]] + self.pieces[text[-1]]
        return b"".join([self.pieces[p] for p in self.find(text)])


class _WordTable:
    """Ids of a column of words. Words that are not in the table are encoded once a column and added.

    `encode` gives all ids of a column of different words, and the number of ids of each.
    """

    def __init__(self, encode):
        self.encode = encode
        self._set(pa.array([], pa.string()), np.empty(0, np.uint32), np.empty(0, np.int32), np.empty(0, np.int64))

    def _set(self, words: pa.Array, ids: np.ndarray, counts: np.ndarray, uses: np.ndarray) -> None:
        self.words, self.ids, self.counts, self.uses = words, ids, counts, uses
        self.starts = np.cumsum(counts, dtype=np.int32) - counts

    def ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many ids there are up to the end of each word."""
        found = pc.index_in(words, value_set=self.words)
        at = found.fill_null(0).to_numpy()
        if found.null_count:
            new = found.is_null()
            missing = words.filter(new).dictionary_encode()
            at = at.copy()
            at[new.to_numpy(zero_copy_only=False)] = missing.indices.to_numpy() + len(self.words)
            self._add(missing.dictionary)
        counts = self.counts[at]
        ends = np.cumsum(counts, dtype=np.int32)
        places = np.repeat(self.starts[at] - (ends - counts), counts)
        places += np.arange(len(places), dtype=np.int32)
        ids = self.ids[places]
        self.uses += np.bincount(at, minlength=len(self.words))
        if len(self.words) > TABLE_ENTRIES or len(self.ids) > TABLE_IDS:
            self._keep_most_used()
        return ids, ends

    def _add(self, words: pa.Array) -> None:
        found = [self.encode(words[i : i + BLOCK_WORDS]) for i in range(0, len(words), BLOCK_WORDS)]
        self._set(
            pa.concat_arrays([self.words, words]),
            np.concatenate([self.ids, *(ids for ids, _ in found)]),
            np.concatenate([self.counts, *(counts for _, counts in found)]),
            np.concatenate([self.uses, np.zeros(len(words), np.int64)]),
        )

    def _keep_most_used(self) -> None:
        """Uses count half from now on, so that words of texts long past make room."""
        keep = np.argsort(-self.uses, kind="stable")[: TABLE_ENTRIES // 2]
        keep = np.sort(keep[np.cumsum(self.counts[keep], dtype=np.int64) <= TABLE_IDS // 2])
        held = np.zeros(len(self.words), bool)
        held[keep] = True
        ids = self.ids[np.repeat(held, self.counts)]
        self._set(self.words.take(pa.array(keep)), ids, self.counts[keep], self.uses[keep] // 2)


def _tails_apart(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words with their tails as words of their own, and the place of each old word and of the end."""
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int32)[: len(words) + 1]
    data = np.frombuffer(data or b"", np.uint8).copy()
    long = np.flatnonzero(np.diff(offsets) > 1)
    last = offsets[long + 1] - 1
    tailed = (_TAIL_BYTES[data[last]] > 0) & _WORD_BYTES[data[last - 1]]
    long, last = long[tailed], last[tailed]
    data[last] = _TAIL_BYTES[data[last]]
    more = np.zeros(len(words) + 1, np.int32)
    more[long + 1] = 1
    places = np.arange(len(words) + 1, dtype=np.int32) + np.cumsum(more, dtype=np.int32)
    cuts = np.empty(places[-1] + 1, np.int32)
    cuts[places] = offsets
    cuts[places[long] + 1] = last
    return pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data)), places


class Encoder:
    """`ids(text)` gives the bytes of all ids, without special tokens added."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.whole = Tokenizer.from_file(path)
        self.lower = self.whole.normalizer is not None
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.pieces = _Pieces(self.whole.model)
        find = _WORD_PIECES if self.lower else _BYTE_PIECES
        self.words = _Words(self.pieces, find, "" if self.lower else " ", self.lower)
        self.find = find
        # Takes spelled pre-tokens with blanks between them; no spelled byte is a blank.
        self.spelled = Tokenizer(self.whole.model)
        self.spelled.pre_tokenizer = CharDelimiterSplit(" ")
        self.letters = " " + "".join(self.pieces.letters[b] for b in range(1, 256))
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.sizes[list(vocabulary.values())] = [len(entry) for entry in vocabulary]
        self.table = _WordTable(self._ids_of_words)

    def _by_words(self, text: str) -> bool:
        """Whether the ids of the words, one by one, are those of the text."""
        if not _PLAIN(text) or any(s in text for s in self.special):
            return False
        return self.lower or not ("  " in text or " \n" in text or text[-1:] == " ")

    def ids(self, text: str) -> bytes:
        if not _PLAIN(text) or any(s in text for s in self.special):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if self.lower:
            return b"".join([self.words[w] for w in text.split(" ")])
        if "  " in text or " \n" in text or text[-1:] == " ":
            return b"".join([self.pieces[p] for p in self.find(text)])
        first, *rest = text.split(" ")
        return b"".join([self.pieces[p] for p in self.find(first)] + [self.words[w] for w in rest])

    def _ids_of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of words, and the number of ids of each.

        The ids of all pre-tokens come from one call; as many letters as a word has bytes are its own.
        """
        listed = words.to_pylist()
        joined = " " + " ".join(listed)
        if not self.lower and not any(t in joined for t in _TAILS):
            pieces = "\0".join(self.find(joined))
            spelled, _ = codecs.charmap_decode(pieces.encode(), "strict", self.letters)
            ids = np.array(self.spelled.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.cumsum(self.sizes[ids])
            word_ends = np.cumsum(pc.binary_length(words).to_numpy() + 1, dtype=np.int64)
            after = np.searchsorted(ends, word_ends, "right")
            if len(ends) and np.array_equal(ends[after - 1], word_ends) and after[-1] == len(ids):
                return ids, np.diff(after, prepend=0).astype(np.int32)
        one_by_one = [self.words.encode(w) for w in listed]
        counts = np.fromiter(map(len, one_by_one), np.int32, len(one_by_one)) // 4
        return np.frombuffer(b"".join(one_by_one), np.uint32), counts

    def ids_of_texts(self, texts: list[str]) -> list[bytes]:
        """`ids` of each text."""
        if sum(map(len, texts)) < COLUMN_LETTERS:
            return [self.ids(text) for text in texts]
        heads, rests = [], []
        for text in texts:
            head, rest = b"", None
            if not self._by_words(text):
                head = self.ids(text)
            elif self.lower:
                rest = text
            else:
                first, blank, rest = text.partition(" ")
                head, rest = b"".join([self.pieces[p] for p in self.find(first)]), rest if blank else None
            heads.append(head)
            rests.append(rest)
        split = pc.split_pattern(pa.array(rests, pa.string()), " ")  # a null has no words
        words, starts = split.values, split.offsets.to_numpy()
        if not self.lower:
            words, places = _tails_apart(words)
            starts = places[starts]
        ids, ends = self.table.ids_of(words)
        body, ends = ids.tobytes(), np.concatenate([[0], 4 * ends.astype(np.int64)])[starts].tolist()
        return [head + body[a:b] for head, a, b in zip(heads, ends, ends[1:])]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per worker process and vocabulary file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)
