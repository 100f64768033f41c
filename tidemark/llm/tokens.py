"""Token ids of texts, by the tokenizers library, with the words seen before remembered.

A byte-level vocabulary's pre-tokenizer starts a token at each single space or line
end between two words, and never lets one reach over it. So a text whose words stand
one space or one line end apart is cut there, each word with the character before it
is given to the library once per worker, and the words' ids are strung together. Any
other text, and one that holds the string of an added token, such as an end-of-text
mark, is given to the library whole. The memory for words is bounded and starts
anew when it is full.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

REMEMBERED = 1_600_000
#: Characters of texts that are encoded together.
TOGETHER = 1 << 20
#: Bytes of texts in an Arrow array whose words are looked up together, and words whose
#: ids are strung together; new words that are learnt together.
ARROW_TOGETHER, STRUNG, LEARNT = 1 << 24, 1 << 17, 1 << 15
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """The place of a public vocabulary, on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Unicode white space but for the space and the line end.
ODD_SPACE = [chr(c) for c in (9, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B))] + [
    chr(c) for c in (0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
]
RUNS = ("  ", " \n", "\n ", "\n\n")


def words_of(text: str) -> list[str] | None:
    """The words, those at the start of a line with a line end before them; None if the
    white space between them is not always one space or one line end."""
    if text[:1] in " \n" or text[-1] in " \n" or any(x in text for x in (*RUNS, *ODD_SPACE)):
        return None
    return ("\n" + text).replace("\n", " \n").split(" ")[1:]


def plain(texts: pa.StringArray) -> np.ndarray:
    """Whether ``words_of`` would cut each text, for texts without nulls."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    good = np.diff(ends) > 0
    if not good.any():
        return good
    space = (data == 32) | (data == 10)
    good[good] &= ~(space[ends[:-1][good]] | space[ends[1:][good] - 1])
    # A run over the border of two texts has the first text's last byte in it.
    run = np.flatnonzero(space[:-1] & space[1:])
    good[np.searchsorted(ends, run, "right") - 1] = False
    # Bytes that may be odd white space; the texts that have some are looked at.
    odd = (data - np.uint8(9) < 5) & (data != 10)
    lead, then = data[:-1], data[1:]
    odd[:-1] |= (lead == 0xC2) & ((then == 0x85) | (then == 0xA0))
    odd[:-1] |= (lead == 0xE1) & (then == 0x9A) | (lead == 0xE2) & (then | 1 == 0x81)
    odd[:-1] |= (lead == 0xE3) & (then == 0x80)
    for k in np.unique(np.searchsorted(ends, np.flatnonzero(odd), "right") - 1):
        good[k] = good[k] and words_of(texts[int(k)].as_py()) is not None
    return good


class Encoder:
    """Encodes with a vocabulary file, as the library does with its defaults."""

    def __init__(self, path: str | None = None, remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or tokenizer_path())
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.remembered = remembered
        vocabulary = self.tokenizer.get_vocab()
        # A token of the byte alphabet has one character per byte.
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, k in vocabulary.items():
            self.bytes_of[k] = len(token)
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int64)  # ends[k + 1] is where word k ends
        self.size = 0

    def _ids(self, text: str) -> np.ndarray:
        got = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(got.ids, np.uint32)

    def learn(self, words: list[str]) -> None:
        """Adds new words: they are encoded as one text and cut by the tokens' bytes."""
        marked = [w if w[0] == "\n" else " " + w for w in words]
        ids = self._ids("".join(marked))
        sizes = np.fromiter((len(w.encode()) for w in marked), np.int64, len(marked))
        ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(sizes)) + 1
        k, n = len(self.place), len(words)
        while self.size + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while k + n >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[self.size : self.size + len(ids)] = ids
        self.ends[k + 1 : k + 1 + n] = self.size + ends
        self.size += len(ids)
        self.place.update(zip(words, range(k, k + n)))

    def encode(self, text: str) -> np.ndarray:
        """The ids of the whole text, as unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; new words of all texts are learnt together."""
        cut = [None if any(x in t for x in self.added) else words_of(t) for t in texts]
        words = list(chain.from_iterable(w for w in cut if w))
        at = list(map(self.place.get, words))
        if None in at:
            new = {w for w, k in zip(words, at) if k is None}
            if len(self.place) + len(new) > self.remembered:
                self.clear()
                new, at = set(words), [None] * len(words)
            self.learn(list(new))
            place = self.place
            at = [place[w] if k is None else k for w, k in zip(words, at)]
        places = np.array(at, np.int64)
        starts = self.ends[places]
        lengths = self.ends[places + 1] - starts
        stops = np.cumsum(lengths)
        total = int(stops[-1]) if len(stops) else 0
        ids = self.ids[np.repeat(starts - stops + lengths, lengths) + np.arange(total)]
        borders = np.append(0, stops)[np.cumsum([0] + [len(w or ()) for w in cut])].tolist()
        # The first token of a cut text is the line end that words_of put before it.
        return [
            self._ids(text) if w is None else ids[a + 1 : b]
            for text, w, a, b in zip(texts, cut, borders, borders[1:])
        ]

    def batches(self, texts) -> Iterator[np.ndarray]:
        """The ids of each text of an iterable, some ``TOGETHER`` characters at a time."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield from self.encode_all(held)
                held, size = [], 0
        if held:
            yield from self.encode_all(held)


class ArrowEncoder(Encoder):
    """Encodes Arrow arrays of texts: Arrow cuts them and looks the words up, in an array
    of those known. Where that is full, the words of the array at hand stay."""

    def clear(self) -> None:
        self.known = pa.array([], pa.string())
        self.ids = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def keep(self, places: np.ndarray) -> None:
        """Forgets all words but those at the places, which rise."""
        lengths = np.diff(self.ends)[places]
        ends = np.append(0, np.cumsum(lengths))
        self.ids = self.ids[np.repeat(self.ends[places] - ends[:-1], lengths) + np.arange(ends[-1])]
        self.ends, self.known = ends, self.known.take(pa.array(places))

    def learn(self, words: pa.StringArray) -> None:
        """Adds new words: some ``LEARNT`` are encoded as one text and cut by the tokens' bytes."""
        at_line = pc.starts_with(words, "\n")
        marked = pc.binary_join_element_wise(pc.if_else(at_line, "", " "), words, "")
        text = marked.buffers()[2].to_pybytes()
        upto = np.append(0, np.cumsum(pc.binary_length(marked).to_numpy(), dtype=np.int64))
        cuts = [*upto[:-1:LEARNT], upto[-1]]
        ids = np.concatenate([self._ids(text[a:b].decode()) for a, b in zip(cuts, cuts[1:])])
        ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), upto[1:]) + 1
        self.ends = np.append(self.ends, len(self.ids) + ends)
        self.ids = np.append(self.ids, ids)
        self.known = pa.concat_arrays([self.known, words])

    def places(self, words: pa.StringArray) -> np.ndarray:
        """Where each word is among those known, when all are."""
        at = pc.index_in(words, value_set=self.known)
        if not at.null_count:
            return at.to_numpy()
        coded = words.filter(at.is_null()).dictionary_encode()
        new = coded.dictionary
        at = at.fill_null(-1).to_numpy()
        missed = at < 0
        if len(self.known) + len(new) > self.remembered:
            used = np.flatnonzero(np.bincount(at[~missed], minlength=len(self.known)))
            back = np.zeros(len(self.known), at.dtype)
            back[used] = np.arange(len(used))
            at = np.where(missed, -1, back[at]) if len(used) else at
            self.keep(used)
        at = np.array(at)
        at[missed] = coded.indices.to_numpy() + len(self.known)
        self.learn(new)
        return at

    def encode_array(self, texts: pa.StringArray) -> list[np.ndarray]:
        """The ids of each text; null is empty."""
        texts = texts.cast(pa.string()).fill_null("")
        cut = plain(texts)
        for x in self.added:
            cut &= ~pc.match_substring(texts, x).to_numpy(zero_copy_only=False)
        # As words_of does: a line end before the text, whose token is left out again.
        marked = pc.replace_substring(texts.filter(pa.array(cut)), "\n", " \n")
        lists = pc.split_pattern(pc.binary_join_element_wise("\n", marked, ""), " ")
        places = self.places(lists.flatten())
        parts = self.strung(places, np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy())))
        return [next(parts) if c else self._ids(texts[k].as_py()) for k, c in enumerate(cut.tolist())]

    def strung(self, places: np.ndarray, borders: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of the words between each two borders, but for the very first id."""
        a = 0
        while a < len(borders) - 1:
            b = max(a + 1, int(np.searchsorted(borders, borders[a] + STRUNG, "right")) - 1)
            inner = borders[a : b + 1] - borders[a]
            part = places[borders[a] : borders[b]]
            starts = self.ends.take(part)
            lengths = self.ends[1:].take(part) - starts
            starts[inner[:-1]] += 1
            lengths[inner[:-1]] -= 1
            stops = np.append(0, np.cumsum(lengths))
            where = np.repeat(starts - stops[:-1], lengths)
            where += np.arange(len(where))
            ids, cuts = self.ids.take(where), stops[inner].tolist()
            yield from map(ids.__getitem__, map(slice, cuts, cuts[1:]))
            a = b

    def batches(self, texts: pa.StringArray) -> Iterator[np.ndarray]:
        """The ids of each text, some ``ARROW_TOGETHER`` bytes at a time."""
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
        a = 0
        while a < len(texts):
            before = int(sizes[a - 1]) if a else 0
            b = max(a + 1, int(np.searchsorted(sizes, before + ARROW_TOGETHER, "right")))
            yield from self.encode_array(texts.slice(a, b - a))
            a = b


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str | None = None, kind: type = Encoder) -> Encoder:
    """The worker's encoder for a vocabulary."""
    key = (path or tokenizer_path(), kind)
    if key not in _encoders:
        _encoders[key] = kind(key[0])
    return _encoders[key]


def crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())
