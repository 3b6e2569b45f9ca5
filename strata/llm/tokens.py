"""Token ids of whole texts, encoded word by word with a bounded cache.

The vocabulary file drops white space and never joins what white space parts,
so a text's ids are its words' ids in order, and each distinct word of a task
is encoded once. Words that are letters with plain trailing punctuation go to
the library's BPE model directly; every other word (digits, apostrophes,
special-token strings, unusual letters) goes through its whole pipeline.
``encode_text`` is the same as the library's ``encode`` of the whole text, and
``encode_texts`` does it for many texts at once, which the tests check.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DEFAULT_VOCABULARY = "word_bpe_49k.json"
# Bytes of words and ids that a task keeps; beyond it the cache starts anew.
CACHE_BYTES = 48 << 20
ENTRY_BYTES = 200  # a slot, a key's and a value's headers
LONGEST_CACHED = 256
TEXT_BYTES = 8 << 20  # of texts that are encoded at once
# Punctuation that the pre-tokenizer parts from the letters before it and that
# starts no special token.
_PLAIN = b'.,;:!?"()|#*$%&-'


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_VOCABULARY)

# The model spells a byte that prints as itself by itself, any other byte by the
# characters from 256 on, in order.
_PRINTS = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_ALPHABET = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTS)}


class WordEncoder(dict):
    """Maps a word (UTF-8 bytes without ASCII white space) to its ids.

    The ids are little-endian bytes of ``dtype``: two bytes each when the
    vocabulary has at most 65,536 entries, else four.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        super().__init__()
        self.tokenizer = Tokenizer.from_file(vocabulary)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.id_bytes = [i.to_bytes(self.dtype.itemsize, "little") for i in range(size)]
        self.cores: dict[bytes, bytes] = {}  # letters of a word
        self.tails: dict[bytes, bytes] = {}  # punctuation after them
        self.held = 0

    def forget(self) -> None:
        """Drop every kept word."""
        self.clear()
        self.cores.clear()
        self.tails.clear()
        self.held = 0

    def _keep(self, where: dict[bytes, bytes], word: bytes, ids: bytes) -> None:
        if len(word) <= LONGEST_CACHED:
            self.held += len(word) + len(ids) + ENTRY_BYTES
            where[word] = ids

    def _model_ids(self, part: str) -> bytes:
        """Ids of one pre-token in the model's byte alphabet."""
        return b"".join([self.id_bytes[t.id] for t in self.tokenizer.model.tokenize(part)])

    def _letters(self, core: bytes) -> bytes | None:
        """Ids of a word of plain letters; None for any other word."""
        text = core.decode("utf-8", "replace").lower()
        if not text.isalpha() or "\u03c3" in text or "\u03c2" in text:
            return None
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                return None
            text = text.encode().decode("latin-1").translate(_BYTE_ALPHABET)
        return self._model_ids(text)

    def _tail(self, tail: bytes) -> bytes:
        end = self.tails.get(tail)
        if end is None:
            end = self._model_ids(tail.decode())
            if len(tail) <= 8:
                self._keep(self.tails, tail, end)
        return end

    def _encode(self, word: bytes) -> bytes:
        core = word.rstrip(_PLAIN)
        found = self.cores.get(core)
        if found is None:
            found = self._letters(core)
            if found is None:
                return self._whole(word)
            if len(core) < len(word):  # else the word itself is kept
                self._keep(self.cores, core, found)
        return found if len(core) == len(word) else found + self._tail(word[len(core):])

    def _whole(self, word: bytes) -> bytes:
        """Ids of a word by the library's whole pipeline."""
        ids = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        return b"".join([self.id_bytes[i] for i in ids])

    def __missing__(self, word: bytes) -> bytes:
        if self.held > CACHE_BYTES:
            self.forget()
        found = self._encode(word)
        self._keep(self, word, found)
        return found

    def encode_text(self, text: bytes | None, end: int | None = None) -> bytes:
        """Ids of a whole text, and then ``end`` if given, as bytes."""
        body = b"".join(map(self.__getitem__, (text or b"").split()))
        return body if end is None else body + np.array([end], dtype=self.dtype).tobytes()

    def encode_texts(self, texts: pa.Array, end: int) -> pa.Array:
        """What ``encode_text`` gives for each binary of ``texts``.

        The texts' distinct words are looked up once, and words that differ in
        A-Z or in plain punctuation at their end share their letters' ids.
        """
        if not len(texts):
            return pa.array([], pa.binary())
        split = pc.ascii_split_whitespace(pc.fill_null(texts, b"").view(pa.string()))
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary
        core = pc.ascii_rtrim(distinct, characters=_PLAIN.decode())
        tail = pc.subtract(pc.binary_length(distinct), pc.binary_length(core)).to_numpy(zero_copy_only=False)
        core = pc.ascii_lower(core).dictionary_encode()
        letters = []
        for c in core.dictionary.view(pa.binary()).to_pylist():
            ids = self.cores.get(c)
            if ids is None:
                ids = self._letters(c)
                if ids is not None:
                    if self.held > CACHE_BYTES:
                        self.forget()
                    self._keep(self.cores, c, ids)
            letters.append(ids)
        found = [letters[i] for i in core.indices.to_pylist()]
        other = np.array([ids is None for ids in found], bool)
        at = np.flatnonzero((tail > 0) | other)
        for i, n, word in zip(at.tolist(), tail[at].tolist(), distinct.view(pa.binary()).take(at).to_pylist(),
                              strict=True):
            found[i] = self._whole(word) if found[i] is None else found[i] + self._tail(word[-n:])
        # the words of a text, then the end
        ends = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
        order = np.insert(words.indices.to_numpy(), ends, len(found))
        found.append(self.id_bytes[end])
        ids = pa.array(found, pa.binary()).take(pa.array(order))
        places = np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1, 4 * ids.offset)
        offsets = places[np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])]
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), ids.buffers()[2]])


def text_slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """A batch's rows in order, about ``most`` bytes of text at a time."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(size):
        done = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, done + most, "right")))
        yield batch.slice(at, to - at)
        at = to


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(vocabulary: str) -> WordEncoder:
    """The worker's encoder for a vocabulary file; the file stays loaded between tasks."""
    found = _ENCODERS.get(vocabulary)
    if found is None:
        found = _ENCODERS[vocabulary] = WordEncoder(vocabulary)
    return found


@contextmanager
def task_encoder(vocabulary: str) -> Iterator[WordEncoder]:
    """The worker's encoder for one task, whose words are dropped when it ends."""
    found = encoder(vocabulary)
    try:
        yield found
    finally:
        found.forget()
