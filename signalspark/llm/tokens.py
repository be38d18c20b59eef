"""Exact, memoised encoding of whole texts with the tokenizers library.

Both public vocabularies here split a text before they merge: a pre-token never
spans certain cuts, so ``ids(text)`` is the concatenation of the ids of its
chunks. Each distinct chunk is encoded once per worker and then looked up; the
tests hold this against direct encoding.

* ``words``: vocabularies that drop white space. Cuts at ASCII white space.
* ``spaces``: byte-level vocabularies, whose pre-tokens take one leading space.
  Cuts before a space that follows a visible character, and around a line break
  between two visible characters.

The memos are bounded dictionaries per Python worker. One that reaches its limit becomes
the older of two generations, from which what is met again is carried over; what is lost
then costs time and never changes a result. Runs of letters have the larger memo: a run
that is not there costs a call of the library, a chunk only a look at its parts.
"""

from __future__ import annotations

import gc
import os
import re
import sys
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

#: entries of one generation: chunks, runs of letters
MEMO, LETTERS = 300_000, 500_000
#: one run of Latin letters and the ASCII punctuation after it: two pre-tokens in both vocabularies
_SIMPLE = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-/:-@\[-`{-~]*)").fullmatch
#: bytes that may belong to white space other than a space or a line break
_ODD = bytes({*range(0x20), 0x7F, 0xC2, 0xE1, 0xE2, 0xE3} - {0x0A})
_PLAIN = bytes(sorted({*range(256)} - {*_ODD}))
_SURE = re.compile(rb"(?:[!-~]|[\xc3-\xdf][\x80-\xbf])\Z")
_LINE = re.compile(rb"((?:[!-~]|[\xc3-\xdf][\x80-\xbf])\n)(?=[!-~]|[\xc3-\xdf])")


class Encoder:
    """Ids of whole texts as little-endian uint32 bytes.

    In byte-level vocabularies a chunk that starts with a line break stands for itself and
    any other for a space and itself; a text starts as if a line break came before it.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._lib = Tokenizer.from_file(path)
        self._words = self._lib.normalizer is not None
        self._lead = b"" if self._words else b" "
        self._memo: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}
        self._letters: dict[bytes, bytes] = {}  # with the leading space, if any
        self._old_letters: dict[bytes, bytes] = {}
        self._bare: dict[bytes, bytes] = {}
        self._break = b"" if self._words else self.direct("\n")
        self._between = " . " if self._words else "\n"  # one id, that no run of letters has
        self._mark = array("I", self.direct(self._between.strip(" ")))

    def direct(self, text: str) -> bytes:
        return array("I", self._lib.encode(text, add_special_tokens=False).ids).tobytes()

    def _plain(self, text: bytes) -> bytes | None:
        """The text with a blank at each cut; None if its white space needs care."""
        if self._words:
            return text
        if (text.translate(None, _PLAIN) or b"  " in text or b"\n " in text or b" \n" in text
                or b"\n\n" in text or text[:1] in (b" ", b"\n", b"")):
            return None
        return b"\n" + text.replace(b"\n", b" \n")

    def _careful(self, text: bytes) -> bytes:
        """Ids of a byte-level text with any white space, cut only where that is surely allowed."""
        parts = text.split(b" ")
        out, lead, last = [], b"", parts[0]
        for p in parts[1:]:
            if _SURE.search(last):
                out.append(self._lines(last, lead))
                lead, last = b" ", p
            else:
                last += b" " + p
        return b"".join([*out, self._lines(last, lead)])

    def _encode(self, pieces: list[bytes], into: dict[bytes, bytes], lead: bytes) -> None:
        for i in range(0, len(pieces), 4096):
            some = pieces[i:i + 4096]
            texts = [(lead + p).decode() for p in some]
            for p, e in zip(some, self._lib.encode_batch_fast(texts, add_special_tokens=False)):
                into[p] = array("I", e.ids).tobytes()

    def _encode_letters(self, runs: list[bytes]) -> None:
        """Encode runs of letters many at a time, as one text with a mark between them."""
        for i in range(0, len(runs), 4096):
            some = runs[i:i + 4096]
            text = self._between.join([(self._lead + p).decode() for p in some])
            ids = np.array(self._lib.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(ids == self._mark[0])
            if len(self._mark) != 1 or len(ends) != len(some) - 1:
                self._encode(some, self._letters, self._lead)
                continue
            raw, at = ids.tobytes(), 0
            for p, end in zip(some, [*(4 * ends).tolist(), len(ids) * 4]):
                self._letters[p] = raw[at:end]
                at = end + 4

    def _learn(self, chunks: set[bytes]) -> None:
        if len(self._letters) > LETTERS:
            self._old_letters, self._letters = self._letters, {}
        if len(self._bare) > MEMO:
            self._bare.clear()
        memo, old, letters, bare, words = self._memo, self._old, self._letters, self._bare, self._words
        old_letters = self._old_letters
        later, new, bare_new, whole = [], set(), set(), []
        for c in chunks:
            ids = old.get(c)
            if ids is None:
                line = c[:1] == b"\n" and not words  # a line break, then no space
                if (m := _SIMPLE(c[1:] if line else c)) is None:
                    whole.append(c)
                    continue
                a, b = m.groups()
                if words:
                    a = a.lower()
                ids = (bare if line else letters).get(a)
                if ids is None and not line and (ids := old_letters.get(a)) is not None:
                    letters[a] = ids
                if b and ids is not None:
                    ids = ids + bare[b] if b in bare else None
                if ids is None:
                    later.append((c, a, b, line))
                    (bare_new if line else new).add(a)
                    if b:
                        bare_new.add(b)
                    continue
                if line:
                    ids = self._break + ids
            memo[c] = ids
        self._encode_letters([x for x in new if x not in letters])
        self._encode([x for x in bare_new if x not in bare], bare, b"")
        for c, a, b, line in later:
            ids = self._break + bare[a] if line else letters[a]
            memo[c] = ids + bare[b] if b else ids
        self._encode([c for c in whole if c[:1] != b"\n" or words], memo, self._lead)
        for c in whole:
            if c[:1] == b"\n" and not words:
                memo[c] = self._break + self.direct(c[1:].decode())

    def _lines(self, chunk: bytes, lead: bytes) -> bytes:
        """Ids of a chunk that may span line breaks."""
        parts = _LINE.sub(rb"\1\0", chunk).split(b"\n\0") if b"\0" not in chunk else [chunk]
        return b"".join([self._piece(b"\n", b"") * (i > 0) + self._piece(p, b"" if i else lead)
                         for i, p in enumerate(parts)])

    def _piece(self, p: bytes, lead: bytes) -> bytes:
        """Ids of a piece without an inner cut."""
        if lead:
            if p in self._letters:
                return self._letters[p]
            if (m := _SIMPLE(p)) and m[1] in self._letters and m[2] in self._bare:
                return self._letters[m[1]] + self._bare[m[2]]
            return self.direct((lead + p).decode())
        if (m := _SIMPLE(p)) and m[2]:
            return self._piece(m[1], b"") + self._piece(m[2], b"")
        if p not in self._bare:
            self._bare[p] = self.direct(p.decode())
        return self._bare[p]

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, given in UTF-8; every distinct chunk of them is looked up once."""
        if len(self._memo) > MEMO:
            self._old, self._memo = self._memo, {}
        memo = self._memo
        plain = [self._plain(t) for t in texts]
        column = pa.array([p for p in plain if p is not None], pa.large_binary()).cast(pa.large_string())
        compute = pa.compute
        cut = compute.ascii_split_whitespace(column) if self._words else compute.split_pattern(column, pattern=" ")
        chunks = cut.flatten().cast(pa.large_binary()).dictionary_encode()
        names = chunks.dictionary.to_pylist()
        if new := {c for c in names if c not in memo}:
            gc.disable()  # many small tuples, no cycles
            try:
                self._learn(new)
            finally:
                gc.enable()
        ids = pa.array([memo[c] for c in names], pa.large_binary()).take(chunks.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, 8 * ids.offset)[cut.offsets.to_numpy()].tolist()
        data, skip = memoryview(ids.buffers()[2] or b""), len(self._break)
        found = (bytes(data[a + skip:b]) for a, b in zip(ends, ends[1:]))
        return [self._careful(t) if p is None else next(found) for t, p in zip(texts, plain)]


if sys.byteorder != "little" or array("I").itemsize != 4:  # ids are written as little-endian uint32
    raise ImportError("a little-endian platform with 4-byte unsigned ints is needed")

_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget_encoders() -> None:
    """Free this worker's memo; stages that do not encode call it, since workers outlive a stage."""
    _encoders.clear()


def small_batches(batch: pa.RecordBatch, column: str, limit: int = 1 << 20):
    """Slices of a batch whose text column holds about ``limit`` bytes each."""
    col = batch.column(column)
    sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < batch.num_rows:
        n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), limit, side="right")))
        yield batch.slice(at, n)
        at += n
