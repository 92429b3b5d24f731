"""Whole-text encoding with a public tokenizer, cached by word where the tokenizer allows it.

A tokenizer that drops white space and splits words, digits and symbol runs (its
stored normaliser, splitter and model options are compared when it is loaded)
never joins characters across ASCII white space, so a text's ids are the ids of
its white-space separated chunks in order.  Chunks are encoded once and kept in a
two-generation cache that is bounded in entries and bytes.  A new chunk of ASCII and precomposed Latin
letters, which normalisation leaves as they are but for case, is cut into the
splitter's letter runs, digits and symbol runs, whose ids come from the library's
model; any other chunk goes through the library's full pipeline.  With every
other tokenizer each whole text goes through the library.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Iterator, Sequence

import numpy as np

#: Entries per cache generation and bytes they take at most; two generations are kept of chunks and of runs.
CACHE_ENTRIES, CACHE_BYTES = 500_000, 1 << 27
#: Bytes of text split at a time.
PIECE = 1 << 18

# Printable ASCII but the apostrophe, which starts contractions, and Latin letters to U+017F but the dotted capital I.
_PLAIN = re.compile(r"[!-&(-~À-ÖØ-öø-įı-ſ]+")
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_PIECES = re.compile(r"[a-zß-öø-įı-ſ]+|[0-9]|[^a-z0-9ß-öø-įı-ſ]+")

# What a tokenizer states when its texts may be encoded chunk by chunk.
_CHUNKED = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "truncation": None,
    "padding": None,
}
_MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "ignore_merges": False}


def splits_at_white_space(stated: dict) -> bool:
    """Whether a tokenizer's stored form allows encoding by chunk, with special tokens that only ``<|`` can start."""
    added = stated["added_tokens"]
    return (
        all(stated[k] == v for k, v in _CHUNKED.items())
        and all(stated["model"][k] == v for k, v in _MODEL.items())
        and all(a["content"].startswith("<|") and not re.search(r"\s", a["content"]) and not a["lstrip"] and not a["rstrip"] and not a["single_word"] for a in added)
    )


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next from U+0100."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


_LETTERS = dict(enumerate(_byte_letters()))


class _Generations:
    """A dictionary that forgets its older half when full, by entries or by bytes; what takes kilobytes is not kept."""

    def __init__(self, entries: int):
        self.entries, self.bytes, self.new, self.old = entries, 0, {}, {}

    def get(self, key):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value: bytes) -> None:
        size = sys.getsizeof(key) + sys.getsizeof(value) + 100  # with its share of the table
        if size > CACHE_BYTES >> 14:
            return
        if len(self.new) >= self.entries or self.bytes + size > CACHE_BYTES:
            self.old, self.new, self.bytes = self.new, {}, 0
        self.new[key] = value
        self.bytes += size


def pieces(data: bytes) -> Iterator[bytes]:
    """A text cut at white space into pieces of about :data:`PIECE` bytes; only a chunk that is longer makes a longer one."""
    at = 0
    while len(data) - at > PIECE:
        found = _SPACE.search(data, at + PIECE)
        if found is None:
            break
        yield data[at : found.start()]
        at = found.end()
    yield data[at:] if at else data


class Encoder:
    """Ids of whole texts as little-endian arrays of the narrowest unsigned type."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self.dtype = np.dtype("<u2" if self._tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._code = "H" if self.dtype.itemsize == 2 else "I"
        self._chunked = splits_at_white_space(json.loads(self._tokenizer.to_str()))
        self._chunks, self._runs = _Generations(entries), _Generations(entries)

    def _pack(self, ids: list[int]) -> bytes:
        return array(self._code, ids).tobytes() if sys.byteorder == "little" else np.array(ids, dtype=self.dtype).tobytes()

    def _run(self, piece: str) -> bytes:
        ids = self._runs.get(piece)
        if ids is None:
            letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_LETTERS)
            ids = self._pack([t.id for t in self._model.tokenize(letters)])
            self._runs.put(piece, ids)
        return ids

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(self._run, _PIECES.findall(text.lower())))
        return self._pack(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, data: bytes) -> bytes:
        """Packed ids of one UTF-8 text."""
        if not self._chunked:
            return self._pack(self._tokenizer.encode(data.decode("utf-8", "replace"), add_special_tokens=False).ids)
        return b"".join(map(self._piece, pieces(data)))

    def _piece(self, data: bytes) -> bytes:
        chunks = data.split()
        cache = self._chunks
        parts = list(map(cache.new.get, chunks))
        if None in parts:
            for at, ids in enumerate(parts):
                if ids is None:
                    ids = cache.get(chunks[at])
                    if ids is None:
                        ids = self._chunk(chunks[at])
                        cache.put(chunks[at], ids)
                    parts[at] = ids
        return b"".join(parts)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a tokenizer file, kept across tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of an installed public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_all(texts: Sequence[bytes], path: str) -> list[bytes]:
    """Packed ids of each text."""
    return list(map(encoder(path).encode, texts))
