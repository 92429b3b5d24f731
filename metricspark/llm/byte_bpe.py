"""Byte-level BPE encoding and decoding through a sentencepiece model made from a rank file.

The vocabulary becomes a sentencepiece BPE model as it stands: every byte of a
piece is one character, a piece's score is its negative rank and normalisation is
the identity, so sentencepiece merges the pair of least rank first, as the rank
file means it.  Texts are cut by the stated pattern; each pre-token is looked up
whole, else encoded by the model, and cached.  Ids decode by the inverse byte
mapping.

The model is bytes of the vocabulary's size, made once on the driver and sent to
the tasks; texts are worked on one by one and nothing is shuffled.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate, chain, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricspark.llm.textops import slices
from metricspark.llm.tokens import public_tokenizer

#: Pre-tokens cached per generation (two are kept); pre-tokens of a long text held at a time, and the characters from which it is long.
CACHE_ENTRIES, BLOCK, LONG = 400_000, 1 << 16, 1 << 20
#: The character that stands for byte 0; the other bytes follow.  None of them is a space for sentencepiece.
FIRST_LETTER = 0x100
_LETTERS = {b: FIRST_LETTER + b for b in range(256)}
_STAND_IN = 0x2603  # neither letter, number nor space in any version of Unicode


def read_ranks(path: str) -> dict[bytes, int]:
    """Pieces and ranks of a rank file (base64 and rank in each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, filter(bytes.strip, f))}


def _packed_each(ids: Iterable[int]) -> list[bytes]:
    """Each id as four bytes, as the cache keeps ids."""
    packed = np.fromiter(ids, dtype=np.uint32).tobytes()
    return [packed[at : at + 4] for at in range(0, len(packed), 4)]


def _letters(piece: bytes) -> str:
    return piece.decode("latin-1").translate(_LETTERS)


@dataclass(frozen=True)
class Vocabulary:
    """What a task needs: the serialised model, the rank of each of its pieces, the pattern and the code points it must not take for letters or numbers."""

    model: bytes
    ranks: tuple[int, ...]
    pattern: str
    unassigned: tuple[int, ...]


def serialise(ranks: Mapping[bytes, int]) -> bytes:
    """A sentencepiece BPE model of the pieces in rank order; the unknown piece comes last.

    A vocabulary without one of the 256 bytes cannot encode every text and is an
    error.
    """
    from sentencepiece import sentencepiece_model_pb2 as pb

    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the vocabulary lacks single bytes")
    model = pb.ModelProto()
    for piece, rank in sorted(ranks.items(), key=lambda x: x[1]):
        model.pieces.add(piece=_letters(piece), score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    model.trainer_spec.model_type = pb.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(model.pieces)
    model.trainer_spec.unk_id = len(model.pieces) - 1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


def unassigned_letters(pattern: str) -> tuple[int, ...]:
    """Code points that the pattern module knows as letters or numbers and tiktoken, of an older Unicode, does not.

    Only code points that Python's own tables lack can differ; each is tried
    behind a letter and a digit with a vocabulary that holds those pairs whole.
    """
    import regex
    import tiktoken

    newer = [c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]
    newer = [ord(c) for c in regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, newer)))]
    ranks = {bytes([b]): b for b in range(256)}
    for c in newer:
        for before in "a1":
            ranks[(before + chr(c)).encode()] = len(ranks)
    library = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return tuple(c for c in newer if all(len(library.encode_ordinary(before + chr(c))) > 1 for before in "a1"))


def vocabulary(path: str | None = None, pattern: str | None = None) -> Vocabulary:
    """The model of a rank file and a pattern; by default those of the installed multilingual vocabulary."""
    import public_tokenizers

    pattern = pattern or public_tokenizers.PATTERN
    ranks = read_ranks(path or public_tokenizer("byte_bpe_multi_50k.tiktoken"))
    return Vocabulary(serialise(ranks), tuple(sorted(ranks.values())), pattern, unassigned_letters(pattern))


class ByteBpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, stated: Vocabulary, entries: int = CACHE_ENTRIES):
        import regex
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_proto=stated.model)
        self._pattern = regex.compile(stated.pattern)
        self._hidden = dict.fromkeys(stated.unassigned, _STAND_IN)
        self._least_hidden = min((chr(c).encode()[0] for c in stated.unassigned), default=256)
        pieces = [bytes(ord(c) - FIRST_LETTER for c in self._model.id_to_piece(i)) for i in range(len(stated.ranks))]
        self._ranks, self._pieces = np.array(stated.ranks, dtype=np.int64), pa.array(pieces, pa.binary())
        self._gapless = stated.ranks == tuple(range(len(stated.ranks)))
        self._whole = dict(zip(pieces, _packed_each(stated.ranks), strict=True))
        self._entries, self._new, self._old = entries, {}, {}

    def _blocks(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text, as tiktoken cuts it, in lists of bounded length."""
        cut = text
        if self._hidden and (np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8) >= self._least_hidden).any():
            cut = text.translate(self._hidden)
        if cut is text and len(text) < LONG:
            yield self._pattern.findall(text)
            return
        spans = (text[m.start() : m.end()] for m in self._pattern.finditer(cut))
        while block := list(islice(spans, BLOCK)):
            yield block

    def _learn(self, tokens: set[str]) -> None:
        """Have pre-tokens in the newer half of the cache: those that are pieces as they stand, the others by the model."""
        if len(self._new) + len(tokens) > self._entries:
            self._old, self._new = self._new, {}
        known = {t: p for t in tokens if (p := self._old.get(t)) is not None}
        self._new.update(known)
        rest, spelled = [], []
        for token in tokens - known.keys() if known else tokens:
            piece = token.encode("utf-8", "replace")
            packed = self._whole.get(piece)
            if packed is None:
                rest.append(token)
                spelled.append(_letters(piece))
            else:
                self._new[token] = packed
        if rest:
            merged = self._model.encode(spelled, num_threads=1)
            packed = self._ranks[np.fromiter(chain.from_iterable(merged), dtype=np.int64)].astype(np.uint32).tobytes()
            ends = accumulate((4 * len(ids) for ids in merged), initial=0)
            self._new.update((t, packed[start:end]) for t, (start, end) in zip(rest, pairwise(ends), strict=True))

    def _packed(self, block: list[str]) -> list[bytes]:
        packed = list(map(self._new.get, block))
        if missing := [at for at, p in enumerate(packed) if p is None]:
            self._learn({block[at] for at in missing})
            for at in missing:
                packed[at] = self._new[block[at]]
        return packed

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, special tokens taken as text."""
        return np.frombuffer(b"".join(b"".join(self._packed(block)) for block in self._blocks(text)), dtype=np.uint32).astype(np.int32)

    def encode_all(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        """Ids of each text; the new pre-tokens of short texts go to the model together."""
        at = 0
        while at < len(texts):
            end, size = at + 1, len(texts[at])
            while end < len(texts) and size + len(texts[end]) < LONG:
                size += len(texts[end])
                end += 1
            if end - at == 1:
                yield self.encode(texts[at])
            else:
                tokens, ends = [], [0]
                for text in texts[at:end]:
                    tokens.extend(chain.from_iterable(self._blocks(text)))
                    ends.append(len(tokens))
                packed = self._packed(tokens)
                for start, stop in pairwise(ends):
                    yield np.frombuffer(b"".join(packed[start:stop]), dtype=np.uint32).astype(np.int32)
            at = end

    def decode(self, ids: Sequence[int]) -> bytes:
        """Bytes that the ids stand for; an id outside the vocabulary is an error."""
        return self.decode_all(pa.array([ids], pa.list_(pa.int32())))[0].as_py()

    def decode_all(self, ids: pa.ListArray) -> pa.BinaryArray:
        """Bytes of each list of ids, null for null; ids and bytes stay in Arrow and are no Python objects."""
        flat = ids.flatten()
        if flat.null_count:
            raise ValueError("an id is null")
        flat = flat.to_numpy()
        at = np.clip(flat if self._gapless else np.searchsorted(self._ranks, flat), 0, len(self._ranks) - 1)
        if (wrong := self._ranks[at] != flat).any():
            raise KeyError(int(flat[wrong][0]))
        ends = np.cumsum(np.append(0, pc.fill_null(ids.value_lengths(), 0)), dtype=np.int32)
        listed = pa.ListArray.from_arrays(pa.array(ends), self._pieces.take(pa.array(at)), mask=ids.is_null())
        return pc.binary_join(listed, b"")


_ready: dict[Vocabulary, ByteBpe] = {}


def _codec(stated: Vocabulary) -> ByteBpe:
    if stated not in _ready:
        _ready.clear()  # a worker serves one vocabulary at a time
        _ready[stated] = ByteBpe(stated)
    return _ready[stated]


def _encode_batches(stated):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(stated.value)
        for batch in slices(batches, 128):
            ids = list(codec.encode_all([t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]))
            offsets = np.cumsum([0] + [len(x) for x in ids], dtype=np.int32)
            values = np.concatenate(ids) if ids else np.empty(0, dtype=np.int32)
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], listed], [*batch.schema.names[:-1], "ids"])

    return run


def _decode_batches(stated):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(stated.value)
        for batch in slices(batches, 128):
            decoded = codec.decode_all(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, "decoded"])

    return run


def encode(df: DataFrame, stated: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids``: the ids of every whole text.

    One row comes out for each row, repeated and null ids included.  A null or
    empty text has no ids.  Other columns are ignored, whatever their names.
    """
    sent = df.sparkSession.sparkContext.broadcast(stated)
    rows = df.select(F.col(id_col), F.col(text_col).alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(_encode_batches(sent), f"`{id_col}` {kind}, ids array<int>")


def decode(df: DataFrame, stated: Vocabulary, ids_col: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the bytes of their ids; null ids decode to null."""
    sent = df.sparkSession.sparkContext.broadcast(stated)
    rows = df.select(*[c for c in df.columns if c not in (ids_col, "decoded")], F.col(ids_col).cast("array<int>").alias("ids"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(_decode_batches(sent), f"{fields}, decoded binary")


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` of decoded rows."""
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return decoded.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
