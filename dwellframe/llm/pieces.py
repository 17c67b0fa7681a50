"""SentencePiece encoding with byte spans, and decoding.

Text is normalised here, by longest prefix through the model's compiled character map, while the source byte
of every normalised byte is kept. The normalised text is then cut into chunks at which no piece of the
vocabulary can span, each distinct chunk is merged into pieces once by the library, and every piece is
projected back to a range of bytes of the original text.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellframe.llm.common import map_texts

SPACE = "▁"
#: Chunks remembered in a worker; at the limit they are forgotten and met anew.
REMEMBERED = 400_000

FIELDS = [
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("starts", T.ArrayType(T.IntegerType())),
    T.StructField("ends", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType()),
]


class CharacterMap:
    """The compiled character map of a model: a double-array trie over UTF-8 bytes and its replacements."""

    def __init__(self, blob: bytes):
        self.units: list[int] = []
        if blob:
            size = struct.unpack_from("<I", blob)[0]
            self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
            self.texts = blob[4 + size :]
        self.seen: dict[str, tuple[int, bytes] | None] = {}

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes consumed, replacement) of the longest entry that starts at ``at``."""
        best, units = None, self.units
        if not units:
            return None
        jump = lambda unit: (unit >> 10) << ((unit & 0x200) >> 6)
        node = jump(units[0])
        for k in range(at, len(raw)):
            node ^= raw[k]
            if node >= len(units) or units[node] & 0x800000FF != raw[k]:
                break
            unit = units[node]
            node ^= jump(unit)
            if unit >> 8 & 1:
                start = units[node] & 0x7FFFFFFF
                best = (k + 1 - at, self.texts[start : self.texts.index(0, start)])
        return best


class Pieces:
    """A model: ``normalise`` text with alignment, ``encode`` to ids with byte spans, ``decode`` ids."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        with open(path, "rb") as f:
            self._load(f.read(), sentencepiece, pb)

    @classmethod
    def from_bytes(cls, blob: bytes) -> Pieces:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        made = cls.__new__(cls)
        made._load(blob, sentencepiece, pb)
        return made

    def _load(self, blob, sentencepiece, pb) -> None:
        model = pb.ModelProto.FromString(blob)
        self.spec = pb.NormalizerSpec.FromString(model.normalizer_spec.SerializeToString())
        self.suffix = model.trainer_spec.treat_whitespace_as_suffix
        self.fallback = model.trainer_spec.byte_fallback
        self.map = CharacterMap(self.spec.precompiled_charsmap)
        kind = pb.ModelProto.SentencePiece
        self.own = sorted((p.piece.encode() for p in model.pieces if p.type == kind.USER_DEFINED), key=len)[::-1]
        self.sizes = np.array([1 if p.type == kind.BYTE else len(p.piece.encode()) for p in model.pieces], np.int64)
        self.plain = not (self.map.units or self.spec.remove_extra_whitespaces or self.own or self.suffix) and self.spec.escape_whitespaces
        # no piece goes on past the end of a word: then blanks with the word after them are merged independently
        apart = not any(re.search(f"[^{SPACE}]{SPACE}", p.piece) for p in model.pieces)
        self.chunked = apart and self.fallback and self.spec.add_dummy_prefix and self.spec.escape_whitespaces and not self.suffix
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=blob)
        self.eos = self.whole.eos_id()
        plain = pb.ModelProto.FromString(blob)
        plain.normalizer_spec.precompiled_charsmap = b""
        plain.normalizer_spec.add_dummy_prefix = False
        plain.normalizer_spec.remove_extra_whitespaces = False
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=plain.SerializeToString())
        self.known: dict[str, int] = {}
        self.ids, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its byte boundaries, the byte offset in ``text``."""
        spec, raw = self.spec, text.encode()
        if not text:
            return "", np.zeros(1, np.int64)
        if self.plain:
            source, lead = np.frombuffer(raw, np.uint8), 3 * spec.add_dummy_prefix
            at = np.repeat(np.arange(len(source) + 1), np.append(np.where(source == 32, 3, 1), 1))
            return SPACE * spec.add_dummy_prefix + text.replace(" ", SPACE), np.concatenate([np.zeros(lead, np.int64), at])
        return self._mapped(raw)

    def _prefix(self, raw: bytes, at: int) -> tuple[int, bytes]:
        for own in self.own:
            if raw.startswith(own, at):
                return len(own), own
        if found := self.map.longest(raw, at):
            return found
        first = raw[at]
        size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return size, raw[at : at + size]

    def _mapped(self, raw: bytes) -> tuple[str, np.ndarray]:
        spec, blank = self.spec, SPACE.encode() if self.spec.escape_whitespaces else b" "
        out, at = bytearray(), []
        parts, place = [], 0
        while place < len(raw):
            size, made = self._prefix(raw, place)
            parts.append((place, size, made))
            place += size
        squeeze = spec.remove_extra_whitespaces
        if squeeze:
            lead = next((k for k, p in enumerate(parts) if p[2] != b" "), len(parts))
            parts = parts[lead:]
        if not parts:
            return "", np.full(1, len(raw), np.int64)

        def put(b: bytes, source: int) -> None:
            out.extend(b)
            at.extend([source] * len(b))

        if spec.add_dummy_prefix and not self.suffix:
            put(blank, parts[0][0])
        after_blank = squeeze
        for start, size, made in parts:
            while after_blank and made.startswith(b" "):
                made = made[1:]
            if not made:
                continue
            whole = made == raw[start : start + size]
            for k, b in enumerate(made):
                put(blank if b == 32 else bytes([b]), start + k if whole else start)
            after_blank = squeeze and made.endswith(b" ")
        end = len(raw)
        if squeeze:
            while out.endswith(blank):
                end = at[-len(blank)]
                del out[-len(blank) :], at[-len(blank) :]
        if spec.add_dummy_prefix and self.suffix:
            put(blank, end)
        return out.decode(), np.array([*at, end], np.int64)

    def _learn(self, keys: list[str]) -> None:
        """Merge the chunks that are not known yet, many at a call: a chunk is a blank and its key."""
        known = self.known
        fresh = [k for k in dict.fromkeys(keys) if k not in known]
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
            self.ids, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)
            fresh = list(dict.fromkeys(keys))
        parts, counts = [], []
        blank = [k for k in fresh if not k.strip(SPACE)]  # runs of blanks alone would join the next chunk
        words = [k for k in fresh if k.strip(SPACE)]
        for k in blank:
            parts.append(np.array(self.merger.encode(SPACE + k), np.int32))
            counts.append(np.array([len(parts[-1])]))
        for i in range(0, len(words), 1000):
            some = words[i : i + 1000]
            ids = np.array(self.merger.encode(SPACE + SPACE.join(some)), np.int32)
            ends = np.cumsum([3 + len(k.encode()) for k in some])
            last = np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1
            parts.append(ids)
            counts.append(np.diff(last, prepend=0))
        for k in (*blank, *words):
            known[k] = len(known)
        if fresh:
            self.ids = np.concatenate([self.ids, *parts])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.concatenate(counts))])

    def _keys(self, text: str, made: str) -> list[str]:
        """The chunks of the normalised text without their first blank."""
        if self.plain and SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [c[1:] for c in re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", made)]

    def encode_batch(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, starts, ends) of each text; see ``encode``."""
        normal = [self.normalise(t) for t in texts]
        if not self.chunked:
            return [self._direct(made, at) for made, at in normal]
        keys = [self._keys(t, made) if made else [] for t, (made, _) in zip(texts, normal, strict=True)]
        flat = [k for ks in keys for k in ks]
        self._learn(flat)
        place = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        first, n = self.first[place], self.first[place + 1] - self.first[place]
        after = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.repeat(first - after[:-1], n) + np.arange(after[-1])] if len(flat) else np.zeros(0, np.int32)
        stops = after[np.cumsum([0, *map(len, keys)])]
        out = []
        for a, b, (_, at) in zip(stops[:-1], stops[1:], normal, strict=True):
            own = ids[a:b]
            ends = np.cumsum(self.sizes[own])
            out.append((own, at[ends - self.sizes[own]], at[ends]))
        return out

    def _direct(self, made: str, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Without chunks; unknown characters have no piece of their own length, so the library tells it."""
        if self.fallback:
            ids = np.array(self.merger.encode(made), np.int32)
            n = self.sizes[ids]
        else:
            found = self.merger.encode(made, return_type="proto").pieces
            ids = np.array([p.id for p in found], np.int32)
            n = np.array([len(p.surface.encode()) for p in found], np.int64)
        ends = np.cumsum(n).astype(np.int64)
        return ids, at[ends - n], at[ends]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, ends): a piece's bytes in the original text are ``[start, end)``."""
        return self.encode_batch([text])[0]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.whole.decode(ids, num_threads=1)


_models: dict[str, Pieces] = {}


def model(path: str) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def encode_texts(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, ``ids`` (end id last), ``starts`` and ``ends`` (bytes of the text) and ``decoded``.

    Row by row: null texts count as empty and give the end id alone, with an empty span; a null id stays
    null; repeated rows are encoded each; other columns are ignored; texts of any length are read whole.
    """

    def make():
        own = model(path)

        def work(texts):
            texts = [t or "" for t in texts]
            ids, starts, ends = [], [], []
            for text, (i, s, e) in zip(texts, own.encode_batch(texts), strict=True):
                size = len(text.encode())
                ids.append(np.append(i, np.int32(own.eos)))
                starts.append(np.append(s, size))
                ends.append(np.append(e, size))
            return [_lists(ids), _lists(starts), _lists(ends), own.decode([i.tolist() for i in ids])]

        return work

    return map_texts(docs, make, FIELDS, keep=keep)


def decode_ids(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the decoded text of the ids in ``out``; null ids give null."""

    @F.pandas_udf(T.StringType())
    def decode(column):
        texts = iter(model(path).decode([list(map(int, i)) for i in column if i is not None]))
        return column.map(lambda i: None if i is None else next(texts))

    return encoded.withColumn(out, decode(ids))


def sha256_of_ids(ids: str) -> Column:
    return F.sha2(F.concat_ws(" ", F.col(ids).cast("array<string>")), 256)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and n_bytes, the length that the spans cover."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), sha256_of_ids("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), F.element_at("ends", -1).cast("long").alias("n_bytes"),
    )
