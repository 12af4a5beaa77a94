"""SentencePiece encoding that keeps, for every piece, the bytes of the source it came from."""

from __future__ import annotations

import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyhouse.llm.common import Recent, append_columns

BLANK = "▁"  # what stands for a space in pieces
CACHED_BYTES = 64 << 20  # of segments, ids and sizes with what Python objects take

FIELDS = [
    T.StructField("ids", T.ArrayType(T.IntegerType())),
    T.StructField("starts", T.ArrayType(T.IntegerType())),
    T.StructField("ends", T.ArrayType(T.IntegerType())),
    T.StructField("decoded", T.StringType()),
]


def _messages(raw: bytes):
    """Fields of a protocol message: number and value."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield key >> 3, raw[at : at + size]
            at += size


class CharacterMap:
    """Compiled character map: a double-array trie over source bytes, and the replacements.

    ``longest`` finds the longest rule that a byte string starts with at a place. An empty map has no
    rule, so that every character stands for itself.
    """

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.replacements = blob[4 + size :] if blob else b""

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest rule at ``at`` and its replacement; None without one."""
        if not self.units:
            return None
        units, found = self.units, None
        place = _offset(units[0])
        for k in range(at, len(source)):
            place ^= source[k]
            if place >= len(units) or (units[place] & 0x800000FF) != source[k]:
                break
            unit = units[place]
            place ^= _offset(unit)
            if unit & 0x100:  # a rule ends here; its value is the place of the replacement
                begin = units[place] & 0x7FFFFFFF
                found = (k + 1 - at, self.replacements[begin : self.replacements.index(b"\0", begin)])
        return found


def _offset(unit: int) -> int:
    return (unit >> 10) << ((unit & 0x200) >> 6)


class Normaliser:
    """Text to the form that pieces are cut from, with the source byte behind each of its bytes."""

    def __init__(self, spec: bytes):
        fields = dict(_messages(spec))
        self.map = CharacterMap(fields.get(2, b""))
        self.prefix = bool(fields.get(3, 1))
        self.trim = bool(fields.get(4, 1))
        self.escape = bool(fields.get(5, 1))
        self.plain = not self.map.units and self.prefix and not self.trim and self.escape

    def _replaced(self, source: bytes):
        at = 0
        while at < len(source):
            rule = self.map.longest(source, at)
            if rule:
                yield at, rule[0], rule[1]
                at += rule[0]
            else:
                lead = source[at]
                width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                yield at, width, source[at : at + width]
                at += width

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and one source place for each of them and for their end."""
        source = text.encode()
        blank = BLANK.encode() if self.escape else b" "
        out, places = bytearray(), []

        def put(raw: bytes, at: int, width: int) -> None:
            same = len(raw) == width
            out.extend(raw)
            places.extend(range(at, at + width) if same else [at] * len(raw))

        parts = list(self._replaced(source))
        if self.trim:
            while parts and parts[0][2] == b" ":
                parts.pop(0)
            while parts and parts[-1][2] == b" ":
                parts.pop()
        if parts and self.prefix:
            put(blank, parts[0][0], 0)
        last_blank = self.trim
        for at, width, raw in parts:
            for k in range(len(raw)) if b" " in raw else [-1]:
                if k < 0:
                    put(raw, at, width)
                    last_blank = False
                elif raw[k : k + 1] == b" ":
                    if not (self.trim and last_blank):
                        put(blank, at, 0)
                    last_blank = True
                else:
                    put(raw[k : k + 1], at, 0)
                    last_blank = False
        end = parts[-1][0] + parts[-1][1] if parts else 0
        return bytes(out), np.array([*places, end], np.int64)


class PieceEncoder:
    """Ids, source spans and decoded text, equal to the library's for whole texts.

    A segment is a run of spaces and what follows up to the next space. Where no piece of the model
    has a blank after another character, and the normaliser only escapes spaces, segments never
    interact: each distinct one is encoded once and kept (the last used, up to ``CACHED_BYTES``). Otherwise, for
    models without byte pieces, and for texts that hold the blank sign itself, whole texts are encoded.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        with open(path, "rb") as f:
            model = f.read()
        self.model = SentencePieceProcessor(model_proto=model)
        pieces, spec = [], b""
        for number, value in _messages(model):
            if number == 1:
                pieces.append(dict(_messages(value)))
            elif number == 3:
                spec = value
        names = [p[1].decode() for p in pieces]
        kinds = [p.get(3, 1) for p in pieces]
        self.normalise = Normaliser(spec)
        self.width = np.array([1 if k == 6 else len(n.encode()) for n, k in zip(names, kinds)], np.int64)
        self.opens = np.array([n.startswith(BLANK) for n in names])
        self.unknown = kinds.index(2)
        self.blank = names.index(BLANK) if BLANK in names else None
        free = not any(k == 4 or re.search(f"[^{BLANK}]{BLANK}", n) for n, k in zip(names, kinds))
        self.by_segment = self.normalise.plain and free and 6 in kinds and self.blank is not None
        self.segments = Recent(CACHED_BYTES)

    def _widths(self, ids: np.ndarray, text: str) -> np.ndarray:
        """Normalised bytes of each piece."""
        if not (ids == self.unknown).any():
            return self.width[ids]
        return np.array([len(p.encode()) for p in self.model.encode(text, out_type=str)], np.int64)

    def _whole(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = np.array(self.model.encode(text), np.int32)
        form, places = self.normalise(text)
        ends = np.cumsum(self._widths(ids, text))
        if len(ids) and ends[-1] != len(form):
            raise ValueError("pieces do not cover the normalised text")
        starts = np.concatenate([[0], ends[:-1]]) if len(ids) else ends
        return ids, places[starts].astype(np.int32), places[ends].astype(np.int32)

    def _keep(self, segment: bytes, ids: np.ndarray) -> None:
        """Store ids and the source bytes of each piece of a segment, which starts with a space."""
        form, places = self.normalise(segment[1:].decode())
        if segment == b" ":
            form, places = BLANK.encode(), np.array([0, 0, 0, 0])
        ends = np.cumsum(self.width[ids])
        at = places[np.concatenate([[0], ends])] + 1  # the space in front is the blank put in front
        at[0] = 0
        self.segments.put(segment, (ids.astype("<i4").tobytes(), np.diff(at).astype("<i4").tobytes()))

    def _learn(self, segments: list[bytes]) -> None:
        # After one space, all of a segment stands for itself in a plain normaliser.
        single = [s for s in segments if len(s) > 1 and s[1:2] != b" "]
        for a in range(0, len(single), 4096):
            part = single[a : a + 4096]
            ids = np.array(self.model.encode(b"".join(part).decode()[1:]), np.int32)
            cuts = np.flatnonzero(self.opens[ids])
            sizes = self.width[ids]
            sizes[cuts] += 1 - len(BLANK.encode())  # the sign in front is one space of the source
            ids, sizes = ids.astype("<i4").tobytes(), sizes.astype("<i4").tobytes()
            begins = (cuts * 4).tolist()
            for s, b, e in zip(part, begins, [*begins[1:], len(ids)], strict=True):
                self.segments.put(s, (ids[b:e], sizes[b:e]))
        for s in segments:
            if s not in self.segments.young:
                self._keep(s, np.array(self.model.encode(s[1:].decode()) or [self.blank], np.int32))

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per text: ids, and where each piece starts and ends in the UTF-8 bytes of the text."""
        raw = [b" " + t.encode() for t in texts]
        mark = BLANK.encode()
        cut = [re.findall(rb" +[^ ]*", r) if self.by_segment and t and mark not in r else None for r, t in zip(raw, texts)]
        self._learn(self.segments.missing(set().union(*[c for c in cut if c])))
        get = self.segments.young.__getitem__
        found = []
        for text, parts in zip(texts, cut):
            if parts is None:
                found.append(self._whole(text))
                continue
            kept = [get(p) for p in parts]
            ids = np.frombuffer(b"".join([k[0] for k in kept]), "<i4")
            sizes = np.frombuffer(b"".join([k[1] for k in kept]), "<i4")
            ends = np.cumsum(sizes, dtype=np.int32) - 1
            starts = ends - sizes
            starts[0] = 0
            found.append((ids, starts, ends))
        return found

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return [self.model.decode(x.tolist()) for x in ids]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate([*arrays, np.zeros(0, np.int32)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def encode_pieces(df: DataFrame, model: str, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """Add ``ids``, ``starts``, ``ends`` and ``decoded`` to every row, in one pass without a shuffle.

    ``starts`` and ``ends`` are the byte span of each piece in the UTF-8 source text: the blank put in
    front of a text has no source bytes, a byte piece has its own byte. Spans follow one another and
    cover the text. A missing or empty text has no pieces and decodes to the empty text. Columns that
    have the name of an added one are replaced; all others, rows and repeats stay.
    """

    def compute(texts: list[str]) -> list:
        e = encoder(model)
        found = e.encode(texts)
        ids = [f[0] for f in found]
        return [_lists(ids), _lists([f[1] for f in found]), _lists([f[2] for f in found]), e.decode(ids)]

    return append_columns(df, text, FIELDS, compute, drop)
