"""Token ids as length-delimited binary records, with a separate index of offsets.

A record is what common record readers expect: eight bytes of length, the masked CRC-32C of those
eight bytes, the payload, and the masked CRC-32C of the payload, all little-endian. The payload is the
number of ids (four bytes) and the ids, two bytes each where the vocabulary allows it, else four.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import SLICE_BYTES, Recent, filesystem, slices, sums_before, text_of
from tallyhouse.sources.staging import new_path

# CRC-32C (Castagnoli), reflected, and the mask that record files put on it: fixed values.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8

ROW = 256  # bytes of one row when checksums are computed side by side
READ_BYTES = 16 << 20
CACHED_WORDS = 1_000_000
CACHED_BYTES = 256 << 20  # of known words, and a quarter of it of their parts, with what Python objects take

# Fixed value: how the given tokenizer cuts words into parts before it looks for pairs.
CUT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# The steps of the given tokenizer before it cuts, and after.
FORMS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
BYTES = [{"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
# Latin letters beyond ASCII, U+00C0 to U+024F in UTF-8, without the two signs among them and the capital I with a
# dot, whose lower-case form has two characters.
LATIN = rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|[\xc5-\xc8][\x80-\xbf]|\xc9[\x80-\x8f]"
# Kinds of bytes in words. Those of letters, digits and marks make up the plain words: printable ASCII without an
# apostrophe and the letters above. Where a tokenizer cuts as above, the parts of a plain word are its runs of one
# kind, and its single digits.
OTHER, SPACE, LETTER, DIGIT, MARK = range(5)
CLASSES = {SPACE: rb"[ \t-\r]", LETTER: rb"[A-Za-z]", DIGIT: rb"[0-9]", MARK: rb"[!-&(-/:-@\[-`{-~]"}
KINDS = bytes(next((k for k, c in CLASSES.items() if re.match(c, bytes([b]))), OTHER) for b in range(256))
SPACED = bytes(SPACE if k == SPACE else OTHER for k in KINDS)
LEADS = np.array([0xC3 <= b <= 0xC9 for b in range(256)])
LATIN_PAIR = np.array([[bool(re.fullmatch(LATIN, bytes([a, b]))) for b in range(256)] for a in range(256)])

INDEX_SCHEMA = (
    "doc_id long, part long, ordinal long, file string, offset long, length long, tokens_before long, n_tokens long"
)
DIGEST_SCHEMA = "doc_id long, part long, ordinal long, tokens_before long, n_tokens long, ids_crc32 long"


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


TABLE = _byte_table()


def _shift_tables(n: int) -> np.ndarray:
    """Four tables that carry a checksum over ``n`` bytes that follow."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(n):
        bits = TABLE[bits & 255] ^ (bits >> 8)
    values = np.arange(256)
    return np.stack([
        np.bitwise_xor.reduce(np.where((values[:, None] >> np.arange(8)) & 1, bits[8 * k : 8 * k + 8], 0), axis=1)
        for k in range(4)
    ]).astype(np.uint32)


SHIFT = _shift_tables(ROW)


def crc32c(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of every part (each of four bytes or more), worked out side by side."""
    if not parts:
        return np.zeros(0, np.uint32)
    sizes = np.array([len(p) for p in parts])
    rows = -(-sizes // ROW)
    first = np.concatenate([[0], np.cumsum(rows)])
    grid = np.zeros(int(first[-1]) * ROW, np.uint8)
    for p, end in zip(parts, first[1:] * ROW):
        grid[end - len(p) : end] = np.frombuffer(p, np.uint8)  # zeros in front change nothing
    for k in range(4):  # the start value, all ones, is the first four bytes inverted
        grid[first[1:] * ROW - sizes + k] ^= 255
    columns = np.ascontiguousarray(grid.reshape(-1, ROW).T)
    each = np.zeros(columns.shape[1], np.uint32)
    for column in columns:
        each = TABLE[(each ^ column) & 255] ^ (each >> 8)
    total = np.zeros(len(parts), np.uint32)
    left = np.arange(len(parts))
    for k in range(int(rows.max())):
        left = left[rows[left] > k]
        c = total[left]
        c = SHIFT[0][c & 255] ^ SHIFT[1][(c >> 8) & 255] ^ SHIFT[2][(c >> 16) & 255] ^ SHIFT[3][c >> 24]
        total[left] = c ^ each[first[left] + k]
    return ~total


def masked(crc: np.ndarray) -> np.ndarray:
    return (((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)).astype(np.uint32)


def kinds_of(data: bytes) -> np.ndarray:
    """The kind of each byte of UTF-8 text that ends with a white space."""
    kinds, values = np.frombuffer(bytearray(data.translate(KINDS)), np.uint8), np.frombuffer(data, np.uint8)
    lead = np.flatnonzero(LEADS[values])
    lead = lead[LATIN_PAIR[values[lead], values[lead + 1]]]
    kinds[lead] = kinds[lead + 1] = LETTER
    return kinds


def strings(values: pa.Array) -> list[bytes]:
    """The values of a large_binary array (an object of Arrow's for each would take longer than the words do)."""
    raw = (values.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    bounds = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1].tolist()
    return [raw[b:e] for b, e in zip(bounds, bounds[1:])]


def runs_of(data: bytes, kinds: np.ndarray) -> tuple[np.ndarray, pa.Array, list[bytes]]:
    """Where runs of one kind and single digits begin, their numbers, and the distinct runs; white space is left out."""
    cut = kinds == DIGIT
    cut[1:] |= kinds[1:] != kinds[:-1]
    cut[0] = True
    begins = np.flatnonzero(cut)
    bounds = pa.py_buffer(np.append(begins, len(data)))
    runs = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, bounds, pa.py_buffer(data)])
    kept = kinds[begins] != SPACE
    runs = runs.filter(pa.array(kept)).dictionary_encode()
    return begins[kept], runs.indices, strings(runs.dictionary)


def joined(ids: list[bytes], numbers: pa.Array, begins: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The ids of runs, joined for each stretch of text up to the next of the ``ends``."""
    values = pa.array(ids, pa.large_binary()).take(numbers)
    raw = (values.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    cuts = np.frombuffer(values.buffers()[1], np.int64)[np.searchsorted(begins, ends)].tolist()
    return [raw[b:e] for b, e in zip([0, *cuts], cuts)]


class WordEncoder:
    """Ids of texts from a tokenizer file, equal to the library's encoding of the whole text.

    Where the tokenizer drops white space and so never joins words, each distinct word is encoded
    once and its ids are kept (the last used, up to ``CACHED_WORDS`` and ``CACHED_BYTES``). Where it lower-cases and
    cuts words in the known way, a new word of plain characters is put together from its parts: those are far fewer,
    since marks around a word make no other part. Words and parts are cut and numbered in Arrow, so that Python looks
    up each distinct one once a slice. Other tokenizers, and texts that hold a special token, are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            plan = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t["content"].encode() for t in plan.get("added_tokens", [])]
        first = ((plan.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        collapses = any(
            n.get("type") == "Replace" and n.get("pattern") == {"Regex": r"\s+"}
            for n in (plan.get("normalizer") or {}).get("normalizers", [])
        )
        drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
        self.by_word = bool(self.special and collapses and drops)
        lowers = any(n.get("type") == "Lowercase" for n in (plan.get("normalizer") or {}).get("normalizers", []))
        self.by_part = self.by_word and lowers and first.get("pattern") == {"Regex": CUT}
        self.merger = self.tokenizer
        if self.by_part and plan["normalizer"]["normalizers"] == FORMS and plan["pre_tokenizer"]["pretokenizers"][1:] == BYTES:
            # Parts are in the composed form, without white space, and cut: of the steps around the model two are left.
            self.merger = Tokenizer(self.tokenizer.model)
            self.merger.normalizer = normalizers.Lowercase()
            self.merger.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            )
        self.words, self.parts = Recent(CACHED_BYTES, CACHED_WORDS), Recent(CACHED_BYTES // 4, CACHED_WORDS)
        suffix = plan["model"].get("end_of_word_suffix") or "\0"
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[i for t, i in names.items() if t.endswith(suffix)]] = True

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _ask(self, words: list[bytes], known: Recent) -> None:
        """Have the library encode new words, with a special token between them."""
        separator = self.special[0].decode()
        mark = self.tokenizer.token_to_id(separator)
        size = self.dtype.itemsize
        for a in range(0, len(words), 4096):
            part = words[a : a + 4096]
            joined = separator.join(w.decode() for w in part)
            ids = np.array(self.tokenizer.encode(joined, add_special_tokens=False).ids, self.dtype)
            cuts = np.flatnonzero(ids == mark) * size
            raw = ids.tobytes()
            begins = [0, *(cuts + size).tolist()]
            for w, b, e in zip(part, begins, [*cuts.tolist(), len(raw)], strict=True):
                known.put(w, raw[b:e])

    def _ask_parts(self, parts: list[bytes]) -> None:
        """Parts end with the only token of theirs that ends a word, so that a space between them will do."""
        size = self.dtype.itemsize
        for a in range(0, len(parts), 512):
            some = parts[a : a + 512]
            found = self.merger.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0].ids
            ids = np.array(found, self.dtype)
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * size
            if len(cuts) != len(some):
                self._ask(some, self.parts)
                continue
            raw, bounds = ids.tobytes(), [0, *cuts.tolist()]
            self.parts.put_all(some, [raw[b:e] for b, e in zip(bounds, bounds[1:])])

    def _learn(self, words: list[bytes]) -> None:
        if not (self.by_part and words):
            return self._ask(words, self.words)
        data = b"\n".join([*words, b""])
        kinds = kinds_of(data)
        sizes = np.array([len(w) + 1 for w in words])
        ends = np.cumsum(sizes)
        odd = np.logical_or.reduceat(kinds == OTHER, ends - sizes)
        kinds[np.repeat(odd, sizes)] = SPACE
        begins, numbers, parts = runs_of(data, kinds)
        self._ask_parts(self.parts.missing(parts))
        ids = list(map(self.parts.young.__getitem__, parts))
        found = joined(ids, numbers, begins, ends)
        self.words.put_all(list(compress(words, ~odd)), list(compress(found, ~odd)))
        self._ask(list(compress(words, odd)), self.words)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as packed whole numbers."""
        if not texts:
            return []
        raw = [t.encode() for t in texts]
        low = [r.lower() for r in raw] if self.by_part else raw
        whole = [not self.by_word or any(s in r or s in x for s in self.special) for r, x in zip(raw, low)]
        split = [b"" if w else x for x, w in zip(low, whole)]
        data = b"\n".join([*split, b""])
        begins, numbers, words = runs_of(data, np.frombuffer(data.translate(SPACED), np.uint8))
        self._learn(self.words.missing(words))
        ids = list(map(self.words.young.__getitem__, words))
        found = joined(ids, numbers, begins, np.cumsum([len(x) + 1 for x in split]))
        return [self._whole(t) if w else x for t, w, x in zip(texts, whole, found)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def pack(payloads: list[bytes]) -> list[bytes]:
    """Records around the payloads."""
    heads = [len(p).to_bytes(8, "little") for p in payloads]
    head_crc = masked(crc32c(heads)).astype("<u4")
    body_crc = masked(crc32c(payloads)).astype("<u4")
    return [
        b"".join((h, a.tobytes(), p, b.tobytes())) for h, a, p, b in zip(heads, head_crc, payloads, body_crc)
    ]


def unpack(records: list[bytes]) -> list[bytes]:
    """Payloads of records; an altered length or payload raises."""
    heads, payloads = [r[:8] for r in records], [r[12:-4] for r in records]
    lengths = np.array([int.from_bytes(h, "little") for h in heads])
    stored = np.array([(int.from_bytes(r[8:12], "little"), int.from_bytes(r[-4:], "little")) for r in records], np.uint32)
    if len(records) and not (
        np.array_equal(lengths, [len(p) for p in payloads])
        and np.array_equal(stored[:, 0], masked(crc32c(heads)))
        and np.array_equal(stored[:, 1], masked(crc32c(payloads)))
    ):
        raise ValueError("a record does not match its checksums")
    return payloads


def ids_of(payload: bytes) -> np.ndarray:
    count = int.from_bytes(payload[:4], "little")
    width = (len(payload) - 4) // count if count else 2
    return np.frombuffer(payload, f"<u{width}", offset=4)


def write_records(
    df: DataFrame, tokenizer: str, folder: str, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode every text and write the records in ascending ``doc_id`` order; returns the index.

    ``df`` is dealt by ranges of ``doc_id`` (repeated ids also by a digest of the text, so that a hot id
    splits); each task sorts its range, writes one file below ``folder`` and returns an index row for
    each record. A file has a name of its own for each attempt, and only files of attempts that ended
    well are in the index, which is written as a table ``folder/index``.

    Missing texts are empty: their record holds the end id alone. A missing ``doc_id`` sorts first.
    Repeated rows are written as often as they come. An empty table gives an empty index. Other
    columns are not read.
    """
    spark = df.sparkSession
    ordered = (
        df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(f"`{text}`").alias("text"))
        .withColumn("digest", F.xxhash64("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), "digest")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "digest", "text")
        .select("doc_id", "text")
    )
    names = [x.split()[0] for x in INDEX_SCHEMA.split(", ")]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode = encoder(tokenizer)
        end = np.array([end_id], encode.dtype).tobytes()
        out, name, offset, before, ordinal = None, "", 0, 0, 0
        for batch in batches:
            for piece in slices(batch, "text"):
                if out is None:
                    store, place = filesystem(folder)
                    store.create_dir(place, recursive=True)
                    name = f"part-{part:06d}-{uuid.uuid4().hex[:8]}.records"
                    out = store.open_output_stream(f"{place}/{name}")
                ids = [x + end for x in encode.encode(piece.column("text").to_pylist())]
                counts = np.array([len(x) // encode.dtype.itemsize for x in ids])
                records = pack([int(n).to_bytes(4, "little") + x for n, x in zip(counts, ids)])
                sizes = np.array([len(r) for r in records])
                out.write(b"".join(records))
                n = len(records)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array(np.full(n, part, np.int64)),
                        pa.array(np.arange(ordinal, ordinal + n, dtype=np.int64)),
                        pa.array([name] * n, pa.string()),
                        pa.array(offset + np.cumsum(sizes) - sizes, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(before + np.cumsum(counts) - counts, pa.int64()),
                        pa.array(counts, pa.int64()),
                    ],
                    names,
                )
                offset, before, ordinal = offset + int(sizes.sum()), before + int(counts.sum()), ordinal + n
        if out is not None:
            out.close()

    ordered.mapInArrow(write, INDEX_SCHEMA).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")


def _fetch(stream, offsets: list[int], sizes: list[int]) -> list[bytes]:
    """Records at the offsets; neighbours come in one read."""
    found: list[bytes] = []
    a = 0
    while a < len(offsets):
        b, total = a + 1, sizes[a]
        while b < len(offsets) and offsets[b] == offsets[b - 1] + sizes[b - 1] and total + sizes[b] <= READ_BYTES:
            total += sizes[b]
            b += 1
        raw = stream.read_at(total, offsets[a])
        for k in range(a, b):
            found.append(raw[offsets[k] - offsets[a] : offsets[k] - offsets[a] + sizes[k]])
        a = b
    return found


def _in_reads(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of index rows of one file, of about a slice of bytes."""
    files = batch.column("file").to_pylist()
    sizes = batch.column("length").to_pylist()
    a = total = 0
    for k in range(batch.num_rows):
        if k > a and (files[k] != files[a] or total + sizes[k] > SLICE_BYTES):
            yield batch.slice(a, k - a)
            a, total = k, 0
        total += sizes[k]
    if a < batch.num_rows:
        yield batch.slice(a)


def read_records(index: DataFrame, folder: str, schema: str, digest) -> DataFrame:
    """Read the records that an index names, in any order of its rows, and check their checksums.

    ``digest`` gets the index rows and their id arrays, and returns the arrays of ``schema``.
    """
    names = [x.split()[0] for x in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = filesystem(folder)
        opened, stream = None, None
        for batch in batches:
            for part in _in_reads(batch):
                name = part.column("file")[0].as_py()
                if name != opened:
                    opened, stream = name, store.open_input_file(f"{place}/{name}")
                records = _fetch(stream, part.column("offset").to_pylist(), part.column("length").to_pylist())
                ids = [ids_of(p) for p in unpack(records)]
                yield pa.RecordBatch.from_arrays(digest(part, ids), names)

    return index.mapInArrow(read, schema)


def _digests(part: pa.RecordBatch, ids: list[np.ndarray]) -> list[pa.Array]:
    return [
        *[part.column(c) for c in ("doc_id", "part", "ordinal", "tokens_before")],
        pa.array([len(x) for x in ids], pa.int64()),
        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
    ]


def token_records(df: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write the records of a table and describe each from what the files hold.

    ``start`` is the number of ids of all records before it: files count on from the totals of the files
    before them.
    """
    spark = df.sparkSession
    folder = folder or new_path(spark, "records")
    index = write_records(df, tokenizer, folder, end_id)
    found = read_records(index, folder, DIGEST_SCHEMA, _digests)
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = sums_before(totals, "part", "tokens").select("part", F.col("before_tokens"))
    return found.join(before, "part").select(
        "doc_id", (F.col("before_tokens") + F.col("tokens_before")).alias("start"), "n_tokens", "ids_crc32"
    )
