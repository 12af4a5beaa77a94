import struct

import public_tokenizers
from hypothesis import given as property_of
from hypothesis import settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tests.llm.helpers import documents, given, rows_of, with_clashing_columns
from tests.llm.test_records import HARD

from tallyhouse.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ENCODER = pieces.PieceEncoder(PATH)
LIBRARY = SentencePieceProcessor(model_file=PATH)
TEXTS = [*HARD, "  two  spaces ", " ", "   ", "▁x▁ y", "a\nb\r\n c", "<s> </s> <unk>", "tab\tx", "0 " * 500]


def check(text, found):
    ids, starts, ends = (list(x) for x in found)
    assert ids == LIBRARY.encode(text)
    source = text.encode()
    assert all(e >= s for s, e in zip(starts, ends)) and starts[1:] == ends[:-1]
    if source:
        assert starts[0] == 0 and ends[-1] == len(source)
    for i, s, e in zip(ids, starts, ends):
        piece = LIBRARY.id_to_piece(int(i))
        if LIBRARY.is_byte(int(i)):
            assert source[s:e] == bytes([int(piece[1:-1], 16)])
        else:
            assert source[s:e].decode().replace(" ", "▁").lstrip("▁") == piece.lstrip("▁")


def test_ids_spans_and_decoded_text_of_hard_texts():
    texts = [t or "" for t in TEXTS]
    for text, found in zip(texts, ENCODER.encode(texts)):
        check(text, found)
    assert ENCODER.decode([f[0] for f in ENCODER.encode(texts)]) == [LIBRARY.decode(LIBRARY.encode(t)) for t in texts]


@settings(max_examples=150, deadline=None)
@property_of(st.text(alphabet=st.sampled_from(" ab.é▁\n\tth日🙂'0"), max_size=40))
def test_any_text_is_encoded_as_the_library_does(text):
    check(text, ENCODER.encode([text])[0])
    ids, starts, ends = ENCODER._whole(text)
    again = ENCODER.encode([text])[0]
    assert ids.tolist() == list(again[0]) and ends.tolist() == list(again[2])


def test_whole_table_and_its_columns(spark):
    docs = with_clashing_columns(given(spark))
    found = rows_of(pieces.encode_pieces(docs, PATH))
    assert len(found) == docs.count() and set(docs.columns) < set(found[0])
    for r in found:
        check(r["text"], (r["ids"], r["starts"], r["ends"]))
        assert r["decoded"] == LIBRARY.decode(r["ids"])


def test_missing_empty_repeated_and_no_rows(spark):
    found = rows_of(pieces.encode_pieces(documents(spark, [None, "", "x", "x"]), PATH))
    assert sorted((r["text"] or "", len(r["ids"]), r["decoded"]) for r in found) == [("", 0, ""), ("", 0, ""), ("x", 1, "x"), ("x", 1, "x")]
    assert rows_of(pieces.encode_pieces(documents(spark, []), PATH)) == []


def compiled_map(rules):
    """A character map with the given rules, laid out as a double array by trying places in turn."""
    texts, replaced = {}, b""
    for source, target in rules.items():
        texts[source] = len(replaced)
        replaced += target + b"\0"
    units = {0: 0}
    used, bases = {0}, set()

    def place(at, prefix):
        labels = sorted({s[len(prefix)] for s in texts if s.startswith(prefix) and len(s) > len(prefix)})
        ends = prefix in texts
        for base in range(1, 4096):
            slots = [base ^ x for x in labels] + ([base] if ends else [])
            if base not in bases and not used & set(slots):
                break
        used.update(slots)
        bases.add(base)
        units[at] = (units[at] & 0xFF) | (base ^ at) << 10 | (0x100 if ends else 0)
        if ends:
            units[base] = texts[prefix] | 0x80000000
        for x in labels:
            units[base ^ x] = x
        for x in labels:
            place(base ^ x, prefix + bytes([x]))

    place(0, b"")
    table = [units.get(k, 0) for k in range(max(units) + 256)]
    return struct.pack("<I", 4 * len(table)) + struct.pack(f"<{len(table)}I", *table) + replaced


def test_longest_rule_of_a_compiled_map_and_its_alignment():
    rules = {"ﬁ".encode(): b"fi", b"a": b"A", b"ab": b"X", "é".encode(): b"e", b"--": b""}
    blob = compiled_map(rules)
    table = pieces.CharacterMap(blob)
    assert table.longest(b"abc", 0) == (2, b"X") and table.longest(b"ac", 0) == (1, b"A")
    assert table.longest(b"zab", 0) is None and table.longest(b"zab", 1) == (2, b"X")
    spec = bytes([2 << 3 | 2]) + _length(len(blob)) + blob + bytes([3 << 3, 0, 4 << 3, 0, 5 << 3, 1])
    form, places = pieces.Normaliser(spec)("ﬁ ab--éa")
    assert form.decode() == "fi▁XeA"
    assert places.tolist() == [0, 0, 3, 3, 3, 4, 8, 10, 11]


def _length(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def test_cache_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_BYTES", 1000)
    encoder = pieces.PieceEncoder(PATH)
    for k in range(20):
        text = f"{k}" + "日本語" * 100
        assert list(encoder.encode([text])[0][0]) == LIBRARY.encode(text)
        assert len(encoder.segments) == 1


def test_passes_work_on_small_slices(spark):
    """Words and ids of a slice take a multiple of its bytes, and two workers share an executor with the JVM."""
    from pyspark.sql import types as T
    from tallyhouse.llm.common import append_columns

    df = documents(spark, ["x" * 300_000] * 24).coalesce(1)
    held = append_columns(df, "text", [T.StructField("held", T.LongType())], lambda texts: [[sum(map(len, texts))] * len(texts)])
    assert [r.held for r in held.select("held").collect()] == [900_000] * 24
