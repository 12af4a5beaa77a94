import json
import unicodedata
import zlib

import numpy as np
from hypothesis import given as examples
from hypothesis import settings
from hypothesis import strategies as st
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import documents, given, rows_of, with_clashing_columns

from tallyhouse.llm import records
from tallyhouse.llm.common import sums_before
from tallyhouse.sources.staging import new_path

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "", None, " \t\n", "The  cat sat.\x1cOn mats'll", "x<|endoftext|>y", "́a é ̈", "İstanbul ΣΑΣ", "日本語 テキスト",
    "a" * 5000, "don't they're I'm 12345 %%%***", "\x85 next ​ zero", "the " * 3000, "🙂🙂 ok",
]


def test_checksum_and_mask_match_known_values():
    assert records.crc32c([b"123456789"])[0] == 0xE3069283
    assert records.crc32c([bytes(32)])[0] == 0x8A9136AA
    long = bytes(range(256)) * 7 + b"tail"
    crc = 0xFFFFFFFF
    for byte in long:
        crc = int(records.TABLE[(crc ^ byte) & 255]) ^ (crc >> 8)
    assert records.crc32c([b"abcd", long])[1] == crc ^ 0xFFFFFFFF
    crc = 0xE3069283
    assert records.masked(np.array([crc], np.uint32))[0] == (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def test_altered_record_raises():
    record = records.pack([b"\x01\x00\x00\x00\x07\x00"])[0]
    assert records.unpack([record]) == [b"\x01\x00\x00\x00\x07\x00"]
    for k in (0, 9, 13, len(record) - 1):
        changed = bytearray(record)
        changed[k] ^= 4
        with pytest.raises(ValueError):
            records.unpack([bytes(changed)])


def expected(rows, end=2):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    start, out = 0, []
    for i, text in sorted(rows, key=lambda r: r[0]):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def plain(df):
    return [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in sorted(rows_of(df), key=lambda r: r["start"])]


def test_given_documents_are_encoded_as_the_library_does(spark):
    docs = given(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert plain(records.token_records(docs.repartition(5), PATH, 2)) == expected(rows)


def test_hard_texts(spark):
    docs = with_clashing_columns(documents(spark, HARD, ids=[7 * k % 13 for k in range(len(HARD))]))
    assert plain(records.token_records(docs, PATH, 2)) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_cache_that_overflows_changes_nothing(monkeypatch):
    monkeypatch.setattr(records, "CACHED_WORDS", 2)
    e = records.WordEncoder(PATH)
    texts = ["one two three", "three four", "one five six", "two"]
    assert [np.frombuffer(e.encode([t])[0], "<u2").tolist() for t in texts] == [
        e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts
    ]


def test_empty_table_repeats_and_missing_ids(spark):
    assert rows_of(records.token_records(documents(spark, []), PATH, 2)) == []
    docs = documents(spark, ["b", "b", "a", None], ids=[3, 3, None, 3])
    found = plain(records.token_records(docs, PATH, 2))
    assert [r[0] for r in found] == [None, 3, 3, 3]
    assert [r[1] for r in found] == [0, *np.cumsum([r[2] for r in found])[:-1]]


def test_index_reads_in_any_order(spark):
    folder = new_path(spark, "records")
    index = records.write_records(given(spark), PATH, folder, 2)
    shuffled = index.orderBy(F.xxhash64("doc_id"))
    read = records.read_records(shuffled, folder, records.DIGEST_SCHEMA, records._digests)
    straight = records.read_records(index, folder, records.DIGEST_SCHEMA, records._digests)
    key = lambda r: r["doc_id"]
    assert sorted(rows_of(read), key=key) == sorted(rows_of(straight), key=key)


def test_sums_before_over_many_blocks(spark, monkeypatch):
    totals = spark.range(5000).select((F.col("id") * 3).alias("n"), (F.col("id") % 7).alias("v"))
    found = {r.n: r.before_v for r in sums_before(totals, "n", "v").collect()}
    total = 0
    for k in range(5000):
        assert found[k * 3] == total
        total += k % 7


def test_words_are_put_together_from_parts():
    e = records.WordEncoder(PATH)
    assert e.by_part
    texts = ["Hello, WORLD! (hello) x86_64 don't DON'T 'tis a--b 3.14 <tag> \x01a\x1cb É,é 日本,x a b İA ~!@#$%^&*()_+", "hello,,, HELLO" * 50]
    for t in texts * 2:
        assert np.frombuffer(e.encode([t])[0], "<u2").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids
    assert b"hello" in e.parts.young and b"hello," in e.words.young and b"Hello," not in e.words.young
    for t in ("é<|STARTOFTEXT|>a", "<|StartOfText|> b", "<|endoftext|>", "a'S it'S", "\x7f a\x7fb"):
        assert np.frombuffer(e.encode([t])[0], "<u2").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@examples(st.text(st.one_of(st.sampled_from("aA zZ'st.,09é\t\n\x00\x1c\x85\u0130\u0131\u03a3\u0301\xd7\xf7\xdf\u0149\u01c5\u024f\u0250<|>"), st.characters(exclude_categories=["Cs"])), max_size=30))
def test_any_text_is_encoded_as_the_library_does(text):
    e = records.encoder(PATH)
    assert np.frombuffer(e.encode([text])[0], "<u2").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


def test_generations_keep_what_is_used_within_the_bound():
    from tallyhouse.llm.common import ENTRY_BYTES, Recent

    known = Recent(100 * (ENTRY_BYTES + 10))
    for k in range(1000):
        wanted = {b"often", b"%05d" % k}
        for key in known.missing(wanted):
            known.put(key, b"12345")
        assert wanted <= known.young.keys() and len(known) <= 103
    assert known.missing({b"often", b"00001"}) == [b"00001"]


class Counted(dict):
    calls = 0

    def __getitem__(self, key):
        self.calls += 1
        return super().__getitem__(key)


def test_a_distinct_word_is_looked_up_once_in_a_slice():
    e = records.WordEncoder(PATH)
    e.words.young, e.parts.young = Counted(), Counted()
    texts = ["hello, World x86 don't " * 500] * 4
    found = e.encode(texts)
    assert np.frombuffer(found[3], "<u2").tolist() == e.tokenizer.encode(texts[3], add_special_tokens=False).ids
    assert e.words.young.calls == 4 and e.parts.young.calls == 6


TEXTS = st.text(st.one_of(st.sampled_from("aAz'1,\u00e9\u00c9\u00d7\u0130\u0301 \t\n\x0b\x1c\x85"), st.characters(exclude_categories=["Cs"])), max_size=12)


@settings(max_examples=200, deadline=None)
@examples(st.lists(st.one_of(TEXTS, st.sampled_from(["", "x<|endoftext|>y", "<|STARTOFTEXT|>", "a'", "'s"])), max_size=8))
def test_texts_of_a_slice_do_not_meet(texts):
    e = records.encoder(PATH)
    assert [np.frombuffer(x, "<u2").tolist() for x in e.encode(texts)] == [
        e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts
    ]


def test_letters_of_parts_are_composed_and_encoded_as_by_the_whole_tokenizer():
    e = records.WordEncoder(PATH)
    assert e.merger is not e.tokenizer
    letters = [chr(k) for k in range(0xC0, 0x250) if k not in (0xD7, 0xF7, 0x130)]
    assert all(unicodedata.normalize("NFC", c) == c for c in letters)
    assert set(records.kinds_of("".join(letters).encode() + b" ")[:-1]) == {records.LETTER}
    assert set(records.kinds_of("\xd7\xf7\u0130\u0250'\x7f ".encode())[:-1]) == {records.OTHER}
    texts = [f"{c}a {c} 1{c}{c}," for c in letters]
    assert [np.frombuffer(x, "<u2").tolist() for x in e.encode(texts)] == [
        e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts
    ]


@pytest.mark.parametrize("change", ["strips accents", "cuts otherwise", "keeps capitals", "keeps white space"])
def test_other_tokenizers_are_encoded_as_the_library_does(tmp_path, change):
    with open(PATH, encoding="utf-8") as f:
        plan = json.load(f)
    forms, cuts = plan["normalizer"]["normalizers"], plan["pre_tokenizer"]["pretokenizers"]
    if change == "strips accents":
        forms[:1] = [{"type": "NFD"}, {"type": "StripAccents"}]
    elif change == "cuts otherwise":
        cuts[0]["pattern"] = {"Regex": r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"}
    elif change == "keeps capitals":
        del forms[2]
    else:
        del forms[1]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(plan), encoding="utf-8")
    e = records.WordEncoder(str(path))
    assert e.merger is e.tokenizer
    texts = ["Été l'ÉTÉ x86,é don't\nHello  WORLD", "", "a\tb é", "<|endoftext|> A"]
    assert [np.frombuffer(x, "<u2").tolist() for x in e.encode(texts)] == [
        e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts
    ]
