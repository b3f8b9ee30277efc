import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.cases import LAYOUT, no_documents, odd_documents
from tripweave.llm import packing
from tripweave.llm.packing import CAPACITY, TokenIds, cuts, pack, sequences
from tripweave.llm.queries import op1_harmonic_packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("capacity", [64, 4096])
def test_cuts(capacity):
    for tokens in (*range(1, 300), 4095, 4096, 4097, 10_000, 123_457):
        found = cuts(tokens, capacity)
        assert sum(found) == tokens and min(found) > 0 and max(found) <= capacity
        for n in found:  # full bins of a class leave little empty
            assert capacity - (capacity // n) * n <= max(0.01 * capacity, n - 1)


def check_places(rows):
    places = defaultdict(list)
    for row in rows:
        places[row.sequence_id].append((row.offset, row.length))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= CAPACITY
    return places


def test_whole_table(spark, small):
    texts = dict(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    rows = op1_harmonic_packing(spark, small).collect()
    check_places(rows)
    tokenizer, pieces = Tokenizer.from_file(PATH), defaultdict(list)
    for row in rows:
        pieces[row.doc_id].append(row)
    assert pieces.keys() == texts.keys()
    for doc, parts in pieces.items():
        ids = [*tokenizer.encode(texts[doc], add_special_tokens=False).ids, 2]
        end = 0
        for part in sorted(parts, key=lambda p: p.start):
            assert part.start == end and part.doc_tokens == len(ids)
            end += part.length
            raw = struct.pack(f"<{part.length}I", *ids[part.start : end])
            assert part.ids_crc32 == zlib.crc32(raw)
        assert end == len(ids)


def test_little_padding(spark, small):
    places = check_places(op1_harmonic_packing(spark, small).collect())
    totals = [sum(n for _, n in parts) for parts in places.values()]
    padding = sum(CAPACITY - n for n in totals if n & (n - 1))
    assert padding <= 0.02 * sum(totals) + CAPACITY


def test_odd_rows(spark):
    docs = odd_documents(spark)
    packed = pack(docs, PATH, with_ids=True)
    rows = packed.collect()
    check_places(rows)
    pieces = defaultdict(list)
    for row in rows:
        pieces[row.doc_id].append(row)
    for doc, text in docs.select("doc_id", "text").distinct().collect():
        copies = docs.where(docs.doc_id.eqNullSafe(doc)).count()
        own = sorted(pieces[doc], key=lambda p: p.start)
        wanted = sorted(ids_of(text) * copies)
        assert sorted(i for part in own for i in part.ids) == wanted
    together = sequences(packed).collect()
    assert sum(len(r.ids) for r in together) == sum(r.length for r in rows)


def test_bins_are_filled_over_tasks(spark):
    docs = spark.createDataFrame([(i, "one two " * (i % 700), "en", "s", 1) for i in range(900)], LAYOUT)
    rows = pack(docs.repartition(8), PATH).collect()
    totals = [sum(n for _, n in parts) for parts in check_places(rows).values()]
    assert sum(totals) == sum(2 * (i % 700) + 1 for i in range(900))
    assert len(totals) * CAPACITY - sum(totals) <= 0.02 * sum(totals) + CAPACITY


def test_no_rows(spark):
    assert pack(no_documents(spark), PATH).count() == 0


def found_ids(tokens, texts):
    return [[*np.frombuffer(raw, "<u4")] + [2] for raw in tokens(pa.array(texts, pa.string()))]


def test_ids_are_those_of_the_tokenizer(monkeypatch):
    texts = [
        None, "", " \t\x0b\n", "Word word, WORD! (word) \"word\".", "it's IT'S 'sam ''s can't!", "...", "a...b ?! --",
        "J\u030c e\u0301 E\u0301, \u0130stanbul \u00c0\u00d6\u00df\u00ff\u00d7\u00f7 \u212a \u017fs", "x\u00a0y\u2028z \x1c a\x00b", "<|endoftext|> <|ENDOFTEXT|> a<|endoftext|>.",
        "3.14, +1 a1 1a! \u0661\u0662", "\u4f60\u597d, \U0001f600! \U0001f600a", "Z" * 300 + "!" * 300,
    ]
    wanted = [ids_of(text) for text in texts]
    tokens = TokenIds(PATH)
    assert found_ids(tokens, texts) == wanted
    assert found_ids(tokens, texts[::-1]) == wanted[::-1]
    monkeypatch.setattr(packing, "_CACHED", 3)  # forgets all the time
    monkeypatch.setattr(packing, "_AT_ONCE", 2)
    assert found_ids(tokens, texts) == wanted and found_ids(tokens, []) == []


def test_a_word_is_tokenized_once_however_it_is_written(monkeypatch):
    """Words are remembered, not their spellings: more chunks than a worker remembers cost nothing new."""
    words = ["".join("qz"[i >> bit & 1] for bit in range(5)) for i in range(32)]
    chunks = [make(word) + sign for word in words for make in (str, str.title, str.upper) for sign in "!?.,;:"]
    monkeypatch.setattr(packing, "_CACHED", 100)
    tokens, asked = TokenIds(PATH), []
    plain = tokens._tokenize
    monkeypatch.setattr(tokens, "_tokenize", lambda texts: asked.extend(" ".join(texts).split()) or plain(texts))
    for _ in range(3):
        for at in range(0, len(chunks), 48):
            texts = [" ".join(chunks[at : at + 48])]
            assert found_ids(tokens, texts) == [ids_of(text) for text in texts]
    assert sorted(asked) == sorted([*words, *"!?.,;:"])
