from __future__ import annotations

import hashlib
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm.llm_helpers import kept_columns, odd_texts, rows

from tidegauge.llm import bpe, bytesops, queries, tokenfiles

os.environ["TOKENIZERS_PARALLELISM"] = "false"
public_tokenizers = pytest.importorskip("public_tokenizers")
WORD, BYTE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))
BITS = (
    "'s|'re|'|''| |  |\n|\t|a|B|é|É|ß|Σ|ς|1|23|...|<|endoftext|>|×|中文|é| |İ|don't|'LL|'ll|'lx|"
    " 've|\r\n|x's|_|\x0b|🙂|٣|ll're|'ve's|aaaa|abab"
).split("|")


def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def odd_strings(count):
    pick = random.Random(4)
    specials = ["<|endoftext|>", "<|startoftext|>", "<|"]
    made = ["".join(pick.choice(BITS + specials) for _ in range(pick.randrange(25))) for _ in range(count)]
    return [*made, "", "a" * 400, "ab" * 300, "<|endoftext|><|endoftext|>", *(t or "" for _, t in odd_texts())]


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("kind", [bpe.Bpe, tokenfiles.LibraryBpe])
def test_ids_and_texts_are_the_librarys(path, kind):
    own, theirs = kind(path), library(path)
    texts = odd_strings(3000)
    data, offsets = bytesops.text_bytes(pa.array(texts, pa.string()))
    values, first = own.encode(data, offsets)
    decoded = own.decode(values, first).to_pylist()
    for k, wanted in enumerate(theirs.encode_batch(texts, add_special_tokens=False)):
        assert values[first[k] : first[k + 1]].tolist() == wanted.ids, repr(texts[k])
        assert decoded[k] == theirs.decode(wanted.ids, skip_special_tokens=False), repr(texts[k])


def test_pieces_that_were_forgotten_are_found_again(monkeypatch):
    monkeypatch.setattr(bpe, "_KEPT_PIECES", 5)
    own, theirs = bpe.Bpe(WORD), library(WORD)
    for text in ("one two three", "four five six one", "seven eight nine two", "one two three four"):
        data, offsets = bytesops.text_bytes(pa.array([text]))
        assert own.encode(data, offsets)[0].tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_odd_rows(odd):
    result = bpe.round_trip(odd, WORD)
    kept_columns(result, odd)
    theirs = library(WORD)
    wanted = []
    for number, text in odd_texts():
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        wanted.append((number, ids, theirs.decode(ids, skip_special_tokens=False)))
    assert rows(result.select("doc_id", "ids", "decoded")) == sorted(wanted, key=str)
    apart = bpe.decode(bpe.encode(odd, WORD), WORD)
    assert rows(apart.select("doc_id", "ids", "decoded")) == sorted(wanted, key=str)


def test_empty_table(nothing):
    assert bpe.round_trip(nothing, WORD).collect() == []


def test_a_column_with_the_name_of_a_result_is_replaced(spark):
    df = spark.createDataFrame([(1, "hello", "old")], "doc_id int, text string, IDS string")
    result = bpe.encode(df, WORD)
    assert result.columns == ["doc_id", "text", "ids"] and result.first().ids


def test_query_equals_the_library(spark, sf_dir):
    theirs = library(WORD)
    wanted = []
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        ids = theirs.encode(row.text or "", add_special_tokens=False).ids
        texts = (" ".join(map(str, ids)), theirs.decode(ids, skip_special_tokens=False))
        wanted.append((row.doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in texts)))
    result = queries.queries()["op6_bpe_encoding"](spark, sf_dir)
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert rows(result) == sorted(wanted, key=str)


# --- Files ------------------------------------------------------------------------


def expected_files(docs):
    theirs, start, out = library(BYTE), 0, []
    for number, text in docs:
        ids = [*theirs.encode(text or "", add_special_tokens=False).ids, 2]
        raw = np.array(ids, "<u4").tobytes()
        out.append((number, start, len(ids), zlib.crc32(raw)))
        start += len(ids)
    return out


def test_files_query_equals_the_library(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    result = queries.queries()["op10_token_files"](spark, sf_dir)
    assert result.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert rows(result) == sorted(expected_files(sorted(map(tuple, docs))), key=str)


def test_files_of_odd_rows(spark, odd, tmp_path):
    folder = tmp_path / "tokens"
    parts = tokenfiles.write_token_files(odd, BYTE, str(folder), part_bytes=50_000)
    found = tokenfiles.read_token_files(parts).collect()
    # Ends meet: each document begins where the one before ends, in the order of the ids.
    found.sort(key=lambda r: r.start)
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1]]
    numbers = [r.doc_id for r in found]
    assert numbers == [None, None, *sorted(x for x in numbers if x is not None)]
    wanted = expected_files(odd_texts())
    assert sorted((str(n), size, crc) for n, _, size, crc in wanted) == sorted(
        (str(r.doc_id), r.n_tokens, zlib.crc32(r.ids)) for r in found
    )
    sizes = {p.suffix: 0 for p in folder.iterdir()}
    for p in folder.iterdir():
        sizes[p.suffix] += p.stat().st_size
    parts_made = parts.count()
    total = sum(r.n_tokens for r in found)
    assert sizes == {".bin": 2 * total, ".off": 8 * (len(found) + parts_made), ".doc": 8 * len(found)}


def test_files_with_an_end_id_beyond_16_bits(spark, tmp_path):
    df = spark.createDataFrame([(5, "b c"), (3, "a")], "doc_id int, text string")
    parts = tokenfiles.write_token_files(df, BYTE, f"file://{tmp_path}/tokens", end_id=70_000)
    found = tokenfiles.read_token_files(parts).orderBy("start").collect()
    assert [r.doc_id for r in found] == [3, 5]
    assert all(np.frombuffer(r.ids, "<u4")[-1] == 70_000 for r in found)


def test_files_of_an_empty_table(nothing, tmp_path):
    parts = tokenfiles.write_token_files(nothing, BYTE, str(tmp_path / "tokens"))
    assert tokenfiles.read_token_files(parts).collect() == []
