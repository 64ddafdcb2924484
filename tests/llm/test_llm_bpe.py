import functools
import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orderloom.llm import bpe
from orderloom.llm.queries import op8_bpe_chunks
from orderloom.llm.text import table

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


PIECES = ["a", "b", " ", "  ", "\n", "é", "日", "👍", "'s", "12", "<|endoftext|>", "\t", " ",
          "\u0085", "\x1c", "***", "word", "<|end", "​", "\x00", "ñ ", " "]


def test_equals_the_library(library, rng, monkeypatch):
    ends = bpe.chunk_ends
    for _ in range(1500):
        text = "".join(rng.choices(PIECES, k=rng.randint(0, 120)))
        monkeypatch.setattr(bpe, "chunk_ends", functools.partial(ends, bits=rng.randint(1, 4)))
        ids = bpe.codec(PATH).encode(text).tolist()
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids == expected
        assert bpe.codec(PATH).decode(ids) == library.decode(expected, skip_special_tokens=False)


RUNS = ["a", "ab", "日本", "ที่", "привет", "0", "१2", "=", "-=", "é", "ſ", "the", "👍", "𠀀x", "\u0378",
        "ⅷ", "'", "'re", "l"]


def test_long_pieces_equal_the_library(library, rng, monkeypatch):
    """Runs of one kind of characters, in which no position is safe."""
    ends = bpe.chunk_ends
    for _ in range(1500):
        text = "".join("".join(rng.choices(rng.sample(RUNS, 2), k=rng.randint(1, 60)))
                       + rng.choice(["", " ", "\n ", "  ", "<|endoftext|>", ". ", "。"])
                       for _ in range(rng.randint(1, 4)))
        monkeypatch.setattr(bpe, "chunk_ends", functools.partial(ends, bits=rng.randint(1, 4)))
        ids = bpe.codec(PATH).encode(text).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_random_letters_equal_the_library(library, rng, monkeypatch):
    ends = bpe.chunk_ends
    letters = "etaoinshrdlu" + "абвгдежз" + "的一是不了人我在有他"
    for _ in range(600):
        text = "".join(rng.choices(letters[:rng.choice([3, 12, 20, 30])], k=rng.randint(2, 400)))
        monkeypatch.setattr(bpe, "chunk_ends", functools.partial(ends, bits=rng.randint(1, 5)))
        ids = bpe.codec(PATH).encode(text).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name, alphabet, between", [
    ("ideographs with marks", "的一是不了人我在有他这中大来上国", "，"),
    ("ideographs without a break", "的一是不了人我在有他这中大来上国", ""),
    ("Cyrillic with spaces", "оеаинтсрвлкмдпуяыьгз", " "),
    ("Thai without a break", "กขคงจฉชซญดตถทนบปผพฟมยรลวสหอ", ""),
    ("lines without spaces", "abcdefghijklmnopqrstuvwxyz0123456789", "\n"),
    ("one line of letters", "abcdefghijklmnopqrstuvwxyz", "")])
def test_little_is_encoded_again(library, rng, monkeypatch, name, alphabet, between):
    codec = bpe.Codec(PATH)
    text = between.join("".join(rng.choices(alphabet, k=rng.randint(2, 40))) for _ in range(9000))
    again = []
    plain, piece = codec.plain, codec._piece
    monkeypatch.setattr(codec, "chunk", plain)
    monkeypatch.setattr(codec, "plain", lambda data: again.append(len(data)) or plain(data))
    monkeypatch.setattr(codec, "_piece", lambda data: again.append(len(data)) or piece(data))
    ids = codec.encode(text).tolist()
    assert len(bpe.chunk_ends(text.encode())) > 20
    assert sum(again) < 0.1 * len(text.encode())
    assert ids == library.encode(text, add_special_tokens=False).ids


def test_documents_table_equals_the_library(library, spark):
    """The registered query against the library, row by row."""
    texts = {r.doc_id: r.text or ""
             for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()}
    rows = op8_bpe_chunks(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (
            len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest())


@pytest.mark.parametrize("run", [" " * 2_000_000, "\n" * 2_000_000, " \n" * 1_000_000])
def test_very_long_white_space(library, run):
    for text in (f"a{run}b", f"a{run}<|endoftext|>{run}"):
        ids = bpe.codec(PATH).encode(text).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert bpe.codec(PATH).decode(ids) == text


WHITE = ["\t", "\v", "\f", "\r", "\xa0", "\u1680", "\u2000", "\u200a", "\u2028", "\u2029",
         "\u202f", "\u205f", "\u3000", "\x1f", "\u180e", "\u200b", "\ufeff"]


def test_long_runs_split_like_the_library(library, rng, monkeypatch):
    ends = bpe.chunk_ends
    for _ in range(1500):
        pieces = rng.choice([PIECES, PIECES + WHITE, [" ", "\n", "a", "<|endoftext|>"]])
        text = "".join(rng.choices(pieces, k=rng.randint(0, 120)))
        monkeypatch.setattr(bpe, "chunk_ends", functools.partial(ends, bits=rng.randint(1, 4)))
        monkeypatch.setattr(bpe, "LONG_RUN", rng.randint(1, 4))
        ids = bpe.codec(PATH).encode(text).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_chunks_are_cut_by_content():
    tail = bytes(range(97, 123)) * 400
    ends = [len(d) - e for d in (tail, b"something else " + tail) for e in bpe.chunk_ends(d)]
    assert len(set(ends)) < len(ends)


def test_shared_chunks_are_encoded_once(monkeypatch):
    codec = bpe.Codec(PATH)
    text = " ".join(f"word{i * i}" for i in range(3000))
    codec.encode(text)
    calls = []
    plain = codec.plain
    monkeypatch.setattr(codec, "plain", lambda data: calls.append(len(data)) or plain(data))
    codec.encode("new beginning " + text)
    assert sum(calls) < len(text) / 2


def test_chunks_used_last_are_kept(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_BYTES", 3000)
    codec, calls = bpe.Codec(PATH), []
    plain = codec.plain
    monkeypatch.setattr(codec, "plain", lambda data: calls.append(data) or plain(data))
    for n in range(100):
        codec.chunk(b"shared by all")
        codec.chunk(b"of one text %d" % n)
    assert calls.count(b"shared by all") == 1
    assert codec._chunk_bytes <= 3000 and len(codec._chunks) > 10
    codec.chunk(b"long " * 3000)
    assert len(codec._chunks) == 1


def test_round_trip_as_rows(docs):
    rows = docs([(1, "Hello  there\n"), (2, None), (3, ""), (4, "<|endoftext|> été")])
    ids = bpe.encode_documents(rows, PATH)
    assert {r.doc_id: r.text for r in bpe.decode_documents(ids, PATH).collect()} == {
        1: "Hello  there\n", 2: "", 3: "", 4: "<|endoftext|> été"}


def test_broken_utf8_decodes_like_the_library(library):
    ids = library.encode("日本 👍", add_special_tokens=False).ids
    for i in range(len(ids)):
        part = ids[:i] + ids[i + 1:]
        assert bpe.codec(PATH).decode(part) == library.decode(part, skip_special_tokens=False)
