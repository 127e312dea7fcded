"""Token counts, BPE and personal data against brute force, the public library and fixed cases."""

from __future__ import annotations

import hashlib
import json
import random
import re
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakepipe.llm import bpe, pii, token_count
from lakepipe.llm.queries import PIECES, QUERIES, WORD_BPE

from ..conftest import SF_SMALL
from .cases import AWKWARD, frame


def longest_match(pieces: set[bytes], word: bytes, mark: bytes = b" ") -> int:
    text, at, n = mark + word, 0, 0
    while at < len(text):
        for end in range(len(text), at, -1):
            if text[at:end] in pieces and text[at:end].startswith(mark) == (at == 0):
                break
        else:
            return -1
        at, n = end, n + 1
    return n


def test_piece_counts_match_greedy_search():
    rng = random.Random(5)
    for _ in range(200):
        pieces = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 25))}
        pieces |= {b" " + bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 4))) for _ in range(8)}
        a = token_count.PieceAutomaton(sorted(pieces))
        for _ in range(60):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
            assert a.count(word) == longest_match(pieces, word), (pieces, word)


def test_token_counts_query(spark):
    pieces = set(token_count.load_pieces(PIECES))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op2_token_counts"](spark, SF_SMALL).collect()}
    assert set(got) == {d.doc_id for d in docs}
    seen: dict[bytes, int] = {}
    for d in docs:
        words = d.text.encode().split()
        for w in words:
            if w not in seen:
                seen[w] = longest_match(pieces, w)
        assert (got[d.doc_id].n_tokens, got[d.doc_id].n_words) == (sum(seen[w] for w in words), len(words))


def test_bpe_query_matches_library(spark):
    library = Tokenizer.from_file(WORD_BPE)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op6_bpe"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


AWKWARD_TEXTS = [
    "İstanbul ΣΑΣ ΟΔΟΣ <|endoftext|>ab<|startoftext|> it's we'll I'VE", "²Ⅷ٣ \x1c\x85\xa0　x é́ ́a 🙂🙂 don''t 漢字カナ",
    "a" * 20000, "ab" * 6000, "<|endoftext|>", "", "x<|endoftext|", "q" * 70 + " " + "q" * 70,
]


@pytest.mark.parametrize("k", range(len(AWKWARD_TEXTS)))
def test_bpe_awkward_texts(k):
    t = bpe.Tokenizer(json.loads(bpe.load_spec(WORD_BPE)))
    library = Tokenizer.from_file(WORD_BPE)
    ids = [i for (i,) in struct.iter_unpack("<I", b"".join(t.encode_stream(AWKWARD_TEXTS[k])))]
    assert ids == library.encode(AWKWARD_TEXTS[k], add_special_tokens=False).ids


def test_bounded_window_gives_whole_word_merges():
    t = bpe.Tokenizer(json.loads(bpe.load_spec(WORD_BPE))).transducer
    rng = random.Random(9)
    for n in (10, 300, 2000):
        for alphabet in ("ab", "etaoinsh", "aeiou<"):
            word = [rng.choice(alphabet) for _ in range(n)]
            whole = [t.vocab[x] for x in t.merge(word[:-1] + [word[-1] + "</w>"])]
            assert list(t.encode(iter(word), window=8)) == whole


def test_lookahead_covers_every_continuation():
    """Random merge lists: boundaries beyond the lookahead never depend on what follows."""
    rng = random.Random(3)
    for _ in range(150):
        vocab, merges = list("ab"), []
        while len(merges) < 12:
            pair = (rng.choice(vocab), rng.choice(vocab))
            if pair not in merges and len(pair[0] + pair[1]) <= 8 and pair[0] + pair[1] not in vocab:
                merges.append(pair)
                vocab.append(pair[0] + pair[1])
            elif rng.random() < 0.05:
                break
        t = bpe.Transducer({v: i for i, v in enumerate(vocab)}, merges)
        for _ in range(20):
            word = [rng.choice("ab") for _ in range(rng.randint(1, 120))]
            assert list(t.encode(iter(word), window=2)) == [t.vocab[x] for x in t.merge(word)]


def test_merge_of_long_words_equals_short_form():
    t = bpe.Tokenizer(json.loads(bpe.load_spec(WORD_BPE))).transducer
    rng = random.Random(4)
    for _ in range(50):
        word = [rng.choice("theanior") for _ in range(rng.randint(2, 48))]
        assert t._merge_long(word) == t.merge(word)


def test_byte_decoder_is_incremental():
    t = bpe.Tokenizer(json.loads(bpe.load_spec(WORD_BPE)))
    text = "naïve 漢字 🙂 done"
    ids = [i for (i,) in struct.iter_unpack("<I", b"".join(t.encode_stream(text)))]
    d = t.decoder(as_bytes=True)
    assert ("".join(d.push([i]) for i in ids) + d.close()).split() == text.split()


def test_encode_then_decode_frames(spark):
    df = frame(spark, AWKWARD)
    library = Tokenizer.from_file(WORD_BPE)
    enc = bpe.encode(df, WORD_BPE)
    back = bpe.decode(enc, WORD_BPE).collect()
    want = sorted(((r[0], library.decode(library.encode(r[1] or "", add_special_tokens=False).ids,
                                         skip_special_tokens=False)) for r in AWKWARD), key=repr)
    assert sorted(((r.doc_id, r.text) for r in back), key=repr) == want


# the contract's patterns, as given
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_spans(text):
    digits = lambda s: re.sub(r"\D", "", s)
    return ([("email", *m.span()) for m in EMAIL.finditer(text)]
            + [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
            + [("card", *m.span()) for m in CARD.finditer(text)
               if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
            + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15])


def test_base_spans_match_patterns():
    rng = random.Random(11)
    alphabet = ["a", "b.", "@", "@x.", ".", "1", "25", "4111111111111111", "4111 1111-1111 1111", "+1", "+49 (30) 123-4567",
                " ", "-", "(", ")", "%", "1.2.3.4", "256.1.1.1", "é", "\n", "x@y.zz", "-.", "00"]
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        got = [s[:3] for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS]
        assert got == base_spans(text), text


def test_pii_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op7_pii"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for d in docs:
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(d.text))
        assert got[d.doc_id].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert got[d.doc_id].spans.startswith(base)


def test_checked_and_scored_kinds():
    spans = lambda t: [(s[0], t[s[1]:s[2]]) for s in pii.find_spans(t)]
    assert spans("IBAN GB82 WEST 1234 5698 7654 32.") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert spans("IBAN GB83 WEST 1234 5698 7654 32.") == []
    assert spans("ssn 123-45-6789") == [("ssn", "123-45-6789")]
    assert spans("part 123-45-6789") == []
    assert spans("call (555) 123-4567 now") == [("local_phone", "(555) 123-4567")]
    assert spans("row (555) 123-4567 now") == []
    assert pii.mask("mail x@y.org or 10.0.0.1!") == "mail <EMAIL> or <IP>!"
    near, far = pii.find_spans("card 4111111111111111"), pii.find_spans("4111111111111111")
    assert near[0][3] > far[0][3]


def test_awkward_rows(spark):
    df = frame(spark, AWKWARD)
    for out in (pii.pii_digest(df), token_count.token_counts(df, PIECES), bpe.digest(df, WORD_BPE)):
        got = sorted((r.doc_id for r in out.collect()), key=lambda x: (x is None, x))
        assert got == [1, 2, 3, 4, 5, 6, 7, 7, None]
        empty = out.filter("doc_id = 1").collect()[0].asDict()
        assert all(v in (0, 0.0, "", hashlib.sha256(b"").hexdigest()) for k, v in empty.items() if k != "doc_id")
        assert out.sparkSession.createDataFrame([], df.schema) is not None
    none = frame(spark, [])
    assert pii.mask_pii(none).collect() == token_count.token_counts(none, PIECES).collect() == []
    assert bpe.digest(none, WORD_BPE).collect() == []


def test_vocabulary_files_are_not_copied():
    assert PIECES == public_tokenizers.path("byte_bpe_50k.tiktoken")
