"""BPE encoding and decoding (operator 6): a streaming transducer with a bounded lookahead.

Encoding. A merge list fixes how far text that is still to come can change boundaries already made.
An unknown continuation first differs at the end of the buffer; each further difference to the left
comes from a merge of higher rank whose right part begins where the earlier merge's left part began.
``sufficient_lookahead`` takes the longest such chain over the merge list: all boundaries that lie
more than this many symbols before the end of the buffer are final. ``Transducer`` keeps a buffer
of a few lookaheads, emits the tokens that end before that point and goes on from there, so a word of any
length is encoded in constant memory; the tokens are those of the whole word's merges.

Decoding. ``Decoder`` takes one id at a time. Without a decoder in the vocabulary file a token's text is
its vocabulary entry and entries are joined by one blank, as the tokenizers library does; with
``as_bytes`` it turns byte symbols back into bytes and emits characters once their UTF-8 form is
complete (a broken sequence becomes U+FFFD).

Text is treated as the vocabulary file says: special tokens are cut out of the raw text first, then
NFC, lower case by code point, and the file's split pattern. Null text is empty text. Repeated rows give
repeated results; other columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import struct
import unicodedata

import regex
from pyspark.sql import DataFrame

from ._base import Cache, map_batches

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
SPAN = 4096
BLOCK = 1 << 15
_BLANK = re.compile(rb"[\x20\x09-\x0d]")


def byte_symbols() -> list[str]:
    """The printable symbol of each byte in byte-level vocabularies.

    Bytes that print in Latin-1 stand for themselves, the others take the code points from 256 on.
    """
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 255 and b != 173:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def sufficient_lookahead(merges: list[tuple[str, str]], size: dict[str, int]) -> int:
    """Symbols before the end of a buffer beyond which no continuation changes a boundary.

    ``size`` gives a token's symbols. Merges are taken from the last rank to the first; ``reach`` of a
    merge (u, v) is |u| plus the best reach of a later merge that can follow it in a chain: one whose right
    part is u, or begins (along its own left parts) with the token uv.
    """
    left: dict[str, list[str]] = {}
    for u, v in merges:
        left.setdefault(u + v, []).append(u)

    def beginnings(token: str) -> set[str]:
        seen, todo = set(), [token]
        while todo:
            t = todo.pop()
            if t not in seen:
                seen.add(t)
                todo += left.get(t, [])
        return seen

    spine = {v: beginnings(v) for v in {v for _, v in merges}}
    exact: dict[str, int] = {}
    begins: dict[str, int] = {}
    best = 0
    for u, v in reversed(merges):
        reach = size[u] + max(exact.get(u, 0), begins.get(u + v, 0))
        best = max(best, reach)
        exact[v] = max(exact.get(v, 0), reach)
        for t in spine[v]:
            begins[t] = max(begins.get(t, 0), reach)
    return best


class Transducer:
    """Merges of one word, as a stream of symbols in and token ids out."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], word_end: str = ""):
        self.vocab, self.word_end = vocab, word_end
        self.rank = {pair: i for i, pair in enumerate(merges)}
        size = {t: len(t.removesuffix(word_end)) if word_end else len(t) for t in vocab}
        self.size = size
        self.longest = max(size.values(), default=1)
        self.lookahead = sufficient_lookahead(merges, size)

    def merge(self, symbols: list[str]) -> list[str]:
        """Symbols after all merges: lowest rank first, the leftmost of equal ones."""
        if len(symbols) > 48:
            return self._merge_long(symbols)
        rank, none, parts = self.rank.get, len(self.rank), list(symbols)
        ranks = [rank(p, none) for p in zip(parts, parts[1:])]  # noqa: B905
        while ranks:
            low = min(ranks)
            if low == none:
                break
            i = ranks.index(low)
            joined = parts[i] = parts[i] + parts[i + 1]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], joined), none)
            if i < len(ranks):
                ranks[i] = rank((joined, parts[i + 1]), none)
        return parts

    def _merge_long(self, symbols: list[str]) -> list[str]:
        n = len(symbols)
        parts: list[str | None] = list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, p in enumerate(zip(symbols, symbols[1:])) if (r := self.rank.get(p)) is not None]  # noqa: B905
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or self.rank.get((parts[i], parts[j])) != r:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (x := self.rank.get((parts[k], parts[after[k]]))) is not None:
                    heapq.heappush(heap, (x, k))
        return [p for p in parts if p is not None]

    def encode(self, symbols, window: int = SPAN):
        """Ids of a word given as any iterable of symbols; holds ``window`` + lookahead of them at most."""
        full = max(window, 2 * self.longest) + self.lookahead
        buffer: list[str] = []
        held = None
        for s in symbols:
            if held is not None:
                buffer.append(held)
            held = s
            if len(buffer) >= full:
                end = done = 0
                for token in self.merge(buffer):
                    end += self.size[token]
                    if end >= len(buffer) - self.lookahead:
                        break
                    yield self.vocab[token]
                    done = end
                del buffer[:done]
        if held is not None:
            buffer.append(held + self.word_end)
            for token in self.merge(buffer):
                yield self.vocab[token]


class Decoder:
    """Ids in, text out, one at a time."""

    def __init__(self, tokens: dict[int, str], as_bytes: bool = False, word_end: str = ""):
        self.tokens, self.as_bytes, self.word_end = tokens, as_bytes, word_end
        self.values = {c: b for b, c in enumerate(byte_symbols())}
        self.first = True
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: list[int]) -> str:
        """The text that these further ids complete; unknown ids are skipped."""
        try:
            parts = list(map(self.tokens.__getitem__, ids))
        except KeyError:
            parts = [t for i in ids if (t := self.tokens.get(i)) is not None]
        if not self.as_bytes:
            text = " ".join(parts)
            text = text if self.first or not parts else " " + text
            self.first = self.first and not parts
            return text
        out = bytearray()
        for t in parts:
            end = bool(self.word_end) and t.endswith(self.word_end)
            out += bytes(self.values[c] for c in (t.removesuffix(self.word_end) if end else t))
            out += b" " * end
        return self.utf8.decode(bytes(out))

    def close(self) -> str:
        return self.utf8.decode(b"", True) if self.as_bytes else ""


class Tokenizer:
    """A vocabulary file of the tokenizers library: BPE with word ends after a split by pattern."""

    def __init__(self, spec: dict, cached: int = 400_000):
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.word_end = model.get("end_of_word_suffix") or ""
        self.transducer = Transducer(model["vocab"], merges, self.word_end)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        ordered = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, ordered)) + ")") if ordered else None
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._split = regex.compile(split.replace("\\s", "\\p{White_Space}"))
        self._symbols = byte_symbols()
        self.pieces = Cache(self._piece, cached)
        self.words = Cache(self._word, cached)

    def _piece(self, piece: str) -> bytes:
        ids = list(self.transducer.encode(self._symbols[b] for b in piece.encode()))
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, raw: bytes) -> bytes:
        text = raw.decode()
        plain = text.replace("Σ", "σ").lower()
        if plain.isalpha() and unicodedata.is_normalized("NFC", text):  # letters only: one piece
            return self.pieces[plain]
        if self._special and "<" in text:
            parts = self._special.split(text)
        else:
            parts = [text]
        out = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(struct.pack("<I", self.special[part]))
            elif part:
                # lower case by code point: no special form of a final sigma
                low = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                out += [self.pieces[p] for p in self._split.findall(low)]
        return b"".join(out)

    def encode_stream(self, text: str | None):
        """Ids of a whole text as little-endian 32-bit integers, in bounded blocks.

        Words between ASCII blanks are independent of each other: no pattern, special token or
        composed character spans a blank.
        """
        data, at = (text or "").encode(), 0
        while at < len(data):
            # about BLOCK bytes up to the next blank: the words of one block are held, not those of the text
            blank = _BLANK.search(data, at + BLOCK)
            end = blank.start() if blank else len(data)
            yield b"".join([self.words[w] for w in data[at:end].split()])
            at = end

    def decoder(self, as_bytes: bool = False) -> Decoder:
        return Decoder(self.tokens, as_bytes, self.word_end)


def load_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _shared_tokenizer(docs: DataFrame, vocabulary: str):
    """A function that gives the Python worker's tokenizer; the file (bounded by its format) is broadcast."""
    spec = docs.sparkSession.sparkContext.broadcast(load_spec(vocabulary))
    state: dict = {}

    def get() -> Tokenizer:
        if "t" not in state:
            state["t"] = Tokenizer(json.loads(spec.value))
        return state["t"]

    return get


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids) of every whole text."""
    get = _shared_tokenizer(docs, vocabulary)

    def run(ids: list, texts: list) -> dict[str, list]:
        t = get()
        return {"doc_id": ids,
                "ids": [[i for (i,) in struct.iter_unpack("<I", b"".join(t.encode_stream(x)))] for x in texts]}

    return map_batches(docs, ["doc_id", "text"], "doc_id long, ids array<int>", run)


def decode(encoded: DataFrame, vocabulary: str, as_bytes: bool = False) -> DataFrame:
    """(doc_id, text) of every row of ids; null ids give null text."""
    get = _shared_tokenizer(encoded, vocabulary)

    def text_of(row: list | None) -> str | None:
        if row is None:
            return None
        d = get().decoder(as_bytes)
        return "".join([d.push(row[k:k + SPAN]) for k in range(0, len(row), SPAN)] + [d.close()])

    return map_batches(encoded, ["doc_id", "ids"], "doc_id long, text string",
                       lambda ids, rows: {"doc_id": ids, "text": [text_of(r) for r in rows]})


def digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Token count, digest of the ids and digest of the text decoded from them, for every text."""
    get = _shared_tokenizer(docs, vocabulary)

    def run(ids: list, texts: list) -> dict[str, list]:
        t = get()
        out: dict[str, list] = {"doc_id": ids, "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in texts:
            n, coded, plain, d = 0, hashlib.sha256(), hashlib.sha256(), t.decoder()
            for block in t.encode_stream(text):
                coded.update(block)
                n += len(block) // 4
                plain.update(d.push(memoryview(block).cast("I").tolist()).encode())
            plain.update(d.close().encode())
            out["n_tokens"].append(n)
            out["ids_sha256"].append(coded.hexdigest())
            out["decoded_sha256"].append(plain.hexdigest())
        return out

    return map_batches(docs, ["doc_id", "text"], SCHEMA, run)
