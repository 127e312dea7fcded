"""Token counts (operator 2): greedy longest-match word pieces counted by one linear pass.

A trie of the vocabulary's pieces gets a failure link and a popped-piece count for every node.
When the next byte of a word has no edge, the automaton adds the node's popped count and follows
its link instead of going back in the text, so a word of n bytes costs O(n) steps and no piece is
ever built. A piece that starts with the vocabulary's word mark (``Ġ`` in byte-level vocabularies)
matches only at the start of a word, all others only inside it.

A word that cannot be covered counts as one unknown token. Null and blank texts have no words and
no tokens. Repeated rows and ids give repeated results. Other columns of the input are ignored.
"""

from __future__ import annotations

import base64

from pyspark.sql import DataFrame

from ._base import Cache, map_batches

SCHEMA = "doc_id long, n_tokens long, n_words long, n_unknown long"


def load_pieces(path: str) -> list[bytes]:
    """Pieces of a rank file (one base64 piece and its rank a line)."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class PieceAutomaton:
    """Longest-match automaton over byte pieces.

    ``edges[node * 256 + byte]`` is the child, ``fail[node]`` the failure link (-1: none) and
    ``popped[node]`` the number of pieces that following the link completes. Node 0 is the root
    (start of a word, where ``mark`` is the first byte) and node 1 the root inside words.
    """

    def __init__(self, pieces: list[bytes], mark: bytes = b" "):
        self.mark = mark
        self.edges: dict[int, int] = {}
        self.fail = [-1, -1]
        self.popped = [0, 0]
        final = [False, False]
        parents: list[tuple[int, int]] = [(-1, -1), (-1, -1)]
        for piece in pieces:
            if not piece:
                continue
            node = 0 if piece.startswith(mark) else 1
            for byte in piece:
                child = self.edges.get(node * 256 + byte)
                if child is None:
                    child = self.edges[node * 256 + byte] = len(parents)
                    parents.append((node, byte))
                    final.append(False)
                node = child
            final[node] = True
        self.fail += [-1] * (len(parents) - 2)
        self.popped += [0] * (len(parents) - 2)
        depth = [0, 0]
        for parent, _ in parents[2:]:
            depth.append(depth[parent] + 1)
        for node in sorted(range(2, len(parents)), key=depth.__getitem__):
            if final[node]:  # the whole node is one piece, the match goes on inside the word
                self.fail[node], self.popped[node] = 1, 1
                continue
            parent, byte = parents[node]
            z, n = self.fail[parent], self.popped[parent]
            while z >= 0:
                child = self.edges.get(z * 256 + byte)
                if child is not None:
                    self.fail[node], self.popped[node] = child, n
                    break
                n += self.popped[z]
                z = self.fail[z]

    def count(self, word: bytes) -> int:
        """Pieces of one word; -1 if it cannot be covered."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node = total = 0
        for byte in self.mark + word:
            child = edges.get(node * 256 + byte)
            while child is None:
                if fail[node] < 0:
                    return -1
                total += popped[node]
                node = fail[node]
                child = edges.get(node * 256 + byte)
            node = child
        while node != 1:
            if fail[node] < 0:
                return -1
            total += popped[node]
            node = fail[node]
        return total


def token_counts(docs: DataFrame, vocabulary: str, cached_words: int = 100_000) -> DataFrame:
    """Pieces, words and unknown words of every whole text.

    The vocabulary file (bounded by its format, some 50,000 pieces) is read once on the driver and
    broadcast; each Python worker builds the automaton once. ``cached_words`` bounds a worker's
    memory of word lengths.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(load_pieces(vocabulary))
    state: dict = {}

    def run(ids: list, texts: list) -> dict[str, list]:
        if "cache" not in state:
            state["cache"] = Cache(PieceAutomaton(pieces.value).count, cached_words)
        look = state["cache"].__getitem__
        out = {"doc_id": ids, "n_tokens": [], "n_words": [], "n_unknown": []}
        for text in texts:
            counts = list(map(look, (text or "").encode().split()))
            unknown = counts.count(-1)
            out["n_tokens"].append(sum(counts) + 2 * unknown)
            out["n_words"].append(len(counts))
            out["n_unknown"].append(unknown)
        return out

    return map_batches(docs, ["doc_id", "text"], SCHEMA, run)
