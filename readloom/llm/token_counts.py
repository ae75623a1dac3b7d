"""Token counts by dynamic programming over a trie of distinct pre-tokens."""

from __future__ import annotations

import base64
import math

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's publisher cuts text before its pieces apply; a fixed value.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NODES = 1_000_000  # nodes that a task's trie grows to before it starts a new one; results do not depend on it
RECENT = 65_536  # scores of one very long pre-token that are kept before those out of any piece's reach go


def read_pieces(path: str = VOCABULARY) -> dict[bytes, int]:
    """Cost of each piece in millionths of a nat: -log of a Zipf law over the ranks of the vocabulary.

    None of the public vocabularies at hand has unigram scores and none may be trained; ranks, which were given by descending
    frequency of merges, stand in for them.

    A piece of several bytes with rank r costs log(r + 3); single bytes, of which any text can be made, cost
    as much as a piece behind the last one. The table is as large as the vocabulary file, whatever the input.
    """
    ranks = {}
    with open(path, "rb") as f:
        for line in f:
            piece, rank = line.split()
            ranks[base64.b64decode(piece)] = int(rank)
    last = len(ranks)
    pieces = {p: round(1e6 * math.log((r if len(p) > 1 else last) + 3)) for p, r in ranks.items()}
    for b in range(256):
        pieces.setdefault(bytes([b]), round(1e6 * math.log(last + 3)))
    return pieces


class ForwardTrie:
    """A trie of pre-tokens. Each node is a prefix and holds its forward score: the least cost of cutting the
    prefix into pieces, and of the cuts with that cost the least number of pieces. A prefix shared by many
    pre-tokens is scored once. `counts` maps each inserted pre-token to the pieces at its terminal node. The trie grows
    to `nodes` nodes at most: of a pre-token that does not fit, the rest is scored along the last prefixes without being stored."""

    def __init__(self, pieces: dict[bytes, int], nodes: int = NODES):
        self.pieces, self.nodes = pieces, nodes
        self.longest = max(map(len, pieces))
        self.clear()

    def clear(self) -> None:
        self.children: dict[tuple[int, int], int] = {}
        self.forward: list[tuple[int, int]] = [(0, 0)]
        self.counts: dict[str, int] = {}

    def insert(self, token: str) -> int:
        raw = token.encode("utf-8", "surrogatepass")
        children, forward, pieces, longest = self.children, self.forward, self.pieces, self.longest
        scores, base = [forward[0]], 0  # forward scores of the prefixes from length `base` on
        node: int | None = 0  # None: beyond what the trie may hold, scores are computed but not stored
        for depth, byte in enumerate(raw, 1):
            child = children.get((node, byte)) if node is not None else None
            if child is not None:
                best = forward[child]
            else:
                best = None
                for start in range(max(0, depth - longest), depth):
                    cost = pieces.get(raw[start:depth])
                    if cost is not None:
                        score, count = scores[start - base]
                        found = (score + cost, count + 1)
                        if best is None or found < best:
                            best = found
                if node is not None and len(forward) < self.nodes:
                    child = children[node, byte] = len(forward)
                    forward.append(best)
            scores.append(best)
            if len(scores) > RECENT:
                base += len(scores) - longest
                del scores[:-longest]
            node = child
        if node is not None:
            self.counts[token] = scores[-1][1]
        return scores[-1][1]

    def count(self, tokens: list[str]) -> int:
        counts, total = self.counts, 0
        try:
            return sum(map(counts.__getitem__, tokens))
        except KeyError:
            for t in tokens:
                n = counts.get(t)
                total += self.insert(t) if n is None else n
            return total


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per document: id, n_bytes (UTF-8), n_pretokens, n_tokens (long).

    n_tokens is the number of pieces in the cheapest cutting of each pre-token under the unigram costs of
    `vocabulary` (see read_pieces), added up over the text. Nothing is shuffled: each task keeps its own
    trie over the pre-tokens that it meets. A null or empty text has 0 of each.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(read_pieces(vocabulary))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        cut, trie = regex.compile(PATTERN), ForwardTrie(pieces.value)
        for b in batches:
            size, pre, tok = [], [], []
            for text in b.column(1):
                text = text.as_py() or ""
                found = cut.findall(text)
                size.append(len(text.encode("utf-8", "surrogatepass")))
                pre.append(len(found))
                tok.append(trie.count(found))
                if len(trie.forward) >= NODES:
                    trie.clear()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(pre, pa.int64()), pa.array(tok, pa.int64())], ["id", "n_bytes", "n_pretokens", "n_tokens"])

    out = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(run, f"id {id_type}, n_bytes long, n_pretokens long, n_tokens long")
    return out.withColumnRenamed("id", id_col)


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    """Per document: n_bytes, n_pretokens, n_tokens."""
    return count_tokens(table(spark, sf_dir, "documents"))
