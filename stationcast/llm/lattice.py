"""Sums over all segmentations of words into vocabulary pieces, for many words at a time."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SPACE = 0x20     # stands for the word boundary that opens every word


@dataclass
class Vocabulary:
    """Pieces as bytes, their trie as a hash table of edges, and a prior from the file's scores."""

    pieces: list[bytes]
    prior: np.ndarray
    keys: np.ndarray      # node * 256 + byte, -1 where the slot is free
    child: np.ndarray
    piece: np.ndarray     # piece that ends in a node, -1 for none

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The child of each node along a byte, -1 for none."""
        key = node * 256 + byte
        slot = _slot(key, len(self.keys))
        out = np.full(len(key), -1, np.int64)
        open_ = np.arange(len(key))
        while len(open_):
            held = self.keys[slot]
            hit = held == key
            out[open_[hit]] = self.child[slot[hit]]
            go = ~hit & (held >= 0)
            open_, key, slot = open_[go], key[go], (slot[go] + 1) & (len(self.keys) - 1)
        return out


def _slot(key: np.ndarray, size: int) -> np.ndarray:
    mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - (size.bit_length() - 1))).astype(np.int64)


def load_vocabulary(path: str, scores: str = "ranks") -> Vocabulary:
    """Read the pieces and scores of a SentencePiece file.

    ``scores="log"`` takes them as log probabilities; ``"ranks"`` as minus the rank of a merge, as
    byte-pair files have them, whose prior follows Zipf's law. A piece for each of the 256 bytes is
    always there, so every text has a segmentation.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weight: dict[bytes, float] = {}
    lowest = model.get_piece_size()
    for k in range(model.get_piece_size()):
        if model.is_control(k) or model.is_unknown(k) or model.is_byte(k):
            continue
        raw = model.id_to_piece(k).replace("▁", " ").encode()
        if SPACE in raw[1:]:
            continue
        score = model.get_score(k)
        value = np.exp(score) if scores == "log" else 1.0 / (3.0 - score)
        weight[raw] = max(weight.get(raw, 0.0), float(value))
    floor = min(weight.values(), default=1.0) / 10 if scores == "log" else 1.0 / (10 * lowest)
    for byte in range(256):
        weight.setdefault(bytes([byte]), floor)
    return make_vocabulary(weight)


def make_vocabulary(weight: dict[bytes, float]) -> Vocabulary:
    pieces = sorted(weight)
    nodes, ends = {b"": 0}, [-1]
    edges: list[tuple[int, int]] = []
    for number, piece in enumerate(pieces):
        for k in range(1, len(piece) + 1):
            if piece[:k] not in nodes:
                nodes[piece[:k]] = len(ends)
                edges.append((nodes[piece[:k - 1]] * 256 + piece[k - 1], len(ends)))
                ends.append(-1)
        ends[nodes[piece]] = number
    size = 1 << max(4, (4 * len(edges)).bit_length())
    keys, child = np.full(size, -1, np.int64), np.zeros(size, np.int64)
    slots = _slot(np.array([k for k, _ in edges]), size).tolist()
    for slot, (key, node) in zip(slots, edges):
        while keys[slot] >= 0:
            slot = (slot + 1) & (size - 1)
        keys[slot], child[slot] = key, node
    prior = np.array([weight[p] for p in pieces])
    return Vocabulary(pieces, prior / prior.sum(), keys, child, np.array(ends))


class Lattice:
    """All arcs of some words: from node, to node, piece. Nodes of different words differ."""

    def __init__(self, vocabulary: Vocabulary, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Words are ``data[start:end]``; each is read with a boundary before it."""
        size = end - start + 1
        self.first = np.cumsum(size + 1) - (size + 1)     # node before each word's boundary
        self.last = self.first + size
        total = int(size.sum())
        offset = np.cumsum(size) - size
        text = np.full(total, SPACE, np.uint8)
        inner = np.ones(total, bool)
        inner[offset] = False
        place = np.arange(total) - np.repeat(offset + 1 - start, size)
        text[inner] = data[place[inner]]
        owner = np.repeat(np.arange(len(size)), size)
        at = np.arange(total)
        node = np.zeros(total, np.int64)
        alive, depth = at, 0
        source, target, piece = [], [], []
        while len(alive):
            node = vocabulary.step(node, text[alive + depth].astype(np.int64))
            keep = node >= 0
            alive, node = alive[keep], node[keep]
            depth += 1
            done = vocabulary.piece[node]
            full = done >= 0
            begin = alive[full] + owner[alive[full]]
            source.append(begin)
            target.append(begin + depth)
            piece.append(done[full])
            more = (alive + depth < total)
            more[more] &= owner[alive[more] + depth] == owner[alive[more]]
            alive, node = alive[more], node[more]
        none = np.zeros(0, np.int64)
        self.source = np.concatenate([none, *source])
        self.target = np.concatenate([none, *target])
        self.piece = np.concatenate([none, *piece])
        self.nodes = total + len(size)
        self.word = np.searchsorted(self.last, self.target)

    def forward(self, score: np.ndarray) -> np.ndarray:
        """Per node the log of the summed weight of all ways to it, by log-space recursion."""
        alpha = np.full(self.nodes, -np.inf)
        alpha[self.first] = 0
        self._sweep(alpha, self.target, self.source, self.target - self.first[self.word], score)
        return alpha

    def backward(self, score: np.ndarray) -> np.ndarray:
        beta = np.full(self.nodes, -np.inf)
        beta[self.last] = 0
        self._sweep(beta, self.source, self.target, self.last[self.word] - self.source, score)
        return beta

    def _sweep(self, total, into, out_of, layer, score):
        """Layer by layer of all words at once, sum what the arcs bring into each node."""
        order = np.lexsort((into, layer))
        into, out_of, weight = into[order], out_of[order], score[self.piece[order]]
        cuts = np.flatnonzero(np.diff(layer[order])) + 1
        for low, high in zip([0, *cuts], [*cuts, len(order)]):
            if low == high:
                continue
            value = total[out_of[low:high]] + weight[low:high]
            node = into[low:high]
            head = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            most = np.maximum.reduceat(value, head)
            spread = np.exp(value - np.repeat(most, np.diff(np.append(head, high - low))))
            total[node[head]] = most + np.log(np.add.reduceat(spread, head))

    def log_probability(self, score: np.ndarray) -> np.ndarray:
        return self.forward(score)[self.last]

    def expected(self, score: np.ndarray, count: np.ndarray, n_pieces: int) -> np.ndarray:
        """How often each piece is used over all segmentations, words weighted by ``count``."""
        alpha, beta = self.forward(score), self.backward(score)
        used = np.exp(alpha[self.source] + score[self.piece] + beta[self.target]
                      - alpha[self.last][self.word]) * count[self.word]
        return np.bincount(self.piece, used, n_pieces)
