"""Words of running text as bits, each bit mixed from the counts of its contexts.

The WORDS most frequent words (used LEAST times or more), the end of a text and the mark OTHER (a word of
the rest, spelled elsewhere) are the leaves of a Huffman tree: a token is the
path to its leaf, a bit a node.  A bit has four predictions: the words' own
counts below the node, and counts in three hashed tables of (previous word, node),
(two previous words, node) and (class, node), the class being the one under which
the words of the text so far are likeliest.  Their log-odds, scaled by confidence, are
combined by the weights of a gate (depth, and how often the contexts were seen),
and an adaptive map (gate and old estimate → observed share) refines the result.

Learning is online, text after text: a batch is predicted with what the batches
before have left, moves weights and map, and is then added to the tables.  Tasks
learn apart; tables and maps are added up, weights averaged by use.  Both sides
of a node share one, so the chances of all tokens sum to one at every step.
Index arrays are made ``intp`` once: numpy casts others in slow steps at each use.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

from flowlake.llm.common import Words, mix64

WORDS = 1 << 12
LEAST = 8                      # uses of a word in the tree: the rarer ones teach what OTHER words cost
OTHER, END = 0, 1              # symbols; words come after them
CONTEXTS = 3
LEVELS = 4                     # of how often a context was seen
DEPTHS = 4
GATES = DEPTHS * LEVELS ** CONTEXTS
BINS = 24
BATCH = 1 << 14                # tokens that learn at once
STEP = 256                     # a table keeps log-odds in such parts
_ODD = 0x9E3779B1


def table_bits(tokens: int) -> int:
    """Slots of a context's table as a power of two: they grow with the training text, within bounds."""
    return min(max(int(np.ceil(np.log2(max(tokens, 1) / 64))), 16), 22)


class Tree:
    """The paths of all symbols and the words' hashes."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, other: int, ends: int):
        """counts: uses of the words by class."""
        weight = np.maximum(np.concatenate([[other, ends], counts.sum(1)]).astype(np.int64), 1)
        share = (counts + 0.5) / (counts.sum(0) + 0.5 * (len(counts) + 1))
        self.gain = np.vstack([np.zeros((2, counts.shape[1])), np.log(share)])
        self.prior = np.log((counts.sum(0) + 0.5) / (counts.sum() + 0.5 * counts.shape[1]))
        n = len(weight)
        self.hash = np.concatenate([np.zeros(2, np.uint64), hashes.astype(np.int64).view(np.uint64)])
        parent, side, mass = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.int8), np.zeros(2 * n - 1, np.int64)
        mass[:n] = weight
        ones = np.zeros(2 * n - 1, np.int64)
        heap = [(int(w), k) for k, w in enumerate(weight)]
        heapq.heapify(heap)
        for node in range(n, 2 * n - 1):
            (wa, a), (wb, b) = heapq.heappop(heap), heapq.heappop(heap)
            parent[a], parent[b], side[b] = node, node, 1
            mass[node], ones[node] = wa + wb, wb
            heapq.heappush(heap, (wa + wb, node))
        root, nodes, bits = 2 * n - 2, [], []
        self.length = np.zeros(n, np.int64)
        for k in range(n):
            path, at = [], k
            while at != root:
                path.append((parent[at], side[at]))
                at = parent[at]
            nodes += [p for p, _ in reversed(path)]
            bits += [s for _, s in reversed(path)]
            self.length[k] = len(path)
        self.start = np.cumsum(self.length) - self.length
        node = np.array(nodes, np.int64)
        depth = np.arange(len(node)) - np.repeat(self.start, self.length)
        self.bit = np.array(bits, np.int8)
        self.node_hash = (node * _ODD).astype(np.uint32)
        self.own = np.log((ones[node] + 0.4) / (mass[node] - ones[node] + 0.4)).astype(np.float32)
        self.depth = np.searchsorted([3, 6, 10], depth, side="right").astype(np.int32)
        # open addressing by the hash's top bits
        self.cells = np.full(1 << 18, -1, np.int32)
        for k in range(2, n):
            at = int(self.hash[k]) >> 46
            while self.cells[at] >= 0:
                at = (at + 1) & (len(self.cells) - 1)
            self.cells[at] = k

    def symbols(self, h: np.ndarray) -> np.ndarray:
        """The symbol of each word hash; OTHER for words without one."""
        at = (h >> np.uint64(46)).astype(np.int64)
        out = self.cells[at]
        live = np.flatnonzero((out >= 0) & (self.hash[out] != h))
        while len(live):
            at[live] = (at[live] + 1) & (len(self.cells) - 1)
            out[live] = self.cells[at[live]]
            live = live[(out[live] >= 0) & (self.hash[out[live]] != h[live])]
        out[out < 0] = OTHER
        return out


def short(h: np.ndarray) -> np.ndarray:
    """32 bits of word hashes, as contexts use them."""
    return (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def sequence(tree: Tree, symbol: np.ndarray, h: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbol, context hashes (CONTEXTS, tokens), row) of the rows' words, bound[i]..bound[i+1], and their ends."""
    rows, n = len(bound) - 1, len(symbol)
    row = np.repeat(np.arange(rows), np.diff(bound) + 1)
    at = np.arange(n) + np.repeat(np.arange(rows), np.diff(bound))
    token, word = np.full(n + rows, END, np.int32), np.zeros(n + rows + 2, np.uint64)
    token[at] = symbol
    word[at + 2] = h.astype(np.uint64) + np.uint64(1)
    first = bound[:-1] + np.arange(rows)
    before, earlier = word[1:-1].copy(), word[:-2].copy()
    before[first] = earlier[first] = 0
    with np.errstate(over="ignore"):
        one = mix64(before * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1))
        two = mix64(one + earlier * np.uint64(0xA0761D6478BD642F))
        kind = mix64(_likeliest(tree, token, first, row) * np.uint64(0xE7037ED1A0B428DB) + np.uint64(3))
    return token, np.stack([(x >> np.uint64(32)).astype(np.uint32) for x in (one, two, kind)]), row


def _likeliest(tree: Tree, token: np.ndarray, first: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Twice the likeliest class by the row's tokens before each one, and one more where it is clear."""
    classes = tree.gain.shape[1]
    if classes == 1:
        return np.zeros(len(token), np.uint64)
    gain = tree.gain[token.astype(np.intp)]
    total = np.cumsum(gain, axis=0) - gain
    total += tree.prior - total[first][row]
    best = total.argmax(1)
    top = total[np.arange(len(total)), best]
    total[np.arange(len(total)), best] = -np.inf
    return (2 * best + (top - total.max(1) > 2)).astype(np.uint64)


def learnable(words: Words, tree: Tree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(symbol, contexts) of batches of whole rows' tokens, cut at BATCH within longer ones."""
    token, context, _ = sequence(tree, tree.symbols(words.hash), short(words.hash), words.bound)
    for lo in range(0, len(token), BATCH):
        yield token[lo:lo + BATCH], context[:, lo:lo + BATCH]


class Mixer:
    """Gated weights, the map behind them, and the contexts' counts or, for scoring, their log-odds."""

    def __init__(self, bits: int):
        self.bits, self.steps = bits, 0
        self.counts = np.zeros((CONTEXTS, 1 << bits, 2), np.uint32)
        self.odds: np.ndarray | None = None
        self.weights = np.full((GATES, 1 + CONTEXTS), 0.3)
        self.uses = np.zeros(GATES)
        self.ones, self.every = np.zeros((GATES, BINS)), np.zeros((GATES, BINS))

    def freeze(self) -> "Mixer":
        """For scoring: log-odds and level of a slot in 16 bits, without the counts."""
        self.odds, self.counts = packed_odds(self.counts), None
        return self

    def state(self) -> np.ndarray:
        return np.concatenate([x.reshape(-1) for x in (self.weights * self.uses[:, None], self.uses, self.ones, self.every)])

    def merge(self, states: list[np.ndarray]) -> None:
        """Weights averaged by use, maps added."""
        total = np.sum(states, axis=0)
        cut = np.cumsum([self.weights.size, GATES, self.ones.size])
        weights, self.uses, ones, every = np.split(total, cut)
        used = self.uses > 0
        self.weights[used] = weights.reshape(self.weights.shape)[used] / self.uses[used, None]
        self.ones, self.every = ones.reshape(self.ones.shape), every.reshape(self.every.shape)

    def _steps(self, tree: Tree, token: np.ndarray, context: np.ndarray) -> tuple:
        """The tokens' numbers of bits; of all their bits: bit, slots, own counts' log-odds, depth."""
        token = token.astype(np.intp)
        length = tree.length[token]
        at = np.arange(int(length.sum())) + np.repeat(tree.start[token] - (np.cumsum(length) - length), length)
        node = tree.node_hash[at]
        shift = np.uint32(32 - self.bits)
        slots = [((np.repeat(c, length) + node) >> shift).astype(np.intp) for c in context]
        return length, tree.bit[at], slots, tree.own[at], tree.depth[at]

    def _mixed(self, xs: list[np.ndarray], levels: list[np.ndarray], depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gate = depth
        for level in levels:
            gate = gate * LEVELS + level
        gate = gate.astype(np.intp)
        weights = np.ascontiguousarray(self.weights.T, np.float32)
        z = sum(x * weights[k][gate] for k, x in enumerate(xs))
        return np.clip(z, -14, 14), gate

    @staticmethod
    def _bin(z: np.ndarray) -> np.ndarray:
        return np.clip((z + 9) * (BINS / 18), 0, BINS - 1).astype(np.intp)

    def learn(self, tree: Tree, token: np.ndarray, context: np.ndarray) -> None:
        _, bit, slots, own, depth = self._steps(tree, token, context)
        # a slot's two counts are read as one number
        pairs = [self.counts[k].view(np.uint64).reshape(-1)[slots[k]].view(np.uint32).reshape(-1, 2) for k in range(CONTEXTS)]
        seen = [_odds(p) for p in pairs]
        xs = [own, *(x for x, _ in seen)]
        z, gate = self._mixed(xs, [level for _, level in seen], depth)
        one, bit = bit.astype(np.intp), bit.astype(np.float32)
        error = bit - 1 / (1 + np.exp(-z))
        cell = gate * BINS + self._bin(z)
        every = np.bincount(cell, minlength=GATES * BINS).reshape(GATES, BINS)
        self.every += every
        self.ones += np.bincount(cell, weights=bit, minlength=GATES * BINS).reshape(GATES, BINS)
        uses, rate = every.sum(1), max(0.5 / (1 + 0.02 * self.steps), 0.02)
        for k, x in enumerate(xs):
            slope = np.bincount(gate, weights=error * x, minlength=GATES)
            self.weights[:, k] += rate * slope / (uses * float(np.dot(x, x)) / (4 * len(x)) + 32)
        self.uses += uses
        self.steps += 1
        for k in range(CONTEXTS):
            np.add.at(self.counts[k].reshape(-1), slots[k] * 2 + one, np.uint32(1))

    def log10(self, tree: Tree, token: np.ndarray, context: np.ndarray) -> np.ndarray:
        """log10 probability of each token, by the frozen tables."""
        share = ((self.ones + 0.5) / (self.every + 1)).astype(np.float32).reshape(-1)
        trust = (self.every / (self.every + 64) * 0.5).astype(np.float32).reshape(-1)
        out = np.empty(len(token))
        for lo in range(0, len(token), BATCH):
            length, bit, slots, own, depth = self._steps(tree, token[lo:lo + BATCH], context[:, lo:lo + BATCH])
            packed = [self.odds[k][slots[k]] for k in range(CONTEXTS)]
            xs = [own, *((v >> 2).astype(np.float32) * np.float32(1 / STEP) for v in packed)]
            z, gate = self._mixed(xs, [v & np.int16(LEVELS - 1) for v in packed], depth)
            p = 1 / (1 + np.exp(-z))
            cell = gate * BINS + self._bin(z)
            p += trust[cell] * (share[cell] - p)
            p = np.clip(np.where(bit == 1, p, 1 - p), 1e-6, 1 - 1e-6)
            out[lo:lo + BATCH] = np.bincount(np.repeat(np.arange(len(length)), length), weights=np.log10(p), minlength=len(length))
        return out


def packed_odds(pair: np.ndarray) -> np.ndarray:
    """Log-odds and level of counts (.., 2) in 16 bits."""
    x, level = _odds(pair)
    return np.rint(x * STEP).astype(np.int16) * np.int16(LEVELS) + level


def _odds(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds scaled by confidence, and the level of how often the context was seen, of counts (.., 2)."""
    n0, n1 = pair[..., 0].astype(np.float32), pair[..., 1].astype(np.float32)
    n = n0 + n1
    n1 += np.float32(0.4)
    n0 += np.float32(0.4)
    n1 /= n0
    x = np.log(n1, out=n1)
    x *= n / (n + np.float32(0.5))
    return x, (n > 0).astype(np.int8) + (n > 2) + (n > 10)
