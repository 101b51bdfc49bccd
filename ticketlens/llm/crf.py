"""A skip-chain conditional random field: labels of tokens, chains of neighbours, and links between similar tokens.

Every token has a label: none, or the beginning or the inside of one kind of
entity. Potentials: features of a token with its label, labels of two neighbours,
and, for tokens of a text that are equal or similar however far apart, a link to a
variable of their own that holds the kind of all of them. Each link rewards a
token that agrees with it. So n similar tokens have n links, not a link a pair, and
what speaks for one occurrence speaks for all others.

The graph has loops, so marginals come from loopy sum-product message passing, a
fixed number of rounds over all messages at once; on a graph without loops, no
deeper than that, they are exact. Weights are fitted by gradient steps on the
likelihood of labelled tokens, with the same messages for its expectations.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

ROUNDS = 12
#: Hashed features; the last one is always there.
FEATURES = 1 << 12
STEPS = 100
RATE = 0.5
RIDGE = 1e-4


@dataclass
class Tokens:
    """Tokens of one or several texts, in order: hashed features, whether each follows the one before at once, and its link (-1: none)."""

    features: np.ndarray
    starts: np.ndarray
    follows: np.ndarray
    links: np.ndarray

    @property
    def n(self) -> int:
        return len(self.follows)

    @classmethod
    def gather(cls, features: Sequence[Sequence[int]], follows: Sequence[bool], groups: Sequence[object]) -> Tokens:
        """`groups`: what similar tokens of a text have in common, None for nothing; alone in its group a token has no link."""
        sizes = np.array([len(f) for f in features], dtype=np.int64)
        seen: dict[object, int] = {}
        for g in groups:
            if g is not None:
                seen[g] = seen.get(g, 0) + 1
        numbers = {g: i for i, g in enumerate(g for g, n in seen.items() if n > 1)}
        flat = np.fromiter((x for f in features for x in f), dtype=np.int64, count=int(sizes.sum()))
        links = np.array([numbers.get(g, -1) for g in groups], dtype=np.int64)
        return cls(flat, np.concatenate(([0], np.cumsum(sizes)))[:-1].astype(np.int64), np.array(follows, dtype=bool), links)


def _normal(x: np.ndarray) -> np.ndarray:
    """Log values shifted so that their exponentials sum to one."""
    top = x.max(axis=1, keepdims=True)
    return x - top - np.log(np.exp(x - top).sum(axis=1, keepdims=True))


def _through(cavity: np.ndarray, table: np.ndarray) -> np.ndarray:
    """log sum over the rows' states of exp(cavity + table), state by state, so that a row's result doesn't depend on others."""
    top = cavity.max(axis=1, keepdims=True)
    weight, factor = np.exp(cavity - top), np.exp(table)
    out = np.zeros((len(cavity), table.shape[1]))
    for j in range(table.shape[0]):
        out += weight[:, j : j + 1] * factor[j]
    return np.log(np.maximum(out, 1e-300)) + top


class Field:
    """The weights; labels are 0 for none, 2 k + 1 and 2 k + 2 for the beginning and the inside of kind k."""

    def __init__(self, kinds: int):
        labels = 2 * kinds + 1
        self.kind = (np.arange(labels) + 1) // 2
        self.token = np.zeros((FEATURES + 1, labels))
        self.pair = np.zeros((labels, labels))
        self.link = np.zeros(kinds + 1)
        self.shared = np.zeros(kinds + 1)

    def parts(self) -> list[np.ndarray]:
        return [self.token, self.pair, self.link, self.shared]

    def unary(self, t: Tokens) -> np.ndarray:
        """Scores of the tokens' own features, and of the words around a run of tokens, which have no label."""
        u = np.add.reduceat(self.token[t.features], t.starts, axis=0) if t.n else np.zeros((0, len(self.kind)))
        u = u + self.token[FEATURES]
        u[~t.follows] += self.pair[0]
        u[self._last(t)] += self.pair[:, 0]
        return u

    @staticmethod
    def _last(t: Tokens) -> np.ndarray:
        """Tokens that no other follows at once."""
        return ~np.append(t.follows[1:], False) if t.n else np.zeros(0, dtype=bool)

    def agreement(self) -> np.ndarray:
        """Potential of a label beside the kind its link holds."""
        return (self.kind[:, None] == np.arange(len(self.link))[None, :]) * self.link

    def messages(self, t: Tokens, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
        """Beliefs of tokens and links after some rounds, with what the gradient needs besides."""
        u, agree = self.unary(t), self.agreement()
        right = np.flatnonzero(t.follows)
        left = right - 1
        linked = np.flatnonzero(t.links >= 0)
        of = t.links[linked]
        hubs = int(of.max()) + 1 if len(of) else 0
        forward, backward = np.zeros((len(right), len(self.kind))), np.zeros((len(right), len(self.kind)))
        up, down = np.zeros((len(linked), len(self.link))), np.zeros((len(linked), len(self.kind)))
        for _ in range(rounds + 1):
            belief = u.copy()
            belief[right] += forward
            belief[left] += backward
            belief[linked] += down
            hub = np.tile(self.shared, (hubs, 1))
            for s in range(len(self.link)):
                hub[:, s] += np.bincount(of, weights=up[:, s], minlength=hubs)
            from_left, from_right = belief[left] - backward, belief[right] - forward
            from_token, from_hub = belief[linked] - down, hub[of] - up
            forward, backward = _normal(_through(from_left, self.pair)), _normal(_through(from_right, self.pair.T))
            up, down = _normal(_through(from_token, agree)), _normal(_through(from_hub, agree.T))
        return {
            "belief": _normal(belief) if t.n else belief, "hub": _normal(hub) if hubs else hub, "left": left, "right": right, "linked": linked, "of": of,
            "from_left": from_left, "from_right": from_right, "from_token": from_token, "from_hub": from_hub,
        }

    def labels(self, t: Tokens) -> np.ndarray:
        """The likeliest label of each token."""
        return self.messages(t)["belief"].argmax(axis=1) if t.n else np.zeros(0, dtype=np.int64)

    def _counts(self, t: Tokens, own: np.ndarray, pairs: np.ndarray, hub: np.ndarray, agreeing: np.ndarray) -> list[np.ndarray]:
        """Sufficient statistics, from the (expected) labels of tokens, neighbours and links."""
        token = np.zeros_like(self.token)
        sizes = np.diff(np.append(t.starts, len(t.features)))
        repeated = np.repeat(own, sizes, axis=0)
        for j in range(own.shape[1]):
            token[:FEATURES, j] = np.bincount(t.features, weights=repeated[:, j], minlength=FEATURES)
        token[FEATURES] = own.sum(axis=0)
        pair = pairs.copy()
        pair[0] += own[~t.follows].sum(axis=0)
        pair[:, 0] += own[self._last(t)].sum(axis=0)
        return [token, pair, agreeing, hub]

    def gradient(self, t: Tokens, labels: np.ndarray) -> list[np.ndarray]:
        """Observed less expected statistics."""
        m = self.messages(t)
        kinds, size = len(self.link), len(self.kind)
        true = np.eye(size)[labels]
        pairs = np.zeros((size, size))
        np.add.at(pairs, (labels[m["left"]], labels[m["right"]]), 1.0)
        of, own = m["of"], self.kind[labels[m["linked"]]]
        hubs = len(m["hub"])
        votes = np.zeros((hubs, kinds))
        np.add.at(votes, (of, own), 1.0)
        held = np.zeros(hubs, dtype=np.int64) if not hubs else np.where(votes[:, 1:].sum(axis=1) > 0, votes[:, 1:].argmax(axis=1) + 1, 0)
        seen = self._counts(t, true, pairs, np.eye(kinds)[held].sum(axis=0), np.bincount(own[own == held[of]], minlength=kinds).astype(float))

        expected_pairs = np.zeros((size, size))
        for at in range(0, len(m["left"]), 4096):
            joint = m["from_left"][at : at + 4096, :, None] + self.pair + m["from_right"][at : at + 4096, None, :]
            joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
            expected_pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        agreeing = np.zeros(kinds)
        if len(of):
            joint = m["from_token"][:, :, None] + self.agreement() + m["from_hub"][:, None, :]
            joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
            joint = (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            agreeing = np.array([joint[self.kind == s, s].sum() for s in range(kinds)])
        meant = self._counts(t, np.exp(m["belief"]), expected_pairs, np.exp(m["hub"]).sum(axis=0), agreeing)
        return [a - b for a, b in zip(seen, meant, strict=True)]

    def fit(self, t: Tokens, labels: np.ndarray, steps: int = STEPS) -> Field:
        """Steps of a size of each weight's own, smaller the more it has moved."""
        if not t.n:
            return self
        moved = [np.full_like(p, 1e-8) for p in self.parts()]
        for _ in range(steps):
            for p, g, m in zip(self.parts(), self.gradient(t, labels), moved, strict=True):
                g = g / t.n - RIDGE * p
                m += g * g
                p += RATE * g / np.sqrt(m)
        return self
